"""Health and recommendations: bounds, planted facts, reporting day."""

import datetime

import pytest
from pyspark.sql import functions as F

from joinscope.operators import health, patterns, recommend
from joinscope.plans import report
from joinscope.schemas import HEALTH_COLUMNS, RECOMMENDATION_COLUMNS
from workload import log_fixture as fx


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    p = patterns.join_patterns(fx.query_log(spark, sf_dir)).persist()
    return fx.usage_metrics(spark, sf_dir).persist(), fx.column_usage_metrics(spark, sf_dir), p


@pytest.fixture(scope="module")
def result(inputs):
    recs, summary = report.health_report(*inputs)
    return recs.collect(), summary.collect(), recs.columns, summary.columns


def test_schemas(result):
    assert tuple(result[2]) == RECOMMENDATION_COLUMNS and tuple(result[3]) == HEALTH_COLUMNS


def test_scores_are_bounded(result):
    for row in result[1]:
        for name in HEALTH_COLUMNS[2:9]:
            assert 0 <= row[name] <= 100
        assert row.recommendation_score == pytest.approx(100 - row.overall_health_score, abs=0.006)


def test_missing_metadata_is_reported(result):
    score = {r.data_product_name: r.metadata_score for r in result[1]}
    assert score["product_7"] == score["product_9"] == 75.0 and score["product_1"] == 100.0
    governed = {r.data_product_name for r in result[0] if r.recommendation_type == "DATA_GOVERNANCE"}
    assert governed == {"product_7", "product_9"}


def test_recommendations_are_complete(result):
    recs = result[0]
    assert sorted(r.row_id for r in recs) == list(range(1, len(recs) + 1))
    ids = {r.row_id: r.recommendation_id for r in recs}
    assert ids[1] == "REC-000001"
    types = {rule.type for rule in recommend.RULES}
    assert len(types) == 13
    for r in recs:
        assert r.recommendation_type in types and r.status == "NEW"
        assert 0 <= r.estimated_impact_score <= 100 and 0 <= r.confidence_score <= 1
        assert r.recommendation_priority in ("HIGH", "MEDIUM", "LOW") and "null" not in r.recommendation_reason.split()[0]


def test_later_reporting_day_ages_products(inputs):
    later = datetime.date(2024, 3, 15)
    scored = report.scored_products(*inputs, as_of=later)
    assert {r.freshness_score for r in scored.select("freshness_score").collect()} == {0.0}
    fired = recommend.fired_rules(scored).filter("recommendation_type = 'ARCHIVAL'")
    assert fired.count() == scored.count()


def test_self_join_counts_once(spark):
    row = ("2026-01-01", "s", "t", "s", "t", "INNER", "a=b", 5)
    df = spark.createDataFrame([row], "log_date string, left_table_database string, left_table_name string, right_table_database string, right_table_name string, join_type string, join_keys string, join_count long")
    hot = patterns.join_hotspots(df).collect()
    assert [(r.tbl, r.total_joins, r.partners) for r in hot] == [("t", 5, 1)]


def test_equal_usage_scores(spark):
    day = datetime.date(2026, 1, 1)
    rows = [("p1", "d", "t", "i", 1, 1, 1, 1, 1.0, 0, day), ("p2", "d", "u", "i", 1, 1, 1, 1, 1.0, 0, day)]
    usage = spark.createDataFrame(
        rows, "data_product_name string, data_object_database_name string, data_product_object_name string, data_product_object_id string, "
        "user_query_count long, app_query_count long, unique_user long, unique_app long, total_execution_time_in_seconds double, "
        "failed_query_count long, metric_date date",
    )
    rollup = health.usage_rollup(usage)
    scores = rollup.select(health._usage_score(rollup).alias("s")).collect()
    assert {r.s for r in scores} == {100.0}


def test_product_without_a_name_has_all_scores(spark, inputs):
    usage, columns, joins = inputs
    named = F.when(F.col("data_product_name") != "product_3", F.col("data_product_name"))
    recs, summary = report.health_report(usage.withColumn("data_product_name", named), columns, joins)
    row = summary.where("data_product_name is null").collect()
    assert len(row) == 1 and all(row[0][c] is not None for c in HEALTH_COLUMNS[2:9])
    assert row[0].metadata_score < 100
    assert recs.where("data_product_name is null and recommendation_type = 'DATA_GOVERNANCE'").count() == 1


def test_top_join_keys_and_rare_columns(spark):
    """A key of two patterns is in the top tenth here; one table has a rare column and none has unused ones."""
    day = datetime.date(2026, 1, 1)
    usage = spark.createDataFrame(
        [(f"p{i}", "s", f"t{i}", f"id{i}", 10 + i, 1, 1, 1, 1.0, 0, day) for i in range(5)],
        "data_product_name string, data_object_database_name string, data_product_object_name string, data_product_object_id string, "
        "user_query_count long, app_query_count long, unique_user long, unique_app long, total_execution_time_in_seconds double, "
        "failed_query_count long, metric_date date",
    )
    joined = [("2026-01-01", f"t{i}", f"k{i}") for i in range(5)] + [("2026-01-02", "t2", "k2")]
    joins = spark.createDataFrame(
        [(d, "s", t, "x", f"o{t}", "INNER", f"{k}={k}", 1) for d, t, k in joined],
        "log_date string, left_table_database string, left_table_name string, right_table_database string, right_table_name string, "
        "join_type string, join_keys string, join_count long",
    )
    columns = spark.createDataFrame(
        [(f"t{i}", f"c{j}", 1 if (i, j) == (3, 0) else 100) for i in range(5) for j in range(2)], "table_name string, column_name string, usage_count long"
    )
    rare_from = columns.where("usage_count = 1").unionByName(columns.where("usage_count > 1").limit(3))
    fired = recommend.fired_rules(report.scored_products(usage, rare_from, joins)).collect()
    of = lambda kind: {r.data_product_name for r in fired if r.recommendation_type == kind}
    assert of("INDEX_RECOMMENDATION") == {"p2"}
    assert of("COLUMN_OPTIMIZATION") == {"p3"}
    reason = next(r.recommendation_reason for r in fired if r.recommendation_type == "COLUMN_OPTIMIZATION")
    assert reason.startswith("0 of ") and "1 are among the rarely used" in reason
