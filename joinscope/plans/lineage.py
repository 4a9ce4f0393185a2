"""Log-to-lineage pipelines, one per result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinscope import modes
from joinscope.functions import pairs, scores
from joinscope.operators import extract
from joinscope.operators.metrics import counted_pairs, daily_pair_metrics, pair_metrics
from joinscope.schemas import SCORED_COLUMNS, SLIM_COLUMNS


def pair_lineage(log: DataFrame, mode: modes.Mode | str, **options) -> DataFrame:
    """Ten-column daily pair metrics in any extraction mode."""
    mode = modes.MODES[mode] if isinstance(mode, str) else mode
    return daily_pair_metrics(log, mode, **options)


def bare_lineage(log: DataFrame, **options) -> DataFrame:
    """Per-block lineage with bare table names, join-free queries included."""
    return daily_pair_metrics(log, modes.PER_BLOCK, **options)


def _products(log: DataFrame, **text_options) -> DataFrame:
    mode = modes.PER_BLOCK_QUALIFIED
    metrics = pair_metrics(counted_pairs(log, mode, **text_options), mode)
    return metrics.withColumnsRenamed(
        {"left_join_table_name": "left_data_product_name", "right_join_table_name": "right_data_product_name"}
    )


def scored_lineage(log: DataFrame, random_ids: bool = False, **text_options) -> DataFrame:
    """Fifteen-column lineage with ids, domain similarity and recommendation score.

    Row ids come from the row's key, so that a rerun gives the same ids; ``random_ids`` draws
    new ones. The log has no run times for this table: ``avg_runtime`` is -1.
    """
    left, right, day = F.col("left_data_product_name"), F.col("right_data_product_name"), F.col("date_wid")
    similarity = scores.domain_similarity(scores.domain(left), scores.domain(right))
    made = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    df = _products(log, **text_options).withColumns(
        {
            "row_wid": scores.random_row_wid() if random_ids else scores.row_wid(left, right, day),
            "metric_wid": scores.pair_wid(left, right, day),
            "left_data_product_id": scores.wid(left),
            "right_data_product_id": F.when(right != "", scores.wid(right)).otherwise(""),
            "avg_runtime": F.lit(-1.0),
            "domain_similarity_score": F.round(similarity, 4),
            "recommendation_score": scores.recommendation_score(
                F.col("join_count"), F.col("query_count"), F.col("unique_users"), similarity
            ),
            "created_timestamp": F.date_format(made, "yyyy-MM-dd HH:mm:ss"),
        }
    )
    return df.select(*SCORED_COLUMNS)


def slim_lineage(log: DataFrame, random_ids: bool = False, **text_options) -> DataFrame:
    """Seven-column lineage."""
    left, right, day = F.col("left_data_product_name"), F.col("right_data_product_name"), F.col("date_wid")
    df = _products(log, **text_options).withColumns(
        {
            "row_wid": scores.random_row_wid() if random_ids else scores.row_wid(left, right, day, F.lit("slim")),
            "metric_date": F.col("Metric date"),
        }
    )
    return df.select(*SLIM_COLUMNS)


def parse_funnel(parsed: DataFrame) -> DataFrame:
    """How many ragged records came through: parsed, or skipped and why."""
    sql = F.col("_sql")
    df = parsed.withColumn("_sql", extract.clean_sql(F.col("SqlTextInfo"), modes.NEAREST_PRECEDING))
    found = F.when(F.col("parse_error").isNull() & (sql != ""), F.expr(pairs.nearest_preceding("_sql")))
    df = df.withColumn("_pairs", found)
    status = F.coalesce(
        F.col("parse_error"),
        F.when(sql == "", "empty SQL"),
        F.when(F.size("_pairs") > 0, "parsed").otherwise("no join pair"),
    )
    return df.groupBy(status.alias("status")).agg(F.count("*").alias("records"))
