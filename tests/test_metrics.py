"""Metrics, numbering and quantiles against plain Python on small and skewed data."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from joinscope import modes
from joinscope.operators import distribution
from joinscope.operators.extract import explode_pairs, extract_pairs
from joinscope.operators.metrics import counted_pairs, pair_metrics
from joinscope.operators.numbering import number_rows
from joinscope.plans import lineage
from workload.log_fixture import query_log


@pytest.fixture(scope="module")
def log(spark, sf_dir):
    return query_log(spark, sf_dir).persist()


def table(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("mode", [modes.NEAREST_PRECEDING, modes.PER_BLOCK, modes.PER_BLOCK_QUALIFIED], ids=lambda m: m.name)
def test_counts_add_up(log, mode):
    metrics = pair_metrics(counted_pairs(log, mode), mode)
    rows = explode_pairs(extract_pairs(log, mode)).count()
    total = metrics.agg(F.sum("join_count").alias("j"), F.sum("query_count").alias("q")).first()
    if mode.join_count == "rows":
        assert total.j == rows
    if mode.query_count == "queries":
        assert metrics.filter("query_count > join_count").count() == 0
    else:
        assert total.q == rows


def test_partitioning_does_not_matter(spark, log):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = table(lineage.pair_lineage(log, "all_scopes"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        assert table(lineage.pair_lineage(log.repartition(5), "all_scopes")) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("mode", [modes.NEAREST_PRECEDING, modes.PER_BLOCK_QUALIFIED, modes.TOP_LEVEL], ids=lambda m: m.name)
def test_combining_repeats_changes_nothing(log, mode):
    plain = pair_metrics(counted_pairs(log, mode), mode)
    combined = pair_metrics(counted_pairs(log.union(log), mode, combine_repeats=True), mode)
    doubled = pair_metrics(counted_pairs(log.union(log), mode), mode)
    assert table(combined) == table(doubled)
    assert table(pair_metrics(counted_pairs(log, mode, combine_repeats=True), mode)) == table(plain)


def test_bad_dates(spark):
    row = ("u", "s", "orders", "SELECT 1 FROM a JOIN b ON a.k = b.k", None, None, None)
    log = spark.createDataFrame(
        [row], "user_name string, Db_nm string, Tbl_nm string, SqlTextInfo string, LogDate timestamp_ntz, StartTime timestamp_ntz, LastResponseTime timestamp_ntz"
    )
    wid = lambda mode: [(r.date_wid, r["Metric date"], r.avg_runtime) for r in lineage.pair_lineage(log, mode).collect()]
    assert wid("top_level") == [] and wid("all_scopes") == []
    assert wid("nearest_preceding") == [("", "", None)]
    assert wid("per_block") == [("00000000", "", None)]


def test_numbering_with_hot_keys_and_nulls(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "hot", "hot", "hot", "b", "c"]), rng.randint(0, 5), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b int, c int").repartition(16)
    got = {tuple(r)[1:]: r.id for r in number_rows(df, ("a", "-b", "c"), "id").collect()}
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1], r[2]))
    assert [got[r] for r in want] == list(range(1, 3001))
    single = number_rows(df.select("c"), ("-c",), "id").orderBy("id").collect()
    assert [(r.id, r.c) for r in single] == [(i + 1, 2999 - i) for i in range(3000)]


def test_numbering_within_groups(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, "hot", "hot", "hot", "b"]), rng.randint(0, 99), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, a int, c int").repartition(16)
    got = {(r.g, r.a, r.c): r.id for r in number_rows(df, ("-a", "c"), "id", within=("g",), ranges=23).collect()}
    for g in (None, "hot", "b"):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        assert [got[r] for r in mine] == list(range(1, len(mine) + 1))
    assert number_rows(df.limit(0), ("a",), "id", within=("g",)).count() == 0


def test_close_values_are_cut_into_many_ranges(spark):
    close = spark.range(100_000).select(F.lit("m").alias("metric"), (F.lit(10.0) + F.col("id") / 1e8).alias("value"))
    both = close.unionByName(spark.createDataFrame([("m", -1e300), ("m", 1e300)], "metric string, value double"))
    positions = distribution.value_positions(both)
    plan = positions._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" in plan
    below = {r.value: r.below for r in positions.where("value in (-1e300, 10.0, 10.0005, 1e300)").collect()}
    assert below[-1e300] == 0 and below[10.0] == 1 and below[1e300] == 100_001
    shares = [(k + 1) / (distribution.SPLITTERS + 1) for k in range(distribution.SPLITTERS)]
    cuts = sorted(set(close.agg(F.percentile_approx("value", shares, 10_000)).first()[0]))
    assert len(cuts) > 200 and max(b - a for a, b in zip(cuts, cuts[1:], strict=False)) < 1e-5


def test_quantiles_and_ranks(spark):
    rng = random.Random(2)
    # A third of all values is the same, and some are negative or missing.
    values = [0.0] * 400 + [rng.uniform(-50, 1e6) for _ in range(797)] + [rng.uniform(0, 1) for _ in range(3)]
    df = spark.createDataFrame([("m", v) for v in values] + [("m", None), ("one", 7.0)], "metric string, value double")
    positions = distribution.value_positions(df)
    got = distribution.quantiles(positions, {"p10": ("m", 0.1), "p50": ("m", 0.5), "p90": ("m", 0.9), "lone": ("one", 0.9)}).first()
    ordered = sorted(values)

    def exact(p):
        at = p * (len(ordered) - 1)
        low = int(at)
        high = min(low + 1, len(ordered) - 1)
        return ordered[low] + (ordered[high] - ordered[low]) * (at - low)

    assert got.p10 == pytest.approx(exact(0.1)) and got.p90 == pytest.approx(exact(0.9))
    assert got.p50 == pytest.approx(statistics.median(values)) and got.lone == 7.0
    ranks = distribution.percent_ranks(df.filter("metric = 'm'"), positions).collect()
    for r in ranks:
        want = None if r.value is None else sum(v < r.value for v in values) / (len(values) - 1)
        assert r.percent_rank == (None if want is None else pytest.approx(want))


@pytest.mark.parametrize("mode", modes.MODES.values(), ids=lambda m: m.name)
def test_no_expensive_expression_runs_twice(log, mode):
    """The scope fold appears once in the plan of a whole pipeline, and nothing runs in Python."""
    df = pair_metrics(counted_pairs(log, mode), mode)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(aggregate(") == (0 if mode.scope == "nearest_preceding" else 1)
    assert "EvalPython" not in plan and "Cartesian" not in plan
