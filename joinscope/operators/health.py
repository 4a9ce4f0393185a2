"""Data-product health: five scores from usage, columns and join patterns together."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.functions import scores
from joinscope.operators.correlate import product_objects, usage_with_columns
from joinscope.operators.distribution import quantiles, value_positions
from joinscope.operators.patterns import join_hotspots, pattern_sides, repeated_pairs
from joinscope.operators.usage import DATABASE, OBJECT, PRODUCT, _long, column_usage, usage_rollup
from joinscope.schemas import HEALTH_COLUMNS
from joinscope.session import materialize

# A join key is an index candidate from this many patterns on.
INDEX_PATTERNS = 3
# A pair is a candidate for a stored join from this many days on.
REPEAT_DAYS = 3
# Failure rates above this percentage are frequent failures.
FREQUENT_FAILURES = 5.0
# Days without activity until the freshness score is zero.
FRESH_DAYS = 30

# Points off the optimization score.
DEDUCTIONS = {
    "slow": 20,
    "many_joins": 15,
    "often_failing": 20,
    "index_candidate": 15,
    "slow_and_many_joins": 15,
    "has_unused_columns": 15,
}

_METADATA = (PRODUCT, DATABASE, OBJECT, "data_product_object_id")


def as_of_date(usage: DataFrame, as_of: datetime.date | None) -> Column:
    """The reporting day: given, or the latest day in the data."""
    if as_of is not None:
        return F.lit(as_of)
    return usage.agg(F.max("metric_date")).scalar()


def metadata_completeness(usage: DataFrame) -> DataFrame:
    """Share of filled name fields per product, in percent."""
    filled = sum((F.coalesce(F.trim(c) != "", F.lit(False)).cast("int") for c in _METADATA), F.lit(0))
    return usage.groupBy(PRODUCT).agg(
        F.round(100.0 * F.sum(filled) / (F.count("*") * len(_METADATA)), 2).alias("metadata_score"),
        F.min("data_product_object_id").alias("product_id"),
    )


def _usage_score(rollup: DataFrame) -> Column:
    """Mean of the four usage metrics, each scaled by the least and most of all products."""
    metrics = ("user_queries", "app_queries", "users", "apps")
    span = rollup.agg(
        F.struct(*[f(m).alias(f"{n}_{m}") for m in metrics for n, f in (("lo", F.min), ("hi", F.max))]).alias("span")
    ).scalar()

    def scaled(m: str) -> Column:
        lo, hi = span.getField(f"lo_{m}"), span.getField(f"hi_{m}")
        return F.when(hi > lo, (F.col(m) - lo) / (hi - lo)).when(hi > 0, 1.0).otherwise(0.0)

    return F.round(100.0 * sum((scaled(m) for m in metrics[1:]), scaled(metrics[0])) / len(metrics), 2)


def _join_features(usage: DataFrame, patterns: DataFrame) -> DataFrame:
    """Per product: joins, partners, index candidates and stored-join candidates of its objects."""
    sides = pattern_sides(patterns)
    keys = sides.filter(F.col("side_key").isNotNull()).groupBy("db", "tbl", "side_key").agg(F.count("*").alias("seen"))
    keys = materialize(keys)
    often = quantiles(value_positions(_long(keys, ["seen"])), {"p90": ("seen", 0.9)}).scalar()
    keyed = keys.groupBy("db", "tbl").agg(
        F.max("seen").alias("key_patterns"),
        F.bool_or(F.col("seen") >= often).alias("top_key"),
        F.max(F.when(F.contains("side_key", F.lit(",")), F.col("seen"))).alias("composite_patterns"),
    )
    pairs = repeated_pairs(patterns)
    limit = quantiles(value_positions(_long(pairs, ["total_joins"])), {"p90": ("total_joins", 0.9)}).scalar()
    stored = pairs.filter((F.col("days") >= REPEAT_DAYS) & (F.col("total_joins") >= limit))
    touched = F.explode(
        F.array_distinct(
            F.array(
                F.struct(F.lower("left_table_database").alias("db"), F.lower("left_table_name").alias("tbl")),
                F.struct(F.lower("right_table_database").alias("db"), F.lower("right_table_name").alias("tbl")),
            )
        )
    )
    stored = stored.select(touched.alias("s"), "total_joins", "days").groupBy("s.db", "s.tbl").agg(
        F.max("days").alias("stored_days"), F.max("total_joins").alias("stored_joins")
    )
    at = ["db", "tbl"]
    objects = (
        product_objects(usage).join(join_hotspots(patterns), at, "left").join(keyed, at, "left").join(stored, at, "left")
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    return objects.groupBy(PRODUCT).agg(
        zero(F.sum("total_joins")).alias("joins"),
        zero(F.max("partners")).alias("partners"),
        zero(F.max("key_patterns")).alias("key_patterns"),
        zero(F.max("composite_patterns")).alias("composite_patterns"),
        F.coalesce(F.bool_or("top_key"), F.lit(False)).alias("top_key"),
        zero(F.max("stored_days")).alias("stored_days"),
        zero(F.max("stored_joins")).alias("stored_joins"),
    )


def _column_features(usage: DataFrame, columns: DataFrame) -> DataFrame:
    """Per product: columns of its objects, unused ones, and those rarely used among all used columns."""
    rare = column_usage(columns).filter(F.col("usage_class") == "rare").groupBy(F.col("table_name").alias("tbl")).agg(
        F.count("*").alias("rare_columns")
    )
    return usage_with_columns(usage, columns).join(rare, "tbl", "left").groupBy(PRODUCT).agg(
        F.sum("columns").alias("columns"),
        F.sum("unused_columns").alias("unused_columns"),
        F.coalesce(F.sum("rare_columns"), F.lit(0)).alias("rare_columns"),
    )


def _with(df: DataFrame, more: DataFrame) -> DataFrame:
    """Left join on the product, where products without a name are one product too."""
    more = more.withColumnRenamed(PRODUCT, "_product")
    return df.join(more, F.col(PRODUCT).eqNullSafe(F.col("_product")), "left").drop("_product")


def product_features(
    usage: DataFrame, columns: DataFrame, patterns: DataFrame, as_of: datetime.date | None = None
) -> DataFrame:
    """One row per product with everything the scores and rules need; materialised."""
    rollup = materialize(usage_rollup(usage))
    day = as_of_date(usage, as_of)
    failure = F.coalesce("failure_rate", F.lit(0.0))
    df = (
        rollup.withColumn("usage_score", _usage_score(rollup))
        .transform(_with, metadata_completeness(usage))
        .transform(_with, _column_features(usage, columns))
        .transform(_with, _join_features(usage, patterns))
        .withColumns(
            {
                "as_of": day,
                "idle_days": F.datediff(day, "last_active"),
                "failure_rate": failure,
                "quality_score": F.round(F.greatest(F.least(100.0 - failure, F.lit(100.0)), F.lit(0.0)), 2),
            }
        )
        .withColumn(
            "freshness_score",
            F.round(100.0 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - F.col("idle_days") / FRESH_DAYS)), 2),
        )
    )
    return materialize(df)


def with_flags(features: DataFrame) -> DataFrame:
    """Add the quantile limits of all products and the flags that cost optimization points."""
    positions = value_positions(
        _long(features, ["average_seconds", "total_seconds", "joins", "queries", "usage_score"])
    )
    limits = quantiles(
        positions,
        {
            "slow_from": ("average_seconds", 0.9),
            "heavy_from": ("total_seconds", 0.9),
            "joins_from": ("joins", 0.9),
            "median_queries": ("queries", 0.5),
            "used_from": ("usage_score", 0.75),
            "high_usage_from": ("usage_score", 0.9),
            "low_usage_to": ("usage_score", 0.1),
        },
    )
    limit = limits.select(F.struct(*limits.columns)).scalar()
    df = features.withColumn("limits", limit)
    no = lambda c: F.coalesce(c, F.lit(False))
    df = df.withColumns(
        {
            "slow": no(F.col("average_seconds") >= F.col("limits.slow_from")),
            "many_joins": no((F.col("joins") > 0) & (F.col("joins") >= F.col("limits.joins_from"))),
            "often_failing": no(F.col("failure_rate") > FREQUENT_FAILURES),
            "index_candidate": no(F.col("key_patterns") >= INDEX_PATTERNS),
            "has_unused_columns": no(F.col("unused_columns") > 0),
        }
    )
    return df.withColumn("slow_and_many_joins", F.col("slow") & F.col("many_joins"))


def _optimization_score() -> Column:
    points = [F.when(F.col(flag), cost).otherwise(0) for flag, cost in DEDUCTIONS.items()]
    return F.greatest(F.lit(100) - sum(points[1:], points[0]), F.lit(0)).cast("double")


def score_products(flagged: DataFrame) -> DataFrame:
    """Add optimization, overall and recommendation score."""
    df = flagged.withColumn("optimization_score", _optimization_score())
    parts = ("usage_score", "quality_score", "metadata_score", "freshness_score", "optimization_score")
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    df = df.withColumn("overall_health_score", F.round(total / len(parts), 2))
    return df.withColumn("recommendation_score", F.round(100.0 - F.col("overall_health_score"), 2))


def health_summary(scored: DataFrame) -> DataFrame:
    """The ten-column health table, one row per product."""
    return scored.withColumns(
        {"row_wid": scores.row_wid(F.coalesce(PRODUCT, F.lit("")), F.lit("health")), "last_updated": F.current_timestamp()}
    ).select(*HEALTH_COLUMNS)
