"""Rollups and rankings of the usage, column and run-time metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joinscope.operators.distribution import quantiles, value_positions
from joinscope.session import materialize

PRODUCT = "data_product_name"
DATABASE = "data_object_database_name"
OBJECT = "data_product_object_name"


def exact_sum(column: str) -> Column:
    """Sum of seconds through whole microseconds: the same whatever order rows come in."""
    return F.sum(F.round(F.col(column) * 1e6).cast("decimal(38,0)")).cast("double") / 1e6


def usage_rollup(usage: DataFrame, keys: Sequence[str] = (PRODUCT,)) -> DataFrame:
    """Totals per product, database or object."""
    total = exact_sum("total_execution_time_in_seconds")
    return (
        usage.groupBy(*keys)
        .agg(
            F.sum("user_query_count").alias("user_queries"),
            F.sum("app_query_count").alias("app_queries"),
            F.sum("unique_user").alias("users"),
            F.sum("unique_app").alias("apps"),
            total.alias("total_seconds"),
            F.sum("failed_query_count").alias("failed"),
            F.max("metric_date").alias("last_active"),
        )
        .withColumn("queries", F.col("user_queries") + F.col("app_queries"))
        .withColumn("average_seconds", F.when(F.col("queries") > 0, F.col("total_seconds") / F.col("queries")))
        .withColumn("failure_rate", F.when(F.col("queries") > 0, 100.0 * F.col("failed") / F.col("queries")))
    )


def top(df: DataFrame, metric: str, names: Sequence[str], k: int, least: bool = False) -> DataFrame:
    """The ``k`` rows with most (or least) of ``metric``, with their place; ties by name."""
    order = [F.asc(metric) if least else F.desc(metric), *[F.asc(n) for n in names]]
    best = df.orderBy(*order).limit(k)
    # At most k rows are left to number.
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    return best.select(place.cast("long").alias("place"), *names, metric)


def usage_ranking(usage: DataFrame, k: int = 10) -> DataFrame:
    """Most and least used products, most used tables and databases, in one table."""
    reports = {
        "most used product": ([PRODUCT], False),
        "least used product": ([PRODUCT], True),
        "most used table": ([DATABASE, OBJECT], False),
        "most used database": ([DATABASE], False),
    }
    every = (PRODUCT, DATABASE, OBJECT)
    objects = materialize(usage_rollup(usage, every).select(*every, "queries"))
    out = None
    for title, (keys, least) in reports.items():
        totals = objects.groupBy(*keys).agg(F.sum("queries").alias("queries"))
        ranked = top(totals, "queries", keys, k, least).select(
            F.lit(title).alias("report"), "place", F.concat_ws(".", *keys).alias("name"), "queries"
        )
        out = ranked if out is None else out.unionByName(ranked)
    return out


def busiest(log: DataFrame, who: Column, name: str, k: int = 10) -> DataFrame:
    """Users or applications with most queries in the raw log."""
    counts = log.select(who.alias(name)).filter(F.col(name).isNotNull()).groupBy(name)
    return top(counts.agg(F.count("*").alias("queries")), "queries", [name], k)


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("m")).select("m.metric", "m.value")


def performance_hotspots(rollup: DataFrame, fraction: float = 0.9) -> DataFrame:
    """Products that are slow, heavy or failing against the ``fraction`` quantile of all."""
    metrics = ["average_seconds", "total_seconds", "failed"]
    limits = quantiles(
        value_positions(_long(rollup, metrics)), {m: (m, fraction) for m in metrics}
    )
    limit = limits.select(F.struct(*metrics)).scalar()
    flags = {
        "is_slow": F.col("average_seconds") >= limit.getField("average_seconds"),
        "is_heavy": F.col("total_seconds") >= limit.getField("total_seconds"),
        "is_failing": (F.col("failed") > 0) & (F.col("failed") >= limit.getField("failed")),
    }
    flagged = rollup.select(PRODUCT, *metrics, *[F.coalesce(c, F.lit(False)).alias(n) for n, c in flags.items()])
    return flagged.filter("is_slow OR is_heavy OR is_failing")


def expensive_joins(pair_metrics: DataFrame, fraction: float = 0.9) -> DataFrame:
    """Daily pairs whose average run time reaches the ``fraction`` quantile."""
    timed = materialize(pair_metrics.filter(F.col("avg_runtime").isNotNull()))
    limit = quantiles(value_positions(_long(timed, ["avg_runtime"])), {"limit": ("avg_runtime", fraction)})
    return timed.filter(F.col("avg_runtime") >= limit.scalar())


def column_usage(columns: DataFrame, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """Columns sorted into unused, rare, ordinary and frequent by their total use."""
    totals = columns.groupBy(F.lower("table_name").alias("table_name"), F.lower("column_name").alias("column_name")).agg(
        F.sum("usage_count").alias("uses")
    )
    used = totals.filter(F.col("uses") > 0)
    limits = quantiles(value_positions(_long(used, ["uses"])), {"low": ("uses", low), "high": ("uses", high)})
    limit = limits.select(F.struct("low", "high")).scalar()
    kind = (
        F.when(F.col("uses") == 0, "unused")
        .when(F.col("uses") <= limit.getField("low"), "rare")
        .when(F.col("uses") >= limit.getField("high"), "frequent")
        .otherwise("ordinary")
    )
    return totals.withColumn("usage_class", kind).withColumn("cleanup_candidate", F.col("uses") == 0)


def usage_trend(usage: DataFrame, days: int = 7) -> DataFrame:
    """Daily queries per product, change on its day before, moving mean, and share of apps."""
    daily = usage.groupBy(PRODUCT, "metric_date").agg(
        F.sum(F.col("user_query_count") + F.col("app_query_count")).alias("queries"),
        F.sum("app_query_count").alias("app_queries"),
    )
    by_day = Window.partitionBy(PRODUCT).orderBy("metric_date")
    recent = by_day.rowsBetween(-(days - 1), Window.currentRow)
    return daily.select(
        PRODUCT,
        "metric_date",
        "queries",
        (F.col("queries") - F.lag("queries").over(by_day)).alias("change"),
        F.round(F.avg("queries").over(recent), 4).alias("moving_mean"),
        F.round(F.when(F.col("queries") > 0, F.col("app_queries") / F.col("queries")), 4).alias("app_share"),
    )
