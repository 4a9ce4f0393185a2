"""Exact ranks and quantiles of columns, without bringing a column into one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Values that cut a metric's distinct values into ranges of about equal number.
SPLITTERS = 255


def value_positions(values: DataFrame) -> DataFrame:
    """For (metric, value) rows: distinct values with ``n`` rows each and ``below`` rows under it.

    Values are counted first, so a frequent one is one row. Splitters taken from the distinct values
    themselves cut them into ranges of about equal number, however they are spread; one window
    runs over the ranges of a metric, the other within a range. Which splitters are found changes
    nothing in the result. Nulls have no place.
    """
    counts = values.filter(F.col("value").isNotNull()).groupBy("metric", "value").agg(F.count("*").alias("n"))
    shares = [(k + 1) / (SPLITTERS + 1) for k in range(SPLITTERS)]
    found = counts.groupBy("metric").agg(F.percentile_approx(F.col("value").cast("double"), shares, 10_000).alias("s"))
    rows = [(r["metric"], sorted(set(r["s"]))) for r in found.collect()]  # a row for each metric
    splitters = values.sparkSession.createDataFrame(rows, "metric string, splitters array<double>")
    under = F.filter("splitters", lambda s: s <= F.col("value").cast("double"))
    counts = counts.join(F.broadcast(splitters), "metric").withColumn("bucket", F.size(under)).drop("splitters")
    preceding = (Window.unboundedPreceding, -1)
    of_metric = Window.partitionBy("metric").orderBy("bucket").rowsBetween(*preceding)
    of_bucket = Window.partitionBy("metric", "bucket").orderBy("value").rowsBetween(*preceding)
    buckets = counts.groupBy("metric", "bucket").agg(F.sum("n").alias("m"))
    buckets = buckets.select("metric", "bucket", F.coalesce(F.sum("m").over(of_metric), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("n").over(of_bucket), F.lit(0))
    return (
        counts.withColumn("within", within)
        .join(buckets, ["metric", "bucket"])
        .select("metric", "value", "n", (F.col("before") + F.col("within")).alias("below"))
    )


def metric_sizes(positions: DataFrame) -> DataFrame:
    return positions.groupBy("metric").agg(F.sum("n").alias("rows"))


def quantiles(positions: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row with a column per wanted (metric, fraction), linearly interpolated."""
    asked = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("name"), F.lit(metric).alias("of"), F.lit(float(p)).alias("p"))
                for name, (metric, p) in wanted.items()
            ]
        )
    )
    at = F.col("p") * (F.col("rows") - 1)
    sized = metric_sizes(positions).select("metric", "rows", asked.alias("q")).filter("q.of = metric")
    sized = sized.select("metric", "q.name", "rows", F.col("q.p").alias("p"))
    sized = sized.select("metric", "name", F.floor(at).alias("lo"), F.ceil(at).alias("hi"), (at - F.floor(at)).alias("part"))

    def value_at(place: str) -> Column:
        covers = (F.col("below") <= F.col(place)) & (F.col(place) < F.col("below") + F.col("n"))
        return F.max(F.when(covers, F.col("value")))

    found = positions.join(sized, "metric").groupBy("name").agg(
        value_at("lo").alias("low"), value_at("hi").alias("high"), F.max("part").alias("part")
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return found.agg(*[F.max(F.when(F.col("name") == name, value)).alias(name) for name in wanted])


def percent_ranks(values: DataFrame, positions: DataFrame) -> DataFrame:
    """Add ``percent_rank`` (share of the other rows below, 0..1) to (metric, value) rows."""
    placed = positions.join(metric_sizes(positions), "metric").select(
        "metric",
        "value",
        F.when(F.col("rows") > 1, F.col("below") / (F.col("rows") - 1)).otherwise(0.0).alias("percent_rank"),
    )
    return values.join(placed, ["metric", "value"], "left")
