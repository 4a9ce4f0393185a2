"""Total order and consecutive numbers in it, without one task seeing all rows.

Rows are dealt into ranges of the order and sorted within them, and each range is written once
with the place of its rows. What crosses ranges is one count for each range and group; their
running sums are the offsets of the numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from joinscope.session import materialize


def ordering(key: str) -> Column:
    """``col`` rises, nulls first; ``-col`` falls, nulls last."""
    return F.desc(f"`{key[1:]}`") if key.startswith("-") else F.asc(f"`{key}`")


def in_ranges(df: DataFrame, order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rows dealt into rising ranges of ``order`` and sorted within each.

    Partition k holds nothing that belongs before partition k - 1. Rows with equal keys share a
    partition, so ``order`` should end in something that tells rows apart.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [ordering(k) for k in order]
    return df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)


def number_rows(
    df: DataFrame, order: Sequence[str], id_column: str = "Row_id", within: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Number rows 1..n in ``order``, for each group ``within`` apart; ``-col`` means descending.

    Null keys are a group like any other. Rows equal in all keys get numbers in any order.
    """
    place, part, first, before = "_place", "_part", "_first", "_before"
    placed = in_ranges(df, [*within, *order], ranges).withColumn(place, F.monotonically_increasing_id())
    placed = materialize(placed.withColumn(part, F.shiftright(place, 33)))
    counts = placed.groupBy(*within, part).agg(F.min(place).alias(first), F.count("*").alias("_n"))
    # One row for each range that the group has rows in: bounded by the number of ranges.
    earlier = Window.partitionBy(*[f"`{k}`" for k in within]).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn(before, F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    offsets = offsets.select(*[F.col(f"`{k}`").alias(f"_k_{i}") for i, k in enumerate(within)], F.col(part).alias("_k"), first, before)
    same = [placed[f"`{k}`"].eqNullSafe(F.col(f"_k_{i}")) for i, k in enumerate(within)] + [placed[part] == F.col("_k")]
    number = F.col(before) + F.col(place) - F.col(first) + 1
    return placed.join(offsets, reduce(and_, same)).select(number.alias(id_column), *[F.col(f"`{c}`") for c in df.columns])
