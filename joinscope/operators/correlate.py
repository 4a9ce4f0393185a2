"""Joins between the three metric tables. All are equi-joins on lower-case names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joinscope.operators.patterns import join_hotspots
from joinscope.operators.usage import DATABASE, OBJECT, PRODUCT


def product_objects(usage: DataFrame) -> DataFrame:
    """Each product's objects with the names to join on."""
    return usage.groupBy(
        PRODUCT,
        F.lower(F.coalesce(F.col(DATABASE), F.lit(""))).alias("db"),
        F.lower(F.coalesce(F.col(OBJECT), F.lit(""))).alias("tbl"),
    ).agg(F.min("data_product_object_id").alias("object_id"))


def usage_with_joins(usage: DataFrame, patterns: DataFrame) -> DataFrame:
    """Product objects with the joins they take part in, on either side."""
    return (
        product_objects(usage)
        .join(join_hotspots(patterns), ["db", "tbl"], "left")
        .select(
            PRODUCT, "db", "tbl",
            F.coalesce("total_joins", F.lit(0)).alias("total_joins"),
            F.coalesce("partners", F.lit(0)).alias("partners"),
            F.coalesce("longest_repeat_days", F.lit(0)).alias("longest_repeat_days"),
        )
    )


def usage_with_columns(usage: DataFrame, columns: DataFrame) -> DataFrame:
    """Product objects with the number of their columns and of the unused ones."""
    per_column = columns.groupBy(F.lower("table_name").alias("tbl"), F.lower("column_name").alias("col")).agg(
        F.sum("usage_count").alias("uses")
    )
    per_table = per_column.groupBy("tbl").agg(
        F.count("*").alias("columns"), F.count_if(F.col("uses") == 0).alias("unused_columns"), F.sum("uses").alias("uses")
    )
    return (
        product_objects(usage)
        .join(per_table, "tbl", "left")
        .select(
            PRODUCT, "db", "tbl",
            F.coalesce("columns", F.lit(0)).alias("columns"),
            F.coalesce("unused_columns", F.lit(0)).alias("unused_columns"),
            F.coalesce("uses", F.lit(0)).alias("column_uses"),
        )
    )


def never_joined(usage: DataFrame, patterns: DataFrame) -> DataFrame:
    """Product objects without any join pattern."""
    return product_objects(usage).join(join_hotspots(patterns), ["db", "tbl"], "left_anti").select(PRODUCT, "db", "tbl")


def joined_products(usage: DataFrame, patterns: DataFrame, partners: int = 2) -> DataFrame:
    """Product objects that are join hotspots: joined with at least ``partners`` tables."""
    hot = join_hotspots(patterns).filter(F.col("partners") >= partners)
    return product_objects(usage).join(hot, ["db", "tbl"], "left_semi").select(PRODUCT, "db", "tbl")
