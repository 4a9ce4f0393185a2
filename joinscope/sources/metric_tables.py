"""The three metric tables that health and recommendations read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from joinscope.schemas import COLUMN_USAGE, JOIN_PATTERNS, USAGE_METRICS
from joinscope.sources.logs import read_table, require_columns


def _columns(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _read(spark: SparkSession, path: str, schema: str, fmt: str | None, rescued: str | None) -> DataFrame:
    return require_columns(read_table(spark, path, fmt, schema, rescued=rescued), _columns(schema))


def read_usage_metrics(spark: SparkSession, path: str, fmt: str | None = None, rescued: str | None = None) -> DataFrame:
    """``rescued``: a column for the CSV cells that don't cast, see ``logs.typed``."""
    return _read(spark, path, USAGE_METRICS, fmt, rescued)


def read_column_usage(spark: SparkSession, path: str, fmt: str | None = None, rescued: str | None = None) -> DataFrame:
    return _read(spark, path, COLUMN_USAGE, fmt, rescued)


def read_join_patterns(spark: SparkSession, path: str, fmt: str | None = None, rescued: str | None = None) -> DataFrame:
    return _read(spark, path, JOIN_PATTERNS, fmt, rescued)
