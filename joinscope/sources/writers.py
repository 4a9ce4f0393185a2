"""Result sinks."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from joinscope.operators.numbering import in_ranges
from joinscope.session import remove

log = logging.getLogger(__name__)


def write_table(
    df: DataFrame, path: str, fmt: str = "csv", partition_by: Sequence[str] = (), order_by: Sequence[str] = ()
) -> bool:
    """Write a flat table; an empty result leaves what was there before and only warns.

    The rows are counted while they are written, so the result is computed once. They are written
    beside the target, which is replaced at the end: a run that fails changes nothing. With
    ``order_by`` (``-col`` falls), the files in the order of their names hold the rows in that order.
    """
    if fmt not in {"csv", "parquet", "json", "orc"}:
        raise ValueError(f"unsupported output format {fmt!r}")
    if order_by:
        df = in_ranges(df, order_by)
    written = Observation()
    target = path.rstrip("/")
    beside = f"{target}.writing-{uuid.uuid4()}"
    writer = df.observe(written, F.count(F.lit(1)).alias("rows")).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    try:
        writer.format(fmt).save(beside)
        if not written.get["rows"]:
            log.warning("result is empty, %s stays as it is", target)
            return False
        replace(df.sparkSession, beside, target)
        return True
    finally:
        remove(df.sparkSession, beside)


def replace(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``, which is only deleted after that."""
    jvm = spark._jvm
    here, there = jvm.org.apache.hadoop.fs.Path(new), jvm.org.apache.hadoop.fs.Path(target)
    old = jvm.org.apache.hadoop.fs.Path(f"{target}.replaced-{uuid.uuid4()}")
    fs = there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    before = fs.exists(there)
    if before and not fs.rename(there, old):
        raise OSError(f"could not set {target} aside")
    if not fs.rename(here, there):
        if before:
            fs.rename(old, there)
        raise OSError(f"could not move the result to {target}")
    if before:
        fs.delete(old, True)


def json_document(recommendations: DataFrame, health: DataFrame) -> DataFrame:
    """Both tables as one JSON text with two arrays: one value, so for reports that fit into one."""
    iso = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}

    def rows(df: DataFrame, name: str):
        # Sorted by the first column, which is unique in both tables.
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name)).scalar()

    return recommendations.sparkSession.range(1).select(
        F.to_json(
            F.struct(
                rows(recommendations, "r").alias("DATA_PRODUCT_RECOMMENDATION"),
                rows(health, "h").alias("DATA_PRODUCT_HEALTH_SUMMARY"),
            ),
            {**iso, "ignoreNullFields": "false"},
        ).alias("value")
    )


def write_report(recommendations: DataFrame, health: DataFrame, path: str, form: str = "tables") -> None:
    """Write the report as two JSON-lines tables, or as one JSON document if ``form`` says so."""
    if form == "document":
        json_document(recommendations, health).coalesce(1).write.mode("overwrite").text(path)
    elif form == "tables":
        for name, df in (("DATA_PRODUCT_RECOMMENDATION", recommendations), ("DATA_PRODUCT_HEALTH_SUMMARY", health)):
            df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")
    else:
        raise ValueError(f"unknown form {form!r}")
