"""Ragged text logs: records of several lines, fields not reliably quoted.

A record opens at a line ``token,``. Files of any size are read in splits: lines are numbered
within their split, only the count of record starts per split crosses splits, and only the
records cut by a split border are put together afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joinscope.functions.columns import blank_to_null, collapse_ws, let, strip
from joinscope.functions.keywords import DATE_AFTER_COMMA, RECORD_START
from joinscope.functions.names import parse_time
from joinscope.session import materialize


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file, start of their split, and an id that rises within the split."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def records_from_lines(lines: DataFrame) -> DataFrame:
    """Records (file, record_no, text), numbered per file from 1; 0 is a line before the first.

    ``lines`` has (file, block, line_no, value). The number does not depend on how the file
    was split. Header records are left out. Lines before the first record stay apart, so that a
    file without any record start is many short texts.
    """
    line = F.regexp_replace("value", "^\ufeff", "")
    starts = line.rlike(RECORD_START).cast("int")
    split = Window.partitionBy("file", "block")
    so_far = split.orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per split: how many records start in it, and in the file before it.
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "block").agg(F.sum(starts).alias("started"))
    splits = splits.withColumn("before", F.coalesce(F.sum("started").over(in_file), F.lit(0)))
    placed = lines.select("file", "block", "line_no", line.alias("line"), starts.alias("starts")).withColumn(
        "place", F.sum("starts").over(so_far)
    )
    leading = (F.col("place") == 0) & (F.col("before") == 0)
    fragments = (
        placed.join(splits, ["file", "block"])
        .withColumn("alone", F.when(leading, F.col("line_no")))
        .groupBy("file", "block", "place", "alone", "started", "before")
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x.line), "\n"
            ).alias("text")
        )
    )
    # Three readers: lines before the first record, whole records, and those cut by a split border.
    fragments = materialize(fragments)
    before = fragments.where("alone is not null").select("file", F.lit(0).cast("long").alias("record_no"), "text")
    records = assembled(fragments.where("alone is null").drop("alone"))
    return records.unionByName(before).filter(~F.ltrim("text").startswith("user_name"))


def assembled(fragments: DataFrame) -> DataFrame:
    """Records (file, record_no, text) of fragments; those cut by a split border are joined.

    ``fragments``: (file, block, place, started, before, text), place 0 being what goes on from the
    split before; ``started`` records start in the split, ``before`` in the file before it.
    """
    numbered = fragments.withColumn("record_no", F.col("before") + F.col("place"))
    whole = (F.col("place") > 0) & (F.col("place") < F.col("started"))
    inner = numbered.filter(whole).select("file", "record_no", "text")
    at_border = (
        numbered.filter(~whole)
        .groupBy("file", "record_no")
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda x: x.text), "\n"
            ).alias("text")
        )
    )
    return inner.unionByName(at_border)


def parse_records(records: DataFrame) -> DataFrame:
    """Add the seven fields as text, and ``parse_error`` where a record does not hold them."""
    text = strip(F.regexp_replace("text", r"\n{2,}", "\n"))
    df = records.withColumn("_f", F.split(text, ",", 4))
    df = df.withColumn("_rest", strip(F.get("_f", F.lit(3))))
    df = df.withColumn("_date_at", F.regexp_instr("_rest", F.lit(DATE_AFTER_COMMA)))
    user = strip(F.get("_f", F.lit(0)))
    tail = F.filter(
        F.transform(F.split(F.substring("_rest", F.col("_date_at"), F.length("_rest")), ","), strip), lambda p: p != ""
    )
    df = df.withColumn("_tail", tail)
    error = (
        F.when(F.size("_f") < 4, "fewer than 4 comma-separated segments")
        .when(~user.rlike(r"^[A-Za-z0-9]+$"), "user name is no plain token")
        .when(F.col("_date_at") == 0, "no date after the SQL text")
        .when(F.size("_tail") < 3, "fewer than 3 time fields")
    )

    def peeled(sql):
        inner = F.substring(sql, F.lit(2), F.length(sql))
        return (
            F.when(sql.startswith('"') & sql.endswith('"'), F.substring(sql, F.lit(2), F.greatest(F.length(sql) - 2, F.lit(0))))
            .when(sql.startswith('"'), inner)
            .otherwise(sql)
        )

    sql = let(strip(F.substring("_rest", F.lit(1), F.col("_date_at") - 1)), peeled)
    last_time = strip(collapse_ws(F.array_join(F.slice("_tail", F.lit(3), F.greatest(F.size("_tail"), F.lit(1))), " ")))
    fields = {
        "user_name": user,
        "Db_nm": strip(F.get("_f", F.lit(1))),
        "Tbl_nm": strip(F.get("_f", F.lit(2))),
        "SqlTextInfo": sql,
        "LogDate": F.get("_tail", F.lit(0)),
        "StartTime": F.get("_tail", F.lit(1)),
        "LastResponseTime": last_time,
    }
    df = df.withColumn("_error", error)
    good = F.col("_error").isNull()
    row = F.struct(F.col("_error").alias("parse_error"), *[F.when(good, c).alias(n) for n, c in fields.items()])
    # A filter on a field would be pushed below the parsing, which would then run twice; not below a generator.
    return df.select(*records.columns, F.explode_outer(F.array(row)).alias("_r")).select(*records.columns, "_r.*")


def accepted(parsed: DataFrame) -> DataFrame:
    """Good records as a query log, with a query id from file and record number."""
    return parsed.filter(F.col("parse_error").isNull()).select(
        F.sha2(F.concat_ws("|", "file", F.col("record_no").cast("string")), 256).alias("query_id"),
        "user_name",
        blank_to_null(F.col("Db_nm")).alias("Db_nm"),
        blank_to_null(F.col("Tbl_nm")).alias("Tbl_nm"),
        "SqlTextInfo",
        *[parse_time(F.col(c)).alias(c) for c in ("LogDate", "StartTime", "LastResponseTime")],
    )


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parse_error").isNotNull()).select("file", "record_no", "parse_error", "text")


def read_ragged_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(query log, rejected records) of ragged text files."""
    parsed = parse_records(records_from_lines(read_lines(spark, path)))
    return accepted(parsed), rejected(parsed)
