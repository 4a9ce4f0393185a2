"""What the operators share: tables, written intermediate results, fixed splits, free names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joinscope.session import kept_folder, remove

#: Characters `\x09-\x0D` and the blank part words, in Java's regular expressions.
BLANKS = r"[ \t-\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a narrow table that one file holds at least, where their number is known.
ROWS_PER_FILE = 500_000


def keep(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared checkpoint folder and read it from there.

    The lineage ends there, so a lost executor costs no more than one read. ``rows``: about how many
    there are; a small table is then written as few files. What is not discarded before is
    deleted when the program ends.
    """
    spark = df.sparkSession
    path = f"{kept_folder(spark)}/kept-{uuid.uuid4()}"
    if rows is not None:
        df = df.coalesce(rows // ROWS_PER_FILE + 1)
    df.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_at = path
    return kept


def discard(*kept: DataFrame) -> None:
    """Delete results of ``keep`` that nothing reads any more."""
    for df in kept:
        remove(df.sparkSession, df.kept_at)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than the blank and ``\\x09-\\x0D``."""
    return F.array_remove(F.split(text, BLANKS), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside a lambda."""
    return F.transform(F.array(value), use)[0]
