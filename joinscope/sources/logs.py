"""Query-log tables: reading, column checks and column resolution."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from joinscope.functions.names import parse_time
from joinscope.schemas import QUERY_LOG_COLUMNS, TIME_COLUMNS
from joinscope.sources.quoted import Verify, read_quoted, read_quoted_csv

_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "json", ".orc": "orc"}

# Other spellings of the canonical columns, lower case.
_OTHER_NAMES = {"user_name": "usr_nm", "Db_nm": "obj_db_nm", "Tbl_nm": "obj_tbl_nm"}


def format_of(path: str) -> str:
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix not in _FORMATS:
        raise ValueError(f"unsupported file type {suffix!r}; expected one of {sorted(_FORMATS)}")
    return _FORMATS[suffix]


def typed(texts: DataFrame, schema: str, rescued: str | None = None) -> DataFrame:
    """Text columns cast to ``schema``, by name; absent columns are null.

    A cell that doesn't cast is null. With ``rescued``, a column of that name maps the columns of a
    row's bad cells to their texts; it is null for a row without any.
    """
    fields = texts.sparkSession.createDataFrame([], schema).schema.fields
    have = {c.lower(): c for c in texts.columns}
    text = {f.name: F.trim(F.col(f"`{have[f.name.lower()]}`")) for f in fields if f.name.lower() in have}
    value = {f.name: text[f.name].try_cast(f.dataType) if f.name in text else F.lit(None).cast(f.dataType) for f in fields}
    columns = [value[f.name].alias(f.name) for f in fields]
    if rescued:
        cells = [F.when((t != "") & value[c].isNull(), F.struct(F.lit(c).alias("column"), F.col(f"`{have[c.lower()]}`").alias("text"))) for c, t in text.items()]
        bad = F.map_from_entries(F.array_compact(F.array(*cells)))
        columns.append(F.when(F.size(bad) > 0, bad).alias(rescued))
    return texts.select(*columns)


def bad_cells(df: DataFrame, keys: Iterable[str], rescued: str = "_rescued") -> DataFrame:
    """(keys, column, text) of the cells that ``typed`` could not cast."""
    return df.where(F.col(rescued).isNotNull()).select(*keys, F.explode(rescued).alias("column", "text"))


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, schema: str | None = None, multi_line: bool = False, rescued: str | None = None
) -> DataFrame:
    """Read a table by file type. CSV columns are all strings unless a schema is given.

    With ``multi_line`` or a schema, quoted CSV fields may span lines, and each file's columns go by its
    own header; files are read in splits either way. ``rescued``: see ``typed``.
    """
    fmt = fmt or format_of(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        if schema is not None:
            return typed(read_quoted_csv(spark, path), schema, rescued)
        return read_quoted_csv(spark, path) if multi_line else reader.options(header=True, quote='"', escape='"').csv(path)
    if fmt not in set(_FORMATS.values()):
        raise ValueError(f"unsupported format {fmt!r}; expected one of {sorted(set(_FORMATS.values()))}")
    return reader.format(fmt).load(path)


def require_columns(df: DataFrame, required: Iterable[str], ignore_case: bool = False) -> DataFrame:
    """Raise, naming what is missing, before any job runs."""
    fold = str.lower if ignore_case else str
    have = {fold(c) for c in df.columns}
    missing = sorted(c for c in required if fold(c) not in have)
    if missing:
        raise ValueError(f"required columns missing: {missing}; found: {df.columns}")
    return df


def resolve_log(df: DataFrame) -> DataFrame:
    """Canonical log columns, found whatever their letter case; absent ones are null.

    Only the SQL text is required. Times given as text are parsed leniently: text that is no
    time becomes null.
    """
    require_columns(df, ["SqlTextInfo"], ignore_case=True)
    actual = {c.lower(): c for c in df.columns}

    def found(name: str):
        source = actual.get(name.lower()) or actual.get(_OTHER_NAMES.get(name, ""))
        if source is None:
            return F.lit(None).cast("timestamp_ntz" if name in TIME_COLUMNS else "string")
        column = F.col(f"`{source}`")
        if name not in TIME_COLUMNS:
            return column.cast("string")
        is_text = dict(df.dtypes)[source] == "string"
        return parse_time(column) if is_text else column.cast("timestamp_ntz")

    key = [F.col(f"`{actual['query_id']}`").alias("query_id")] if "query_id" in actual else []
    return df.select(*key, *[found(c).alias(c) for c in QUERY_LOG_COLUMNS])


def read_query_log(spark: SparkSession, path: str, fmt: str | None = None, strict: bool = False) -> DataFrame:
    """A log ready for the pipelines; ``strict`` requires all seven columns by exact name."""
    df = read_table(spark, path, fmt, multi_line=True)
    if strict:
        require_columns(df, QUERY_LOG_COLUMNS)
    return resolve_log(df)


def is_log_record(fields: Column) -> Column:
    """Whether a record that is read again after a damaged one may count: its log date is a time, and its names are words."""
    named = lambda *names: F.map_values(F.map_filter(fields, lambda name, _: F.lower(name).isin(*names)))
    dated = parse_time(F.try_element_at(named("logdate"), F.lit(1))).isNotNull()
    names = named("user_name", "usr_nm", "db_nm", "obj_db_nm", "tbl_nm", "obj_tbl_nm")
    return dated & F.forall(names, lambda n: n.isNull() | ~F.trim(n).rlike(r"\s"))


def read_checked_log(spark: SparkSession, path: str, verified: Verify = is_log_record) -> tuple[DataFrame, DataFrame]:
    """(query log, rejected) of CSV files that may hold damaged records."""
    texts, rejected = read_quoted(spark, path, verified=verified)
    return resolve_log(texts), rejected
