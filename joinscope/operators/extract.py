"""From query-log rows to join pairs.

No Python per row. Costly columns are added in separate steps, so that the optimizer keeps
each as one projection and does not repeat it where a later step reads it twice. The structured
modes read a text that many rows share once; the rows of any other log are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.functions import pairs as P
from joinscope.functions import scopes, sqltext, text
from joinscope.functions.columns import blank_to_null
from joinscope.functions.keywords import FUSED_FROM
from joinscope.modes import Mode

#: The columns that the pairs of a row depend on.
_INPUTS = ("SqlTextInfo", "Db_nm", "Tbl_nm")
#: Texts are read once for all their rows if there are at most so many different ones ..
MOST_TEXTS = 10_000
#: .. of at most so many characters in all ..
MOST_CHARACTERS = 32_000_000
#: .. and so many rows for each.
REPEATS = 8

_WORK = ("_sql", "_pieces", "_events", "_comment_tables", "_structured")


def clean_sql(sql: Column, mode: Mode, mask_literals: bool = True, protect: Sequence[str] = ()) -> Column:
    source = text.blank_literals(sql, slash_comments=mode.clean == "comments") if mask_literals else sql
    if mode.clean == "comments":
        return text.strip_comments(source)
    if mode.clean == "hints":
        return text.strip_hints_and_comments(source)
    if mode.clean == "repair":
        return text.repair_sql(source, protect)
    if mode.clean == "flat":
        return text.flatten_sql(source)
    return text.clean_teradata(source)


def driving_table(mode: Mode) -> str:
    """Name of the log's own table, for queries without a join."""
    whole = sqltext.qualify("Db_nm", "Tbl_nm")
    return whole if mode.qualified else sqltext.last_part(whole)


def extract_pairs(
    log: DataFrame, mode: Mode, mask_literals: bool = True, protect: Sequence[str] = ()
) -> DataFrame:
    """Add ``pairs``, the ordered join pairs of each query text.

    Rows without SQL are dropped. ``mask_literals=False`` leaves quoted text visible to the
    patterns; ``protect`` lists names the keyword repair must not cut. Where few texts stand for
    many rows, they are read apart and joined back; this looks at the log once beforehand.
    """
    log = log.filter(text.has_sql(F.col("SqlTextInfo")))
    inputs = [c for c in _INPUTS if c in log.columns]
    if mode.scope == "nearest_preceding" or not _few_texts(log, inputs):
        return _with_pairs(log, mode, mask_literals, protect)
    found = _with_pairs(log.select(*inputs).distinct(), mode, mask_literals, protect)
    found = found.withColumnsRenamed({c: f"_of_{c}" for c in inputs})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in inputs])
    return log.join(F.broadcast(found), same, "left").drop(*[f"_of_{c}" for c in inputs])


def _few_texts(log: DataFrame, inputs: Sequence[str]) -> bool:
    seen = log.agg(
        F.count("*").alias("rows"),
        F.approx_count_distinct(F.xxhash64(*inputs), 0.02).alias("texts"),
        F.max(F.length(F.concat_ws("", *inputs))).alias("longest"),
    ).first()
    if not seen.rows or seen.texts > MOST_TEXTS or seen.texts * seen.longest > MOST_CHARACTERS:
        return False
    return seen.rows >= REPEATS * seen.texts


def _with_pairs(log: DataFrame, mode: Mode, mask_literals: bool, protect: Sequence[str]) -> DataFrame:
    df = log.withColumn("_sql", clean_sql(F.col("SqlTextInfo"), mode, mask_literals, protect))
    if mode.scope == "nearest_preceding":
        df = df.withColumn("pairs", F.expr(P.nearest_preceding("_sql")))
    else:
        df = df.withColumn("_pieces", scopes.pieces(F.col("_sql")))
        df = df.withColumn("_events", scopes.table_events("_pieces"))
        if mode.scope == "all_scopes":
            df = df.withColumn("pairs", F.expr(P.all_scopes("_events")))
        elif mode.scope == "top_level":
            fused = f"rlike(_sql, {sqltext.quote(FUSED_FROM)})"
            df = df.withColumn("pairs", F.expr(P.top_level("_events", "Tbl_nm", unless=fused)))
        elif mode.scope == "dirty_log":
            raw = text.blank_literals(F.col("SqlTextInfo")) if mask_literals else F.col("SqlTextInfo")
            df = df.withColumn("_comment_tables", text.comment_join_tables(raw, protect))
            df = df.withColumn("_structured", F.expr(P.top_level("_events", None)))
            with_comments = F.expr(P.with_comment_tables("_structured", "_comment_tables"))
            by_text = F.expr(P.chained_by_text("_sql", "_comment_tables", "Tbl_nm"))
            df = df.withColumn("pairs", F.when(F.size("_structured") > 0, with_comments).otherwise(by_text))
        else:
            structured = P.per_block("_pieces", "_events", "Db_nm" if mode.qualified else None, mode.with_keys)
            df = df.withColumn("_structured", F.expr(P.both_sides(structured)))
            by_text = P.on_keyed("_sql", "Db_nm", distinct_tables=not mode.qualified)
            if not mode.qualified:
                by_text = P.bare_pairs(by_text)
            by_text = F.expr(P.both_sides(by_text))
            df = df.withColumn("pairs", F.when(F.size("_structured") > 0, F.col("_structured")).otherwise(by_text))
    if mode.per_query_distinct:
        df = df.withColumn("pairs", F.expr(P.distinct_pairs("pairs")))
    if mode.no_join_rows:
        alone = sqltext.let(
            "dt",
            driving_table(mode),
            f"CASE WHEN dt <> '' THEN array({P.pair('dt', "''", "'NONE'", P.NO_KEYS)}) ELSE {P.NO_PAIRS} END",
        )
        df = df.withColumn("pairs", F.when(F.size("pairs") == 0, F.expr(alone)).otherwise(F.col("pairs")))
    return df.drop(*_WORK)


def explode_pairs(with_pairs: DataFrame) -> DataFrame:
    """One row per query and pair; queries without pairs disappear.

    The outer form is deliberate: a plain explode would add a size filter that the optimizer
    pushes below the extraction, and so run it twice.
    """
    return (
        with_pairs.withColumn("_p", F.explode_outer("pairs"))
        .filter(F.col("_p").isNotNull())
        .select(
            *[c for c in with_pairs.columns if c != "pairs"],
            F.col("_p.left").alias("left_join_table_name"),
            F.col("_p.right").alias("right_join_table_name"),
            F.col("_p.join_type").alias("join_type"),
            F.col("_p.join_keys").alias("join_keys"),
        )
    )


def explode_counted_pairs(with_pairs: DataFrame) -> DataFrame:
    """As :func:`explode_pairs`, but one row per query and distinct pair with its count ``n``.

    Fewer rows reach the shuffle, and a row stands for one query, so that distinct queries
    are a plain count.
    """
    counted = F.transform(
        F.expr(P.distinct_pairs("pairs")),
        lambda p: F.struct(
            p.left.alias("left"),
            p.right.alias("right"),
            F.size(F.filter("pairs", lambda q: (q.left == p.left) & (q.right == p.right))).alias("n"),
            F.coalesce(F.size(p.join_keys), F.lit(0)).alias("n_keys"),
        ),
    )
    return (
        with_pairs.withColumn("_p", F.explode_outer(counted))
        .filter(F.col("_p").isNotNull())
        .select(
            *[c for c in with_pairs.columns if c != "pairs"],
            F.col("_p.left").alias("left_join_table_name"),
            F.col("_p.right").alias("right_join_table_name"),
            F.col("_p.n").alias("n"),
            F.col("_p.n_keys").alias("n_keys"),
        )
    )


def split_statements(log: DataFrame) -> DataFrame:
    """One row per statement of a multi-statement text, numbered from 0, literals blanked."""
    parts = text.statements(text.blank_literals(F.col("SqlTextInfo")))
    return log.select(
        "*", F.posexplode_outer(parts).alias("statement_no", "statement")
    ).filter(F.col("statement").isNotNull())


def tables_as_written(log: DataFrame, mode: Mode) -> DataFrame:
    """Alias map rows: one per aliased table of each query, in block order."""
    df = log.withColumn("_pieces", scopes.pieces(clean_sql(F.col("SqlTextInfo"), mode)))
    df = df.withColumn("_e", F.explode_outer(scopes.table_events("_pieces")))
    return df.filter((F.col("_e.tbl") != "") & blank_to_null(F.col("_e.aka")).isNotNull()).select(
        *log.columns, F.col("_e.aka").alias("alias"), F.col("_e.tbl").alias("table_name")
    )
