"""Sixteen SQL shapes with the pairs each mode must find."""

import pytest
from pyspark.sql import functions as F

from joinscope import modes
from joinscope.functions import pairs as P
from joinscope.functions import text
from joinscope.operators.extract import clean_sql, extract_pairs
from workload import golden


@pytest.fixture(scope="module")
def templates(spark):
    rows = [(i + 1, "u1", "sales", "orders", t) for i, t in enumerate(golden.TEMPLATES)]
    return spark.createDataFrame(rows, "t int, user_name string, Db_nm string, Tbl_nm string, SqlTextInfo string")


def found(df):
    return {r.t: [(p.left, p.right) for p in r.pairs] for r in df.select("t", "pairs").collect() if r.pairs}


@pytest.mark.parametrize(
    "mode, expected",
    [
        (modes.ALL_SCOPES, golden.ALL_SCOPES),
        (modes.TOP_LEVEL, golden.TOP_LEVEL),
        (modes.DIRTY_LOG, golden.DIRTY_LOG),
        (modes.NEAREST_PRECEDING, golden.NEAREST_PRECEDING),
        (modes.PER_BLOCK, golden.PER_BLOCK),
    ],
    ids=lambda v: v.name if isinstance(v, modes.Mode) else "",
)
def test_pairs(templates, mode, expected):
    assert found(extract_pairs(templates, mode)) == expected


def test_qualified_pairs_with_type_and_keys(templates):
    rows = extract_pairs(templates, modes.PER_BLOCK_QUALIFIED).select("t", "pairs").collect()
    got = {
        r.t: [(p.left, p.right, p.join_type, [f"{k.left_key}={k.right_key}" for k in p.join_keys]) for p in r.pairs]
        for r in rows
    }
    want = {
        t: [(golden.qualified(l), golden.qualified(r), kind, keys) for l, r, kind, keys in ps]
        for t, ps in golden.PER_BLOCK_KEYED.items()
    }
    assert got == want


def test_on_keyed(templates):
    cleaned = templates.withColumn("sql", clean_sql(F.col("SqlTextInfo"), modes.PER_BLOCK_QUALIFIED))
    got = found(cleaned.withColumn("pairs", F.expr(P.on_keyed("sql", "Db_nm"))))
    assert got == {t: [(golden.qualified(l), golden.qualified(r)) for l, r in ps] for t, ps in golden.ON_KEYED.items()}


def test_comment_tables(templates):
    rows = templates.select("t", text.comment_join_tables(F.col("SqlTextInfo")).alias("c")).collect()
    assert {r.t: r.c for r in rows if r.c} == golden.COMMENT_TABLES
