"""Text rules on small examples."""

import pytest
from pyspark.sql import functions as F

from joinscope.functions import names, scores, text


def apply(spark, rule, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(rule(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "rule, given, want",
    [
        (text.blank_literals, "a = 'x -- y' -- don't", "a = '' -- don't"),
        (text.blank_literals, "a = 'it''s' AND \"o'clock\" = 1 /* it's */", "a = '''' AND \"o'clock\" = 1 /* it's */"),
        (text.strip_comments, "a /* x\ny */ b -- c\nd // e\nf", "a   b \nd \nf"),
        (text.strip_hints_and_comments, "SELECT /*+ HINT */ a -- b", "SELECT   a"),
        (text.flatten_sql, " a\n\n b -- c\n\td ", "a b d"),
        (text.clean_teradata, "LOCKING TABLE x FOR ACCESS SELECT a -- c\n FROM t ; ", "LOCKING TABLE x FOR ACCESS SELECT a FROM t"),
        (text.clean_teradata, "LOCKING db.t FOR READ SELECT 1 ;", "SELECT 1"),
        (text.clean_teradata, "SELECT a (NAMED b), c COMPRESS 0, d FROM t /* x */ EXPAND ON p", "SELECT a (), c , d FROM t"),
        (text.clean_teradata, "SELECT 1;\nBTEQ end", "SELECT 1"),
        (text.split_fused_keywords, "costINNER JOIN paid_atFROM t codeWHERE", "cost INNER JOIN paid_at FROM t code WHERE"),
        (text.split_fused_keywords, "orders region alias", "orders regi on ali as"),
        (text.drop_slash_remarks, "a / b /remark here/ c", "a  remark here/ c"),
        (text.repair_sql, "SELECT a.k_CDFROM t -- c\n/old AND join/JOIN u", "SELECT a.k_CD FROM t JOIN u"),
    ],
)
def test_rules(spark, rule, given, want):
    assert apply(spark, rule, given) == want


@pytest.mark.parametrize("sql", ["SELECT a FROM normalized_a JOIN b", "SELECT format FROM titles, compressed c"])
def test_dialect_words_elsewhere_change_no_name(spark, sql):
    alone = apply(spark, text.clean_teradata, sql)
    beside = apply(spark, text.clean_teradata, sql + " WHERE x (TITLE 'x') = 1")
    assert beside == alone + " WHERE x () = 1"


def test_protected_names_stay_whole(spark):
    rule = lambda c: text.split_fused_keywords(c, protect=["region", "nation"])
    assert apply(spark, rule, "FROM region JOIN nation KEYON") == "FROM region JOIN nation KEY ON"


def test_comment_tables(spark):
    sql = "FROM a\nLEFT JOIN -- db.big_tab AS t ON a.k = t.k\nx -- INNER JOIN db.other o JOIN ab\n-- nothing here"
    assert apply(spark, text.comment_join_tables, sql) == ["big_tab", "other"]


@pytest.mark.parametrize(
    "given, want",
    [
        ("3/24/2026", "2026-03-24 00:00:00"), ("5/13/2026 9:49", "2026-05-13 09:49:00"),
        ("2026-03-24", "2026-03-24 00:00:00"), ("2026-03-24 01:02:03.5", "2026-03-24 01:02:03.500000"),
        (" 12/1/2026 23:59:58 ", "2026-12-01 23:59:58"), ("13/45/2026", None), ("soon", None), ("", None),
    ],
)
def test_times(spark, given, want):
    got = apply(spark, names.parse_time, given)
    assert (None if got is None else str(got)) == want


@pytest.mark.parametrize(
    "user, prefix, other, head",
    [
        ("svp01", "SVP", "SVP", "svp01"), ("ETLx", "ETL", "ETL", "ETLx"), ("operator", "OP", "OP", "operator"),
        ("jdoe", None, "OTHER", "jdoe"), ("fin_app", None, "OTHER", "fin"), (None, None, "OTHER", None),
    ],
)
def test_apps(spark, user, prefix, other, head):
    assert apply(spark, names.app_prefix, user) == prefix
    assert apply(spark, names.app_prefix_or_other, user) == other
    assert apply(spark, names.app_before_underscore, user) == head


def test_negative_runtime_and_null(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2026-01-01 00:00:10' s, timestamp_ntz'2026-01-01 00:00:07' e UNION ALL "
        "SELECT timestamp_ntz'2026-01-01 00:00:10', null"
    )
    got = df.select(
        names.runtime_micros(F.col("s"), F.col("e"), True).alias("c"), names.runtime_micros(F.col("s"), F.col("e"), False).alias("u")
    ).collect()
    assert {(r.c, r.u) for r in got} == {(0, -3_000_000), (None, None)}


@pytest.mark.parametrize(
    "table, domain",
    [("sales.orders", "order"), ("sales.customer", "customer"), ("sales.dept", "order"), ("", "unknown"), ("x.ledger", "finance")],
)
def test_domains(spark, table, domain):
    assert apply(spark, scores.domain, table) == domain


def test_scores(spark):
    score = lambda j, q, u, d: spark.range(1).select(
        scores.recommendation_score(F.lit(j), F.lit(q), F.lit(u), F.lit(d)).alias("s")
    ).first().s
    assert score(10, 20, 3, 1.0) == 38.0
    assert score(1000, 1000, 1000, 1.0) == 100.0
    similarity = lambda l, r: spark.range(1).select(
        scores.domain_similarity(scores.domain(F.lit(l)), scores.domain(F.lit(r))).alias("s")
    ).first().s
    assert [similarity("sales.orders", r) for r in ("sales.customer", "sales.dept", "")] == [0.2, 1.0, 0.3]
    assert apply(spark, scores.wid, "a.b") == "E32B629F6584"
