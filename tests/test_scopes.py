"""Pairs of trickier statements, and properties of the extraction."""

import pytest

from joinscope import modes
from joinscope.operators import extract
from joinscope.operators.extract import extract_pairs
from workload.golden import TEMPLATES

SCHEMA = "id int, Db_nm string, Tbl_nm string, SqlTextInfo string"


def pairs(spark, mode, *sqls, tbl="orders", db="sales", **options):
    log = spark.createDataFrame([(i, db, tbl, q) for i, q in enumerate(sqls)], SCHEMA)
    rows = extract_pairs(log, mode, **options).orderBy("id").collect()
    got = {r.id: [(p.left, p.right) for p in r.pairs] for r in rows}
    out = [got.get(i) for i in range(len(sqls))]
    return out[0] if len(out) == 1 else out


CASES = [
    # unaliased tables: JOIN is never taken for an alias
    (modes.NEAREST_PRECEDING, "SELECT 1 FROM orders JOIN customer ON a = b JOIN dept ON c = d", [("orders", "customer"), ("customer", "dept")]),
    (modes.PER_BLOCK, "SELECT 1 FROM orders JOIN customer ON a = b JOIN dept ON c = d", [("orders", "customer"), ("customer", "dept")]),
    # derived table first: its own FROM table is the left side
    (modes.TOP_LEVEL, "SELECT 1 FROM (SELECT k FROM Base b) q JOIN Cust c ON q.k = c.k", [("Base", "Cust")]),
    (modes.PER_BLOCK, "SELECT 1 FROM (SELECT k FROM base b JOIN z ON z.k = b.k) q JOIN cust c ON q.k = c.k", [("base", "cust"), ("base", "z")]),
    # function arguments and IN lists are no scopes and no FROM clauses
    (modes.PER_BLOCK, "SELECT EXTRACT(YEAR FROM o.d), TRIM(BOTH ' ' FROM o.s) FROM o JOIN c ON COALESCE(o.k, 0) = c.k WHERE o.x IN (1, 2)", [("o", "c")]),
    # joins in WHERE subqueries belong to their own block
    (modes.PER_BLOCK, "SELECT 1 FROM a JOIN b ON a.k = b.k WHERE EXISTS (SELECT 1 FROM c JOIN d ON c.k = d.k)", [("a", "b"), ("c", "d")]),
    (modes.TOP_LEVEL, "SELECT 1 FROM a JOIN b ON a.k = b.k WHERE a.x IN (SELECT x FROM c JOIN d ON c.k = d.k)", [("a", "b")]),
    (modes.ALL_SCOPES, "SELECT 1 FROM a JOIN b ON a.k = b.k WHERE EXISTS (SELECT 1 FROM c JOIN d ON c.k = d.k)", [("a", "b"), ("b", "d"), ("c", "d")]),
    # comma lists: several, after a join, with a derived table
    (modes.TOP_LEVEL, "SELECT 1 FROM a, c x, b WHERE 1 = 1", [("a", "c"), ("c", "b")]),
    (modes.TOP_LEVEL, "SELECT 1 FROM a JOIN b ON a.k = b.k, c WHERE 1 = 1", [("a", "b"), ("b", "c")]),
    (modes.ALL_SCOPES, "SELECT 1 FROM a, (SELECT 1 FROM z) q", [("a", "z")]),
    # parenthesised join group
    (modes.TOP_LEVEL, "SELECT 1 FROM (a JOIN b ON a.k = b.k) JOIN c ON b.k = c.k", [("a", "b"), ("b", "c")]),
    # quoted and three-part names
    (modes.PER_BLOCK, 'SELECT 1 FROM "Db"."Tab" t JOIN `x`.`y`.`Z` z ON t.k = z.k', [("tab", "z")]),
    (modes.PER_BLOCK_QUALIFIED, "SELECT 1 FROM c.db.t t JOIN u ON t.k = u.k", [("db.t", "sales.u")]),
    # set operation: each branch starts again
    (modes.TOP_LEVEL, "SELECT 1 FROM a JOIN b ON 1=1 UNION SELECT 1 FROM c JOIN d ON 1=1", [("a", "b"), ("c", "d")]),
    # DML
    (modes.TOP_LEVEL, "INSERT INTO t SELECT 1 FROM a JOIN b ON a.k = b.k", [("a", "b")]),
    (modes.PER_BLOCK, "DELETE FROM a WHERE k IN (SELECT k FROM b JOIN c ON b.k = c.k)", [("b", "c")]),
    (modes.TOP_LEVEL, "UPDATE t JOIN b ON t.k = b.k SET x = 1", [("orders", "b")]),
    # several statements: all but the one-statement modes read them
    (modes.ALL_SCOPES, "SELECT 1 FROM a JOIN b ON 1=1; SELECT 1 FROM c JOIN d ON 1=1", [("a", "b"), ("c", "d")]),
    (modes.TOP_LEVEL, "SELECT 1 FROM a JOIN b ON 1=1; SELECT 1 FROM c JOIN d ON 1=1", [("a", "b")]),
    # self-joins
    (modes.ALL_SCOPES, "SELECT 1 FROM a x JOIN a y ON 1=1 JOIN c ON 1=1", [("a", "c")]),
    (modes.PER_BLOCK, "SELECT 1 FROM a x JOIN a y ON 1=1", [("a", "a")]),
    (modes.NEAREST_PRECEDING, "SELECT 1 FROM b JOIN a x ON 1=1 JOIN a y ON 1=1", [("b", "a"), ("b", "a")]),
    # alias used as a table name: the last definition wins
    (modes.NEAREST_PRECEDING, "SELECT 1 FROM orders o JOIN cust c ON 1=1 JOIN o ON 1=1", [("orders", "cust"), ("cust", "o")]),
    # letter case
    (modes.TOP_LEVEL, "select 1 from Orders o inner join DEPT d on 1=1", [("Orders", "DEPT")]),
    # dirty text
    (modes.DIRTY_LOG, "SELECT 1 FROM orders o\nJOIN -- customer c\nWHERE o.x = 1", [("orders", "customer")]),
    (modes.DIRTY_LOG, "SELECT 1 FROM a INNER JOIN b ON 1=1 INNER JOIN B ON 1=1", [("a", "b")]),
    (modes.DIRTY_LOG, "garbage JOIN customer c", [("orders", "customer")]),
]


@pytest.fixture(scope="module")
def by_mode(spark):
    out = {}
    for mode in {c[0] for c in CASES}:
        sqls = [c[1] for c in CASES if c[0] is mode]
        got = pairs(spark, mode, *sqls)
        out[mode] = dict(zip(sqls, got if len(sqls) > 1 else [got]))
    return out


@pytest.mark.parametrize("mode, sql, want", CASES, ids=lambda v: v.name if isinstance(v, modes.Mode) else None)
def test_case(by_mode, mode, sql, want):
    assert by_mode[mode][sql] == want


def test_keys(spark):
    sql = (
        "SELECT 1 FROM a JOIN b ON (a.k = b.k AND a.\"J\" = b.j) AND COALESCE(a.x, 0) = b.x AND a.z = 'q' AND a.m >= b.m "
        "JOIN c USING (k) JOIN x ON NVL(c.x, 1) = x.x, y JOIN d ON d.k = (SELECT max(k) FROM e WHERE e.p = 1)"
    )
    log = spark.createDataFrame([(1, "s", "t", sql)], SCHEMA)
    got = extract_pairs(log, modes.PER_BLOCK_QUALIFIED).first().pairs
    keys = {(p.left, p.right): [(k.left_key, k.right_key) for k in p.join_keys] for p in got}
    assert keys[("s.a", "s.b")] == [("k", "k"), ("J", "j"), ("", "x"), ("z", "")]
    assert keys[("s.b", "s.c")] == []
    assert keys[("s.c", "s.x")] == [("", "x")]
    assert keys[("s.x", "s.y")] == []
    assert keys[("s.y", "s.d")] == [("k", ""), ("p", "1")]


def test_blank_sql_is_skipped(spark):
    assert pairs(spark, modes.PER_BLOCK, "", "  ", "NaN", "None", None) == [None] * 5


def test_missing_database_gives_no_prefix(spark):
    assert pairs(spark, modes.PER_BLOCK_QUALIFIED, "SELECT 1 FROM a JOIN b ON a.k = b.k", db=None) == [("a", "b")]


def test_unmasked_literals_are_visible(spark):
    sql = "SELECT 'FROM x JOIN y' FROM a JOIN b ON 1=1"
    assert pairs(spark, modes.NEAREST_PRECEDING, sql) == [("a", "b")]
    assert ("x", "y") in pairs(spark, modes.NEAREST_PRECEDING, sql, mask_literals=False)


@pytest.mark.parametrize("mode", [modes.ALL_SCOPES, modes.NEAREST_PRECEDING, modes.PER_BLOCK], ids=lambda m: m.name)
def test_comments_and_blanks_change_nothing(spark, mode):
    plain = [t for t in TEMPLATES if "--" not in t and "kFROM" not in t]
    noisy = [t.replace(" JOIN ", "\n\tJOIN ").replace(" FROM ", " /* FROM q JOIN r */\n  FROM -- JOIN s\n ") for t in plain]
    assert pairs(spark, mode, *plain) == pairs(spark, mode, *noisy)


def test_long_statement(spark):
    joins = " ".join(f"JOIN t{i} x{i} ON x{i}.k = x{i - 1}.k" for i in range(1, 300))
    got = pairs(spark, modes.PER_BLOCK, f"SELECT '{'x' * 50000}' FROM t0 x0 {joins} -- " + "y" * 50000)
    assert got == [(f"t{i}", f"t{i + 1}") for i in range(299)]


@pytest.mark.parametrize("mode", modes.MODES.values(), ids=lambda m: m.name)
def test_repeated_texts_are_read_once(spark, monkeypatch, mode):
    rows = [(i, None if i % 3 == 0 else "Sales", None if i % 2 else "orders", TEMPLATES[i % 4] if i % 5 else " ") for i in range(400)]
    log = spark.createDataFrame(rows, SCHEMA)
    many = extract_pairs(log, mode)
    got = {r.id: r for r in many.collect()}
    plan = many._jdf.queryExecution().optimizedPlan().toString()
    assert ("Join LeftOuter" in plan) == (mode.scope != "nearest_preceding")
    monkeypatch.setattr(extract, "MOST_TEXTS", 1)
    single = extract_pairs(log, mode)
    assert "Join LeftOuter" not in single._jdf.queryExecution().optimizedPlan().toString()
    want = {r.id: r for r in single.collect()}
    assert got == want and len(want) == 320
