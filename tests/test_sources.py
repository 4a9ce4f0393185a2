"""Readers, ragged text over real file splits, and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from joinscope import modes
from joinscope.plans import lineage
from joinscope.sources import logs, metric_tables, quoted, ragged, writers
from workload import log_fixture as fx

CSV = (
    "USER_NAME,db_nm,Tbl_nm,SqlTextInfo,LogDate,StartTime,LastResponseTime\n"
    'svp1,sales,orders,"SELECT a, b\nFROM x JOIN y ON x.k = ""y"".k",3/24/2026,2026-03-24 01:00:00,2026-03-24 01:00:05\n'
    "jdoe,,orders,SELECT 1,never,,\n"
)


def test_csv_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(CSV)
    rows = logs.read_query_log(spark, str(path)).collect()
    assert [r.user_name for r in rows] == ["svp1", "jdoe"]
    assert "\nFROM x JOIN y" in rows[0].SqlTextInfo and '"y".k' in rows[0].SqlTextInfo
    assert str(rows[0].LogDate) == "2026-03-24 00:00:00" and rows[1].LogDate is None
    with pytest.raises(ValueError, match="user_name"):
        logs.read_query_log(spark, str(path), strict=True)


def test_other_column_names_and_defaults(spark):
    df = spark.createDataFrame([("SELECT 1", "u", "d")], "sqltextinfo string, USR_NM string, obj_db_nm string")
    row = logs.resolve_log(df).first()
    assert (row.SqlTextInfo, row.user_name, row.Db_nm, row.Tbl_nm, row.LogDate) == ("SELECT 1", "u", "d", None, None)
    with pytest.raises(ValueError, match="SqlTextInfo"):
        logs.resolve_log(spark.range(1))


def test_file_types(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported"):
        logs.read_table(spark, "log.xlsx")
    path = str(tmp_path / "log.parquet")
    spark.range(3).write.parquet(path)
    assert logs.read_table(spark, path).count() == 3


def test_metric_tables(spark, sf_dir, tmp_path):
    path = str(tmp_path / "usage.parquet")
    fx.usage_metrics(spark, sf_dir).write.parquet(path)
    assert metric_tables.read_usage_metrics(spark, path).count() > 0
    csv = tmp_path / "c.csv"
    csv.write_text("row_wid,log_date,table_name,column_name,usage_count,distinct_users,distinct_apps,created_timestamp\nr,2026-01-02,t,c,3,1,1,2026-01-02 00:00:00\n")
    row = metric_tables.read_column_usage(spark, str(csv)).first()
    assert (row.usage_count, str(row.log_date)) == (3, "2026-01-02")


def brute_force_records(content):
    """Plain reading of the record rule."""
    import re

    out, current = [], []
    for line in content.lstrip("﻿").split("\n"):
        if re.match(r"[A-Za-z0-9]+\s*,", line) and current:
            out.append("\n".join(current))
            current = [line]
        else:
            current.append(line)
    out.append("\n".join(current))
    return [r for r in out if not r.lstrip().startswith("user_name")]


@pytest.mark.parametrize("split_bytes", [97, 1 << 20])
def test_ragged_file_over_many_splits(spark, tmp_path, split_bytes):
    header = "﻿user_name,Db_nm,Tbl_nm,SqlTextInfo,LogDate,StartTime,LastResponseTime\n"
    records = []
    for i in range(300):
        sql = f"SELECT {i}\n\n  , x\nFROM a{i} JOIN b ON 1=1" + "\n" * (i % 4) + ("z" * (i * 7 % 400))
        records.append(f'u{i},db,t,"{sql}",3/24/2026,3/24/2026 2:35,3/24/2026\n2:36')
    records.append("bad,row")
    content = header + "\n".join(records)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "log.txt").write_text(content, encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    open_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        lines = ragged.read_lines(spark, str(tmp_path / "in"))
        splits = lines.select("block").distinct().count()
        got = ragged.records_from_lines(lines).orderBy("record_no").collect()
        good, bad = ragged.read_ragged_log(spark, str(tmp_path / "in"))
        ids = {r.query_id for r in good.collect()}
        rejected = bad.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
    assert (splits > 100) == (split_bytes == 97)
    assert [r.text for r in got] == brute_force_records(content)
    assert [r.record_no for r in got] == list(range(1, 302))
    assert len(ids) == 300 and [r.parse_error for r in rejected] == ["fewer than 4 comma-separated segments"]


def test_ragged_lines_before_any_record_stay_apart(spark, tmp_path):
    lines = [f"-- remark {i}" for i in range(500)]
    (tmp_path / "none.txt").write_text("\n".join(lines))
    (tmp_path / "some.txt").write_text("\n".join(lines[:3]) + '\nu1,d,t,"SELECT 1\nFROM t",3/24/2026,3/24/2026 2:35,3/24/2026 2:36\n')
    read = ragged.read_lines(spark, str(tmp_path)).withColumn("block", F.floor(F.col("line_no") / 40))
    got = [(r.file.rsplit("/", 1)[1], r.record_no, r.text) for r in ragged.records_from_lines(read).collect()]
    assert sorted(got) == sorted(
        [("none.txt", 0, t) for t in lines] + [("some.txt", 0, t) for t in lines[:3]]
        + [("some.txt", 1, 'u1,d,t,"SELECT 1\nFROM t",3/24/2026,3/24/2026 2:35,3/24/2026 2:36')]
    )


def test_ragged_fields(spark):
    rows = [
        (1, 'u1,d,t,"SELECT 1",3/24/2026,3/24/2026 2:35,3/24/2026\n2:36'),
        (2, 'u2 , d , t , "SELECT a,\n\n\nb FROM t,3/24/2026 9:49, x , y, z'),
        (3, "u3,d,t,SELECT 1"),
        (4, "u4,d,t"),
        (5, "u_5,d,t,SELECT 1,3/24/2026,a,b"),
        (6, "u6,d,t,SELECT 1,3/24/2026,,a"),
    ]
    df = spark.createDataFrame([("f", n, t) for n, t in rows], "file string, record_no long, text string")
    got = {r.record_no: r for r in ragged.parse_records(df).collect()}
    assert (got[1].SqlTextInfo, got[1].LastResponseTime) == ("SELECT 1", "3/24/2026 2:36")
    assert (got[2].user_name, got[2].SqlTextInfo) == ("u2", "SELECT a,\nb FROM t")
    assert (got[2].LogDate, got[2].StartTime, got[2].LastResponseTime) == ("3/24/2026 9:49", "x", "y z")
    assert [got[i].parse_error is None for i in range(1, 7)] == [True, True, False, False, False, False]
    good = ragged.accepted(ragged.parse_records(df)).orderBy("user_name").collect()
    assert str(good[0].StartTime) == "2026-03-24 02:35:00" and good[1].StartTime is None


def test_write_table(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert writers.write_table(df, str(tmp_path / "out" / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "csv")).collect()[0].s == "a"
    assert writers.write_table(df, str(tmp_path / "p"), "parquet", partition_by=["n"])
    assert not writers.write_table(df.filter("n > 1"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    with pytest.raises(ValueError):
        writers.write_table(df, str(tmp_path / "x"), "xlsx")


def test_empty_or_failed_write_leaves_the_old_table(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert writers.write_table(df, out, "parquet")
    assert not writers.write_table(df.filter("n > 5"), out, "parquet")
    with pytest.raises(Exception, match="no number"):
        writers.write_table(df.select(F.when(F.col("n") < 2, F.col("n")).otherwise(F.raise_error("no number").cast("int")).alias("n")), out, "parquet")
    assert spark.read.parquet(out).count() == 2
    assert writers.write_table(df.filter("n = 1"), out, "parquet") and spark.read.parquet(out).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["t"]  # nothing is left beside it


def test_ordered_write(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g")).repartition(7)
    writers.write_table(df, str(tmp_path / "o"), "csv", order_by=("-g", "k"))
    rows = []
    for part in sorted((tmp_path / "o").glob("part-*.csv")):
        rows += [tuple(map(int, line.split(","))) for line in part.read_text().splitlines()[1:]]
    assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == 5000
    assert len(list((tmp_path / "o").glob("part-*.csv"))) > 1


def test_report_document_and_tables(spark, tmp_path):
    recs = spark.sql("SELECT 2L AS row_id, 'x' AS t, timestamp'2026-01-02 03:04:05' AS at UNION ALL SELECT 1L, null, null")
    health = spark.sql("SELECT 'h' AS row_wid, 1.5D AS score")
    writers.write_report(recs, health, str(tmp_path / "doc"), form="document")
    text = spark.read.text(str(tmp_path / "doc")).collect()
    doc = json.loads(text[0].value)
    assert list(doc) == ["DATA_PRODUCT_RECOMMENDATION", "DATA_PRODUCT_HEALTH_SUMMARY"]
    assert doc["DATA_PRODUCT_RECOMMENDATION"] == [
        {"row_id": 1, "t": None, "at": None}, {"row_id": 2, "t": "x", "at": "2026-01-02T03:04:05Z"},
    ]
    assert doc["DATA_PRODUCT_HEALTH_SUMMARY"] == [{"row_wid": "h", "score": 1.5}]
    writers.write_report(recs, health, str(tmp_path / "tables"))
    assert spark.read.json(str(tmp_path / "tables" / "DATA_PRODUCT_RECOMMENDATION")).count() == 2


def test_empty_log_gives_empty_result(spark):
    log = spark.createDataFrame([], "user_name string, Db_nm string, Tbl_nm string, SqlTextInfo string, LogDate timestamp_ntz, StartTime timestamp_ntz, LastResponseTime timestamp_ntz")
    for mode in (modes.NEAREST_PRECEDING, modes.PER_BLOCK):
        out = lineage.pair_lineage(log, mode)
        assert out.count() == 0 and out.columns[0] == "Row_id"
    assert lineage.scored_lineage(log).count() == 0
    assert lineage.slim_lineage(log).select(F.count("*")).first()[0] == 0


def test_quoted_csv_over_real_splits(spark, tmp_path):
    rows = [("id", "text", "last")]
    for i in range(400):
        rows.append((str(i), f'line {i}\nsays ""quoted, with comma""\n' + "x" * (i % 37), f"end {i}"))
    text = "\n".join(f'{a},"{b}",{c}' if a != "id" else "id,text,last" for a, b, c in rows) + "\n"
    (tmp_path / "log.csv").write_text(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = logs.read_table(spark, str(tmp_path / "log.csv"), multi_line=True)
        assert df.columns == ["id", "text", "last"]
        lines = spark.read.text(str(tmp_path / "log.csv"))
        assert lines.select(F.spark_partition_id()).distinct().count() > 4
        got = {r.id: (r.text, r.last) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {a: (b.replace('""', '"'), c) for a, b, c in rows[1:]}


DAMAGED_A = '''id,user,sql,date
1,ann,"SELECT a, b

FROM t",2020-01-01
2,bob,"SELECT x",2020-01-02
3,cyd,"SELECT lost
FROM u,2020-01-03
4,dan,"SELECT y
FROM v",2020-01-04

5,5" pipe,SELECT z,2020-01-05
6,eve,"a ""quoted"" word",2020-01-06
7,"fay,"SELECT 1",2020-01-07
8,gus,"SELECT 2",2020-01-08
9,hal,"SELECT lost
10,ian,"SELECT lost too
11,jon,"SELECT 3
FROM w",2020-01-11
,kim,,2020-01-12
13,leo,x
14,"",y,2020-01-14
15,mia,"open
'''
DAMAGED_B = 'date,id,sql,extra\r\n2021-01-01,101,"SELECT 7\r\n, 8",e\r\n2021-01-02,102,SELECT 9,\r\n'


def _dated(fields):
    return F.try_element_at(fields, F.lit("date")).rlike(r"^\d{4}-\d\d-\d\d$")


def test_damaged_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(DAMAGED_A)
    (tmp_path / "b.csv").write_bytes(DAMAGED_B.encode())
    log, rejected = quoted.read_quoted(spark, str(tmp_path), verified=_dated)
    got = {(r.id, r.user, r.sql, r.date, r.extra) for r in log.collect()}
    assert got == {
        ("1", "ann", "SELECT a, b\n\nFROM t", "2020-01-01", None), ("2", "bob", "SELECT x", "2020-01-02", None),
        ("4", "dan", "SELECT y\nFROM v", "2020-01-04", None), ("5", '5" pipe', "SELECT z", "2020-01-05", None),
        ("6", "eve", 'a "quoted" word', "2020-01-06", None), ("8", "gus", "SELECT 2", "2020-01-08", None),
        ("11", "jon", "SELECT 3\nFROM w", "2020-01-11", None), (None, "kim", None, "2020-01-12", None), ("14", None, "y", "2020-01-14", None),
        ("101", None, "SELECT 7\n, 8", "2021-01-01", "e"), ("102", None, "SELECT 9", "2021-01-02", None),
    }
    assert sorted(r.text for r in rejected.collect()) == sorted(
        ['3,cyd,"SELECT lost', "FROM u,2020-01-03", '7,"fay,"SELECT 1",2020-01-07', '9,hal,"SELECT lost', '10,ian,"SELECT lost too', "13,leo,x", '15,mia,"open']
    )


def test_record_longer_than_allowed_is_rejected_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_LINES", 20)
    rows = [f"{i},x,2020-01-01" for i in range(200)]
    (tmp_path / "a.csv").write_text("\n".join(["id,sql,date", *rows[:50], '50,"never closed,2020-01-01', *rows[51:]]))
    log, rejected = quoted.read_quoted(spark, str(tmp_path / "a.csv"), verified=_dated)
    assert sorted(int(r.id) for r in log.collect()) == [i for i in range(200) if i != 50]
    assert [(r.error, r.text) for r in rejected.collect()] == [("longer than 20 lines", '50,"never closed,2020-01-01')]


def _records_of(spark, tmp_path, text):
    (tmp_path / "a.csv").write_text(text)
    lines = ragged.read_lines(spark, str(tmp_path / "a.csv"))
    cut = lines.withColumn("block", F.floor(F.col("line_no") / 7_000))  # over block ends as well
    return {r.record_no: r.text for r in quoted.quoted_records(cut).collect()}


def test_long_records_are_whole(spark, tmp_path, monkeypatch):
    long = '1,"' + "\n".join(f"line {i}" for i in range(quoted.MOST_LINES + 5)) + '",x'
    assert _records_of(spark, tmp_path, f"id,sql,last\n{long}\n2,b,y\n") == {1: "id,sql,last", 2: long, 3: "2,b,y"}
    monkeypatch.setattr(quoted, "MOST_LINES", 3)
    within, open_ = '1,"a\nb\nc\nd\n""e",x', '3,"a\nb\nc\nd'
    assert _records_of(spark, tmp_path, f"id,sql,last\n{within}\n2,b,y\n{open_}") == {1: "id,sql,last", 2: within, 3: "2,b,y", 4: open_}


def test_long_sound_records_are_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_LINES", 3)
    sql = 'SELECT ""a"", b\n\n, c\nFROM t\nWHERE x = ""y""'
    short = '2,"SELECT 1,\n2,\n3,\n4"'
    text = "\n".join(["id,sql,date", f'1,"{sql}",2020-01-01', short, "3,x,2020-01-03", '4,"lost "quote\n\n\n\nz",2020-01-04', f'5,"{sql}\n",2020-01-05', "6,x,2020-01-06", '7,"open', "8,x,2020-01-08", "\n\n9,x,2020-01-09"])
    (tmp_path / "a.csv").write_text(text)
    log, rejected = quoted.read_quoted(spark, str(tmp_path / "a.csv"), verified=_dated)
    whole = sql.replace('""', '"')
    assert {(r.id, r.sql) for r in log.collect()} == {("1", whole), ("3", "x"), ("5", whole + "\n"), ("6", "x"), ("8", "x"), ("9", "x")}
    assert sorted((r.error, r.text) for r in rejected.collect()) == sorted(
        [("longer than 3 lines", t) for t in ('2,"SELECT 1,', '4,"lost "quote', '7,"open')]
        + [("1 fields instead of 3", t) for t in ('4"',)] + [("2 fields instead of 3", t) for t in ("2,", "3,", 'z",2020-01-04')]
    )


def test_long_records_are_judged_by_their_lines_as_by_their_texts(spark, tmp_path, monkeypatch):
    odd = ['1,"a""\n""b",c', '2,"""\n"""', '3,"\n"', '4,"\n",', '5,"a"b\nc",d', '6,"a\nb"c",d', '7,x,"\n,"",""\n",y', '8,"a\nb",c,d', '9,"\n""\nc"d",', 'e,"\n"",z\n""",f']
    (tmp_path / "a.csv").write_text("id,sql,date\n" + "\n".join(["x,y,z", *odd, *odd[::-1], '9,"open\n"",']))
    lines = ragged.read_lines(spark, str(tmp_path / "a.csv")).withColumn("block", F.floor(F.col("line_no") / 4))
    numbered = quoted.materialize(quoted.numbered_lines(lines))
    headers = quoted.materialize(quoted._headers(numbered))
    judged = quoted._judged(quoted._candidates(numbered), headers, "file", None).where("lines > 1").collect()
    monkeypatch.setattr(quoted, "MOST_LINES", 1)
    got = {(r.record_no, r.lines, r.closed, r.text) for r in quoted._too_long(numbered, headers).collect()}
    assert got == {(r.record_no, r.lines, r.closed, r.text.split("\n")[0]) for r in judged if r.error is not None}
    assert len(judged) == 21 and 7 < len(got) < 21


def test_no_line_is_lost_after_the_last_round(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_LINES", 3)
    monkeypatch.setattr(quoted, "MOST_ROUNDS", 1)
    (tmp_path / "a.csv").write_text('id,sql,date\n1,x,2020-01-01\n2,"open\nb\n\nc\nd')
    log, rejected = quoted.read_quoted(spark, str(tmp_path / "a.csv"))
    assert [r.id for r in log.collect()] == ["1"]
    assert sorted(r.text for r in rejected.collect()) == sorted(['2,"open', "b", "", "c", "d"])


def test_ragged_text_is_parsed_once(spark, tmp_path):
    (tmp_path / "r.txt").write_text("svp1,sales,orders,SELECT 1 FROM a JOIN b ON 1=1,3/24/2026,3/24/2026 9:05,3/24/2026 9:06\n")
    log, rejected = ragged.read_ragged_log(spark, str(tmp_path / "r.txt"))
    plan = log.where("SqlTextInfo <> ''")._jdf.queryExecution().optimizedPlan().toString()
    # Once for each of the three readers of the stored fragments, which are not put together again.
    assert plan.count("regexp_instr(") == 3 and "collect_list(struct(line_no" not in plan
    assert [r.SqlTextInfo for r in log.collect()] == ["SELECT 1 FROM a JOIN b ON 1=1"] and rejected.count() == 0


def test_lines_are_dealt_by_their_number(spark, monkeypatch):
    lines = spark.range(900).select(F.lit("f").alias("file"), F.floor(F.col("id") / 10).alias("block"), F.col("id").alias("line_no"), F.concat("id", F.lit(',"x\n"')).alias("value"))
    want = {tuple(r) for r in quoted.quoted_records(lines).collect()}
    monkeypatch.setattr(quoted, "TASK_LINES", 20)
    many = quoted.quoted_records(lines)
    assert {tuple(r) for r in many.collect()} == want and len(want) == 900
    assert quoted._parts(lines) == 45
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(file" in plan and ", 45)" in plan


def test_runs_of_unsound_records_go_on_over_stretches(spark, monkeypatch):
    # (record, lines): a run over three stretches of 4, one that ends with its stretch, one that starts with it
    rows = [(2, 1), (3, 5), *[(n, 1) for n in range(4, 8)], (8, 2), (9, 1), (13, 1), (15, 3), (17, 2), (19, 1), (20, 2), (24, 2)]
    unsound = spark.createDataFrame([(f, n, k) for f in ("a", "b") for n, k in rows], "file string, record_no long, lines long")
    whole = {tuple(r) for r in quoted._regions(unsound).collect()}
    assert {r[1]: r[2] for r in whole if r[0] == "a"} == {2: None, **dict.fromkeys(range(3, 10), 3), 13: None, 15: 15, 17: 17, 19: None, 20: 20, 24: 24}
    for size in (1, 2, 4, 5):
        monkeypatch.setattr(quoted, "STRETCH", size)
        assert {tuple(r) for r in quoted._regions(unsound).collect()} == whole


def test_states_do_not_depend_on_the_splits(spark, tmp_path):
    (tmp_path / "a.csv").write_text(DAMAGED_A * 30)
    lines = ragged.read_lines(spark, str(tmp_path / "a.csv"))
    want = {(r.record_no, r.text) for r in quoted.quoted_records(lines).collect()}
    for size in (1, 3, 7):
        cut = lines.withColumn("block", F.floor(F.col("line_no") / size))
        assert {(r.record_no, r.text) for r in quoted.quoted_records(cut).collect()} == want


def test_bad_cells_are_reported(spark, tmp_path):
    (tmp_path / "u.csv").write_text("log_date,row_wid,table_name,column_name,usage_count,distinct_users\n2026-01-02,r1,t,c,3 times,1\nsoon,r2,t,c, 4 ,\n")
    table = metric_tables.read_column_usage(spark, str(tmp_path / "u.csv"), rescued="_rescued")
    rows = {r.row_wid: r for r in table.collect()}
    assert rows["r1"].usage_count is None and rows["r2"].usage_count == 4 and rows["r2"].log_date is None
    assert {tuple(r) for r in logs.bad_cells(table, ["row_wid"]).collect()} == {("r1", "usage_count", "3 times"), ("r2", "log_date", "soon")}


def test_checked_log(spark, tmp_path):
    (tmp_path / "log.csv").write_text(CSV + 'x,sales,t,"SELECT lost,3/24/2026,,\n' + CSV.split("\n", 1)[1])
    log, rejected = logs.read_checked_log(spark, str(tmp_path / "log.csv"))
    assert [r.user_name for r in log.collect()].count("svp1") == 2
    # shortly after a damaged record, one without a date does not count
    assert sorted(r.text for r in rejected.collect()) == ["jdoe,,orders,SELECT 1,never,,", 'x,sales,t,"SELECT lost,3/24/2026,,']
