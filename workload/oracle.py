"""Check SQL for the registered queries.

Nothing here parses SQL text: expected pairs come from the hand-written template table, and
everything else is ordinary aggregation.
"""

from __future__ import annotations

import re

from joinscope.operators.recommend import RULES
from joinscope.schemas import HEALTH_COLUMNS, RECOMMENDATION_COLUMNS
from workload import golden
from workload.log_fixture import OBJECTS


def _lit(value: object) -> str:
    if value is None:
        return "NULL"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("'", "''") + "'"


def _values(rows: list[tuple], columns: str) -> str:
    body = ", ".join("(" + ", ".join(_lit(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS g({columns})"


def _pairs(expected: dict[int, list[tuple]], name=lambda t: t) -> str:
    rows = [(t, i, name(p[0]), name(p[1])) for t, ps in expected.items() for i, p in enumerate(ps)]
    return _values(rows, "t, seq, l, r")


def _keyed_pairs() -> str:
    q = golden.qualified
    rows = [
        (t, i, q(l), q(r), kind, len(keys), ",".join(keys))
        for t, ps in golden.PER_BLOCK_KEYED.items()
        for i, (l, r, kind, keys) in enumerate(ps)
    ]
    return _values(rows, "t, seq, l, r, kind, n_keys, keys")


_TEMPLATES = _values([(i + 1, sql) for i, sql in enumerate(golden.TEMPLATES)], "t, sql")

LOG = """
log AS (
  SELECT o_orderkey AS query_id, o_orderkey % 16 + 1 AS t,
    CASE o_orderkey % 5 WHEN 0 THEN 'SVP' WHEN 1 THEN 'etl' WHEN 2 THEN 'OP' WHEN 3 THEN 'jdoe' END
      || CAST(o_custkey % 20 AS VARCHAR) AS user_name,
    CASE o_orderkey % 5 WHEN 0 THEN 'SVP' WHEN 1 THEN 'ETL' WHEN 2 THEN 'OP' END AS app,
    CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m%d') AS wid,
    strftime(o_orderdate, '%Y-%m-%d') AS day_text,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN -1 ELSE o_orderkey % 41 END AS seconds,
    o_orderdate AS log_date
  FROM orders)"""


def _pair_query(expected, name=lambda t: t) -> str:
    return (
        f"WITH {LOG} SELECT query_id, l AS left_join_table_name, r AS right_join_table_name "
        f"FROM log JOIN {_pairs(expected, name)} USING (t)"
    )


def _metrics(expected, wid, day, users, apps, queries, seconds, decimals, order) -> str:
    return f"""
WITH {LOG},
rows AS (SELECT log.*, l, r FROM log JOIN {_pairs(expected)} USING (t)),
agg AS (
  SELECT {wid} AS date_wid, {day} AS "Metric date", l AS left_join_table_name, r AS right_join_table_name,
    count(*) AS join_count, {users} AS unique_users, {apps} AS unique_app, {queries} AS query_count,
    round(avg({seconds}), {decimals}) AS avg_runtime
  FROM rows GROUP BY 1, 2, 3, 4)
SELECT row_number() OVER (ORDER BY {order}) AS "Row_id", * FROM agg"""


_DAMAGED = f"""
WITH {LOG},
marked AS (SELECT log.*, sql, query_id % 37 = 5 OR query_id % 43 = 11 AS damaged FROM log JOIN {_TEMPLATES} USING (t))"""
_CLIPPED = "CASE WHEN seconds < 0 THEN 0 ELSE seconds END"
_BY_DATE = "date_wid, left_join_table_name, right_join_table_name"
_USERS, _APPS = "count(DISTINCT user_name)", "count(DISTINCT app)"

AGG = {
    "all_scopes": _metrics(
        golden.ALL_SCOPES, "CAST(wid AS INTEGER)", "day", _USERS, _APPS, "count(user_name)", "seconds", 2,
        "date_wid, join_count DESC, left_join_table_name, right_join_table_name",
    ),
    "top_level": _metrics(golden.TOP_LEVEL, "wid", "day", _USERS, _APPS, "count(seconds)", _CLIPPED, 2, _BY_DATE),
    "dirty_log": _metrics(golden.DIRTY_LOG, "wid", "day", _USERS, _APPS, "count(seconds)", _CLIPPED, 2, _BY_DATE),
    "nearest_preceding": _metrics(
        golden.NEAREST_PRECEDING, "wid", "day_text", _USERS, _APPS, "count(DISTINCT query_id)", "seconds", 4,
        "left_join_table_name, right_join_table_name, date_wid",
    ),
    "per_block": _metrics(
        golden.PER_BLOCK, "wid", "day_text", _USERS, "count(DISTINCT coalesce(app, 'OTHER'))", "count(*)", _CLIPPED, 3,
        _BY_DATE,
    ),
}

_wid = lambda s, n=12: f"upper(substring(md5({s}), 1, {n}))"
_DOMAIN = (
    "CASE WHEN {0} LIKE '%customer' THEN 'customer' WHEN {0} = '' THEN 'unknown' ELSE 'order' END"
)
_SIMILARITY = "CASE WHEN ld = 'unknown' OR rd = 'unknown' THEN 0.3 WHEN ld = rd THEN 1.0 ELSE 0.2 END"
_SCORE = (
    "round(least({q} / 10.0, 10.0) * 4 + least({j} / 5.0, 5.0) * 4 + least({u} / 3.0, 10.0) * 2 + {s} * 20, 2)"
)
_PRODUCTS = f"""
WITH {LOG},
rows AS (SELECT log.*, l, r, n_keys FROM log JOIN {_keyed_pairs()} USING (t)),
agg AS (
  SELECT wid AS date_wid, min(day_text) AS metric_date, l, r, CAST(greatest(sum(n_keys), 1) AS BIGINT) AS join_count,
    count(DISTINCT user_name) AS unique_users, count(DISTINCT user_name) AS unique_app, count(*) AS query_count
  FROM rows GROUP BY wid, l, r),
dom AS (SELECT *, {_DOMAIN.format('l')} AS ld, {_DOMAIN.format('r')} AS rd FROM agg),
sim AS (SELECT *, CAST({_SIMILARITY} AS DOUBLE) AS s FROM dom)"""

USAGE = f"""
usage AS (
  SELECT CAST(ts AS DATE) AS metric_date, 'product_' || CAST(user_id % 12 AS VARCHAR) AS data_product_name,
    CASE WHEN user_id % 12 = 9 THEN NULL ELSE 'sales' END AS db,
    list_extract([{', '.join(_lit(o) for o in OBJECTS)}], CAST(user_id % 12 + 1 AS INTEGER)) AS object,
    CASE WHEN user_id % 12 = 7 THEN NULL ELSE 'ID-' || CAST(user_id % 12 AS VARCHAR) END AS object_id,
    count(*) FILTER (event_id % 3 <> 0) AS user_query_count, count(*) FILTER (event_id % 3 = 0) AS app_query_count,
    count(DISTINCT CASE WHEN event_id % 3 <> 0 THEN user_id END) AS unique_user,
    count(DISTINCT CASE WHEN event_id % 3 = 0 THEN event_id % 7 END) AS unique_app,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
    count(*) FILTER (event_type = 'error') AS failed
  FROM events GROUP BY 1, 2, 3, 4, 5)"""


def _rollup(keys: str) -> str:
    return f"""
  SELECT {keys}, CAST(sum(user_query_count) AS BIGINT) AS user_queries, CAST(sum(app_query_count) AS BIGINT) AS app_queries,
    CAST(sum(unique_user) AS BIGINT) AS users, CAST(sum(unique_app) AS BIGINT) AS apps,
    CAST(sum(cents) AS DOUBLE) / 100 AS total_seconds, CAST(sum(failed) AS BIGINT) AS failed,
    max(metric_date) AS last_active,
    CAST(sum(user_query_count + app_query_count) AS BIGINT) AS queries,
    CAST(sum(cents) AS DOUBLE) / 100 / CAST(sum(user_query_count + app_query_count) AS BIGINT) AS average_seconds,
    100.0::DOUBLE * CAST(sum(failed) AS BIGINT) / CAST(sum(user_query_count + app_query_count) AS BIGINT) AS failure_rate
  FROM usage GROUP BY ALL"""


COLUMNS = f"""
col AS (
  SELECT list_extract([{', '.join(_lit(o) for o in OBJECTS[:5])}], CAST(p_partkey % 5 + 1 AS INTEGER)) AS table_name,
    'col_' || CAST(p_size % 20 AS VARCHAR) AS column_name,
    CAST(sum(CASE WHEN p_size % 20 = 0 AND p_partkey % 5 <> 3 THEN 0 ELSE p_partkey % 50 END) AS BIGINT) AS uses
  FROM part GROUP BY 1, 2)"""

PATTERNS = f"""
pat AS (
  SELECT day AS log_date, split_part(l, '.', 1) AS ldb, split_part(l, '.', 2) AS lt, split_part(r, '.', 1) AS rdb,
    split_part(r, '.', 2) AS rt, kind, keys, count(*) AS join_count, count(DISTINCT user_name) AS users,
    count(DISTINCT app) AS apps
  FROM log JOIN {_keyed_pairs()} USING (t) WHERE r <> '' GROUP BY 1, 2, 3, 4, 5, 6, 7),
side AS (
  SELECT ldb AS db, lt AS tbl, rt AS partner, log_date, join_count, lt || '|' || rt AS pair,
    nullif(array_to_string(list_transform(string_split(keys, ','), lambda k: split_part(k, '=', 1)), ','), '') AS side_key
  FROM pat
  UNION ALL
  SELECT rdb, rt, lt, log_date, join_count, lt || '|' || rt,
    nullif(array_to_string(list_transform(string_split(keys, ','), lambda k: split_part(k, '=', 2)), ','), '')
  FROM pat WHERE lt <> rt),
hot AS (
  SELECT db, tbl, CAST(sum(n) AS BIGINT) AS total_joins, count(*) AS partners, max(days) AS longest_repeat_days
  FROM (SELECT db, tbl, partner, sum(join_count) AS n, count(DISTINCT log_date) AS days FROM side GROUP BY ALL)
  GROUP BY db, tbl),
rep AS (
  SELECT ldb, lt, rdb, rt, CAST(sum(join_count) AS BIGINT) AS total_joins, count(DISTINCT log_date) AS days
  FROM pat GROUP BY ALL)"""

_OBJ = "obj AS (SELECT data_product_name, coalesce(db, '') AS db, object AS tbl FROM usage GROUP BY ALL)"

HEALTH = f"""
WITH {LOG}, {USAGE}, {COLUMNS}, {PATTERNS}, {_OBJ},
roll AS ({_rollup('data_product_name')}),
span AS (SELECT min(user_queries) AS a0, max(user_queries) AS a1, min(app_queries) AS b0, max(app_queries) AS b1,
  min(users) AS c0, max(users) AS c1, min(apps) AS d0, max(apps) AS d1 FROM roll),
meta AS (
  SELECT data_product_name, min(object_id) AS product_id,
    round(100.0::DOUBLE * sum(1 + (db IS NOT NULL)::INT + (object IS NOT NULL)::INT + (object_id IS NOT NULL)::INT)
      / (count(*) * 4), 2) AS metadata_score
  FROM usage GROUP BY 1),
colf AS (
  SELECT data_product_name, coalesce(sum(n), 0) AS columns, coalesce(sum(z), 0) AS unused_columns, coalesce(sum(q), 0) AS rare_columns FROM obj LEFT JOIN
    (SELECT table_name, count(*) AS n, count(*) FILTER (uses = 0) AS z,
      count(*) FILTER (uses > 0 AND uses <= (SELECT quantile_cont(uses, 0.25) FROM col WHERE uses > 0)) AS q FROM col GROUP BY 1) c ON c.table_name = obj.tbl
  GROUP BY 1),
seen AS (SELECT db, tbl, side_key, count(*) AS seen FROM side WHERE side_key IS NOT NULL GROUP BY ALL),
keyed AS (
  SELECT db, tbl, max(seen) AS key_patterns, max(seen) FILTER (side_key LIKE '%,%') AS composite_patterns,
    bool_or(seen >= (SELECT quantile_cont(seen, 0.9) FROM seen)) AS top_key
  FROM seen GROUP BY 1, 2),
stored AS (SELECT * FROM rep WHERE days >= 3 AND total_joins >= (SELECT quantile_cont(total_joins, 0.9) FROM rep)),
touched AS (
  SELECT db, tbl, max(days) AS stored_days, max(total_joins) AS stored_joins
  FROM (SELECT ldb AS db, lt AS tbl, days, total_joins FROM stored UNION ALL SELECT rdb, rt, days, total_joins FROM stored)
  GROUP BY 1, 2),
joinf AS (
  SELECT data_product_name, coalesce(sum(total_joins), 0) AS joins, coalesce(max(partners), 0) AS partners,
    coalesce(max(key_patterns), 0) AS key_patterns, coalesce(max(composite_patterns), 0) AS composite_patterns,
    coalesce(max(stored_days), 0) AS stored_days, coalesce(max(stored_joins), 0) AS stored_joins, coalesce(bool_or(top_key), false) AS top_key
  FROM obj LEFT JOIN hot USING (db, tbl) LEFT JOIN keyed USING (db, tbl) LEFT JOIN touched USING (db, tbl) GROUP BY 1),
feat AS (
  SELECT roll.*, metadata_score, product_id, columns, unused_columns, rare_columns, joins, partners, key_patterns, composite_patterns, top_key,
    stored_days, stored_joins, (SELECT max(metric_date) FROM usage) AS as_of,
    round(100.0::DOUBLE * ((user_queries - a0) / (a1 - a0)::DOUBLE + (app_queries - b0) / (b1 - b0)::DOUBLE
      + (users - c0) / (c1 - c0)::DOUBLE + (apps - d0) / (d1 - d0)::DOUBLE) / 4, 2) AS usage_score,
    round(greatest(least(100.0::DOUBLE - failure_rate, 100.0::DOUBLE), 0), 2) AS quality_score,
    date_diff('day', last_active, (SELECT max(metric_date) FROM usage)) AS idle_days
  FROM roll JOIN meta USING (data_product_name) JOIN colf USING (data_product_name)
    JOIN joinf USING (data_product_name) CROSS JOIN span),
lim AS (
  SELECT quantile_cont(average_seconds, 0.9) AS slow_from, quantile_cont(total_seconds, 0.9) AS heavy_from,
    quantile_cont(joins, 0.9) AS joins_from, quantile_cont(queries, 0.5) AS median_queries,
    quantile_cont(usage_score, 0.75) AS used_from, quantile_cont(usage_score, 0.9) AS high_from,
    quantile_cont(usage_score, 0.1) AS low_to FROM feat),
flag AS (
  SELECT *, average_seconds >= slow_from AS slow, joins > 0 AND joins >= joins_from AS many_joins,
    failure_rate > 5 AS often_failing, key_patterns >= 3 AS index_candidate,
    coalesce(unused_columns, 0) > 0 AS has_unused FROM feat, lim),
scored AS (
  SELECT *, round(100.0::DOUBLE * greatest(0, 1 - idle_days / 30.0::DOUBLE), 2) AS freshness_score,
    CAST(greatest(0, 100 - 20 * slow::INT - 15 * many_joins::INT - 20 * often_failing::INT - 15 * index_candidate::INT
      - 15 * (slow AND many_joins)::INT - 15 * has_unused::INT) AS DOUBLE) AS optimization_score FROM flag),
total AS (
  SELECT *, round((usage_score + quality_score + metadata_score + freshness_score + optimization_score) / 5, 2)
    AS overall_health_score FROM scored)"""

# Rules as (type, condition, impact metric, lower is worse); only the wording is shared.
_RULES = (
    ("INDEX_RECOMMENDATION", "index_candidate OR top_key", "key_patterns", False),
    ("MATERIALIZED_VIEW", "stored_days > 0", "stored_joins", False),
    ("QUERY_OPTIMIZATION", "slow", "average_seconds", False),
    ("TABLE_OPTIMIZATION", "total_seconds >= heavy_from AND queries >= median_queries", "total_seconds", False),
    ("COLUMN_OPTIMIZATION", "has_unused OR rare_columns > 0", "unused_columns", False),
    ("PERFORMANCE_IMPROVEMENT", "slow AND usage_score >= used_from", "average_seconds", False),
    ("JOIN_OPTIMIZATION", "many_joins", "joins", False),
    ("ARCHIVAL", "idle_days > 30", "idle_days", False),
    ("DATA_GOVERNANCE", "metadata_score < 100", "metadata_score", True),
    ("MONITORING", "failure_rate > 0 AND failure_rate <= 5", "failure_rate", False),
    ("RELIABILITY", "often_failing", "failure_rate", False),
    ("HIGH_USAGE_ALERT", "usage_score >= high_from", "usage_score", False),
    ("LOW_USAGE_ALERT", "usage_score <= low_to", "usage_score", True),
)


# What each rule's reason reports, in the order of its text.
_REASON_VALUES = {
    "INDEX_RECOMMENDATION": ("key_patterns", "composite_patterns"),
    "MATERIALIZED_VIEW": ("stored_joins", "stored_days"),
    "QUERY_OPTIMIZATION": ("average_seconds", "slow_from"),
    "TABLE_OPTIMIZATION": ("total_seconds", "queries"),
    "COLUMN_OPTIMIZATION": ("unused_columns", "columns", "rare_columns"),
    "PERFORMANCE_IMPROVEMENT": ("average_seconds", "usage_score"),
    "JOIN_OPTIMIZATION": ("joins", "partners"),
    "ARCHIVAL": ("idle_days",),
    "DATA_GOVERNANCE": ("metadata_score",),
    "MONITORING": ("failed", "queries"),
    "RELIABILITY": ("failed", "queries"),
    "HIGH_USAGE_ALERT": ("usage_score",),
    "LOW_USAGE_ALERT": ("usage_score",),
}


def _recommendations() -> str:
    wording = {r.type: r for r in RULES}
    parts = []
    for kind, condition, metric, inverse in _RULES:
        rank = f"(rank() OVER (ORDER BY {metric}) - 1) / (count(*) OVER () - 1)::DOUBLE"
        severity = f"1.0::DOUBLE - {rank}" if inverse else rank
        rule = wording[kind]
        pieces = rule.reason.replace("%.2f", "%d").split("%d")
        formats = re.findall("%d|%.2f", rule.reason)
        reason = _lit(pieces[0])
        for form, value, piece in zip(formats, _REASON_VALUES[kind], pieces[1:]):
            shown = f"CAST({value} AS BIGINT)" if form == "%d" else f"CAST({value} AS DECIMAL(18, 2))"
            reason += f" || CAST({shown} AS VARCHAR) || {_lit(piece)}"
        parts.append(
            f"SELECT data_product_name, product_id AS data_product_id, as_of AS recommendation_date, "
            f"'{kind}' AS recommendation_type, {_lit(rule.title)} AS recommendation_title, "
            f"{_lit(rule.description)} AS recommendation_description, {reason} AS recommendation_reason, "
            f"{_lit(rule.benefit)} AS expected_benefit, CAST(round(100 * ({severity})) AS INTEGER) AS estimated_impact_score, "
            f"{condition} AS fires FROM total"
        )
    return f"""{HEALTH}, fired AS ({' UNION ALL '.join(parts)})
SELECT row_number() OVER w AS row_id, 'REC-' || lpad(CAST(row_number() OVER w AS VARCHAR), 6, '0') AS recommendation_id,
  * EXCLUDE (fires), strftime(recommendation_date, '%Y%m%d') AS recommendation_date_wid, 1.0::DOUBLE AS confidence_score,
  CASE WHEN estimated_impact_score >= 70 THEN 'HIGH' WHEN estimated_impact_score >= 40 THEN 'MEDIUM' ELSE 'LOW' END
    AS recommendation_priority, 'Enterprise AI Recommendation Engine' AS generated_by, 'NEW' AS status
FROM fired WHERE fires WINDOW w AS (ORDER BY data_product_name, recommendation_type)"""


def _text_rules() -> dict[str, str]:
    def over(expression: str) -> str:
        k = "CAST(o_orderkey AS VARCHAR)"
        return f"SELECT o_orderkey AS query_id, {expression.format(k=k)} AS text FROM orders"

    nl = "chr(10)"
    return {
        "text_strip_comments": over(f"'SELECT   k' || {{k}} || ', j ' || {nl} || {nl} || 'FROM t'"),
        "text_strip_hints": over(f"'SELECT   k' || {{k}} || '  ' || {nl} || 'FROM t'"),
        "text_flatten": over("'SELECT k' || {k} || ' FROM t'"),
        "text_teradata": over("'SELECT a () (), b' || {k} || ' () FROM t'"),
        "text_split_fused": over("'SELECT regi on, k' || {k} || ' FROM t WHERE a UNI ON cost INNER JOIN u'"),
        "text_slash_remarks": over("'SELECT a  remark ' || {k} || ' here/ FROM t /* kept */'"),
        "text_repair": over("'SELECT a.k' || {k} || ' FROM t JOIN u a ON a.k = u.k'"),
        "name_normalize": over("'tab' || {k}"),
        "name_bare": over("'Tab' || {k}"),
        "name_qualify": over("'sales.tab' || {k}"),
        "name_app_prefix": over("'SVP'"),
        "name_app_other": over("'OTHER'"),
        "name_app_before_underscore": over("'fin'"),
        "wid": over("upper(substring(md5('sales.t' || {k}), 1, 12))"),
    }


def _document() -> str:
    """Both result tables as one JSON text, each ordered by its first column."""
    wid = _wid("data_product_name || '|health'", 16)
    recs = ", ".join(c for c in RECOMMENDATION_COLUMNS if c != "created_timestamp")
    summary = ", ".join(c for c in HEALTH_COLUMNS if c != "last_updated")
    rows = lambda columns, order: f"list(struct_pack({', '.join(f'{c} := {c}' for c in columns.split(', '))}) ORDER BY {order})"
    return f"""
SELECT to_json(struct_pack(
  DATA_PRODUCT_RECOMMENDATION := (SELECT {rows(recs, "row_id")} FROM ({_recommendations()})),
  DATA_PRODUCT_HEALTH_SUMMARY := (SELECT {rows(summary, "row_wid")} FROM (
    SELECT *, {wid} AS row_wid, round(100.0::DOUBLE - overall_health_score, 2) AS recommendation_score
    FROM ({HEALTH} SELECT * FROM total)))))::VARCHAR AS value"""


def _ragged() -> str:
    """The ragged records, their place in the file, and what each has to parse to."""
    key = "query_id"
    broken_time = "strftime({0}, '%-m/%-d/%Y') || chr(10) || strftime({0}, '%-H:%M')"
    time = "strftime({0}, '%-m/%-d/%Y %-H:%M')"
    return f"""
WITH {LOG},
base AS (
  SELECT log.*, sql, coalesce(user_name, 'anon7') AS u, log_date + to_seconds({key} % 86400) AS started FROM log
  JOIN {_TEMPLATES} USING (t)),
ended AS (
  SELECT *, coalesce(started + to_seconds(seconds), started) AS ended,
    row_number() OVER (PARTITION BY {key} % 4 ORDER BY {key}) AS record_no,
    'part-' || CAST({key} % 4 AS VARCHAR) AS file,
    u || ',sales,orders,' || CASE {key} % 3 WHEN 0 THEN '"' || sql || '"' WHEN 1 THEN '"' || sql || chr(10) || chr(10)
      ELSE sql END AS head,
    CASE WHEN {key} % 50 = 7 THEN 'no date after the SQL text'
      WHEN {key} % 60 = 3 THEN 'fewer than 4 comma-separated segments'
      WHEN {key} % 70 = 5 THEN 'fewer than 3 time fields' END AS parse_error
  FROM base),
rec AS (
  SELECT *, CASE WHEN {key} % 50 = 7 THEN head WHEN {key} % 60 = 3 THEN u || ',sales'
    ELSE head || ',' || {time.format('log_date')} || ',' || {time.format('started')}
      || CASE WHEN {key} % 70 = 5 THEN '' ELSE ',' || {broken_time.format('ended')} END END AS text
  FROM ended)"""


def _both_sides_of(first: str, second: str, extra: str = "") -> str:
    return (
        f"SELECT o_orderkey AS query_id, {first} AS left_join_table_name, {second} AS right_join_table_name "
        f"FROM orders{extra}"
    )


_T7 = "'t' || CAST(o_orderkey % 7 AS VARCHAR)"
_PAIR_COLUMNS = "l AS left_join_table_name, r AS right_join_table_name"


def _alias_rows() -> str:
    # (template, alias, table) as written, in the order of the templates.
    o, c, d = ("o", "sales.orders"), ("c", "sales.customer"), ("d", "sales.dept")
    rows = {
        1: [o, c], 2: [o, c, d], 3: [("a", "sales.orders"), ("b", "sales.orders")], 5: [o], 6: [o, d], 7: [c],
        8: [o, c, ("x", "sales.part"), ("y", "sales.supplier")], 9: [c, ("n", "sales.nation")], 10: [o, c], 11: [o, d],
        12: [("x", "t"), d, ("a", "sales.orders"), ("b", "sales.customer")], 13: [o, c], 14: [o, c, o, c], 15: [o, c],
        16: [o, c],
    }
    return _values([(t, a, n) for t, es in rows.items() for a, n in es], "t, alias, table_name")


def _key_rows() -> str:
    q = golden.qualified
    rows = [
        (t, q(l), q(r), *k.split("="))
        for t, ps in golden.PER_BLOCK_KEYED.items()
        for l, r, _, keys in ps
        for k in keys
    ]
    return _values(rows, "t, l, r, left_key, right_key")


def _ranking(k: int) -> str:
    reports = (
        ("most used product", "data_product_name", "DESC"),
        ("least used product", "data_product_name", "ASC"),
        ("most used table", "concat_ws('.', db, object)", "DESC"),
        ("most used database", "coalesce(db, '')", "DESC"),
    )
    parts = [
        f"SELECT * FROM (SELECT '{title}' AS report, row_number() OVER (ORDER BY n {direction}, tie) AS place, name, n AS queries "
        f"FROM (SELECT {name} AS name, {'db' if 'database' in title else name} AS tie, "
        f"CAST(sum(user_query_count + app_query_count) AS BIGINT) AS n FROM usage GROUP BY ALL)) WHERE place <= {k}"
        for title, name, direction in reports
    ]
    return f"WITH {USAGE} " + " UNION ALL ".join(parts)


def oracle() -> dict[str, str]:
    per_block, keyed = _pairs(golden.PER_BLOCK), _keyed_pairs()
    ragged = _ragged()
    out = {f"agg_{name}": sql for name, sql in AGG.items()}
    out.update(_text_rules())
    out.update(
        {
            "pairs_all_scopes": _pair_query(golden.ALL_SCOPES),
            "pairs_top_level": _pair_query(golden.TOP_LEVEL),
            "pairs_dirty_log": _pair_query(golden.DIRTY_LOG),
            "pairs_nearest_preceding": _pair_query(golden.NEAREST_PRECEDING),
            "pairs_per_block": _pair_query(golden.PER_BLOCK),
            "pairs_per_block_qualified": _pair_query(golden.PER_BLOCK, golden.qualified),
            "pairs_on_keyed": _pair_query(golden.ON_KEYED, golden.qualified),
            "pairs_distinct": _pair_query(golden.PER_BLOCK),
            "no_join_rows": _pair_query({t: ps for t, ps in golden.PER_BLOCK.items() if ps[0][1] == ""}),
            "driving_table_fallback": _both_sides_of("'orders'", _T7),
            "extract_with_fallback": _both_sides_of("'orders'", _T7),
            "masked_literals": _both_sides_of("'orders'", _T7),
            "alias_resolution": f"WITH {LOG} SELECT query_id, alias, table_name FROM log JOIN {_alias_rows()} USING (t)",
            "comment_joins": f"WITH {LOG} SELECT query_id, table_name FROM log JOIN "
            + _values([(t, n) for t, ns in golden.COMMENT_TABLES.items() for n in ns], "t, table_name") + " USING (t)",
            "comment_join_append": _both_sides_of("'orders'", "'customer'") + " UNION ALL "
            + _both_sides_of("'customer'", "'extra' || CAST(o_orderkey % 5 AS VARCHAR)"),
            "comma_and_derived_joins": " UNION ALL ".join(
                (
                    _both_sides_of("'base'", _T7), _both_sides_of(_T7, "'dept'"), _both_sides_of("'dept'", "'side'"),
                    _both_sides_of("'base'", "'side'"),
                )
            ),
            "join_keys": f"WITH {LOG} SELECT query_id, {_PAIR_COLUMNS}, left_key, right_key "
            f"FROM log JOIN {_key_rows()} USING (t)",
            "join_type": f"WITH {LOG} SELECT query_id, {_PAIR_COLUMNS}, kind AS join_type FROM log JOIN {keyed} USING (t)",
            "multi_statement": f"WITH {LOG} SELECT query_id, 0 AS statement_no, {_PAIR_COLUMNS} FROM log JOIN {per_block} USING (t)"
            " UNION ALL SELECT query_id, 1, 's' || CAST(query_id % 3 AS VARCHAR), 'u' FROM log",
            "run_attributes": f"""WITH {LOG} SELECT query_id, CAST(wid AS INTEGER) AS date_wid, day AS "Metric date",
                seconds * 1000000 AS micros, ({_CLIPPED}) * 1000000 AS clipped FROM log""",
            "lenient_times": """SELECT o_orderkey AS query_id, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate
                WHEN 1 THEN o_orderdate + INTERVAL 545 MINUTE WHEN 2 THEN o_orderdate + to_seconds(o_orderkey % 86400)
                END AS parsed FROM orders""",
            "ragged_records": f"{ragged} SELECT file, record_no, text FROM rec",
            "ragged_fields": f"""{ragged} SELECT file, record_no, parse_error,
                CASE WHEN parse_error IS NULL THEN u END AS user_name, CASE WHEN parse_error IS NULL THEN 'sales' END AS "Db_nm",
                CASE WHEN parse_error IS NULL THEN 'orders' END AS "Tbl_nm",
                CASE WHEN parse_error IS NULL THEN sql END AS "SqlTextInfo",
                CASE WHEN parse_error IS NULL THEN strftime(log_date, '%-m/%-d/%Y %-H:%M') END AS "LogDate",
                CASE WHEN parse_error IS NULL THEN strftime(started, '%-m/%-d/%Y %-H:%M') END AS "StartTime",
                CASE WHEN parse_error IS NULL THEN strftime(ended, '%-m/%-d/%Y %-H:%M') END AS "LastResponseTime" FROM rec""",
            "parse_funnel": f"""{ragged} SELECT coalesce(parse_error, CASE WHEN t IN ({', '.join(str(t) for t in golden.NEAREST_PRECEDING)})
                THEN 'parsed' ELSE 'no join pair' END) AS status, count(*) AS records FROM rec GROUP BY 1""",
            "ragged_lineage": f"""{ragged}, rows AS (
                SELECT rec.*, l, r, date_diff('minute', date_trunc('minute', started), date_trunc('minute', ended)) * 60 AS whole
                FROM rec JOIN {_pairs(golden.NEAREST_PRECEDING)} USING (t) WHERE parse_error IS NULL),
              agg AS (SELECT wid AS date_wid, day_text AS "Metric date", l AS left_join_table_name, r AS right_join_table_name,
                count(*) AS join_count, count(DISTINCT u) AS unique_users, count(DISTINCT app) AS unique_app,
                count(DISTINCT query_id) AS query_count, round(avg(whole), 4) AS avg_runtime FROM rows GROUP BY 1, 2, 3, 4)
              SELECT row_number() OVER (ORDER BY left_join_table_name, right_join_table_name, date_wid) AS "Row_id", * FROM agg""",
            "csv_log_lineage": AGG["nearest_preceding"],
            "csv_damaged_log": f"""{_DAMAGED} SELECT CAST(query_id AS VARCHAR) AS query_id,
                CASE WHEN query_id % 4 < 3 THEN nullif(coalesce(user_name, ''), '') END AS user_name, 'sales' AS "Db_nm",
                CASE WHEN query_id % 41 < 7 THEN 'ord"ers' ELSE 'orders' END AS "Tbl_nm",
                length(sql) + CASE WHEN query_id % 3 = 0 THEN 3 ELSE 2 END AS sql_length,
                strftime(log_date, '%Y-%m-%d %H:%M:%S') AS "LogDate",
                strftime(log_date + to_seconds(query_id % 86400 + seconds), '%Y-%m-%d %H:%M:%S') AS "LastResponseTime",
                CASE WHEN query_id % 4 = 3 THEN 'n/a' END AS note
              FROM marked WHERE NOT damaged""",
            "csv_rejected_lines": f"""{_DAMAGED}, counted AS (
                SELECT 'part-' || CAST(query_id % 4 AS VARCHAR) AS file, 1 + len(string_split(sql, chr(10))) + CASE WHEN query_id % 3 = 0 THEN 1 ELSE 0 END AS n
                FROM marked WHERE damaged)
              SELECT file, CAST(sum(n) AS BIGINT) AS rejected, CAST(sum(n) AS BIGINT) AS lines FROM counted GROUP BY file""",
            "usage_bad_cells": f"""WITH {USAGE}, cells AS (
                SELECT strftime(metric_date, '%Y-%m-%d') || '-' || split_part(data_product_name, '_', 2) AS row_wid,
                  CASE WHEN day(metric_date) % 7 NOT IN (3, 4) THEN user_query_count END AS user_query_count, app_query_count,
                  CASE WHEN day(metric_date) % 5 <> 2 THEN CAST(metric_date AS TIMESTAMP) END AS created_timestamp,
                  user_query_count AS n, day(metric_date) AS d FROM usage)
              SELECT row_wid, user_query_count, app_query_count, created_timestamp, 'user_query_count' AS "column", n || ' queries' AS text FROM cells WHERE d % 7 = 3
              UNION ALL SELECT row_wid, user_query_count, app_query_count, created_timestamp, 'created_timestamp', 'soon' FROM cells WHERE d % 5 = 2""",
            "ordered_output": f"""SELECT row_number() OVER (ORDER BY join_count DESC, date_wid, left_join_table_name, right_join_table_name) AS place,
                date_wid, left_join_table_name, right_join_table_name, join_count FROM ({AGG["top_level"]})""",
            "user_query_numbers": f"""WITH {LOG} SELECT row_number() OVER (PARTITION BY user_name ORDER BY log_date + to_seconds(query_id % 86400), query_id) AS number,
                user_name, query_id FROM log""",
            "runtime_ranks": f"""WITH {LOG} SELECT query_id, percent_rank() OVER (ORDER BY seconds + 1e-7::DOUBLE * query_id) AS percent_rank
                FROM log WHERE seconds IS NOT NULL""",
            "bare_lineage": AGG["per_block"],
            "combined_repeats": AGG["per_block"],
            "lineage_preview": f"SELECT * FROM ({AGG['all_scopes']}) WHERE \"Row_id\" <= 10",
            "scored_lineage": f"""{_PRODUCTS} SELECT {_wid("l || '|' || r || '|' || date_wid", 16)} AS row_wid, date_wid,
                {_wid("l || '|' || r || '|' || date_wid")} AS metric_wid, l AS left_data_product_name,
                {_wid('l')} AS left_data_product_id, r AS right_data_product_name,
                CASE WHEN r = '' THEN '' ELSE {_wid('r')} END AS right_data_product_id, join_count, unique_users, unique_app,
                query_count, -1.0::DOUBLE AS avg_runtime,
                {_SCORE.format(q='query_count', j='join_count', u='unique_users', s='s')} AS recommendation_score,
                s AS domain_similarity_score FROM sim""",
            "slim_lineage": f"""{_PRODUCTS} SELECT {_wid("l || '|' || r || '|' || date_wid || '|slim'", 16)} AS row_wid, date_wid,
                metric_date, l AS left_data_product_name, r AS right_data_product_name, join_count, unique_users FROM sim""",
            "domain_similarity": f"""WITH {LOG}, d AS (SELECT query_id, {_DOMAIN.format('l')} AS ld, {_DOMAIN.format('r')} AS rd
                FROM log JOIN {keyed} USING (t)) SELECT query_id, ld AS left_domain, rd AS right_domain,
                CAST({_SIMILARITY} AS DOUBLE) AS similarity FROM d""",
            "recommendation_score": "SELECT o_orderkey AS query_id, "
            + _SCORE.format(q="(o_orderkey % 150)", j="(o_orderkey % 40)", u="(o_orderkey % 50)", s="0.3::DOUBLE")
            + " AS score FROM orders",
            "join_patterns": f"""WITH {LOG}, {PATTERNS} SELECT log_date, ldb AS left_table_database, lt AS left_table_name,
                rdb AS right_table_database, rt AS right_table_name, kind AS join_type, keys AS join_keys, join_count,
                users AS distinct_users, apps AS distinct_apps FROM pat""",
            "usage_rollup": f"WITH {USAGE} {_rollup('data_product_name')}",
            "usage_rollup_by_object": f"WITH {USAGE} "
            + _rollup("db AS data_object_database_name, object AS data_product_object_name"),
            "corr_usage_joins": f"""WITH {LOG}, {USAGE}, {PATTERNS}, {_OBJ} SELECT obj.*, coalesce(total_joins, 0) AS total_joins,
                coalesce(partners, 0) AS partners, coalesce(longest_repeat_days, 0) AS longest_repeat_days
                FROM obj LEFT JOIN hot USING (db, tbl)""",
            "corr_usage_columns": f"""WITH {USAGE}, {COLUMNS}, {_OBJ} SELECT obj.*, coalesce(n, 0) AS columns,
                coalesce(z, 0) AS unused_columns, coalesce(s, 0) AS column_uses FROM obj LEFT JOIN
                (SELECT table_name, count(*) AS n, count(*) FILTER (uses = 0) AS z, CAST(sum(uses) AS BIGINT) AS s FROM col GROUP BY 1) c
                ON c.table_name = obj.tbl""",
            "never_joined_products": f"WITH {LOG}, {USAGE}, {PATTERNS}, {_OBJ} SELECT * FROM obj WHERE NOT EXISTS "
            "(SELECT 1 FROM hot WHERE hot.db = obj.db AND hot.tbl = obj.tbl)",
            "joined_products": f"WITH {LOG}, {USAGE}, {PATTERNS}, {_OBJ} SELECT * FROM obj WHERE EXISTS "
            "(SELECT 1 FROM hot WHERE hot.db = obj.db AND hot.tbl = obj.tbl AND partners >= 2)",
            "usage_ranking": _ranking(5),
            "busiest_users": f"""WITH {LOG} SELECT * FROM (SELECT row_number() OVER (ORDER BY count(*) DESC, user_name) AS place,
                user_name, count(*) AS queries FROM log WHERE user_name IS NOT NULL GROUP BY user_name) WHERE place <= 10""",
            "busiest_apps": f"""WITH {LOG} SELECT * FROM (SELECT row_number() OVER (ORDER BY count(*) DESC, app) AS place,
                app, count(*) AS queries FROM log WHERE app IS NOT NULL GROUP BY app) WHERE place <= 10""",
            "performance_hotspots": f"""WITH {USAGE}, roll AS ({_rollup('data_product_name')}), f AS (
                SELECT data_product_name, average_seconds, total_seconds, failed,
                average_seconds >= (SELECT quantile_cont(average_seconds, 0.9) FROM roll) AS is_slow,
                total_seconds >= (SELECT quantile_cont(total_seconds, 0.9) FROM roll) AS is_heavy,
                failed > 0 AND failed >= (SELECT quantile_cont(failed, 0.9) FROM roll) AS is_failing FROM roll)
                SELECT * FROM f WHERE is_slow OR is_heavy OR is_failing""",
            "expensive_joins": f"""WITH m AS ({AGG['top_level']}) SELECT * EXCLUDE ("Row_id") FROM m
                WHERE avg_runtime >= (SELECT quantile_cont(avg_runtime, 0.9) FROM m)""",
            "column_usage": f"""WITH {COLUMNS}, lim AS (SELECT quantile_cont(uses, 0.25) AS lo, quantile_cont(uses, 0.75) AS hi
                FROM col WHERE uses > 0) SELECT table_name, column_name, uses, CASE WHEN uses = 0 THEN 'unused'
                WHEN uses <= lo THEN 'rare' WHEN uses >= hi THEN 'frequent' ELSE 'ordinary' END AS usage_class,
                uses = 0 AS cleanup_candidate FROM col, lim""",
            "join_hotspots": f"WITH {LOG}, {PATTERNS} SELECT * FROM hot",
            "repeated_pairs": f"""WITH {LOG}, {PATTERNS} SELECT ldb AS left_table_database, lt AS left_table_name,
                rdb AS right_table_database, rt AS right_table_name, total_joins, days FROM rep""",
            "usage_trend": f"""WITH {USAGE}, d AS (SELECT data_product_name, metric_date,
                CAST(sum(user_query_count + app_query_count) AS BIGINT) AS queries, CAST(sum(app_query_count) AS BIGINT) AS a
                FROM usage GROUP BY 1, 2) SELECT data_product_name, metric_date, queries,
                queries - lag(queries) OVER w AS change,
                round(avg(queries) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS moving_mean,
                round(a / queries::DOUBLE, 4) AS app_share FROM d WINDOW w AS (PARTITION BY data_product_name ORDER BY metric_date)""",
            "recommendations": _recommendations(),
            "report_document": _document(),
            "health_summary": f"""{HEALTH} SELECT data_product_name, usage_score, quality_score, metadata_score, freshness_score,
                optimization_score, overall_health_score, round(100.0::DOUBLE - overall_health_score, 2) AS recommendation_score
                FROM total""",
        }
    )
    for column in ("usage_score", "quality_score", "metadata_score", "freshness_score", "optimization_score"):
        out[column] = f"{HEALTH} SELECT data_product_name, {column} FROM total"
    return out
