"""Registered queries: every operator over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from joinscope import modes
from joinscope.functions import names, scores, sqltext, text
from joinscope.functions import pairs as P
from joinscope.operators import correlate, distribution, health, metrics, patterns, recommend, usage
from joinscope.operators.extract import clean_sql, explode_pairs, extract_pairs, split_statements, tables_as_written
from joinscope.operators.numbering import number_rows
from joinscope.plans import lineage, report
from joinscope.session import kept_folder, materialize
from joinscope.sources import ragged, writers
from joinscope.schemas import USAGE_METRICS
from joinscope.sources.logs import bad_cells, is_log_record, resolve_log, typed
from joinscope.sources.quoted import by_name, parse_quoted, quoted_records, sound_records
from workload import log_fixture as fx
from workload.log_fixture import query_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


_PAIR = ("left_join_table_name", "right_join_table_name")


def _pairs_of(mode: modes.Mode) -> Query:
    return lambda spark, sf: explode_pairs(extract_pairs(query_log(spark, sf), mode)).select("query_id", *_PAIR)


def _metrics_of(mode: modes.Mode) -> Query:
    return lambda spark, sf: lineage.pair_lineage(query_log(spark, sf), mode)


for _mode in modes.MODES.values():
    QUERIES[f"pairs_{_mode.name}"] = _pairs_of(_mode)
    if _mode is not modes.PER_BLOCK_QUALIFIED:
        QUERIES[f"agg_{_mode.name}"] = _metrics_of(_mode)


# --- extraction ------------------------------------------------------------------------


def _with_text(log: DataFrame, sql) -> DataFrame:
    return log.withColumn("SqlTextInfo", sql)


@query
def driving_table_fallback(spark, sf):
    log = query_log(spark, sf)
    target = F.concat(F.lit("LEFT JOIN sales.t"), (F.col("query_id") % 7), F.lit(" c ON c.k = 1"))
    return explode_pairs(extract_pairs(_with_text(log, target), modes.TOP_LEVEL)).select("query_id", *_PAIR)


@query
def pairs_on_keyed(spark, sf):
    df = query_log(spark, sf)
    df = df.withColumn("sql", clean_sql(F.col("SqlTextInfo"), modes.PER_BLOCK_QUALIFIED))
    found = explode_pairs(df.withColumn("pairs", F.expr(P.on_keyed("sql", "Db_nm"))))
    return found.select("query_id", *_PAIR)


@query
def alias_resolution(spark, sf):
    found = tables_as_written(query_log(spark, sf), modes.TOP_LEVEL)
    return found.select("query_id", "alias", "table_name")


@query
def comment_joins(spark, sf):
    found = query_log(spark, sf).withColumn("table_name", F.explode_outer(text.comment_join_tables(F.col("SqlTextInfo"))))
    return found.filter(F.col("table_name").isNotNull()).select("query_id", "table_name")


@query
def comment_join_append(spark, sf):
    log = query_log(spark, sf)
    sql = F.concat(
        F.lit("SELECT o.k FROM sales.orders o JOIN sales.customer c ON o.k = c.k\n-- LEFT JOIN sales.extra"),
        F.col("query_id") % 5,
        F.lit(" e ON e.k = o.k"),
    )
    return explode_pairs(extract_pairs(_with_text(log, sql), modes.DIRTY_LOG)).select("query_id", *_PAIR)


@query
def join_keys(spark, sf):
    found = explode_pairs(extract_pairs(query_log(spark, sf), modes.PER_BLOCK_QUALIFIED))
    found = found.withColumn("k", F.explode_outer("join_keys")).filter(F.col("k").isNotNull())
    return found.select("query_id", *_PAIR, "k.left_key", "k.right_key")


@query
def join_type(spark, sf):
    found = explode_pairs(extract_pairs(query_log(spark, sf), modes.PER_BLOCK_QUALIFIED))
    return found.select("query_id", *_PAIR, "join_type")


@query
def extract_with_fallback(spark, sf):
    # An UPDATE has no SELECT block, so only the text search finds its join.
    sql = F.concat(
        F.lit("UPDATE sales.stock SET x = 1 FROM sales.orders o JOIN sales.t"),
        F.col("query_id") % 7,
        F.lit(" c ON c.k = o.k"),
    )
    found = explode_pairs(extract_pairs(_with_text(query_log(spark, sf), sql), modes.PER_BLOCK))
    return found.select("query_id", *_PAIR)


@query
def pairs_distinct(spark, sf):
    log = query_log(spark, sf)
    twice = F.concat("SqlTextInfo", F.lit("\n; "), "SqlTextInfo")
    return explode_pairs(extract_pairs(_with_text(log, twice), modes.PER_BLOCK)).select("query_id", *_PAIR)


@query
def no_join_rows(spark, sf):
    found = explode_pairs(extract_pairs(query_log(spark, sf), modes.PER_BLOCK))
    return found.filter(F.col("right_join_table_name") == "").select("query_id", *_PAIR)


@query
def multi_statement(spark, sf):
    log = query_log(spark, sf)
    more = F.concat(
        "SqlTextInfo",
        F.lit("\n; SELECT o.x FROM sales.s"),
        F.col("query_id") % 3,
        F.lit(" o JOIN sales.u c ON o.x = c.x WHERE o.y = ';'"),
    )
    parts = split_statements(_with_text(log, more)).withColumn("SqlTextInfo", F.col("statement"))
    return explode_pairs(extract_pairs(parts, modes.PER_BLOCK)).select("query_id", "statement_no", *_PAIR)


@query
def masked_literals(spark, sf):
    log = query_log(spark, sf)
    sql = F.concat(
        F.lit("SELECT '-- FROM x JOIN y ON (' AS q, o.k FROM sales.orders o JOIN sales.t"),
        F.col("query_id") % 7,
        F.lit(" c ON o.k = c.k WHERE o.y = '; JOIN z'"),
    )
    return explode_pairs(extract_pairs(_with_text(log, sql), modes.PER_BLOCK)).select("query_id", *_PAIR)


@query
def comma_and_derived_joins(spark, sf):
    log = query_log(spark, sf)
    sql = F.concat(
        F.lit("SELECT 1 FROM (SELECT k FROM sales.base JOIN sales.side s ON s.k = base.k) q, sales.t"),
        F.col("query_id") % 7,
        F.lit(" c LEFT JOIN sales.dept d ON d.k = c.k WHERE EXTRACT(YEAR FROM c.d) = 1"),
    )
    return explode_pairs(extract_pairs(_with_text(log, sql), modes.ALL_SCOPES)).select("query_id", *_PAIR)


# --- text rules ------------------------------------------------------------------------


def _text_rule(rule: Callable, before: str, after: str) -> Query:
    """Apply a rule to ``before || key || after`` for every row."""

    def run(spark, sf):
        log = query_log(spark, sf).withColumn("raw", F.concat(F.lit(before), F.col("query_id"), F.lit(after)))
        return log.select("query_id", rule(F.col("raw")).alias("text"))

    return run


TEXT_RULES = {
    "text_strip_comments": (text.strip_comments, "SELECT /* a\nb */ k", ", j -- rest\n// more\nFROM t"),
    "text_strip_hints": (text.strip_hints_and_comments, " SELECT /*+ FULL(t) */ k", " -- rest\nFROM t /* x */"),
    "text_flatten": (text.flatten_sql, "SELECT  k", "\n\t FROM /* c */ t -- end"),
    "text_teradata": (
        text.clean_teradata,
        "LOCKING ROW FOR ACCESS SELECT a (FORMAT 'x9') (TITLE 'T'), b",
        " (NAMED c) FROM t -- z\n AT ISOLATION LEVEL READ NORMALIZE /* q */ ;  ",
    ),
    "text_split_fused": (text.split_fused_keywords, "SELECT region, k", "FROM  tWHERE aUNION costINNER JOIN u"),
    "text_slash_remarks": (text.drop_slash_remarks, "SELECT a / b /remark ", " here/ FROM t /* kept */"),
    "text_repair": (text.repair_sql, "SELECT a.k", "FROM t -- x\n/old text/ JOIN u /* y */ aON a.k = u.k"),
    "name_normalize": (lambda c: F.expr(sqltext.norm("raw")), ' "Tab', '" '),
    "name_bare": (lambda c: F.expr(sqltext.bare("raw")), "Db.Schema.`Tab", "`"),
    "name_qualify": (lambda c: F.expr(sqltext.qualify("' SALES '", "raw")), '"Tab', '"'),
    "name_app_prefix": (lambda c: F.coalesce(names.app_prefix(c), F.lit("none")), "svp_", ""),
    "name_app_other": (names.app_prefix_or_other, " jdoe", ""),
    "name_app_before_underscore": (names.app_before_underscore, "fin_app_", ""),
    "wid": (scores.wid, "sales.t", ""),
}
for _name, (_rule, _before, _after) in TEXT_RULES.items():
    QUERIES[_name] = _text_rule(_rule, _before, _after)


@query
def run_attributes(spark, sf):
    log = metrics.with_run_attributes(query_log(spark, sf), modes.TOP_LEVEL)
    unclipped = metrics.with_run_attributes(log.drop("date_wid", "Metric date", "runtime_micros"), modes.ALL_SCOPES)
    both = unclipped.withColumn("clipped", names.runtime_micros(F.col("StartTime"), F.col("LastResponseTime"), True))
    return both.select("query_id", "date_wid", "Metric date", F.col("runtime_micros").alias("micros"), "clipped")


@query
def lenient_times(spark, sf):
    key = F.col("query_id")
    day = F.date_format("LogDate", "M/d/yyyy")
    raw = F.when(key % 4 == 0, day).when(key % 4 == 1, F.concat(day, F.lit(" 9:05"))).when(
        key % 4 == 2, F.date_format("StartTime", "yyyy-MM-dd HH:mm:ss")
    ).otherwise("no time")
    return query_log(spark, sf).select("query_id", names.parse_time(raw).alias("parsed"))


# --- sources ---------------------------------------------------------------------------


@query
def ragged_records(spark, sf):
    return ragged.records_from_lines(fx.ragged_lines(spark, sf))


@query
def ragged_fields(spark, sf):
    parsed = ragged.parse_records(ragged.records_from_lines(fx.ragged_lines(spark, sf)))
    return parsed.drop("text")


@query
def parse_funnel(spark, sf):
    parsed = ragged.parse_records(ragged.records_from_lines(fx.ragged_lines(spark, sf)))
    return lineage.parse_funnel(parsed)


@query
def ragged_lineage(spark, sf):
    parsed = ragged.parse_records(ragged.records_from_lines(fx.ragged_lines(spark, sf)))
    return lineage.pair_lineage(ragged.accepted(parsed), modes.NEAREST_PRECEDING)


@query
def csv_log_lineage(spark, sf):
    log = resolve_log(parse_quoted(quoted_records(fx.csv_lines(spark, sf)), fx.CSV_COLUMNS))
    return lineage.pair_lineage(log, modes.NEAREST_PRECEDING)


def _damaged(spark, sf):
    return sound_records(fx.damaged_csv_lines(spark, sf), is_log_record)


@query
def csv_damaged_log(spark, sf):
    log = by_name(_damaged(spark, sf)[0], (*fx.CSV_COLUMNS, "note"))
    sql = F.col("SqlTextInfo")
    return log.select("query_id", "user_name", "Db_nm", "Tbl_nm", F.char_length(sql).cast("long").alias("sql_length"), "LogDate", "LastResponseTime", "note")


@query
def csv_rejected_lines(spark, sf):
    rejected = _damaged(spark, sf)[1]
    lines = F.sum(F.size(F.split("text", "\n"))).alias("lines")
    return rejected.groupBy("file").agg(F.count("*").alias("rejected"), lines)


@query
def usage_bad_cells(spark, sf):
    usage = typed(fx.usage_texts(spark, sf), USAGE_METRICS, rescued="_rescued")
    return bad_cells(usage, ("row_wid", "user_query_count", "app_query_count", "created_timestamp"))


# --- lineage tables --------------------------------------------------------------------


@query
def bare_lineage(spark, sf):
    return lineage.bare_lineage(query_log(spark, sf))


@query
def combined_repeats(spark, sf):
    return lineage.pair_lineage(query_log(spark, sf), modes.PER_BLOCK, combine_repeats=True)


@query
def scored_lineage(spark, sf):
    return lineage.scored_lineage(query_log(spark, sf)).drop("created_timestamp")


@query
def slim_lineage(spark, sf):
    return lineage.slim_lineage(query_log(spark, sf))


@query
def lineage_preview(spark, sf):
    return metrics.preview(lineage.pair_lineage(query_log(spark, sf), modes.ALL_SCOPES), 10)


@query
def domain_similarity(spark, sf):
    found = explode_pairs(extract_pairs(query_log(spark, sf), modes.PER_BLOCK_QUALIFIED))
    left, right = (scores.domain(F.col(c)) for c in _PAIR)
    return found.select(
        "query_id", left.alias("left_domain"), right.alias("right_domain"), scores.domain_similarity(left, right).alias("similarity")
    )


@query
def recommendation_score(spark, sf):
    key = F.col("query_id")
    score = scores.recommendation_score(key % 40, key % 150, key % 50, F.lit(0.3))
    return query_log(spark, sf).select("query_id", score.alias("score"))


@query
def ordered_output(spark, sf):
    """Daily metrics written in order; each row's place in the files, by their names."""
    daily = lineage.pair_lineage(query_log(spark, sf), modes.TOP_LEVEL, numbered=False)
    path = f"{kept_folder(spark)}/ordered-{uuid.uuid4()}"
    writers.write_table(daily, path, "parquet", order_by=("-join_count", "date_wid", *_PAIR))
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = rows.groupBy("file").agg(F.count("*").alias("n")).select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("row") + 1
    return rows.join(files, "file").select(place.alias("place"), "date_wid", *_PAIR, "join_count")


@query
def user_query_numbers(spark, sf):
    """Each user's queries, numbered by start; a third of the users' rows may be one user's."""
    log = query_log(spark, sf).select("user_name", "StartTime", "query_id")
    return number_rows(log, ("StartTime", "query_id"), "number", within=("user_name",)).select("number", "user_name", "query_id")


@query
def runtime_ranks(spark, sf):
    """Each query's place among the run times of its database, from exact counts in ranges."""
    seconds = F.timestamp_diff("SECOND", "StartTime", "LastResponseTime").cast("double")
    values = query_log(spark, sf).select("query_id", F.col("Db_nm").alias("metric"), (seconds + 1e-7 * F.col("query_id")).alias("value"))
    positions = distribution.value_positions(values.select("metric", "value"))
    ranked = distribution.percent_ranks(values, positions).where("value is not null")
    return ranked.select("query_id", "percent_rank")


# --- metric tables ---------------------------------------------------------------------


def _inputs(spark, sf):
    """The three metric tables; those that are read many times are stored once."""
    return (
        materialize(fx.usage_metrics(spark, sf)),
        fx.column_usage_metrics(spark, sf),
        materialize(patterns.join_patterns(query_log(spark, sf))),
    )


@query
def join_patterns(spark, sf):
    return patterns.join_patterns(query_log(spark, sf)).drop("row_wid", "created_timestamp")


@query
def usage_rollup(spark, sf):
    return usage.usage_rollup(fx.usage_metrics(spark, sf))


@query
def usage_rollup_by_object(spark, sf):
    return usage.usage_rollup(fx.usage_metrics(spark, sf), [usage.DATABASE, usage.OBJECT])


@query
def corr_usage_joins(spark, sf):
    return correlate.usage_with_joins(fx.usage_metrics(spark, sf), patterns.join_patterns(query_log(spark, sf)))


@query
def corr_usage_columns(spark, sf):
    return correlate.usage_with_columns(fx.usage_metrics(spark, sf), fx.column_usage_metrics(spark, sf))


@query
def never_joined_products(spark, sf):
    return correlate.never_joined(fx.usage_metrics(spark, sf), patterns.join_patterns(query_log(spark, sf)))


@query
def joined_products(spark, sf):
    return correlate.joined_products(fx.usage_metrics(spark, sf), patterns.join_patterns(query_log(spark, sf)))


@query
def usage_ranking(spark, sf):
    return usage.usage_ranking(fx.usage_metrics(spark, sf), 5)


@query
def busiest_users(spark, sf):
    return usage.busiest(query_log(spark, sf), F.col("user_name"), "user_name", 10)


@query
def busiest_apps(spark, sf):
    return usage.busiest(query_log(spark, sf), names.app_prefix(F.col("user_name")), "app", 10)


@query
def performance_hotspots(spark, sf):
    return usage.performance_hotspots(usage.usage_rollup(fx.usage_metrics(spark, sf)))


@query
def expensive_joins(spark, sf):
    daily = lineage.pair_lineage(query_log(spark, sf), modes.TOP_LEVEL, numbered=False)
    return usage.expensive_joins(daily)


@query
def column_usage(spark, sf):
    return usage.column_usage(fx.column_usage_metrics(spark, sf))


@query
def join_hotspots(spark, sf):
    return patterns.join_hotspots(patterns.join_patterns(query_log(spark, sf)))


@query
def repeated_pairs(spark, sf):
    return patterns.repeated_pairs(patterns.join_patterns(query_log(spark, sf)))


@query
def usage_trend(spark, sf):
    return usage.usage_trend(fx.usage_metrics(spark, sf))


def _score(column: str) -> Query:
    return lambda spark, sf: report.scored_products(*_inputs(spark, sf)).select(usage.PRODUCT, column)


for _column in ("usage_score", "quality_score", "metadata_score", "freshness_score", "optimization_score"):
    QUERIES[_column] = _score(_column)


@query
def health_summary(spark, sf):
    scored = report.scored_products(*_inputs(spark, sf))
    return health.health_summary(scored).drop("row_wid", "last_updated")


@query
def recommendations(spark, sf):
    scored = report.scored_products(*_inputs(spark, sf))
    return recommend.recommendations(scored).drop("created_timestamp")


@query
def report_document(spark, sf):
    recs, summary = report.health_report(*_inputs(spark, sf))
    return writers.json_document(recs.drop("created_timestamp"), summary.drop("last_updated"))
