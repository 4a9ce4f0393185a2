"""Daily metrics of join pairs.

Two aggregations: first per user within (date, pair), where map-side combining takes the
weight of a hot pair, then per (date, pair), where users and apps are plain counts. No
distinct aggregate has to expand the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.functions import names
from joinscope.functions.keywords import APP_PREFIXES
from joinscope.modes import Mode
from joinscope.operators.extract import explode_counted_pairs, extract_pairs
from joinscope.operators.numbering import number_rows
from joinscope.schemas import PAIR_METRIC_COLUMNS

PAIR_KEYS = ["date_wid", "Metric date", "left_join_table_name", "right_join_table_name"]


def app_of(user: Column, mode: Mode) -> Column:
    if mode.app == "prefix":
        return names.app_prefix(user)
    if mode.app == "prefix_or_other":
        return names.app_prefix_or_other(user)
    return names.app_before_underscore(user)


def app_bit(user: Column, mode: Mode) -> Column:
    """One bit per app of the fixed list, so that distinct apps need no distinct aggregate."""
    apps = [*APP_PREFIXES, "OTHER"]
    place = F.array_position(F.array(*[F.lit(a) for a in apps]), app_of(user, mode))
    return F.when(place > 0, F.call_function("shiftleft", F.lit(1), (place - 1).cast("int")))


def count_bits(column: str) -> Column:
    return F.coalesce(F.bit_count(F.bit_or(column)), F.lit(0)).cast("long")


def with_run_attributes(log: DataFrame, mode: Mode) -> DataFrame:
    """Date keys and run time of each query; unreadable dates as the mode wants them."""
    day = F.col("LogDate")
    if mode.bad_date_wid is None:
        log = log.filter(day.isNotNull())
    wid = names.date_wid(day)
    if mode.bad_date_wid is not None:
        wid = F.coalesce(wid, F.lit(mode.bad_date_wid))
    metric = names.metric_date_text(day) if mode.metric_date_type == "string" else day.cast("date")
    if mode.metric_date_type == "string":
        metric = F.coalesce(metric, F.lit(""))
    has_times = {"StartTime", "LastResponseTime"} <= set(log.columns)
    micros = (
        names.runtime_micros(F.col("StartTime"), F.col("LastResponseTime"), mode.clip_runtime)
        if has_times
        else F.lit(None).cast("long")
    )
    return log.withColumns(
        {"date_wid": wid.cast(mode.date_wid_type), "Metric date": metric, "runtime_micros": micros}
    )


def counted_pairs(log: DataFrame, mode: Mode, combine_repeats: bool = False, **text_options) -> DataFrame:
    """Narrow part of every pipeline: one row per query and distinct pair.

    With ``combine_repeats`` equal texts of one user and day are first counted together and
    parsed once. That pays where the same statements run again and again; where nearly every
    text is different it only moves the texts through a shuffle.
    """
    keys = ["user_name", "Db_nm", "Tbl_nm", "SqlTextInfo", "date_wid", "Metric date"]
    timed = F.col("runtime_micros").isNotNull().cast("long")
    rows = with_run_attributes(log, mode).select(*keys, "runtime_micros", timed.alias("timed_runs"))
    if combine_repeats:
        rows = rows.groupBy(*keys).agg(
            F.sum("runtime_micros").alias("runtime_micros"),
            F.sum("timed_runs").alias("timed_runs"),
            F.count("*").alias("runs"),
        )
    else:
        rows = rows.withColumn("runs", F.lit(1).cast("long"))
    exploded = explode_counted_pairs(extract_pairs(rows, mode, **text_options))
    return exploded.drop("Db_nm", "Tbl_nm", "SqlTextInfo")


def pair_metrics(counted: DataFrame, mode: Mode) -> DataFrame:
    """Metrics per (date, left, right) from rows of :func:`counted_pairs`."""
    per_user = counted.groupBy(*PAIR_KEYS, "user_name").agg(
        F.sum(F.col("n") * F.col("runs")).alias("n"),
        F.sum("runs").alias("queries"),
        F.sum(F.col("n_keys") * F.col("runs")).alias("keys"),
        F.sum(F.col("n") * F.col("timed_runs")).alias("timed"),
        F.sum(F.col("n") * F.col("runtime_micros")).alias("micros"),
    )
    if mode.app == "before_underscore":
        per_user = per_user.withColumn("app", app_of(F.col("user_name"), mode))
        unique_app = F.count_distinct("app")
    else:
        per_user = per_user.withColumn("app_bit", app_bit(F.col("user_name"), mode))
        unique_app = count_bits("app_bit")

    rows = F.sum("n")
    query_count = {
        "users": F.coalesce(F.sum(F.when(F.col("user_name").isNotNull(), F.col("n"))), F.lit(0)),
        "runtimes": F.coalesce(F.sum("timed"), F.lit(0)),
        "queries": F.sum("queries"),
        "rows": rows,
    }[mode.query_count]
    join_count = F.greatest(F.sum("keys"), F.lit(1)) if mode.join_count == "key_pairs" else rows
    seconds = F.sum(F.col("micros").cast("decimal(38,0)")).cast("double") / 1e6
    timed_rows = F.sum("timed")
    return per_user.groupBy(*PAIR_KEYS).agg(
        join_count.alias("join_count"),
        F.count("user_name").alias("unique_users"),
        unique_app.alias("unique_app"),
        query_count.alias("query_count"),
        F.round(F.when(timed_rows > 0, seconds / timed_rows), mode.runtime_decimals).alias("avg_runtime"),
    )


def daily_pair_metrics(log: DataFrame, mode: Mode, numbered: bool = True, **text_options) -> DataFrame:
    """The ten-column daily metrics of a query log; ``numbered=False`` leaves out Row_id."""
    metrics = pair_metrics(counted_pairs(log, mode, **text_options), mode)
    if not numbered:
        return metrics.select(*PAIR_METRIC_COLUMNS[1:])
    return number_rows(metrics, mode.order).select(*[F.col(f"`{c}`") for c in PAIR_METRIC_COLUMNS])


def preview(metrics: DataFrame, rows: int = 10) -> DataFrame:
    """First rows in number order, as a top-k plan."""
    return metrics.orderBy("Row_id").limit(rows)
