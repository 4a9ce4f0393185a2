"""Users, dates and run times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joinscope.functions.columns import blank_to_null, strip
from joinscope.functions.keywords import APP_PREFIXES


def app_prefix(user: Column) -> Column:
    """Service-account prefix of the user, null for people."""
    return blank_to_null(F.regexp_extract(F.upper(user), "^(" + "|".join(APP_PREFIXES) + ")", 1))


def app_prefix_or_other(user: Column) -> Column:
    return F.coalesce(app_prefix(strip(user)), F.lit("OTHER"))


def app_before_underscore(user: Column) -> Column:
    return F.substring_index(user, "_", 1)


def parse_time(text: Column) -> Column:
    """Lenient timestamp without time zone: ISO forms and ``M/D/YYYY [H:MM[:SS]]``, else null."""
    t = strip(text)
    slashed = F.try_to_timestamp(t, F.lit("M/d/yyyy[ H:mm[:ss]]"))
    return F.coalesce(t.try_cast("timestamp_ntz"), slashed.cast("timestamp_ntz"))


def date_wid(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def metric_date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def runtime_micros(start: Column, end: Column, clip: bool) -> Column:
    """Run time in whole microseconds, so that sums are exact; null when a side is missing."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.when(micros < 0, F.lit(0).cast("long")).otherwise(micros) if clip else micros
