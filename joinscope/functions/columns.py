"""Small Column helpers shared by the other modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as understood by a full strip, not only blanks.
_WS = " \t\n\r\f\u000b"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression, so that ``body`` may use it often."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_WS))


def collapse_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)
