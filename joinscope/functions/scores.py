"""Identifiers and scores of the lineage tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from joinscope.functions.keywords import DOMAIN_KEYWORDS


def wid(seed: Column) -> Column:
    """Stable 12-character id."""
    return F.upper(F.substring(F.md5(seed.cast("binary")), 1, 12))


def pair_wid(left: Column, right: Column, date: Column) -> Column:
    return wid(F.concat_ws("|", left, right, date))


def row_wid(*key: Column) -> Column:
    """16-character row id from the row's key, so that a rerun or a retried task agrees."""
    return F.upper(F.substring(F.md5(F.concat_ws("|", *key).cast("binary")), 1, 16))


def random_row_wid() -> Column:
    """16-character random row id, new on every run."""
    return F.upper(F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 16))


def domain(table: Column) -> Column:
    name = F.lower(table)
    out = F.lit("unknown")
    for label, words in reversed(DOMAIN_KEYWORDS.items()):
        out = F.when(name.rlike("|".join(words)), label).otherwise(out)
    return out


def domain_similarity(left_domain: Column, right_domain: Column) -> Column:
    unknown = (left_domain == "unknown") | (right_domain == "unknown")
    return F.when(unknown, 0.3).when(left_domain == right_domain, 1.0).otherwise(0.2)


def recommendation_score(joins: Column, queries: Column, users: Column, similarity: Column) -> Column:
    """0-100: up to 40 for queries, 20 each for joins, users and same domain."""
    raw = (
        F.least(queries / 10.0, F.lit(10.0)) * 4
        + F.least(joins / 5.0, F.lit(5.0)) * 4
        + F.least(users / 3.0, F.lit(10.0)) * 2
        + similarity * 20
    )
    return F.round(raw, 2)
