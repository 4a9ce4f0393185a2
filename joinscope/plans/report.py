"""Health and recommendation report from the three metric tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from joinscope.operators import health
from joinscope.operators.recommend import GENERATED_BY, recommendations


def scored_products(
    usage: DataFrame, columns: DataFrame, patterns: DataFrame, as_of: datetime.date | None = None
) -> DataFrame:
    return health.score_products(health.with_flags(health.product_features(usage, columns, patterns, as_of)))


def health_report(
    usage: DataFrame,
    columns: DataFrame,
    patterns: DataFrame,
    as_of: datetime.date | None = None,
    generated_by: str = GENERATED_BY,
) -> tuple[DataFrame, DataFrame]:
    """(recommendations, health summary)."""
    scored = scored_products(usage, columns, patterns, as_of)
    return recommendations(scored, generated_by), health.health_summary(scored)
