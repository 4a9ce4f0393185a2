"""Rule-based recommendations: every rule that fires on a product gives one row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope.operators.distribution import percent_ranks, value_positions
from joinscope.operators.health import FRESH_DAYS, FREQUENT_FAILURES, INDEX_PATTERNS
from joinscope.operators.numbering import number_rows
from joinscope.operators.usage import PRODUCT
from joinscope.schemas import RECOMMENDATION_COLUMNS
from joinscope.session import materialize

# Fixed value: who signs the recommendations, unless the caller says otherwise.
GENERATED_BY = "Enterprise AI Recommendation Engine"


@dataclass(frozen=True)
class Rule:
    type: str
    fires: str
    # Metric whose percentile rank is the impact, and the inputs that confidence counts.
    metric: str
    inputs: tuple[str, ...]
    title: str
    description: str
    # Template and its arguments, naming the metrics behind the rule.
    reason: str
    values: tuple[str, ...]
    benefit: str
    # Low values are the serious ones.
    inverse: bool = False


RULES = (
    Rule(
        "INDEX_RECOMMENDATION", f"key_patterns >= {INDEX_PATTERNS} OR top_key", "key_patterns", ("joins", "key_patterns"),
        "Index the repeated join key",
        "Create an index on the join key of this product's tables, a composite one where the key has several columns.",
        "A join key appears in %d join patterns, a composite key in %d; the inputs list no indexes, so this is a candidate.",
        ("key_patterns", "composite_patterns"), "Faster joins and less scan work.",
    ),
    Rule(
        "MATERIALIZED_VIEW", "stored_days > 0", "stored_joins", ("joins", "stored_joins"),
        "Store the repeated join",
        "Keep the most repeated join of this product as a materialized view or summary table.",
        "One table pair is joined %d times over %d days.", ("stored_joins", "stored_days"),
        "The join is computed once instead of in every query.",
    ),
    Rule(
        "QUERY_OPTIMIZATION", "slow", "average_seconds", ("average_seconds",),
        "Tune slow queries", "Review the plans of this product's slowest queries.",
        "Average execution time of %.2f s reaches the upper tenth of all products (%.2f s).",
        ("average_seconds", "limits.slow_from"), "Shorter waiting time for users.",
    ),
    Rule(
        "TABLE_OPTIMIZATION", "total_seconds >= limits.heavy_from AND queries >= limits.median_queries", "total_seconds",
        ("total_seconds", "queries"),
        "Optimize or partition the tables", "Partition this product's tables by the columns its queries filter on.",
        "Total execution time of %.2f s over %d queries reaches the upper tenth of all products.",
        ("total_seconds", "queries"), "Less data read per query and lower load.",
    ),
    Rule(
        "COLUMN_OPTIMIZATION", "has_unused_columns OR rare_columns > 0", "unused_columns", ("columns", "unused_columns"),
        "Clean up unused columns", "Drop or archive the columns of this product that no query uses, and move rare ones apart.",
        "%d of %d listed columns have a usage of 0, and %d are among the rarely used.", ("unused_columns", "columns", "rare_columns"), "Smaller tables and a clearer schema.",
    ),
    Rule(
        "PERFORMANCE_IMPROVEMENT", "slow AND usage_score >= limits.used_from", "average_seconds",
        ("average_seconds", "usage_score"),
        "Cache frequent results", "Cache the results of this product's frequent queries.",
        "Average execution time is %.2f s at a usage score of %.2f.", ("average_seconds", "usage_score"),
        "Fast answers for the most frequent questions.",
    ),
    Rule(
        "JOIN_OPTIMIZATION", "many_joins", "joins", ("joins", "partners"),
        "Simplify frequent joins", "Reduce the joins of this product; redesign it when it has five or more partners.",
        "%d joins with %d partner tables reach the upper tenth of all products.", ("joins", "partners"),
        "Simpler queries and less shuffle work.",
    ),
    Rule(
        "ARCHIVAL", f"idle_days > {FRESH_DAYS}", "idle_days", ("idle_days",),
        "Archive the idle product", "Move this product to cheaper storage.",
        "The last activity was %d days before the reporting day.", ("idle_days",), "Lower storage cost.",
    ),
    Rule(
        "DATA_GOVERNANCE", "metadata_score < 100", "metadata_score", ("metadata_score",),
        "Complete the metadata", "Fill in the missing database, object or id of this product.",
        "Metadata is %.2f percent complete.", ("metadata_score",), "The product can be found and owned.", inverse=True,
    ),
    Rule(
        "MONITORING", f"failure_rate > 0 AND failure_rate <= {FREQUENT_FAILURES}", "failure_rate", ("failed", "queries"),
        "Watch failures", "Set an alert on this product's failure rate.",
        "%d of %d queries failed.", ("failed", "queries"), "Problems are seen early.",
    ),
    Rule(
        "RELIABILITY", "often_failing", "failure_rate", ("failed", "queries"),
        "Reduce failures", "Find and fix the causes of this product's failed queries.",
        "%d of %d queries failed.", ("failed", "queries"), "Dependable results.",
    ),
    Rule(
        "HIGH_USAGE_ALERT", "usage_score >= limits.high_usage_from", "usage_score", ("usage_score",),
        "Plan capacity", "Check that this product's resources keep up with its use.",
        "A usage score of %.2f is in the upper tenth of all products.", ("usage_score",), "No surprise at peak load.",
    ),
    Rule(
        "LOW_USAGE_ALERT", "usage_score <= limits.low_usage_to", "usage_score", ("usage_score",),
        "Review low usage", "Ask whether this product is still needed.",
        "A usage score of %.2f is in the lowest tenth of all products.", ("usage_score",), "Effort goes where it is used.",
        inverse=True,
    ),
)


def _with_ranks(flagged: DataFrame) -> DataFrame:
    """Add one percentile rank column per rule metric."""
    metrics = sorted({r.metric for r in RULES})
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]
    values = flagged.select(PRODUCT, F.explode(F.array(*cells)).alias("m")).select(PRODUCT, "m.metric", "m.value")
    ranked = percent_ranks(values, value_positions(values.select("metric", "value")))
    wide = ranked.groupBy(PRODUCT).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("percent_rank"))).alias(f"rank_{m}") for m in metrics]
    )
    renamed = wide.withColumnRenamed(PRODUCT, "_product")
    return flagged.join(renamed, F.col(PRODUCT).eqNullSafe(F.col("_product")), "left").drop("_product")


def _outcome(rule: Rule) -> Column:
    rank = F.coalesce(F.col(f"rank_{rule.metric}"), F.lit(0.0))
    severity = 1.0 - rank if rule.inverse else rank
    present = sum((F.col(i).isNotNull().cast("int") for i in rule.inputs), F.lit(0))
    return F.struct(
        F.coalesce(F.expr(rule.fires), F.lit(False)).alias("fires"),
        F.lit(rule.type).alias("recommendation_type"),
        F.lit(rule.title).alias("recommendation_title"),
        F.lit(rule.description).alias("recommendation_description"),
        F.format_string(rule.reason, *rule.values).alias("recommendation_reason"),
        F.lit(rule.benefit).alias("expected_benefit"),
        F.round(100 * severity).cast("int").alias("estimated_impact_score"),
        F.round(present / len(rule.inputs), 2).alias("confidence_score"),
    )


def fired_rules(flagged: DataFrame) -> DataFrame:
    """(product, rule) rows in one pass over the products."""
    df = _with_ranks(flagged)
    outcomes = F.filter(F.array(*[_outcome(r) for r in RULES]), lambda o: o.fires)
    impact = F.col("estimated_impact_score")
    priority = F.when(impact >= 70, "HIGH").when(impact >= 40, "MEDIUM").otherwise("LOW")
    return (
        df.select(PRODUCT, F.col("product_id").alias("data_product_id"), "as_of", F.explode(outcomes).alias("o"))
        .select(PRODUCT, "data_product_id", "as_of", "o.*")
        .drop("fires")
        .withColumn("recommendation_priority", priority)
    )


def recommendations(flagged: DataFrame, generated_by: str = GENERATED_BY) -> DataFrame:
    """The seventeen-column recommendation table, numbered by product and type."""
    rows = number_rows(fired_rules(materialize(flagged)), (PRODUCT, "recommendation_type"), "row_id")
    return rows.withColumns(
        {
            "recommendation_id": F.format_string("REC-%06d", "row_id"),
            "recommendation_date": F.col("as_of"),
            "recommendation_date_wid": F.date_format("as_of", "yyyyMMdd"),
            "generated_by": F.lit(generated_by),
            "status": F.lit("NEW"),
            "created_timestamp": F.current_timestamp(),
        }
    ).select(*RECOMMENDATION_COLUMNS)
