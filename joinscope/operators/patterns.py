"""Join patterns: the log's joins by day, databases, tables, type and keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from joinscope import modes
from joinscope.functions import scores
from joinscope.operators.extract import explode_pairs, extract_pairs
from joinscope.operators.metrics import app_bit, count_bits

_KEYS = (
    "log_date", "left_table_database", "left_table_name", "right_table_database", "right_table_name",
    "join_type", "join_keys",
)


def _database(name: Column) -> Column:
    return F.when(F.contains(name, F.lit(".")), F.substring_index(name, ".", 1)).otherwise("")


def join_patterns(log: DataFrame, **text_options) -> DataFrame:
    """The join-pattern table; keys read ``left=right``, several joined by commas."""
    rows = log.select("user_name", "Db_nm", "Tbl_nm", "SqlTextInfo", F.col("LogDate").cast("date").alias("log_date"))
    joins = explode_pairs(extract_pairs(rows, modes.PER_BLOCK_QUALIFIED, **text_options)).filter(
        F.col("right_join_table_name") != ""
    )
    left, right = F.col("left_join_table_name"), F.col("right_join_table_name")
    keys = F.array_join(F.transform("join_keys", lambda k: F.concat(k.left_key, F.lit("="), k.right_key)), ",")
    per_user = joins.select(
        "log_date",
        _database(left).alias("left_table_database"),
        F.substring_index(left, ".", -1).alias("left_table_name"),
        _database(right).alias("right_table_database"),
        F.substring_index(right, ".", -1).alias("right_table_name"),
        "join_type",
        keys.alias("join_keys"),
        "user_name",
    ).groupBy(*_KEYS, "user_name").agg(F.count("*").alias("n"))
    return (
        per_user.withColumn("bit", app_bit(F.col("user_name"), modes.ALL_SCOPES))
        .groupBy(*_KEYS)
        .agg(
            F.sum("n").alias("join_count"),
            F.count("user_name").alias("distinct_users"),
            count_bits("bit").alias("distinct_apps"),
        )
        .withColumn("row_wid", scores.row_wid(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in _KEYS]))
        .withColumn("created_timestamp", F.current_timestamp())
        .select("row_wid", *_KEYS, "join_count", "distinct_users", "distinct_apps", "created_timestamp")
    )


def pattern_sides(patterns: DataFrame) -> DataFrame:
    """One row per pattern and table it touches; a self-join touches its table once."""

    def side(own: str, other: str, keep: int) -> Column:
        key = F.transform(F.split("join_keys", ","), lambda k: F.get(F.split(k, "="), F.lit(keep)))
        return F.struct(
            F.lower(f"{own}_table_database").alias("db"),
            F.lower(f"{own}_table_name").alias("tbl"),
            F.lower(F.concat_ws(".", f"{other}_table_database", f"{other}_table_name")).alias("partner"),
            F.when(F.col("join_keys") != "", F.array_join(key, ",")).alias("side_key"),
        )

    left, right = side("left", "right", 0), side("right", "left", 1)
    same = (F.lower("left_table_database") == F.lower("right_table_database")) & (
        F.lower("left_table_name") == F.lower("right_table_name")
    )
    both = F.when(same, F.array(left)).otherwise(F.array(left, right))
    pair = F.concat_ws("|", *[F.lower(c) for c in _KEYS[1:5]]).alias("pair")
    return patterns.select("log_date", "join_count", pair, F.explode(both).alias("s")).select(
        "log_date", "join_count", "pair", "s.*"
    )


def join_hotspots(patterns: DataFrame) -> DataFrame:
    """Tables by how much, with how many partners and on how many days they are joined."""
    # Two steps, so that a hot table is combined per partner and day before it is counted.
    per_partner = pattern_sides(patterns).groupBy("db", "tbl", "partner", "log_date").agg(F.sum("join_count").alias("n"))
    per_partner = per_partner.groupBy("db", "tbl", "partner").agg(
        F.sum("n").alias("n"), F.count("*").alias("days")
    )
    return per_partner.groupBy("db", "tbl").agg(
        F.sum("n").alias("total_joins"),
        F.count("*").alias("partners"),
        F.max("days").alias("longest_repeat_days"),
    )


def repeated_pairs(patterns: DataFrame) -> DataFrame:
    """Table pairs with their joins over all days and the number of days."""
    names = list(_KEYS[1:5])
    per_day = patterns.groupBy(*names, "log_date").agg(F.sum("join_count").alias("n"))
    return per_day.groupBy(*names).agg(F.sum("n").alias("total_joins"), F.count("*").alias("days"))
