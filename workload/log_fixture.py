"""Query log and metric tables derived from the supplied tables, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workload.golden import TEMPLATES


#: Partitions of the log.
SPLITS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows out by key, as a log of many files would be.

    The number is fixed: without one, adaptive execution would put a small table into one partition.
    """
    return df.repartition(SPLITS, key)


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One logged query per order; the text is template ``o_orderkey % 16``."""
    orders = spread(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey"
    )
    key = F.col("o_orderkey")
    kind = key % 5
    prefix = F.when(kind == 0, "SVP").when(kind == 1, "etl").when(kind == 2, "OP").when(kind == 3, "jdoe")
    texts = F.array(*[F.lit(t) for t in TEMPLATES])
    log_date = F.col("o_orderdate").cast("timestamp_ntz")
    start = log_date + F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    runtime = F.when(key % 97 == 0, F.lit(-1)).otherwise(key % 41)
    end = F.when(key % 101 != 0, start + F.make_dt_interval(secs=runtime.cast("decimal(18,6)")))
    return orders.select(
        key.alias("query_id"),
        F.concat(prefix, (F.col("o_custkey") % 20).cast("string")).alias("user_name"),
        F.lit("sales").alias("Db_nm"),
        F.lit("orders").alias("Tbl_nm"),
        F.get(texts, (key % len(TEMPLATES)).cast("int")).alias("SqlTextInfo"),
        log_date.alias("LogDate"),
        start.alias("StartTime"),
        end.alias("LastResponseTime"),
    )


OBJECTS = (
    "orders", "customer", "dept", "part", "supplier", "nation", "region", "lineitem",
    "invoice", "shipment", "campaign", "ledger",
)


def usage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily usage of twelve products, from the events; some metadata is missing on purpose."""
    product = (F.col("user_id") % 12).cast("int")
    is_app = F.col("event_id") % 3 == 0
    name = F.get(F.array(*[F.lit(o) for o in OBJECTS]), F.col("product"))
    cents = F.sum(F.round(F.col("value") * 100).cast("long"))
    daily = (
        table(spark, sf_dir, "events")
        .select(F.col("ts").cast("date").alias("metric_date"), product.alias("product"), "user_id", "event_id", "event_type", "value", is_app.alias("app"))
        .groupBy("metric_date", "product")
        .agg(
            F.count_if(~F.col("app")).alias("user_query_count"),
            F.count_if("app").alias("app_query_count"),
            F.count_distinct(F.when(~F.col("app"), F.col("user_id"))).alias("unique_user"),
            F.count_distinct(F.when(F.col("app"), F.col("event_id") % 7)).alias("unique_app"),
            (cents / 100.0).alias("total_execution_time_in_seconds"),
            F.count_if(F.col("event_type") == "error").alias("failed_query_count"),
        )
    )
    return daily.select(
        F.concat_ws("-", "metric_date", "product").alias("row_wid"),
        "metric_date",
        F.concat(F.lit("product_"), F.col("product")).alias("data_product_name"),
        F.when(F.col("product") != 9, "sales").alias("data_object_database_name"),
        name.alias("data_product_object_name"),
        F.when(F.col("product") != 7, F.concat(F.lit("ID-"), F.col("product"))).alias("data_product_object_id"),
        "user_query_count",
        "app_query_count",
        "unique_user",
        "unique_app",
        "total_execution_time_in_seconds",
        (F.col("total_execution_time_in_seconds") / (F.col("user_query_count") + F.col("app_query_count"))).alias(
            "average_execution_time_in_seconds"
        ),
        "failed_query_count",
        F.col("metric_date").cast("timestamp").alias("created_timestamp"),
    )


def column_usage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column usage from the parts: five tables of twenty columns, one of them never used in four of the tables."""
    key, size = F.col("p_partkey"), F.col("p_size") % 20
    day = F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int"))
    return table(spark, sf_dir, "part").select(
        key.cast("string").alias("row_wid"),
        day.alias("log_date"),
        F.get(F.array(*[F.lit(o) for o in OBJECTS[:5]]), (key % 5).cast("int")).alias("table_name"),
        F.concat(F.lit("col_"), size).alias("column_name"),
        F.when((size == 0) & (key % 5 != 3), 0).otherwise(key % 50).alias("usage_count"),
        (key % 9).alias("distinct_users"),
        (key % 3).alias("distinct_apps"),
        day.cast("timestamp").alias("created_timestamp"),
    )


def ragged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as lines of ragged text in four files, with splits that cut records in two.

    Some records lack the date, a time or most fields.
    """
    log = query_log(spark, sf_dir)
    key = F.col("query_id")
    time = lambda c: F.date_format(c, "M/d/yyyy H:mm")
    user = F.coalesce("user_name", F.lit("anon7"))
    head = F.concat_ws(",", user, "Db_nm", "Tbl_nm")
    quoted = F.concat(F.lit('"'), F.col("SqlTextInfo"), F.lit('"'))
    sql = F.when(key % 3 == 0, quoted).when(key % 3 == 1, F.concat(F.lit('"'), F.col("SqlTextInfo"), F.lit("\n\n"))).otherwise(
        F.col("SqlTextInfo")
    )
    ended = F.coalesce("LastResponseTime", "StartTime")
    text = (
        F.when(key % 50 == 7, F.concat_ws(",", head, sql))
        .when(key % 60 == 3, F.concat_ws(",", user, "Db_nm"))
        .when(key % 70 == 5, F.concat_ws(",", head, sql, time("LogDate"), time("StartTime")))
        .otherwise(F.concat_ws(",", head, sql, time("LogDate"), time("StartTime"), F.replace(time(ended), F.lit(" "), F.lit("\n"))))
    )
    lines = log.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "value"))
    place = key * 8 + F.col("pos")
    return lines.select(
        F.concat(F.lit("part-"), key % 4).alias("file"),
        F.floor(place / 1000).alias("block"),
        place.alias("line_no"),
        "value",
    )


CSV_COLUMNS = ("query_id", "user_name", "Db_nm", "Tbl_nm", "SqlTextInfo", "LogDate", "StartTime", "LastResponseTime")


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as lines of quoted CSV in four files, with splits that cut records in two."""
    log = query_log(spark, sf_dir)
    key = F.col("query_id")
    text = F.concat(F.lit("\n"), F.col("SqlTextInfo"), F.when(key % 3 == 0, "\n\n").otherwise(" "))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    time = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    fields = [key.cast("string"), F.coalesce("user_name", F.lit("")), F.col("Db_nm"), F.col("Tbl_nm"), quoted]
    record = F.concat_ws(",", *fields, *[time(c) for c in CSV_COLUMNS[5:]])
    lines = log.select(key, F.posexplode(F.split(record, "\n")).alias("pos", "value"))
    place = key * 64 + F.col("pos")
    file = F.concat(F.lit("part-"), key % 4)
    body = lines.select(file.alias("file"), F.floor(place / 5000).alias("block"), place.alias("line_no"), "value")
    heads = spark.range(4).select(
        F.concat(F.lit("part-"), "id").alias("file"), F.lit(0).cast("long").alias("block"),
        F.lit(-1).cast("long").alias("line_no"), F.lit(",".join(CSV_COLUMNS)).alias("value"),
    )
    return body.unionByName(heads)


#: Column order of each of the four damaged files; the last one has no user and a column of its own.
DAMAGED_COLUMNS = (
    CSV_COLUMNS,
    CSV_COLUMNS[::-1],
    CSV_COLUMNS[3:] + CSV_COLUMNS[:3],
    ("query_id", "note", "Db_nm", "Tbl_nm", "SqlTextInfo", "LogDate", "StartTime", "LastResponseTime"),
)


def damaged_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as four CSV files with headers of their own and damaged records, at times two in a row.

    Damage by key: the quote after the SQL text is lost (1 of 37), or the last field is (1 of 43).
    A quote within an unquoted field (7 of 41) does no harm.
    """
    log = query_log(spark, sf_dir)
    key = F.col("query_id")
    lost = key % 37 == 5
    short = (key % 43 == 11) & ~lost
    text = F.concat(F.lit("\n"), F.col("SqlTextInfo"), F.when(key % 3 == 0, "\n\n").otherwise(" "))
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.when(lost, "").otherwise('"'))
    time = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))
    field = {
        "query_id": key.cast("string"), "user_name": F.coalesce("user_name", F.lit("")), "Db_nm": F.col("Db_nm"),
        "Tbl_nm": F.when(key % 41 < 7, 'ord"ers').otherwise(F.col("Tbl_nm")), "SqlTextInfo": quoted, "note": F.lit("n/a"),
        **{c: time(c) for c in CSV_COLUMNS[5:]},
    }
    rows = [[field[c] for c in order] for order in DAMAGED_COLUMNS]
    record = F.coalesce(*[F.when(key % 4 == i, F.when(short, F.concat_ws(",", *r[:-1])).otherwise(F.concat_ws(",", *r))) for i, r in enumerate(rows)])
    lines = log.select(key, F.posexplode(F.split(record, "\n")).alias("pos", "value"))
    place = key * 64 + F.col("pos")
    file = F.concat(F.lit("part-"), key % 4)
    body = lines.select(file.alias("file"), F.floor(place / 5000).alias("block"), place.alias("line_no"), "value")
    heads = [(f"part-{i}", 0, -1, ",".join(order)) for i, order in enumerate(DAMAGED_COLUMNS)]
    return body.unionByName(spark.createDataFrame(heads, "file string, block long, line_no long, value string"))


def usage_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The usage metrics as text, with cells that are no numbers or dates; some are blank."""
    usage = usage_metrics(spark, sf_dir)
    day = F.day("metric_date")
    texts = usage.select(*[F.col(c).cast("string").alias(c) for c in usage.columns])
    n = F.col("user_query_count")
    return texts.withColumns(
        {
            "user_query_count": F.when(day % 7 == 3, F.concat(n, F.lit(" queries"))).when(day % 7 == 4, " ").otherwise(n),
            "created_timestamp": F.when(day % 5 == 2, "soon").otherwise(F.col("created_timestamp")),
        }
    )
