"""Fixed table schemas."""

from __future__ import annotations

# --- Fixed values: column names and order of inputs and results. -----------------------

QUERY_LOG = (
    "user_name string, Db_nm string, Tbl_nm string, SqlTextInfo string, "
    "LogDate timestamp_ntz, StartTime timestamp_ntz, LastResponseTime timestamp_ntz"
)
QUERY_LOG_COLUMNS = ("user_name", "Db_nm", "Tbl_nm", "SqlTextInfo", "LogDate", "StartTime", "LastResponseTime")
TIME_COLUMNS = ("LogDate", "StartTime", "LastResponseTime")

PAIR_METRIC_COLUMNS = (
    "Row_id", "date_wid", "Metric date", "left_join_table_name", "right_join_table_name",
    "join_count", "unique_users", "unique_app", "query_count", "avg_runtime",
)
SCORED_COLUMNS = (
    "row_wid", "date_wid", "metric_wid", "left_data_product_name", "left_data_product_id",
    "right_data_product_name", "right_data_product_id", "join_count", "unique_users", "unique_app",
    "query_count", "avg_runtime", "recommendation_score", "domain_similarity_score", "created_timestamp",
)
SLIM_COLUMNS = (
    "row_wid", "date_wid", "metric_date", "left_data_product_name", "right_data_product_name",
    "join_count", "unique_users",
)
USAGE_METRICS = (
    "row_wid string, metric_date date, data_product_name string, data_object_database_name string, "
    "data_product_object_name string, data_product_object_id string, user_query_count long, "
    "app_query_count long, unique_user long, unique_app long, total_execution_time_in_seconds double, "
    "average_execution_time_in_seconds double, failed_query_count long, created_timestamp timestamp"
)
COLUMN_USAGE = (
    "row_wid string, log_date date, table_name string, column_name string, usage_count long, "
    "distinct_users long, distinct_apps long, created_timestamp timestamp"
)
JOIN_PATTERNS = (
    "row_wid string, log_date date, left_table_database string, left_table_name string, "
    "right_table_database string, right_table_name string, join_type string, join_keys string, "
    "join_count long, distinct_users long, distinct_apps long, created_timestamp timestamp"
)
RECOMMENDATION_COLUMNS = (
    "row_id", "recommendation_id", "recommendation_date", "recommendation_date_wid", "data_product_name",
    "data_product_id", "recommendation_type", "recommendation_title", "recommendation_description",
    "recommendation_reason", "expected_benefit", "estimated_impact_score", "confidence_score",
    "recommendation_priority", "generated_by", "status", "created_timestamp",
)
HEALTH_COLUMNS = (
    "row_wid", "data_product_name", "usage_score", "quality_score", "metadata_score", "freshness_score",
    "optimization_score", "overall_health_score", "recommendation_score", "last_updated",
)
