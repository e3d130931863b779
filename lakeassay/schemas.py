"""Column layouts shared by writers and readers."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The columns of the metrics and insights tables and of a model's answer, which consumers read by name.
# `run_id`, `table_name` and `parse_ok` of an insight are additions.
METRIC_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("run_timestamp", TimestampType()),
    StructField("table_name", StringType()),
    StructField("layer", StringType()),
    StructField("check_name", StringType()),
    StructField("column_name", StringType()),
    StructField("metric_value", DoubleType()),
    StructField("threshold", DoubleType()),
    StructField("passed", BooleanType()),
    StructField("details", StringType()),
])

INSIGHT_SCHEMA = StructType([
    StructField("run_timestamp", TimestampType()),
    StructField("metrics_run_timestamp", TimestampType()),
    StructField("summary", StringType()),
    StructField("root_cause", StringType()),
    StructField("suggested_action", StringType()),
    StructField("severity", StringType()),
    StructField("failed_check_count", LongType()),
    StructField("passed_check_count", LongType()),
    StructField("raw_response", StringType()),
    StructField("run_id", StringType()),
    StructField("table_name", StringType()),
    StructField("parse_ok", BooleanType()),
])

RESPONSE_SCHEMA = StructType([
    StructField("summary", StringType()),
    StructField("root_cause", StringType()),
    StructField("suggested_action", StringType()),
    StructField("severity", StringType()),
])

# The lineage columns every loaded table carries, in the order in which
# cleaned tables list them.
LINEAGE_COLUMNS = (
    "_source_system",
    "_source_schema",
    "_source_table",
    "_ingested_at",
    "_row_hash",
    "_is_deleted",
    "_deleted_at",
)

# Check names and severities that consumers filter on.
CHECK_NAMES = (
    "null_rate",
    "duplicate_rate",
    "schema_conformity",
    "outlier_rate",
    "freshness_hours",
    "referential_integrity",
)
SEVERITIES = ("critical", "high", "medium", "low")
