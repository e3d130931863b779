"""The clinical-trials project: its tables, keys, clean-up rules and references."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from lakeassay.model import ForeignKey, SilverSpec, TableSpec

# Names and keys of the source tables and of the tables built from them.
DATABASE = "dq_project"
SOURCE_SYSTEM = "postgresql_aact"
SOURCE_SCHEMA = "ctgov"

KEYS = {
    "studies": ("nct_id",),
    "sponsors": ("nct_id", "name", "lead_or_collaborator"),
    "conditions": ("nct_id", "name"),
    "interventions": ("nct_id", "intervention_type", "name"),
    "eligibilities": ("nct_id",),
    "facilities": ("nct_id", "name", "city", "country"),
    "outcomes": ("id",),
    "outcome_analyses": ("id",),
}
WATERMARKS = {"studies": "last_update_posted_date"}
GOLD_KEYS = {
    "gold_study_status_counts": ("gold_study_status", ("overall_status",)),
    "gold_phase_summary": ("gold_phase_summary", ("phase", "study_type")),
    "gold_condition_intervention_summary": (
        "gold_condition_intervention", ("condition_name", "intervention_type")),
}
METRICS_TABLE = "quality_metrics"
INSIGHTS_TABLE = "ai_insights"
ANSWERS_TABLE = "ai_answers"

SILVER = {
    "studies": SilverSpec(
        keys=KEYS["studies"], required=("nct_id",),
        trim=("brief_title", "official_title", "phase"),
        lower_trim=("overall_status", "study_type"),
        timestamps=("last_update_posted_date",)),
    "sponsors": SilverSpec(
        keys=KEYS["sponsors"], required=("nct_id",), trim=("name",), lower_trim=("lead_or_collaborator",)),
    "conditions": SilverSpec(keys=KEYS["conditions"], required=("nct_id",), trim=("name",)),
    "interventions": SilverSpec(
        keys=KEYS["interventions"], required=("nct_id",), trim=("name",), lower_trim=("intervention_type",)),
    "eligibilities": SilverSpec(
        keys=KEYS["eligibilities"], required=("nct_id",),
        trim=("minimum_age", "maximum_age"), lower_trim=("gender",)),
    "facilities": SilverSpec(
        keys=KEYS["facilities"], required=("nct_id",), trim=("name", "city", "state", "country")),
    "outcomes": SilverSpec(
        keys=KEYS["outcomes"], required=("nct_id",), trim=("title",), lower_trim=("outcome_type",)),
    "outcome_analyses": SilverSpec(keys=KEYS["outcome_analyses"], required=("outcome_id",)),
}


def _layouts() -> dict[str, StructType]:
    """What later steps rely on: cleaned columns are text, parsed ones times, counts whole numbers.

    Other columns and the types of numeric keys are the source's business.
    """
    layouts = {}
    for table, spec in SILVER.items():
        named = [k for k in spec.keys if k not in ("id", "outcome_id")]
        texts = [StructField(c, StringType()) for c in dict.fromkeys([*named, *spec.trim, *spec.lower_trim])]
        times = [StructField(c, TimestampType()) for c in spec.timestamps]
        for short, fields in ((f"bronze_{table}", texts), (f"silver_{table}", texts + times)):
            if fields:
                layouts[short] = StructType(fields)
    for short, (_, keys) in GOLD_KEYS.items():
        layouts[short] = StructType([*[StructField(c, StringType()) for c in keys], StructField("study_count", LongType())])
    return layouts


LAYOUTS = _layouts()

# The e-commerce tables of the CSV demo.
CSV_SCHEMAS = {
    "customers": StructType([
        StructField("customer_id", IntegerType()), StructField("name", StringType()),
        StructField("email", StringType()), StructField("country", StringType()),
        StructField("registered_at", TimestampType())]),
    "products": StructType([
        StructField("product_id", IntegerType()), StructField("name", StringType()),
        StructField("category", StringType()), StructField("unit_price", DoubleType())]),
    "orders": StructType([
        StructField("order_id", IntegerType()), StructField("customer_id", IntegerType()),
        StructField("product_id", IntegerType()), StructField("order_date", TimestampType()),
        StructField("amount", DoubleType()), StructField("quantity", IntegerType()),
        StructField("status", StringType())]),
}


def table_name(short: str, database: str = DATABASE) -> str:
    return f"{database}.{short}"


def _references(table: str, database: str) -> tuple[ForeignKey, ...]:
    if table == "studies":
        return ()
    if table == "outcome_analyses":
        return (ForeignKey("outcome_id", table_name("silver_outcomes", database), "id"),)
    return (ForeignKey("nct_id", table_name("silver_studies", database), "nct_id"),)


def bronze_spec(table: str, database: str = DATABASE) -> TableSpec:
    """How a source table is loaded and checked."""
    short = f"bronze_{table}"
    return TableSpec(
        name=table_name(short, database), layer=short, keys=KEYS[table], timestamp=WATERMARKS.get(table, "_ingested_at"),
        watermark=WATERMARKS.get(table), foreign_keys=_references(table, database))


def quality_specs(database: str = DATABASE, expected: dict[str, StructType] | None = None) -> list[TableSpec]:
    """What to check, for every loaded, cleaned and aggregated table.

    `expected` maps short table names, such as `silver_studies`, to layouts to conform to.
    """
    expected = expected or {}
    specs = []
    for stage in ("bronze", "silver"):
        for table, keys in KEYS.items():
            short = f"{stage}_{table}"
            specs.append(TableSpec(
                name=table_name(short, database), layer=short, keys=keys,
                timestamp=WATERMARKS.get(table, "_ingested_at"), watermark=WATERMARKS.get(table),
                foreign_keys=_references(table, database), expected_schema=expected.get(short)))
    for short, (layer, keys) in GOLD_KEYS.items():
        specs.append(TableSpec(
            name=table_name(short, database), layer=layer, keys=keys, expected_schema=expected.get(short)))
    return specs
