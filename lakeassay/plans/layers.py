"""Building the cleaned and the aggregated tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import SparkSession

from lakeassay import project
from lakeassay.operators import gold
from lakeassay.operators.silver import standardise
from lakeassay.plans.jobs import run_together
from lakeassay.sources import tables


def build_silver(spark: SparkSession, *, database: str = project.DATABASE, fmt: str = "parquet", at_once: int = 4) -> None:
    def build(table: str) -> None:
        bronze = spark.table(project.table_name(f"bronze_{table}", database))
        cleaned = standardise(bronze, project.SILVER[table])
        tables.publish(cleaned, project.table_name(f"silver_{table}", database), fmt=fmt)

    run_together([partial(build, table) for table in project.SILVER], at_once)


def build_gold(spark: SparkSession, *, database: str = project.DATABASE, fmt: str = "parquet") -> None:
    studies, conditions, interventions = (
        spark.table(project.table_name(f"silver_{t}", database))
        for t in ("studies", "conditions", "interventions"))
    results = {
        "gold_study_status_counts": gold.study_status_counts(studies),
        "gold_phase_summary": gold.phase_summary(studies),
        "gold_condition_intervention_summary": gold.condition_intervention_summary(
            studies, conditions, interventions),
    }
    run_together([
        partial(tables.publish, frame, project.table_name(short, database), fmt=fmt)
        for short, frame in results.items()])
