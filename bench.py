"""Time the headline queries and print one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Every query runs
to its last column into a sink that discards the rows. With BENCH_COMPARE=1 the line also
holds `per_column`: the same null and outlier checks of lineitem made with one Spark job per
column, the pattern these checks replace.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry.queries import QUERIES  # noqa: E402

HEADLINE = (
    "row_hash",
    "incremental_extract",
    "cdc_merge",
    "cdc_merge_repeated_keys",
    "cdc_change_summary",
    "silver_studies_like",
    "silver_sponsors_like",
    "gold_status_counts",
    "gold_condition_intervention",
    "dq_null_rate",
    "dq_duplicate_rate",
    "dq_duplicate_rate_all_columns",
    "dq_outlier_rate",
    "dq_referential_integrity",
    "dq_orphan_rows",
    "dq_run_all",
    "dq_suite_given",
    "dq_suite",
    "mon_quality_score",
    "mon_rolling_baseline",
    "insight_prompt",
    "insight_parse",
    "inject_all",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def per_column(df: DataFrame) -> None:
    """Null and outlier rates with separate jobs for each column."""
    df.count()
    for column in df.columns:
        df.where(F.col(column).isNull()).count()
    numbers = [name for name, kind in df.dtypes if kind in ("int", "bigint", "double")]
    df.count()
    for column in numbers:
        mean, std = df.agg(F.mean(column), F.stddev(column)).first()
        if std:
            df.where(F.abs((F.col(column) - mean) / std) > 3.0).count()


def together(df: DataFrame) -> None:
    from lakeassay.model import TableSpec
    from lakeassay.operators.checks import run_checks
    from registry.frames import RUN

    run_checks(df, TableSpec("lineitem", "bronze"), RUN, checks=("null_rate", "outlier_rate")).collect()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    discard(spark.read.parquet(f"{sf_dir}/nation.parquet"))
    timings = {name: seconds(lambda: discard(QUERIES[name](spark, sf_dir))) for name in HEADLINE}
    result = {
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if os.environ.get("BENCH_COMPARE") == "1":
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        per_column(lines), together(lines)
        result["per_column"] = {
            "one_job_per_column": seconds(lambda: per_column(lines)),
            "two_passes": seconds(lambda: together(lines)),
        }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
