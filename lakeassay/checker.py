"""Checks of a session's tables, kept in one metrics table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeassay.model import RunContext, TableSpec, Thresholds
from lakeassay.operators import checks
from lakeassay.plans.suite import write_metrics


@dataclass(frozen=True)
class TableChecker:
    """Runs what a `TableSpec` declares, looking referenced tables up in the session.

    Every call is a run of its own, with its own id and time, unless one is given.
    """

    spark: SparkSession
    metrics_table: str
    limits: Thresholds = Thresholds()
    fmt: str = "parquet"

    def check(self, spec: TableSpec, df: DataFrame | None = None, *, run: RunContext | None = None,
              references: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """The metrics of `df`, or of the table that the spec names."""
        given = dict(references or {})
        wanted = {fk.ref_table for fk in spec.foreign_keys} - set(given)
        given.update((name, self.spark.table(name)) for name in wanted)
        rows = self.spark.table(spec.name) if df is None else df
        return checks.run_checks(rows, spec, run or RunContext(), references=given, limits=self.limits)

    def record(self, metrics: DataFrame) -> None:
        """Append metrics to the table."""
        write_metrics(metrics, self.metrics_table, fmt=self.fmt)
