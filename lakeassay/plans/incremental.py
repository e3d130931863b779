"""Checking a table again after a load, by reading only the buckets that the load wrote."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakeassay.functions import quoted
from lakeassay.model import RunContext, TableSpec, Thresholds
from lakeassay.operators.checks import Subject, column_metrics, duplicate_metrics, numeric_columns, run_checks
from lakeassay.operators.profiles import ROWS, combined, count_tails, profile_parts, still_hold
from lakeassay.schemas import CHECK_NAMES
from lakeassay.sources import tables
from lakeassay.sources.tables import BUCKET, KEY, KeyedTable

#: What an active row is, as SQL over a loaded table.
_ACTIVE = "NOT coalesce(_is_deleted, false)"


@dataclass(frozen=True)
class Checked:
    """The metrics of a table, and the buckets that were read for its profile and for its outlier counts."""

    metrics: DataFrame
    profiled: list[int]
    counted: list[int]


class _Memory:
    """What is known about the folders of a table, kept beside it and replaced as a whole."""

    def __init__(self, table: KeyedTable, kind: str, spark: SparkSession) -> None:
        self._spark, self.name = spark, f"{table.name}__{kind}"

    def of(self, places: DataFrame) -> DataFrame | None:
        """Rows about the folders that the table has now."""
        return self._spark.table(self.name).drop("part").join(places, "folder") if tables.exists(self._spark, self.name) else None

    def keep(self, rows: DataFrame) -> None:
        tables.publish(rows, self.name)
        tables.expire(self._spark, self.name, keep=2)


def check_changed(spark: SparkSession, table: KeyedTable, spec: TableSpec, run: RunContext, *, staging: tables.Staging,
                  references: Mapping[str, DataFrame] | None = None, limits: Thresholds = Thresholds(),
                  keys: Mapping[tuple[str, str, bool], DataFrame] | None = None) -> Checked:
    """The metrics `run_checks` gives, of a table loaded into buckets, reading anew only what has changed since the last call.

    Null rates, freshness, means and spreads, and duplicates of the key the table is stored by, add up from profiles of the
    buckets' folders, which are written once; only folders without a profile are read. Outliers are counted anew in
    those folders, and in others only where a value lies between the old and the new limits. A changed layout or specification
    profiles all folders again. Foreign keys are checked in full: they also depend on the other table. What is known is kept in two tables
    beside the checked one. The result reads what is in `staging`. One call at a time for a table.
    """
    folders = table.folders
    places = spark.createDataFrame([(int(b), f) for b, f in folders.items()], "part int, folder string")
    data = spark.table(table.name)
    rows = table.rows.select(*map(quoted, data.columns), KEY, BUCKET)
    active = "true" if spec.include_deleted else _ACTIVE
    nulls = [c for c in data.columns if c not in spec.skip_null_columns]
    numbers = numeric_columns(data)
    timestamp = spec.timestamp if spec.timestamp in data.columns else None

    def within(buckets: list[int]) -> DataFrame:
        return rows if len(buckets) == len(folders) else rows.where(F.col(BUCKET).isin(buckets))

    # Profiles
    described = repr(([(f.name, f.dataType.simpleString()) for f in data.schema.fields], nulls, timestamp, active))
    layout = hashlib.sha256(described.encode()).hexdigest()
    memory = _Memory(table, "profile", spark)
    known = memory.of(places)
    if known is not None:
        known = known.where(F.col("layout") == layout)
    done = {r[0] for r in known.select("part").distinct().collect()} if known is not None else set()
    stale = sorted(set(folders) - done)
    if stale:
        columns = list(dict.fromkeys([*nulls, *numbers]))
        fresh = (profile_parts(within(stale), BUCKET, columns, keys=KEY, timestamp=timestamp, active=active)
                 .join(places, "part").withColumn("layout", F.lit(layout)))
        profiles = staging.stage(fresh if known is None else known.unionByName(fresh))
        memory.keep(profiles)
    else:
        profiles = known
    # One row per column; times as numbers, which do not depend on the driver's zone.
    whole = {r["column_name"]: r for r in combined(profiles).withColumn("latest", F.unix_micros("latest")).collect()}

    # Outliers
    spreads = {c: (whole[c]["mean"], whole[c]["std"]) for c in numbers if whole[c]["std"] and not math.isnan(whole[c]["std"])}
    counted, far = [], dict.fromkeys(numbers, 0)
    if spreads:
        memory = _Memory(table, "tails", spark)
        tails = memory.of(places)
        if tails is not None:
            moved = spark.createDataFrame([(c, *s) for c, s in spreads.items()], "column_name string, mean double, std double")
            tails = staging.stage(still_hold(tails, moved, limits.outlier_zscore))
        held = {} if tails is None else {r[0]: set(r[1]) for r in tails.groupBy("part").agg(F.collect_set("column_name")).collect()}
        missing = {bucket: set(spreads) - held.get(bucket, set()) for bucket in folders}
        counted = sorted(bucket for bucket, columns in missing.items() if columns)
        if counted:
            again = {c: spreads[c] for c in spreads if any(c in missing[bucket] for bucket in counted)}
            fresh = (count_tails(within(counted), BUCKET, again, limits.outlier_zscore, active=active).join(places, "part"))
            if tails is not None:
                redone = F.col("part").isin(counted) & F.col("column_name").isin(list(again))
                fresh = tails.where(~redone).unionByName(fresh)
            tails = staging.stage(fresh)
            memory.keep(tails)
        far |= {r[0]: r[1] for r in tails.groupBy("column_name").agg(F.sum("far")).collect()}

    subject = Subject(spec.name, spec.layer, run)
    metrics = column_metrics(spark, subject, limits, nulls, numbers, timestamp, _totals(whole, far))
    rest = [c for c in CHECK_NAMES if c in ("schema_conformity", "referential_integrity")]
    if spec.keys == table.keys:
        total = whole[ROWS]
        metrics = metrics.unionByName(duplicate_metrics(spark, subject, limits, spec.keys, total["total"], total["filled"]))
    else:
        rest.append("duplicate_rate")
    others = run_checks(data, spec, run, references=references, limits=limits, checks=rest, keys=keys)
    return Checked(staging.stage(metrics.unionByName(others).coalesce(1)), stale, counted)


def _totals(whole: Mapping[str, Row], far: Mapping[str, int]) -> dict[str, dict]:
    return {c: {**r.asDict(), "far": far.get(c, 0), "total": whole[ROWS]["total"]} for c, r in whole.items()}
