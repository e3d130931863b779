"""Checking many tables as one run, keeping the metrics and writing the insight."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeassay import project
from lakeassay.model import RunContext, TableSpec, Thresholds
from lakeassay.operators.checks import reference_keys, run_checks
from lakeassay.operators.insights import insight_rows, prompts, rule_based_responses
from lakeassay.operators.monitor import RUN, latest_run
from lakeassay.plans.incremental import check_changed
from lakeassay.plans.jobs import run_together
from lakeassay.plans.journal import COMMIT_EVERY, Journal
from lakeassay.sources import tables


def run_suite(frames: Mapping[str, DataFrame], specs: Sequence[TableSpec], run: RunContext,
              limits: Thresholds = Thresholds()) -> DataFrame:
    """Metrics of all tables as one lazy DataFrame."""
    keys = _shared_keys(frames, specs)
    results = [run_checks(frames[s.name], s, run, references=frames, limits=limits, keys=keys) for s in specs]
    return reduce(DataFrame.unionByName, results)


def _shared_keys(frames: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> dict[tuple[str, str, bool], DataFrame]:
    """The distinct keys of every column that some foreign key points at."""
    targets = dict.fromkeys(fk.target for s in specs for fk in s.foreign_keys if fk.ref_table in frames)
    return {target: reference_keys(frames[target[0]], *target[1:]) for target in targets}


def staged_suite(frames: Mapping[str, DataFrame], specs: Sequence[TableSpec], run: RunContext, *,
                 staging: tables.Staging, limits: Thresholds = Thresholds(), at_once: int = 4,
                 keyed: Mapping[str, tables.KeyedTable] | None = None,
                 gathered: Mapping[str, str] | None = None) -> DataFrame:
    """The same metrics, computed now, several tables at a time.

    One plan over many tables waits for each table's profile before it starts the next
    scan, and losing it means starting over. Here each table is a job of its own. Keys that
    tables refer to are made distinct and written once, before the checks. Of the tables in
    `keyed` only buckets that changed since their last check are read; `gathered` names the
    column by which a table is stored in buckets. The result reads what is in `staging`.
    """
    planned = _shared_keys(frames, specs)
    staged = run_together([partial(staging.stage, keys) for keys in planned.values()], at_once)
    keys = dict(zip(planned, staged))

    def check(spec: TableSpec) -> DataFrame:
        if spec.name in (keyed or {}):
            return check_changed(frames[spec.name].sparkSession, keyed[spec.name], spec, run, staging=staging,
                                 references=frames, limits=limits, keys=keys).metrics
        metrics = run_checks(frames[spec.name], spec, run, references=frames, limits=limits, keys=keys,
                             gathered=(gathered or {}).get(spec.name))
        return staging.stage(metrics.coalesce(1))

    return reduce(DataFrame.unionByName, run_together([partial(check, s) for s in specs], at_once))


def write_metrics(metrics: DataFrame, table: str, *, fmt: str = "parquet") -> None:
    """Append metric rows, kept by day so that the newest run is found without a full scan."""
    dated = metrics.withColumn("run_date", F.to_date("run_timestamp"))
    # A run's metrics are few: one file per run, not one per check.
    tables.append(dated.coalesce(1), table, fmt=fmt, partition_by=("run_date",))


def check_tables(spark: SparkSession, run: RunContext, *, database: str = project.DATABASE,
                 specs: Sequence[TableSpec] | None = None, fmt: str = "parquet", at_once: int = 4,
                 incremental: bool = False) -> str:
    """Check every table of the project and append the metrics; returns the metrics table.

    With `incremental`, tables that loads keep in buckets are checked from profiles of their buckets, of which only
    changed ones are read again; the metrics are the same.
    """
    specs = specs if specs is not None else project.quality_specs(database, project.LAYOUTS)
    frames = {s.name: spark.table(s.name) for s in specs}
    name = project.table_name(project.METRICS_TABLE, database)
    keyed = {s.name: tables.KeyedTable(spark, s.name, fmt) for s in specs if tables.is_keyed(spark, s.name)} if incremental else {}
    with tables.Staging(spark) as staging:
        write_metrics(staged_suite(frames, specs, run, staging=staging, at_once=at_once, keyed=keyed), name, fmt=fmt)
    return name


def write_insight(spark: SparkSession, run: RunContext, *, database: str = project.DATABASE,
                  respond: Callable[[str], str] | None = None, fmt: str = "parquet", asked: str = "",
                  commit_every: int = COMMIT_EVERY) -> str:
    """Append the insights of the newest run, if there is one; returns the insights table.

    Answers of a model are kept in a journal under their prompts, with `asked` naming the model: if a call is lost, the next
    asks only for what is missing. A prompt that raises has an insight without text and its error in the journal.
    """
    metrics = latest_run(spark.table(project.table_name(project.METRICS_TABLE, database)))
    name = project.table_name(project.INSIGHTS_TABLE, database)
    if respond is None:
        responses = rule_based_responses(metrics)
    else:
        journal, asking = Journal(spark, project.table_name(project.ANSWERS_TABLE, database), asked, fmt), prompts(metrics)
        journal.ask(asking, respond, run.timestamp, commit_every=commit_every)
        responses = journal.answers(asking).select(*RUN, "table_name", "raw_response")
    with tables.Staging(spark) as staging:
        tables.append(staging.stage(insight_rows(metrics, responses, run.timestamp)), name, fmt=fmt)
    return name
