"""Loading one source table into its bronze table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeassay import project
from lakeassay.functions import key_text, latest_per_key, quoted, with_row_hash
from lakeassay.model import RunContext, TableSpec
from lakeassay.operators.ingest import (
    OPERATIONS,
    after_watermark,
    high_watermark,
    merge_keyed,
    merged_columns,
    stamp_lineage,
)
from lakeassay.plans.jobs import run_together
from lakeassay.sources import tables

#: What the row hash adds to a row in memory.
HASH_BYTES = 48


@dataclass(frozen=True)
class LoadResult:
    """What a load did: `initial`, `merged` or `skipped`, and the rows per kind of change.

    `surplus` is how many source rows were left out because a later row has their key. Tables merged in place keep
    the counts of a merge in their own history and leave them out here.
    """

    table: str
    outcome: str
    changes: dict[str, int]
    surplus: int = 0


@dataclass(frozen=True)
class Origin:
    """Where rows come from, as their lineage columns say."""

    system: str
    schema: str
    table: str


def load(spark: SparkSession, spec: TableSpec, source: DataFrame, run: RunContext, origin: Origin, *,
         fmt: str = "parquet", inclusive: bool = False, hash_mode: str = "joined", new_columns: str = "add",
         buckets: int | None = None, bucket_bytes: int = tables.BUCKET_BYTES) -> LoadResult:
    """Load a source DataFrame (usually a lazy database scan) into the table `spec.name`.

    A table with a `spec.watermark` is read from its newest loaded value on. All others are read
    whole, and rows missing from the source are marked deleted. The source is read exactly
    once. An empty read leaves an existing table as it is, so a failed extract cannot mark
    everything deleted. Of several source rows with one key the latest is loaded, in the
    first load too, so keys are unique. What happens to columns that appear later is up to
    `new_columns`, as in `merge_snapshot`.

    A table of plain files is cut by key into as many buckets as hold `bucket_bytes` of rows in memory each, and into `buckets` at
    least; a merge that finds the number four times too small writes the table anew with more. The extract is dealt out to the
    table's buckets as it is written, as the source has it, so that neither choosing the latest rows nor merging shuffles them.
    """
    if not spec.keys:
        raise ValueError(f"{spec.name} declares no key to load by")
    loaded = tables.exists(spark, spec.name)
    if spec.watermark and loaded:
        newest = high_watermark(spark.table(spec.name), spec.watermark).first()["max_watermark"]
        source = after_watermark(source, spec.watermark, newest, inclusive=inclusive)

    def stamped(df: DataFrame) -> DataFrame:
        return stamp_lineage(df, system=origin.system, schema=origin.schema, table=origin.table, ingested_at=run.timestamp)

    with tables.Staging(spark) as whole, tables.Staging(spark) as staging:
        extract = whole.stage(source)
        keyed = extract.withColumn(tables.KEY, key_text(extract, spec.keys))
        sizes = tables.slot_sizes(stamped(keyed), tables.KEY)
        read, size = sum(rows for rows, _ in sizes), sum(held for _, held in sizes)
        if loaded and not read:
            return LoadResult(spec.name, "skipped", {})
        table, full = tables.KeyedTable(spark, spec.name, fmt), spec.watermark is None

        def latest(df: DataFrame) -> DataFrame:
            # All rows of a key have one KEY, so rows dealt out by it stay where they are.
            return latest_per_key(with_row_hash(stamped(df), mode=hash_mode), [tables.KEY, *spec.keys])

        if tables.supports_row_changes(fmt):
            if not loaded:
                tables.publish(latest(keyed).drop(tables.KEY), spec.name, fmt=fmt)
                count = spark.table(spec.name).count()
                return LoadResult(spec.name, "initial", {"insert": count}, read - count)
            batch = staging.stage(latest(keyed))
            tables.merge_into(batch.drop(tables.KEY), spec.name, spec.keys, as_of=run.timestamp, full_extract=full, new_columns=new_columns)
            return LoadResult(spec.name, "merged", {}, read - batch.count())

        def wanted(rows: int) -> int:
            """The buckets for so many rows of this size."""
            return -(-rows * (size // max(read, 1) + HASH_BYTES) // bucket_bytes)

        cut = table.buckets if loaded else max(1, buckets or 1, wanted(read))
        # A batch that has outgrown the table is not sorted in the table's few buckets.
        parts = wanted(read) if wanted(read) >= 4 * cut else cut
        rows = keyed
        if max((held for _, held in sizes), default=0) > max(size // min(parts, tables.SLOTS // 2), bucket_bytes):
            # A key has more rows than a bucket should. Spark limits each task to one of them before it shuffles the rest.
            rows = latest(keyed).select(*map(quoted, keyed.columns))
        dealt = staging.stage(tables.spread(rows, tables.KEY, parts, read, size), tables.KEY, parts)
        whole.remove()
        if not loaded:
            table.create(latest(dealt), cut, spec.keys)
            count = spark.table(spec.name).count()
            return LoadResult(spec.name, "initial", {"insert": count}, read - count)
        surplus = read - dealt.select(tables.KEY, *map(quoted, spec.keys)).distinct().count()
        within = None
        if not full:
            # Nothing outside the batch's own buckets can change.
            within = [r[0] for r in tables.with_bucket(dealt, cut).select(tables.BUCKET).distinct().collect()]
        changes = _merge(table, latest(dealt), run, within, full_extract=full, new_columns=new_columns, wanted=wanted)
        return LoadResult(spec.name, "merged", changes, surplus)


def load_table(spark: SparkSession, table: str, source: DataFrame, run: RunContext, *, database: str = project.DATABASE, **options) -> LoadResult:
    """Load one of the project's tables into `<database>.bronze_<table>`; the options are those of `load`."""
    return load(spark, project.bronze_spec(table, database), source, run, Origin(project.SOURCE_SYSTEM, project.SOURCE_SCHEMA, table), **options)


def changes_by_bucket(table: tables.KeyedTable, batch: DataFrame, run: RunContext, within: Sequence[int] | None, *,
                      full_extract: bool) -> DataFrame:
    """Rows per bucket and kind of change that merging `batch`, which has KEY once per key, would bring to the buckets `within`, or to all.

    Reads keys, hashes and flags only. The table's buckets stay where they are: the batch is dealt out alike.
    """
    count, rows = table.buckets, table.rows
    if within is not None:
        rows = rows.where(F.col(tables.BUCKET).isin(list(within)))
    narrow = [tables.KEY, "_ingested_at", "_row_hash", "_is_deleted", "_deleted_at"]
    placed = batch.select(*narrow).repartition(count, tables.KEY)
    merged = merge_keyed(rows.select(*narrow), placed, tables.KEY, as_of=run.timestamp, full_extract=full_extract)
    return tables.with_bucket(merged, count).groupBy(tables.BUCKET, "_op").agg(F.count(F.lit(1)).alias("n"))


def merged_buckets(table: tables.KeyedTable, batch: DataFrame, run: RunContext, touched: Sequence[int] | None, *,
                   full_extract: bool, new_columns: str) -> DataFrame:
    """The rows of the `touched` buckets, or of all, after the merge; the table is not shuffled here either."""
    count = table.buckets
    old, placed = table.rows, tables.with_bucket(batch.repartition(count, tables.KEY), count)
    if touched is not None:
        old, placed = (df.where(F.col(tables.BUCKET).isin(list(touched))) for df in (old, placed))
    return merge_keyed(old.drop(tables.BUCKET), placed.drop(tables.BUCKET), tables.KEY, as_of=run.timestamp,
                       full_extract=full_extract, new_columns=new_columns).drop("_op")


def _merge(table: tables.KeyedTable, batch: DataFrame, run: RunContext, within: Sequence[int] | None, *, full_extract: bool,
           new_columns: str, wanted: Callable[[int], int]) -> dict[str, int]:
    """Merge a batch, writing only buckets with a change anew; returns the rows per kind of change.

    Only the buckets `within`, or all, are looked at.

    The first pass says which buckets change, the second reads those whole. Where the table has outgrown its buckets, the
    second pass takes all of them and cuts the table anew.
    """
    merged_columns(table.rows.drop(tables.BUCKET), batch, new_columns)
    found = changes_by_bucket(table, batch, run, within, full_extract=full_extract).collect()
    changes = {op: sum(r["n"] for r in found if r["_op"] == op) for op in OPERATIONS}
    if within is not None:
        changes["unchanged"] += table.rows.where(~F.col(tables.BUCKET).isin(within)).count()
    touched = sorted({r[tables.BUCKET] for r in found if r["_op"] != "unchanged"})
    if touched:
        more = wanted(sum(changes.values()))
        grown = more >= 4 * table.buckets
        everything = grown or len(touched) == table.buckets
        rows = merged_buckets(table, batch, run, None if everything else touched, full_extract=full_extract, new_columns=new_columns)
        if grown:
            table.create(rows, more, table.keys)
        else:
            table.replace(rows, touched)
    return changes


def load_all(spark: SparkSession, read: Callable[[str], DataFrame], run: RunContext, *,
             at_once: int = 4, **options) -> list[LoadResult]:
    """Load every source table, `at_once` of them at a time.

    `read` gives the lazy scan of a table by its short name; the other options are those of
    `load_table`.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {options.get('database', project.DATABASE)}")
    return run_together([
        partial(load_table, spark, table, read(table), run, **options) for table in project.KEYS], at_once)
