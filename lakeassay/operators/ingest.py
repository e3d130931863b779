"""Loading with change capture: stamping, watermarks and merging of snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeassay.functions import key_of, latest_per_key, quoted

OPERATIONS = ("insert", "update", "resurrect", "delete", "unchanged")


def stamp_lineage(df: DataFrame, *, system: str, schema: str, table: str, ingested_at: Column | None = None) -> DataFrame:
    """Add source, ingest time and delete flags. One `ingested_at` holds for the batch."""
    return df.withColumns({
        "_source_system": F.lit(system),
        "_source_schema": F.lit(schema),
        "_source_table": F.lit(table),
        "_ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        "_is_deleted": F.lit(False),
        "_deleted_at": F.lit(None).cast("timestamp"),
    })


def high_watermark(target: DataFrame, column: str) -> DataFrame:
    """The newest value loaded so far, as one row; null for an empty table."""
    return target.agg(F.max(quoted(column)).alias("max_watermark"))


def after_watermark(source: DataFrame, column: str, watermark, *, inclusive: bool = False) -> DataFrame:
    """Source rows newer than a watermark; everything when there is none yet.

    `watermark` is a value, which reaches the source as a pushed-down filter, or a
    one-row DataFrame from `high_watermark`, read as a scalar subquery, which does not.

    The strict form misses rows that arrive late with exactly the watermark's value.
    `inclusive` reads those again, which is safe: merging an equal row changes nothing.
    """
    if watermark is None:
        return source
    if isinstance(watermark, DataFrame):
        bound = watermark.scalar()
        first_load = bound.isNull()
    else:
        bound, first_load = F.lit(watermark), F.lit(False)
    value = quoted(column)
    newer = value >= bound if inclusive else value > bound
    return source.where(first_load | newer)


def merge_snapshot(target: DataFrame, source: DataFrame, keys: Sequence[str], *, as_of: Column,
                   full_extract: bool, new_columns: str = "add") -> DataFrame:
    """The target after the source's changes, plus an `_op` column saying what happened.

    Both sides carry lineage and a row hash. Rows whose hash changed are updated, new keys
    inserted, deleted keys that return become active again. With `full_extract`, active
    target keys that the source lacks are marked deleted at `as_of`. Keys match null to
    null. Of several source rows with one key the latest counts.

    Columns that only the source has are added, null in rows it does not change, or refused
    with `new_columns="refuse"`. Columns that only the target has are an error: their values
    would silently become null.

    The sides meet in one full outer join on the key, so each is shuffled once: choosing the
    latest source row uses the same partitioning. Loading keeps target keys unique, so no key
    is larger than one row on either side; a repeated target key still comes out right, but
    its rows meet in one task.
    """
    latest = latest_per_key(source.withColumn("_new_key", key_of(keys)), ["_new_key"])
    columns = merged_columns(target, source, new_columns)
    return _merged(target, latest, key_of(keys), F.col("_new_key"), columns, as_of, full_extract)


def merge_keyed(target: DataFrame, source: DataFrame, key: str, *, as_of: Column, full_extract: bool, new_columns: str = "add") -> DataFrame:
    """`merge_snapshot` of sides that hold their key as one column, never null, of which the source has each value once.

    Where the target is stored in buckets of that column, and the source is partitioned alike, the target is not shuffled.
    """
    columns = merged_columns(target, source, new_columns)
    return _merged(target, source, quoted(key), quoted(key), columns, as_of, full_extract)


def _merged(target: DataFrame, latest: DataFrame, old_key: Column, new_key: Column, columns: Sequence[str],
            as_of: Column, full_extract: bool) -> DataFrame:
    added = [c for c in columns if c not in target.columns]
    known = target.withColumns({c: F.lit(None).cast(latest.schema[c].dataType) for c in added}) if added else target
    old = known.select(old_key.alias("_old_key"), F.struct(*map(quoted, columns)).alias("_old"))
    new = latest.select(new_key.alias("_new_key"), F.struct(*map(quoted, columns)).alias("_new"))

    here, there = F.col("_new_key").isNotNull(), F.col("_old_key").isNotNull()
    was_deleted = F.coalesce(F.col("_old._is_deleted"), F.lit(False))
    differs = ~F.col("_old._row_hash").eqNullSafe(F.col("_new._row_hash"))
    operation = (
        F.when(~there, "insert")
        .when(here & was_deleted, "resurrect")
        .when(here & differs, "update")
        .when(~here & ~was_deleted & F.lit(full_extract), "delete")
        .otherwise("unchanged"))
    taken = F.col("_op").isin("insert", "update", "resurrect")
    gone = F.col("_op") == "delete"

    def kept(name: str) -> Column:
        value = F.when(taken, F.col("_new").getField(name)).otherwise(F.col("_old").getField(name))
        if name == "_is_deleted":
            value = F.when(gone, F.lit(True)).otherwise(value)
        elif name == "_deleted_at":
            value = F.when(gone, as_of).otherwise(value)
        return value.alias(name)

    joined = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
    return joined.withColumn("_op", operation).select(*map(kept, columns), "_op")


def merged_columns(target: DataFrame, source: DataFrame, new_columns: str) -> list[str]:
    """The columns of a merge, new ones after the target's data columns; lost or refused ones are an error."""
    if new_columns not in ("add", "refuse"):
        raise ValueError(f"new_columns must be 'add' or 'refuse', not {new_columns!r}")
    lost = [c for c in target.columns if c not in source.columns]
    if lost:
        raise ValueError(f"the source no longer has the columns {', '.join(lost)}")
    added = [c for c in source.columns if c not in target.columns]
    if added and new_columns == "refuse":
        raise ValueError(f"the source has new columns: {', '.join(added)}")
    data = [c for c in target.columns if not c.startswith("_")]
    return [*data, *added, *[c for c in target.columns if c.startswith("_")]]


def change_summary(merged: DataFrame) -> DataFrame:
    """Row count per kind of change."""
    return merged.groupBy("_op").agg(F.count(F.lit(1)).alias("row_count"))


def surplus_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys that occur more than once, of which a merge uses only the latest row."""
    groups = source.groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias("copies"))
    return groups.where("copies > 1")
