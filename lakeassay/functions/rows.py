"""Row-level expressions: activity, hashing, keys and choice of a survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DecimalType, DoubleType, FloatType, TimestampType

NULL_TEXT = "<NULL>"


def quoted(name: str) -> Column:
    """The top-level column of that name, also when the name holds a dot."""
    return F.col("`" + name.replace("`", "``") + "`")


def business_columns(df: DataFrame) -> list[str]:
    """Columns that are data, not lineage (lineage names start with an underscore)."""
    return [c for c in df.columns if not c.startswith("_")]


def active_rows(df: DataFrame, *, null_is_active: bool = True, include_deleted: bool = False) -> DataFrame:
    """Leave out soft-deleted rows.

    Checks count a null flag as active; cleaning (`null_is_active=False`) drops it.
    A table without the flag, or `include_deleted`, passes through.
    """
    if include_deleted or "_is_deleted" not in df.columns:
        return df
    deleted = F.col("_is_deleted")
    return df.where(~F.coalesce(deleted, F.lit(False)) if null_is_active else ~deleted)


def row_hash(df: DataFrame, *, mode: str = "joined") -> Column:
    """Fingerprint of the data columns in column order.

    `joined` is the md5 of the `||`-joined texts with nulls spelled out. Values that
    hold `||` themselves can collide there; `safe` hashes the row as JSON instead.
    """
    columns = business_columns(df)
    if mode == "joined":
        texts = [F.coalesce(quoted(c).cast("string"), F.lit(NULL_TEXT)) for c in columns]
        return F.md5(F.concat_ws("||", *texts))
    if mode == "safe":
        document = F.to_json(F.struct(*map(quoted, columns)), {"ignoreNullFields": "false"})
        return F.sha2(document, 256)
    raise ValueError(f"row hash mode must be 'joined' or 'safe', not {mode!r}")


def with_row_hash(df: DataFrame, *, mode: str = "joined") -> DataFrame:
    return df.withColumn("_row_hash", row_hash(df, mode=mode))


def key_of(columns: Sequence[str]) -> Column:
    """All key columns as one value. Its equality counts null as equal to null."""
    return F.struct(*map(quoted, columns))


def key_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """All key columns as one text, never null and different for different keys, which a table can be stored by.

    Whole numbers of any width have one text, as have decimals of any scale; times do not depend on the session's zone.
    """
    parts = []
    for name in columns:
        kind, value = df.schema[name].dataType, quoted(name)
        if isinstance(kind, TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, (FloatType, DoubleType)):
            value = value.cast("double") + F.lit(0.0)  # one text for both zeros
        elif isinstance(kind, BinaryType):
            value = F.hex(value)
        text = value.cast("string")
        if isinstance(kind, DecimalType) and kind.scale:
            text = F.regexp_replace(text, r"\.?0+$", "")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def latest_order(df: DataFrame) -> list[Column]:
    """Newest ingest first, then the hash; without lineage the whole row decides."""
    order = []
    if "_ingested_at" in df.columns:
        order.append(F.col("_ingested_at").desc())
    if "_row_hash" in df.columns:
        order.append(F.col("_row_hash").asc())
    return order if "_row_hash" in df.columns else order + [quoted(c).asc() for c in business_columns(df)]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, always the same one.

    Spark turns `row_number() = 1` into a per-task limit before the shuffle, so a key
    that holds a large share of the table sends one row per map task, not all of them.
    """
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*(order or latest_order(df)))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
