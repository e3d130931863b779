"""Deterministic corruption of a table, for seeing the checks fail."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from lakeassay.functions import quoted
from lakeassay.model import DefectSpec

# The row selection works modulo a prime. Keys are reduced by it first, so that no product
# leaves the range of a long, however large the keys are.
PRIME = 1000003
MULTIPLIER = 427799
SEED_STEP = 7919
# Groups of buckets whose sizes the driver sees when an exact number of copies is drawn.
GROUPS = 1024


def selected(df: DataFrame, key: str, rate: float, seed: int | Column) -> Column:
    """True for about `rate` of the keys; the same rows each time for the same seed.

    The shifted key is squared: runs of consecutive keys then scatter, and different
    seeds pick unrelated rows, which a linear formula would not do.
    """
    number = quoted(key) if isinstance(df.schema[key].dataType, IntegralType) else F.xxhash64(quoted(key))
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    prime = F.lit(PRIME).cast("bigint")
    shifted = F.pmod(F.pmod(number.cast("bigint"), prime) + seed * F.lit(SEED_STEP), prime)
    drawn = F.pmod(shifted * shifted * F.lit(MULTIPLIER), prime)
    return F.coalesce(drawn < F.lit(rate * PRIME), F.lit(False))


def inject_nulls(df: DataFrame, key: str, columns: list[str] | tuple[str, ...], rate: float = 0.05, seed: int = 0) -> DataFrame:
    """Null out a share of each column, chosen anew per column."""
    emptied = {
        c: F.when(~selected(df, key, rate, seed + 10 * i), quoted(c))
        for i, c in enumerate(columns)}
    return df.withColumns(emptied)


def inject_duplicates(df: DataFrame, key: str, rate: float = 0.03, seed: int = 0, *, mark: str | None = None) -> DataFrame:
    """Emit a share of the rows twice, in one scan. `mark` names a column numbering the copies."""
    copies = F.when(selected(df, key, rate, seed), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    doubled = df.select("*", F.explode(copies).alias(mark or "_copy"))
    return doubled if mark else doubled.drop("_copy")


def inject_exact_duplicates(df: DataFrame, rate: float = 0.03, seed: int = 0, *, mark: str | None = None, bucket_rows: int = 100_000) -> DataFrame:
    """Add exactly `int(rows * rate)` copies of rows drawn with replacement; the same ones each time for the same rows and seed.

    `mark` names a column numbering the copies of a row, 0 for the row itself. The draw does not depend on how the rows are
    partitioned. It is a multinomial one, split from the top: rows that are equal in all columns are one identity with
    a weight, identities are hashed to buckets of about `bucket_rows`, buckets to at most GROUPS groups. Seeded draws divide
    the copies among groups by weight on the driver, then among the buckets of each group, then among the identities of
    each bucket. Only hashes are shuffled for it; equal rows are counted before.
    """
    plain = [F.to_json(F.struct(quoted(f.name))) if _holds_map(f.dataType) else quoted(f.name) for f in df.schema.fields]
    hashed = df.withColumns({"_h1": F.xxhash64(F.lit(1), *_nulls_apart(plain)), "_h2": F.xxhash64(F.lit(2), *_nulls_apart(plain))})
    weights = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("weight"))
    total = df.count()
    copies = int(total * rate)
    if copies == 0:
        return df.withColumn(mark, F.lit(0)) if mark else df
    buckets = max(1, -(-total // bucket_rows))
    bucket = F.pmod("_h1", F.lit(buckets))
    placed = weights.select("_h1", "_h2", "weight", bucket.alias("bucket"), F.pmod("bucket", F.lit(min(buckets, GROUPS))).alias("group"))
    sizes = placed.groupBy("group", "bucket").agg(F.sum("weight").alias("weight"))

    groups = {r["group"]: r["weight"] for r in sizes.groupBy("group").agg(F.sum("weight").alias("weight")).collect()}
    shares = dict(zip(sorted(groups), _divided(copies, [groups[g] for g in sorted(groups)], seed).tolist()))

    def among_buckets(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bucket")
        return pd.DataFrame({"bucket": rows["bucket"], "copies": _divided(shares[key[0]], rows["weight"], seed, 1, key[0])})

    def among_rows(key: tuple, rows: pd.DataFrame, drawn: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_h1", "_h2"])
        extra = _divided(int(drawn["copies"].iloc[0]), rows["weight"], seed, 2, key[0])
        return rows.assign(extra=extra).loc[extra > 0, ["_h1", "_h2", "extra"]]

    drawn = sizes.groupBy("group").applyInPandas(among_buckets, "bucket long, copies long")
    extra = placed.groupBy("bucket").cogroup(drawn.groupBy("bucket")).applyInPandas(among_rows, "_h1 long, _h2 long, extra long")
    # Of equal rows one stands for all; a task passes on one of them.
    one = F.row_number().over(Window.partitionBy("_h1", "_h2").orderBy("_h1"))
    chosen = hashed.join(extra, ["_h1", "_h2"]).withColumn("_one", one).where("_one = 1")
    added = chosen.select(*map(quoted, df.columns), F.explode(F.sequence(F.lit(1), F.col("extra").cast("int"))).alias("_copy"))
    both = df.withColumn("_copy", F.lit(0)).unionByName(added)
    return both.withColumnRenamed("_copy", mark) if mark else both.drop("_copy")


def _holds_map(kind: DataType) -> bool:
    return "map<" in kind.simpleString()


def _nulls_apart(columns: Sequence[Column]) -> list[Column]:
    """The columns with a flag for null each: hashing alone passes over nulls."""
    return [x for c in columns for x in (c.isNull(), c)]


def _divided(copies: int, weights: Sequence[int], *seed: int) -> np.ndarray:
    """A draw of `copies` among the weights; the same for the same seed."""
    weights = np.asarray(weights, float)
    return np.random.default_rng([int(s) % 2**63 for s in seed]).multinomial(copies, weights / weights.sum())


def inject_outliers(df: DataFrame, key: str, column: str, rate: float = 0.01, factor: float = 100.0, seed: int | Column = 0) -> DataFrame:
    spiked = F.when(selected(df, key, rate, seed), quoted(column) * factor).otherwise(quoted(column))
    return df.withColumn(column, spiked.cast(df.schema[column].dataType))


def inject_stale(df: DataFrame, key: str, column: str, as_of: Column, rate: float = 0.02, days: int = 730, seed: int | Column = 0) -> DataFrame:
    """Set a share of the dates to `days` before `as_of`."""
    old = (as_of - F.make_dt_interval(F.lit(days))).cast(df.schema[column].dataType)
    return df.withColumn(column, F.when(selected(df, key, rate, seed), old).otherwise(quoted(column)))


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Schema drift."""
    return df.drop(*columns)


def shuffle_rows(df: DataFrame, seed: int = 0) -> DataFrame:
    """Rows in random order, for an export whose readers take the order as it comes.

    The order comes from a hash of the row, so it is the same however the rows are partitioned.
    """
    columns = [F.to_json(F.struct(quoted(f.name))) if _holds_map(f.dataType) else quoted(f.name) for f in df.schema.fields]
    return df.orderBy(F.xxhash64(F.lit(seed), *_nulls_apart(columns)), F.xxhash64(F.lit(seed + 1), *_nulls_apart(columns)))


def corrupt(df: DataFrame, spec: DefectSpec, as_of: Column) -> DataFrame:
    """Nulls, duplicates, outliers, stale dates and drift, in that order.

    The selections read the key as it was before its own nulls, and copies of a row
    are drawn separately for outliers and stale dates.
    """
    df = df.withColumn("_origin", quoted(spec.key))
    df = inject_nulls(df, "_origin", spec.null_columns, spec.null_rate, spec.seed)
    if spec.exact_duplicates:
        df = inject_exact_duplicates(df, spec.duplicate_rate, spec.seed + 1, mark="_copy")
    else:
        df = inject_duplicates(df, "_origin", spec.duplicate_rate, spec.seed + 1, mark="_copy")
    per_copy = F.lit(100) * F.col("_copy")
    if spec.outlier_column:
        df = inject_outliers(df, "_origin", spec.outlier_column, spec.outlier_rate,
                             spec.outlier_factor, F.lit(spec.seed + 2) + per_copy)
    if spec.stale_column:
        df = inject_stale(df, "_origin", spec.stale_column, as_of, spec.stale_rate,
                          spec.stale_days, F.lit(spec.seed + 3) + per_copy)
    return drop_columns(df, "_origin", "_copy", *spec.drop_columns)
