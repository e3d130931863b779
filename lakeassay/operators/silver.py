"""Cleaning of loaded tables, driven by a `SilverSpec`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeassay.functions import active_rows, latest_per_key, quoted
from lakeassay.model import SilverSpec
from lakeassay.schemas import LINEAGE_COLUMNS


def clean_columns(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Trim, lower-case and parse the columns the spec names. Unparseable times become null."""
    cleaned = {c: F.trim(quoted(c)) for c in spec.trim}
    cleaned |= {c: F.lower(F.trim(quoted(c))) for c in spec.lower_trim}
    cleaned |= {c: quoted(c).try_cast("timestamp") for c in spec.timestamps}
    return df.withColumns(cleaned) if cleaned else df


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(quoted(column).isNotNull())
    return df


def lineage_last(df: DataFrame) -> DataFrame:
    """Data columns in their order, then the lineage columns that are there."""
    lineage = [c for c in LINEAGE_COLUMNS if c in df.columns]
    return df.select(*[quoted(c) for c in df.columns if c not in lineage], *lineage)


def standardise(bronze: DataFrame, spec: SilverSpec) -> DataFrame:
    """Active rows, one per key, cleaned, with the required columns present.

    The requirement on a key column moves below the deduplication, so rows without
    a key are dropped before the shuffle.
    """
    rows = active_rows(bronze, null_is_active=False)
    if spec.dedupe == "raw":
        rows = clean_columns(latest_per_key(rows, spec.keys), spec)
    else:
        rows = latest_per_key(clean_columns(rows, spec), spec.keys)
    return lineage_last(require_columns(rows, *spec.required))
