"""Plain declarations that operators take: what a table is and what a run is."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Thresholds:
    """Pass limits per check. Rates are shares of the rows looked at."""

    null_rate: float = 0.05
    duplicate_rate: float = 0.02
    freshness_hours: float = 24.0 * 30
    outlier_zscore: float = 3.0
    outlier_rate: float = 0.01
    orphan_rate: float = 0.0


@dataclass(frozen=True)
class ForeignKey:
    """`column` of the checked table must exist in `ref_table.ref_column`."""

    column: str
    ref_table: str
    ref_column: str
    ref_include_deleted: bool = False

    @property
    def target(self) -> tuple[str, str, bool]:
        """What the key points at; foreign keys with the same target share its distinct keys."""
        return self.ref_table, self.ref_column, self.ref_include_deleted


@dataclass(frozen=True)
class TableSpec:
    """How one table is loaded and checked.

    `skip_null_columns` names columns that are null by construction, so that they do
    not fail every run; pass `()` to measure them as well. `report_extra` makes data columns
    that the expected schema does not name fail the schema check.
    """

    name: str
    layer: str = ""
    keys: tuple[str, ...] = ()
    timestamp: str | None = None
    watermark: str | None = None
    foreign_keys: tuple[ForeignKey, ...] = ()
    expected_schema: StructType | None = None
    report_extra: bool = False
    include_deleted: bool = False
    skip_null_columns: tuple[str, ...] = ("_deleted_at",)


@dataclass(frozen=True)
class SilverSpec:
    """Declarative clean-up of one table.

    `dedupe="raw"` removes duplicate keys before strings are cleaned;
    `dedupe="normalised"` cleans first, so keys that differ only in padding or
    letter case collapse too.
    """

    keys: tuple[str, ...]
    required: tuple[str, ...]
    trim: tuple[str, ...] = ()
    lower_trim: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    dedupe: str = "raw"

    def __post_init__(self) -> None:
        if self.dedupe not in ("raw", "normalised"):
            raise ValueError(f"dedupe must be 'raw' or 'normalised', not {self.dedupe!r}")


@dataclass(frozen=True)
class DefectSpec:
    """Shares of rows to corrupt, for exercising the checks.

    `exact_duplicates` adds exactly that share of copies, drawn with replacement, where else it holds in expectation.
    """

    key: str
    null_columns: tuple[str, ...] = ()
    null_rate: float = 0.05
    duplicate_rate: float = 0.03
    exact_duplicates: bool = False
    outlier_column: str | None = None
    outlier_rate: float = 0.01
    outlier_factor: float = 100.0
    stale_column: str | None = None
    stale_rate: float = 0.02
    stale_days: int = 730
    drop_columns: tuple[str, ...] = ()
    seed: int = 42


@dataclass(frozen=True)
class RunContext:
    """One identity and one clock for everything a run writes."""

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    as_of: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def timestamp(self) -> Column:
        return instant(self.as_of)


def instant(moment: datetime) -> Column:
    """A timestamp literal; a moment without zone is read in the session time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")
