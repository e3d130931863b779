"""Quality checks. Each takes a DataFrame and returns metric rows, lazily.

All column-wise checks of a table share one aggregate, and the outlier counts a second
one that reads the first one's means as a scalar subquery. Duplicates and foreign keys
group by the key first, so a key that holds a large share of the rows reaches the
shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructType

from lakeassay.functions import active_rows, business_columns, quoted
from lakeassay.functions.text import literal, name, number_text, share
from lakeassay.model import ForeignKey, RunContext, TableSpec, Thresholds
from lakeassay.schemas import CHECK_NAMES, METRIC_SCHEMA

# Columns per aggregate. Each batch reads only its own columns, so splitting a wide
# table costs no extra input but keeps the generated code small.
BATCH_COLUMNS = 100


@dataclass(frozen=True)
class Subject:
    """What a metric row says it is about."""

    table_name: str
    layer: str
    run: RunContext


# The wording of `details` ("nulls out of", "mean=", "std=0", "latest active record at",
# "duplicates out of", "expected ..., got", "orphan rows out of ... checked against").
def _measure(check: str, column: str, value: str, threshold: float, details: str) -> str:
    """One metric as a SQL struct; `value` and `details` are SQL over the summary row."""
    fields = {
        "check_name": literal(check),
        "column_name": literal(column),
        "value": value,
        "threshold": f"double({float(threshold)!r})",
        "details": details,
    }
    return "struct(" + ", ".join(f"{sql} AS {field}" for field, sql in fields.items()) + ")"


def _emit(summary: DataFrame, subject: Subject, measures: Sequence[str]) -> DataFrame:
    """Turn a one-row summary into one row per metric. Values pass or fail before rounding."""
    rows = summary.selectExpr(f"inline(array({', '.join(measures)}))")
    return rows.select(
        F.lit(subject.run.run_id).alias("run_id"),
        subject.run.timestamp.alias("run_timestamp"),
        F.lit(subject.table_name).alias("table_name"),
        F.lit(subject.layer).alias("layer"),
        "check_name",
        "column_name",
        F.expr("if(check_name = 'freshness_hours', round(value, 2), round(value, 4)) AS metric_value"),
        "threshold",
        F.expr("if(check_name = 'schema_conformity', value >= threshold, value <= threshold) AS passed"),
        "details",
    )


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _column_checks(df: DataFrame, subject: Subject, limits: Thresholds, *,
                   nulls: Sequence[str] = (), numbers: Sequence[str] = (),
                   timestamp: str | None = None) -> DataFrame:
    """Null, outlier and freshness metrics of a batch of columns."""
    wanted = ["count(1) AS total"]
    wanted += [f"count({name(c)}) AS filled_{i}" for i, c in enumerate(nulls)]
    for i, column in enumerate(numbers):
        # NaN would make the mean and the spread NaN and so hide every outlier.
        number = f"double({name(column)})"
        known = f"if(isnan({number}), NULL, {number})"
        wanted += [f"avg({known}) AS mean_{i}", f"stddev_samp({known}) AS std_{i}", f"count_if(isnan({number})) AS nan_{i}"]
    if timestamp:
        wanted.append(f"max(try_cast({name(timestamp)} AS timestamp)) AS latest")
    summary = df.agg(F.expr(f"struct({', '.join(wanted)}) AS profile"))
    if numbers:
        summary = _with_outlier_counts(df, summary, numbers, limits.outlier_zscore)

    return _emit(summary, subject, _column_measures(subject, limits, nulls, numbers, timestamp))


def _column_measures(subject: Subject, limits: Thresholds, nulls: Sequence[str], numbers: Sequence[str], timestamp: str | None) -> list[str]:
    """The metrics of a summary row: a struct `profile` and, per number, `far_<i>`."""
    measures = []
    for i, column in enumerate(nulls):
        missing = f"profile.total - profile.filled_{i}"
        measures.append(_measure(
            "null_rate", column, share(missing, "profile.total"), limits.null_rate,
            f"format_string('%d nulls out of %d active rows', {missing}, profile.total)"))
    for i, column in enumerate(numbers):
        mean, std = f"profile.mean_{i}", f"profile.std_{i}"
        spread = f"concat('mean=', {number_text(mean)}, ', std=', {number_text(std)})"
        measures.append(_measure(
            "outlier_rate", column, share(f"far_{i}", "profile.total"), limits.outlier_rate,
            f"concat(CASE WHEN {std} IS NULL OR {std} = 0 THEN 'std=0' ELSE {spread} END, "
            f"if(profile.nan_{i} > 0, format_string(', %d NaN left out', profile.nan_{i}), ''))"))
    if timestamp:
        now = literal(subject.run.as_of.isoformat(sep=" "))
        hours = f"double(unix_micros(timestamp {now}) - unix_micros(profile.latest)) / 1e6D / 3600D"
        measures.append(_measure(
            "freshness_hours", timestamp, f"coalesce({hours}, double('infinity'))", limits.freshness_hours,
            "concat('latest active record at ', coalesce(string(profile.latest), 'None'))"))
    return measures


def _with_outlier_counts(df: DataFrame, profile: DataFrame, numbers: Sequence[str], limit: float) -> DataFrame:
    """The profile and, per numeric column, how many values lie beyond the z-score limit.

    The profile is one row, read as a scalar subquery. Both uses below are the same
    subquery, which Spark runs once.
    """
    values = df.selectExpr(*[f"double({name(c)}) AS x_{i}" for i, c in enumerate(numbers)])
    known = values.withColumn("profile", profile.scalar())
    # A spread of zero gives null. NaN compares as greater than any number, so it is ruled out by name: as a value,
    # and as the spread of a column that holds infinities.
    counts = [
        f"count_if(NOT isnan(profile.std_{i}) AND NOT isnan(x_{i}) "
        f"AND abs(try_divide(x_{i} - profile.mean_{i}, profile.std_{i})) > {limit!r}D) AS far_{i}"
        for i in range(len(numbers))]
    return known.agg(*map(F.expr, counts)).withColumn("profile", profile.scalar())


def column_metrics(spark: SparkSession, subject: Subject, limits: Thresholds, nulls: Sequence[str], numbers: Sequence[str],
                   timestamp: str | None, totals: Mapping[str, Mapping]) -> DataFrame:
    """Null, outlier and freshness metrics from totals that are known: per column `total`, `filled`, `nan`, `mean`, `std`, `far`,
    and the newest time in microseconds as `latest`."""
    wanted = list(dict.fromkeys([*nulls, *numbers]))
    frames = []
    for start in range(0, max(len(wanted), 1), BATCH_COLUMNS):
        batch = wanted[start : start + BATCH_COLUMNS]
        empty, counted = [c for c in batch if c in nulls], [c for c in batch if c in numbers]
        fresh = timestamp if start == 0 else None
        known = totals[(batch or [timestamp])[0]] if batch or fresh else None
        if known is None:
            continue
        fields = [F.lit(known["total"]).cast("long").alias("total")]
        fields += [F.lit(totals[c]["filled"]).cast("long").alias(f"filled_{i}") for i, c in enumerate(empty)]
        for i, c in enumerate(counted):
            fields += [F.lit(totals[c][f]).cast(kind).alias(f"{f}_{i}") for f, kind in (("mean", "double"), ("std", "double"), ("nan", "long"))]
        if fresh:
            fields.append(F.timestamp_micros(F.lit(totals[fresh]["latest"]).cast("long")).alias("latest"))
        far = [F.lit(totals[c]["far"]).cast("long").alias(f"far_{i}") for i, c in enumerate(counted)]
        summary = spark.range(1).select(F.struct(*fields).alias("profile"), *far)
        frames.append(_emit(summary, subject, _column_measures(subject, limits, empty, counted, fresh)))
    return _union(frames) if frames else spark.createDataFrame([], METRIC_SCHEMA)


def duplicate_metrics(spark: SparkSession, subject: Subject, limits: Thresholds, keys: Sequence[str], total: int, kinds: int) -> DataFrame:
    """The duplicate metric from known numbers of rows and of different keys."""
    summary = spark.range(1).select(F.lit(total).cast("long").alias("total"), F.lit(kinds).cast("long").alias("kinds"))
    return _emit(summary, subject, [_duplicate_measure(keys, limits)])


def _duplicate_measure(keys: Sequence[str], limits: Thresholds) -> str:
    return _measure(
        "duplicate_rate", ",".join(keys), share("total - kinds", "total"), limits.duplicate_rate,
        "format_string('%d duplicates out of %d active rows', total - kinds, total)")


def _batched(df: DataFrame, subject: Subject, limits: Thresholds, nulls: Sequence[str],
             numbers: Sequence[str], timestamp: str | None) -> list[DataFrame]:
    """Split the columns so that one aggregate stays small; the numbers of a batch stay together."""
    wanted = [c for c in df.columns if c in set(nulls) | set(numbers)]
    batches = [wanted[i:i + BATCH_COLUMNS] for i in range(0, len(wanted), BATCH_COLUMNS)] or [[]]
    frames = []
    for position, batch in enumerate(batches):
        freshness = timestamp if position == 0 else None
        if batch or freshness:
            frames.append(_column_checks(
                df, subject, limits,
                nulls=[c for c in batch if c in nulls],
                numbers=[c for c in batch if c in numbers],
                timestamp=freshness))
    return frames


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], METRIC_SCHEMA)


def null_rate(df: DataFrame, subject: Subject, limits: Thresholds = Thresholds(), *,
              skip_columns: Sequence[str] = ("_deleted_at",)) -> DataFrame:
    """Share of nulls per column; one aggregate for all columns."""
    columns = [c for c in df.columns if c not in skip_columns]
    frames = _batched(df, subject, limits, columns, (), None)
    return _union(frames) if frames else _empty(df)


def outlier_rate(df: DataFrame, subject: Subject, limits: Thresholds = Thresholds()) -> DataFrame:
    """Share of rows further than the z-score limit from the mean, per numeric column."""
    frames = _batched(df, subject, limits, (), numeric_columns(df), None)
    return _union(frames) if frames else _empty(df)


def freshness(df: DataFrame, subject: Subject, timestamp: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """Hours from the newest record to the run; infinite, and failing, when there is none."""
    return _column_checks(df, subject, limits, timestamp=timestamp)


def _compact(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """What tells keys apart: the columns, with all texts among them replaced by 128 bits of one SHA-256, so that no text is shuffled."""
    # Texts of another collation may be equal without having the same bytes.
    texts = [c for c in keys if df.schema[c].dataType == StringType()]
    others = [quoted(c).alias(f"k{i}") for i, c in enumerate(keys) if c not in texts]
    if not texts:
        return others
    # With its length before each text, and a mark for null, no two keys are written alike.
    parts = [F.coalesce(F.concat(F.octet_length(quoted(c)).cast("string"), F.lit(":"), quoted(c)), F.lit("-")) for c in texts]
    return [*others, F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32)).alias("digest")]


def duplicate_rate(df: DataFrame, subject: Subject, limits: Thresholds = Thresholds(), *,
                   keys: Sequence[str] = (), gathered: str | None = None) -> DataFrame:
    """Share of rows beyond the first of their key, or of all data columns. Null equals null.

    Of a table in buckets of the key column `gathered` nothing is shuffled, so that column is grouped by as it is.
    """
    keys = list(keys) or business_columns(df)
    as_is = [quoted(gathered).alias("bucketed")] if gathered in keys else []
    groups = df.groupBy(*as_is, *_compact(df, [c for c in keys if not as_is or c != gathered])).agg(F.count(F.lit(1)).alias("copies"))
    summary = groups.agg(F.expr("coalesce(sum(copies), 0) AS total"), F.expr("count(1) AS kinds"))
    return _emit(summary, subject, [_duplicate_measure(keys, limits)])


def schema_conformity(df: DataFrame, subject: Subject, expected: StructType, *,
                      report_extra: bool = False) -> DataFrame:
    """1 or 0 per expected column: present with exactly that type. Runs no job.

    `report_extra` adds a failing row for each data column the expectation does not name.
    """
    actual = {f.name: str(f.dataType) for f in df.schema.fields}
    measures = []
    for field in expected.fields:
        found = actual.get(field.name, "MISSING")
        fits = found == str(field.dataType)
        details = "" if fits else f"expected {field.dataType}, got {found}"
        measures.append(_measure("schema_conformity", field.name, "1D" if fits else "0D", 1.0, literal(details)))
    if report_extra:
        for extra in business_columns(df):
            if extra not in expected.fieldNames():
                measures.append(_measure(
                    "schema_conformity", extra, "0D", 1.0, literal(f"unexpected {actual[extra]}")))
    if not measures:
        return _empty(df)
    return _emit(df.sparkSession.range(1), subject, measures)


def reference_keys(reference: DataFrame, column: str, include_deleted: bool = False) -> DataFrame:
    """The distinct keys that foreign keys may point at, as column `ref`."""
    return _reference_keys(reference, column, include_deleted).distinct()


def referential_integrity(df: DataFrame, reference: DataFrame, subject: Subject, *, column: str,
                          ref_table: str, ref_column: str, ref_include_deleted: bool = False,
                          limits: Thresholds = Thresholds()) -> DataFrame:
    """Share of non-null foreign keys without an active referenced row.

    Both sides shrink to one row per key before they meet, so neither a popular key nor
    a reference with repeated keys makes the join larger than the key sets.
    """
    return _integrity(df, reference_keys(reference, ref_column, ref_include_deleted), subject, ForeignKey(
        column, ref_table, ref_column, ref_include_deleted), limits)


def _integrity(df: DataFrame, parents: DataFrame, subject: Subject, key: ForeignKey, limits: Thresholds,
               gathered: str | None = None) -> DataFrame:
    """The check against distinct keys, as `reference_keys` gives them."""
    column = key.column
    children = (
        df.select(quoted(column).alias("fk")).where("fk IS NOT NULL")
        .groupBy("fk").agg(F.count(F.lit(1)).alias("rows")))
    if column == gathered:
        # Else all parents would be dealt out to the buckets of the children, which may be few.
        children = children.repartition("fk")
    matched = children.join(parents, F.col("fk") == F.col("ref"), "left")
    summary = matched.agg(
        F.expr("coalesce(sum(rows), 0) AS checked"),
        F.expr("coalesce(sum(if(ref IS NULL, rows, 0)), 0) AS orphans"))
    against = literal(f" checked against {key.ref_table}.{key.ref_column}")
    return _emit(summary, subject, [_measure(
        "referential_integrity", column, share("orphans", "checked"), limits.orphan_rate,
        f"concat(orphans, ' orphan rows out of ', checked, {against})")])


def orphan_rows(df: DataFrame, reference: DataFrame, *, column: str, ref_column: str,
                ref_include_deleted: bool = False) -> DataFrame:
    """The rows behind a referential failure."""
    children = df.where(quoted(column).isNotNull())
    # Not reduced to distinct keys: with both inputs straight from a shuffle Spark can
    # split the children of a popular key over several tasks.
    parents = _reference_keys(reference, ref_column, ref_include_deleted)
    return children.join(parents, quoted(column) == F.col("ref"), "left_anti")


def _reference_keys(reference: DataFrame, column: str, include_deleted: bool) -> DataFrame:
    rows = active_rows(reference, include_deleted=include_deleted)
    return rows.select(quoted(column).alias("ref")).where("ref IS NOT NULL")


def run_checks(df: DataFrame, spec: TableSpec, run: RunContext, *,
               references: Mapping[str, DataFrame] | None = None,
               limits: Thresholds = Thresholds(),
               checks: Sequence[str] = CHECK_NAMES,
               keys: Mapping[tuple[str, str, bool], DataFrame] | None = None,
               gathered: str | None = None) -> DataFrame:
    """Every check that applies to a table, as one DataFrame of one run.

    The schema check needs `spec.expected_schema`, freshness a `spec.timestamp` column
    that is there, and foreign keys their referenced tables in `references`, or their
    distinct keys in `keys`, by table, column and whether deleted rows count. `gathered`
    names the column by which the table is stored in buckets, if it is.
    """
    unknown = set(checks) - set(CHECK_NAMES)
    if unknown:
        raise ValueError(f"unknown checks: {sorted(unknown)}")
    rows = active_rows(df, include_deleted=spec.include_deleted)
    subject = Subject(spec.name, spec.layer, run)

    nulls = [c for c in rows.columns if c not in spec.skip_null_columns] if "null_rate" in checks else []
    numbers = numeric_columns(rows) if "outlier_rate" in checks else []
    timestamp = spec.timestamp if "freshness_hours" in checks and spec.timestamp in rows.columns else None
    frames = _batched(rows, subject, limits, nulls, numbers, timestamp)
    if "duplicate_rate" in checks:
        frames.append(duplicate_rate(rows, subject, limits, keys=spec.keys, gathered=gathered))
    if "schema_conformity" in checks and spec.expected_schema:
        frames.append(schema_conformity(rows, subject, spec.expected_schema, report_extra=spec.report_extra))
    if "referential_integrity" in checks:
        for fk in spec.foreign_keys:
            parents = (keys or {}).get(fk.target)
            if parents is None:
                if fk.ref_table not in (references or {}):
                    raise KeyError(f"{spec.name}.{fk.column} refers to {fk.ref_table}, which was not given")
                parents = reference_keys(references[fk.ref_table], fk.ref_column, fk.ref_include_deleted)
            frames.append(_integrity(rows, parents, subject, fk, limits, gathered))
    return _union(frames) if frames else _empty(df)
