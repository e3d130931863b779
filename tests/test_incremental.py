"""Metrics from profiles of buckets equal those of a full run, and only changed buckets are read."""

import math
import random
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from lakeassay import ForeignKey, RunContext, TableSpec, Thresholds
from lakeassay.operators import profiles
from lakeassay.operators.checks import run_checks
from lakeassay.plans.bronze import Origin, load, load_all
from lakeassay.plans.incremental import check_changed
from lakeassay.plans.suite import check_tables
from lakeassay.sources import tables

RUNS = [RunContext(f"r{d}", datetime(2024, 3, d + 1)) for d in range(9)]
FROM = Origin("s", "c", "t")
LAYOUT = "id bigint, x double, y int, z decimal(10,2), t string, at timestamp, o bigint, `odd ``name.x` float"
SPEC = TableSpec(
    "profiled.t", "bronze_t", keys=("id",), timestamp="at", foreign_keys=(ForeignKey("o", "other", "id"),),
    expected_schema=StructType([StructField("t", StringType()), StructField("gone", StringType())]))


@pytest.fixture(scope="module", autouse=True)
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS profiled")


def rows(spark, count=400, changed=(), seed=5):
    chance, data = random.Random(seed), []
    for i in range(count):
        x = chance.gauss(0, 1) * (40 if i % 50 == 0 else 1)
        row = [i, math.nan if i % 60 == 1 else None if i % 7 == 0 else x, i % 13, None if i % 3 == 0 else Decimal(i), "" if i % 2 else None,
               datetime(2024, 1, 1) + timedelta(hours=i), i % 5, 1.5]
        if i in changed:
            row[1], row[5] = 99.0, datetime(2024, 2, 20)
        data.append(tuple(row))
    return spark.createDataFrame(data, LAYOUT)


def facts(df):
    return sorted(map(str, df.collect()))


def checked(spark, spec, run, limits=Thresholds()):
    """The incremental result, after comparing it with a full run."""
    others = {"other": spark.range(3)}
    with tables.Staging(spark) as staging:
        done = check_changed(spark, tables.KeyedTable(spark, spec.name), spec, run, staging=staging, references=others, limits=limits)
        assert done.metrics.count() > 10
        assert facts(done.metrics) == facts(run_checks(spark.table(spec.name), spec, run, references=others, limits=limits))
    return done


def test_three_loads(spark):
    table = tables.KeyedTable(spark, SPEC.name)
    load(spark, SPEC, rows(spark), RUNS[0], FROM, buckets=16)
    first = checked(spark, SPEC, RUNS[0])
    assert first.profiled == first.counted == list(range(16))
    again = checked(spark, SPEC, RUNS[1])
    assert again.profiled == again.counted == []

    before = table.folders
    load(spark, SPEC, rows(spark, changed=[5]), RUNS[2], FROM)
    touched = sorted(b for b in before if table.folders[b] != before[b])
    second = checked(spark, SPEC, RUNS[2])
    assert second.profiled == touched and len(touched) == 1
    # The mean has moved a little: other buckets are counted again only where a value lies between the limits.
    assert set(touched) <= set(second.counted) and len(second.counted) < 16

    before = table.folders
    load(spark, SPEC, rows(spark, 399, changed=[5, 8, 20]), RUNS[3], FROM)  # one key is gone
    third = checked(spark, SPEC, RUNS[3])
    assert third.profiled == sorted(b for b in before if table.folders[b] != before[b])
    assert checked(spark, SPEC, RUNS[4], Thresholds(outlier_zscore=2.0)).profiled == []
    everything = TableSpec(**{**SPEC.__dict__, "include_deleted": True, "skip_null_columns": ()})
    assert len(checked(spark, everything, RUNS[5]).profiled) == 16


def test_untouched_buckets_are_not_opened(spark):
    spec = TableSpec("profiled.unread", "bronze_t", keys=("id",))
    same = rows(spark).select("id", F.lit(3).alias("k"), "t")
    load(spark, spec, same, RUNS[0], FROM, buckets=8)
    checked(spark, spec, RUNS[0])
    table = tables.KeyedTable(spark, spec.name)
    before = table.folders
    load(spark, spec, same.withColumn("t", F.when(F.col("id") == 4, "new").otherwise(F.col("t"))), RUNS[1], FROM)
    for bucket, folder in before.items():
        if table.folders[bucket] == folder:
            for file in Path(folder.removeprefix("file:")).glob("*.parquet"):
                file.write_bytes(b"not a table")
    with tables.Staging(spark) as staging:
        done = check_changed(spark, table, spec, RUNS[1], staging=staging)
        assert len(done.profiled) == 1 and done.counted == done.profiled
        nulls = {r.column_name: r.details for r in done.metrics.where("check_name = 'null_rate'").collect()}
        assert nulls["t"] == "199 nulls out of 400 active rows" and nulls["id"] == "0 nulls out of 400 active rows"
        kept = done.metrics.where("check_name = 'duplicate_rate'").first()
        assert kept.details == "0 duplicates out of 400 active rows"


def test_a_new_column_profiles_all_folders(spark):
    spec = TableSpec("profiled.wider", "bronze_t", keys=("id",), timestamp="at")
    load(spark, spec, rows(spark, 60), RUNS[0], FROM, buckets=4)
    checked(spark, spec, RUNS[0])
    load(spark, spec, rows(spark, 60).withColumn("w", F.col("id") * 2), RUNS[1], FROM)
    assert len(checked(spark, spec, RUNS[1]).profiled) == 4


def test_deleted_rows_infinities_and_constant_columns(spark):
    spec = TableSpec("profiled.odd", "bronze_t", keys=("id",))
    data = [(i, math.inf if i == 3 else float(i), 7, None) for i in range(30)]
    make = lambda d: spark.createDataFrame(d, "id int, x double, c int, n double")
    load(spark, spec, make(data), RUNS[0], FROM, buckets=4)
    checked(spark, spec, RUNS[0])
    load(spark, spec, make(data[:1]), RUNS[1], FROM)  # all others are deleted: some buckets have no active row
    checked(spark, spec, RUNS[1])
    load(spark, spec, make(data[5:]), RUNS[2], FROM)
    checked(spark, spec, RUNS[2])


def test_moments_of_parts_add_up(spark):
    chance = random.Random(3)
    data = [(i % 7, chance.gauss(1e6, 1), None if i % 4 else 1.0) for i in range(5000)]
    df = spark.createDataFrame(data, "p int, x double, y double").withColumn("k", F.monotonically_increasing_id())
    parts = profiles.profile_parts(df, "p", ["x", "y"], keys="k")
    whole = {r.column_name: r for r in profiles.combined(parts).collect()}
    full = df.agg(F.avg("x"), F.stddev_samp("x"), F.avg("y"), F.stddev_samp("y")).first()
    assert math.isclose(whole["x"]["mean"], full[0], rel_tol=1e-12) and math.isclose(whole["x"]["std"], full[1], rel_tol=1e-9)
    assert (whole["y"]["mean"], whole["y"]["std"], whole["y"]["n"], whole["y"]["filled"]) == (1.0, 0.0, 1250, 1250)
    assert (whole[profiles.ROWS]["total"], whole[profiles.ROWS]["filled"]) == (5000, 5000)


@pytest.mark.parametrize("seed", range(3))
def test_counts_hold_exactly_when_no_value_changes_sides(spark, seed):
    chance = random.Random(seed)
    data = [(i % 20, chance.gauss(0, 1)) for i in range(400)]
    df = spark.createDataFrame(data, "p int, x double")
    count = lambda mean, std: {r.part: r.far for r in profiles.count_tails(df, "p", {"x": (mean, std)}, 1.5).collect()}
    tails = profiles.count_tails(df, "p", {"x": (0.0, 1.0)}, 1.5)
    for mean, std in ((0.01, 1.0), (0.0, 0.98), (-0.05, 1.04), (0.0, 1.0), (1.7, 0.1)):
        spreads = spark.createDataFrame([("x", mean, std)], "column_name string, mean double, std double")
        kept = {r.part: r.far for r in profiles.still_hold(tails, spreads, 1.5).collect()}
        now = count(mean, std)
        assert kept.items() <= now.items()
        if (mean, std) == (0.0, 1.0):
            assert kept == now
        z = {p: [x for q, x in data if q == p] for p in range(20)}
        same = {p for p, xs in z.items() if all((abs(x) > 1.5) == (abs((x - mean) / std) > 1.5) for x in xs)}
        if abs(mean) < 1:
            assert set(kept) == same


def test_suite_with_and_without_profiles(spark):
    from test_pipeline import FIRST, LAYOUTS
    from lakeassay.plans.layers import build_gold, build_silver

    for day in (0, 1):
        load_all(spark, lambda t: spark.createDataFrame(FIRST[t][day:] or FIRST[t], LAYOUTS[t]), RUNS[day], database="profiled")
        build_silver(spark, database="profiled")
        build_gold(spark, database="profiled")
        name = check_tables(spark, RUNS[day], database="profiled", incremental=True)
        check_tables(spark, RunContext("full", RUNS[day].as_of), database="profiled")
        of = lambda run: facts(spark.table(name).where((F.col("run_id") == run) & (F.to_date("run_timestamp") == F.lit(RUNS[day].as_of.date()))).drop("run_id"))  # noqa: E731, B023
        assert of(RUNS[day].run_id) == of("full") and len(of("full")) > 100
