import re
from datetime import date, datetime, timedelta

import pytest
from conftest import planned
from pyspark.sql import functions as F

from lakeassay.operators import monitor

LAYOUT = ("run_id string, run_timestamp timestamp, layer string, table_name string, check_name string, column_name string, "
          "metric_value double, threshold double, passed boolean, details string")
D1, D2 = datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8)


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame([
        ("r1", D1, "silver_a", "a", "null_rate", "x", 0.5, 0.05, False, "old"),
        ("r1", D1, "silver_a", "a", "referential_integrity", "k", 0.2, 0.0, False, "old orphans"),
        ("r2", D2, "silver_a", "a", "null_rate", "x", 0.1, 0.05, False, "d1"),
        ("r2", D2, "silver_a", "a", "null_rate", "y", 0.0, 0.05, True, "d2"),
        ("r2", D2, "silver_a", "a", "referential_integrity", "k", 0.3, 0.0, False, "d3"),
        ("r2", D2, "gold_b", "b", "null_rate", "z", 0.2, 0.05, False, "d4"),
        ("r2", D2, "gold_c", "c", "duplicate_rate", "z", 0.0, 0.02, True, "d5"),
    ], LAYOUT)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_scores(metrics):
    assert rows(monitor.quality_score(metrics)) == [(40.0,)]
    assert rows(monitor.failed_checks(metrics)) == [(3,)]
    assert rows(monitor.score_by_table(metrics)) == [("b", 0.0), ("a", 33.3), ("c", 100.0)]
    assert rows(monitor.score_by_layer(metrics)) == [
        (date(2024, 1, 1), "silver_a", 0.0), (date(2024, 1, 2), "gold_b", 0.0),
        (date(2024, 1, 2), "gold_c", 100.0), (date(2024, 1, 2), "silver_a", 33.3)]
    assert rows(monitor.score_by_stage(metrics)) == [
        (date(2024, 1, 1), "silver", 0.0), (date(2024, 1, 2), "gold", 50.0), (date(2024, 1, 2), "silver", 33.3)]


def test_lists(metrics):
    assert [r.details for r in monitor.failing_checks(metrics).collect()] == ["d4", "d1", "d3"]
    assert rows(monitor.referential_failures(metrics)) == [
        ("silver_a", "a", "k", 0.3, "d3"), ("silver_a", "a", "k", 0.2, "old orphans")]
    assert rows(monitor.null_hotspots(metrics, top=2)) == [("gold_b | z", 0.2), ("silver_a | x", 0.1)]
    assert rows(monitor.null_hotspots(metrics)) == [("gold_b | z", 0.2), ("silver_a | x", 0.1), ("silver_a | y", 0.0)]


def test_hotspots_have_no_limit_of_their_own(spark):
    many = spark.createDataFrame([("r", D1, "l", "t", "null_rate", f"c{i:03}", i / 100, 0.05, False, "") for i in range(60)], LAYOUT)
    assert len(rows(monitor.null_hotspots(many))) == 60


def test_of_two_runs_with_one_time_one_is_newest(metrics):
    twin = metrics.where("run_id = 'r2'").withColumn("run_id", F.lit("r10"))
    assert {r.run_id for r in monitor.latest_run(metrics.unionByName(twin)).collect()} == {"r2"}
    assert monitor.latest_run(metrics.withColumn("run_id", F.lit(None).cast("string"))).count() == 5


def test_alerts(metrics):
    assert sorted(rows(monitor.score_alerts(metrics))) == [("gold_b", "b", 0.0, 1, 0.8), ("silver_a", "a", 0.3333, 2, 0.8)]


def test_no_metrics(metrics):
    none = metrics.where("false")
    assert rows(monitor.quality_score(none)) == [(None,)]
    assert rows(monitor.failed_checks(none)) == [(0,)]
    assert rows(monitor.latest_run(none)) == []


def test_stored_metrics_are_read_for_the_newest_day_only(spark, metrics, tmp_path):
    metrics.withColumn("run_date", F.to_date("run_timestamp")).write.partitionBy("run_date").parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    newest = monitor.latest_run(stored)
    assert re.search(r"PartitionFilters: \[isnotnull\(run_date#\d+\), \(run_date#\d+ = Subquery", planned(newest))
    assert newest.count() == 5


def test_insight_queries(spark):
    insights = spark.createDataFrame(
        [(D1, D1, "high", 1, 2, "s1", "r", "a"), (D2, D2, "low", 0, 3, "s2", "r", "a"), (D2, D1, "low", 0, 3, "s3", "r", "a")],
        "run_timestamp timestamp, metrics_run_timestamp timestamp, severity string, failed_check_count bigint, "
        "passed_check_count bigint, summary string, root_cause string, suggested_action string")
    assert [r.summary for r in monitor.latest_insight(insights).collect()] == ["s2"]
    assert rows(monitor.severity_trend(insights)) == [(date(2024, 1, 1), "high", 1), (date(2024, 1, 2), "low", 2)]


def test_rolling_baseline(spark):
    def row(day, value, hour=0):
        return ("r", datetime(2024, 1, day, hour), "l", "t", "null_rate", "x", value, 0.05, True, "")

    history = spark.createDataFrame(
        [row(1, 0.9), row(3, 0.1), row(3, 0.3, 5), row(9, 0.2), row(10, float("inf")), row(20, 0.7)], LAYOUT)
    found = {r.run_date.day: (r.current_value, r.baseline_value, r.deviation)
             for r in monitor.rolling_baseline(history).collect()}
    assert found == {
        1: (0.9, None, None), 3: (0.2, 0.9, -0.7), 9: (0.2, 0.2, 0.0), 10: (None, 0.2, None), 20: (0.7, None, None)}


def test_runs_of_one_day_have_their_own_baselines(spark):
    start = datetime(2024, 1, 1)
    at = [start, start + timedelta(hours=6), start + timedelta(days=7), start + timedelta(days=7, microseconds=1), start + timedelta(days=7, hours=6)]
    rows = [(f"r{i}", t, "l", "t", "null_rate", "c", float(2**i)) for i, t in enumerate(at)]
    rows.append(("twin", at[4], "l", "t", "null_rate", "c", float("inf")))
    df = spark.createDataFrame(rows, "run_id string, run_timestamp timestamp, layer string, table_name string, check_name string, column_name string, metric_value double")
    found = {r.run_id: (r.current_value, r.baseline_value) for r in monitor.run_baseline(df).collect()}
    assert found == {"r0": (1.0, None), "r1": (2.0, 1.0), "r2": (4.0, 1.5), "r3": (8.0, 3.0), "r4": (16.0, round(14 / 3, 6)), "twin": (None, round(14 / 3, 6))}
