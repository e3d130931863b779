import json
import re
from datetime import datetime

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from lakeassay.model import instant
from lakeassay.operators import insights
from lakeassay.schemas import INSIGHT_SCHEMA

D1, D2 = datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8, 30, 0, 250)
LAYOUT = ("run_id string, run_timestamp timestamp, layer string, table_name string, check_name string, column_name string, "
          "metric_value double, threshold double, passed boolean, details string")
NOW = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def metrics(spark):
    return spark.createDataFrame([
        ("r1", D1, "silver_a", "a", "null_rate", "x", 0.01, 0.05, True, "fine"),
        ("r2", D2, "silver_a", "a", "null_rate", "x", 0.125, 0.05, False, "1 nulls"),
        ("r2", D2, "gold_b", "b", "freshness_hours", "ts", float("inf"), 720.0, False, "latest active record at None"),
        ("r2", D2, "gold_b", "b", "null_rate", "z", 0.0, 0.05, True, None),
    ], LAYOUT)


def test_ranked_metrics_start_with_failures(metrics):
    ranked = insights.ranked_metrics(metrics).where(F.col("run_timestamp") == F.lit(D2)).orderBy("layer", "rank").collect()
    assert [(r.rank, r.layer, r.check_name) for r in ranked] == [
        (1, "gold_b", "freshness_hours"), (2, "gold_b", "null_rate"), (1, "silver_a", "null_rate")]


def test_every_metric_of_a_large_run_has_its_line(spark):
    many = spark.range(400).select(
        F.lit("r").alias("run_id"), F.lit(D1).alias("run_timestamp"), F.lit("l").alias("layer"),
        F.concat(F.lit("t"), F.col("id") % 2).alias("table_name"),
        F.lit("null_rate").alias("check_name"), F.concat(F.lit("c"), "id").alias("column_name"),
        F.lit(0.0).alias("metric_value"), F.lit(0.05).alias("threshold"), (F.col("id") >= 100).alias("passed"),
        F.lit("").alias("details"))
    counts = insights.pass_fail_counts(many).first()
    assert (counts.total_checks, counts.passed_check_count, counts.failed_check_count) == (400, 300, 100)
    texts = [r.metrics_summary for r in insights.metric_lines(many).collect()]
    assert len(texts) == 2
    assert all("Total checks: 400 | Passed: 300 | Failed: 100\n" in t and "of this table: 200 | Passed: 150" in t for t in texts)
    lines = [line for t in texts for line in t.split("\n")[4:]]
    assert sorted(re.search(r"column=c(\d+)", line)[1] for line in lines) == sorted(str(i) for i in range(400))
    assert [len(r.sample_failures.split("\n")) for r in insights.top_failures(many).collect()] == [50, 50]


def test_runs_of_the_same_time_stay_apart(spark, metrics):
    twin = metrics.where(F.col("run_id") == "r2").withColumn("run_id", F.lit("r3")).withColumn("passed", F.lit(True))
    both = metrics.unionByName(twin)
    assert {(r.run_id, r.total_checks, r.failed_check_count) for r in insights.pass_fail_counts(both).collect()} == {
        ("r1", 1, 0), ("r2", 3, 2), ("r3", 3, 0)}
    assert insights.prompts(both).count() == 5
    assert {r.run_id: json.loads(r.raw_response)["severity"] for r in insights.rule_based_responses(both).collect()} == {
        "r1": "low", "r2": "critical", "r3": "low"}
    rows = insights.insights_for_latest_run(both, instant(NOW)).collect()
    assert [(r.run_id, r.failed_check_count) for r in rows] == [("r3", 0)]


def test_lines(metrics):
    texts = {(r.run_id, r.table_name): r.metrics_summary for r in insights.metric_lines(metrics, domain="d").collect()}
    assert texts["r1", "a"] == (
        "Latest run timestamp: 2024-01-01T08:00:00\nTotal checks: 1 | Passed: 1 | Failed: 0\nDataset domain: d\n"
        "Checks of this table: 1 | Passed: 1 | Failed: 0\n"
        "layer=silver_a | table=a | check=null_rate | column=x | value=0.01 | threshold=0.05 | passed=True | details=fine")
    lines = texts["r2", "b"].split("\n")
    assert lines[:2] == ["Latest run timestamp: 2024-01-02T08:30:00.000250", "Total checks: 3 | Passed: 1 | Failed: 2"]
    assert lines[3] == "Checks of this table: 2 | Passed: 1 | Failed: 1"
    assert lines[4] == (
        "layer=gold_b | table=b | check=freshness_hours | column=ts | value=inf | threshold=720.0 | passed=False | "
        "details=latest active record at None")
    assert lines[-1].endswith("passed=True | details=None")


def test_failures(metrics):
    texts = {(r.run_id, r.table_name): r.sample_failures for r in insights.top_failures(metrics).collect()}
    assert texts["r1", "a"] == "No failing checks in the latest run."
    assert texts["r2", "a"] == (
        "layer=silver_a | table=a | column=x | check=null_rate | value=0.125 | threshold=0.05 | details=1 nulls")


def test_metrics_are_read_once_for_the_prompts(spark, metrics, tmp_path):
    metrics.write.parquet(str(tmp_path / "m"))
    plan = executed_plan(insights.prompts(spark.read.parquet(str(tmp_path / "m"))))
    assert plan.split("Initial Plan")[0].count("FileScan") == 1


def test_prompt(metrics):
    rows = {r.run_id: r.prompt for r in insights.prompts(metrics, "A {{METRICS_SUMMARY}} B {{SAMPLE_FAILURES}}").collect()}
    assert rows["r1"].startswith("A Latest run timestamp") and rows["r1"].endswith("B No failing checks in the latest run.")
    assert "{{" not in insights.prompts(metrics).first().prompt
    for key in ("summary", "root_cause", "suggested_action", "severity"):
        assert f'"{key}"' in insights.PROMPT_TEMPLATE


def test_parse(spark):
    full = {"summary": "s", "root_cause": "r", "suggested_action": "a", "severity": "high"}
    raw = [
        json.dumps(full), "```json\n" + json.dumps(full) + "\n```", "```" + json.dumps(full) + "```  ",
        '{"summary": "only"}', "no json", '{"summary": ', json.dumps({**full, "severity": "URGENT"}),
        json.dumps({**full, "severity": "Critical"}), None, "", json.dumps(full) + " and more text",
        json.dumps(full) + json.dumps(full), json.dumps(full) + ", " + json.dumps(full), json.dumps([full]), '"text"', "{}",
        json.dumps(full) + "], [" + json.dumps(full), json.dumps({"summary": "a ] } \" [ {"}), json.dumps(full)[:-1] + ",}"]
    df = spark.createDataFrame(list(enumerate(raw)), "id int, raw_response string")
    got = {r.id: r for r in insights.parse_responses(df).collect()}
    assert all((got[i].summary, got[i].severity, got[i].parse_ok) == ("s", "high", True) for i in (0, 1, 2))
    assert (got[3].summary, got[3].root_cause, got[3].severity, got[3].parse_ok) == ("only", "", "unknown", True)
    assert not got[4].parse_ok and not got[5].parse_ok and not got[8].parse_ok and not got[9].parse_ok
    assert [i for i in range(10, 19) if got[i].parse_ok] == [15, 17] and got[17].summary == "a ] } \" [ {"
    assert all((got[i].summary, got[i].severity) == ("", "unknown") for i in (10, 11, 12, 13, 14, 15, 16, 18))
    assert got[6].severity == "unknown" and got[7].severity == "critical"


def test_rules(spark, metrics):
    rows = {r.run_timestamp: json.loads(r.raw_response) for r in insights.rule_based_responses(metrics).collect()}
    assert rows[D1] == {"summary": "All 1 checks passed.", "root_cause": "", "suggested_action": "", "severity": "low"}
    assert rows[D2]["severity"] == "critical"
    assert rows[D2]["summary"] == "2 of 3 checks failed. The first is freshness_hours on gold_b b.ts at inf."


@pytest.mark.parametrize("failed,total,check,severity", [
    (0, 10, "null_rate", "low"), (1, 10, "null_rate", "medium"), (1, 10, "referential_integrity", "high"),
    (2, 10, "null_rate", "high"), (5, 10, "null_rate", "critical")])
def test_severity(spark, failed, total, check, severity):
    df = spark.createDataFrame(
        [("r", D1, "l", "t", check, f"c{i}", 0.0, 0.0, i >= failed, "") for i in range(total)], LAYOUT)
    assert json.loads(insights.rule_based_responses(df).first().raw_response)["severity"] == severity


def test_insight_of_the_latest_run(metrics):
    found = insights.insights_for_latest_run(metrics, instant(NOW))
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in INSIGHT_SCHEMA]
    rows = found.collect()
    assert [(r.metrics_run_timestamp, r.run_timestamp, r.failed_check_count, r.passed_check_count) for r in rows] == [(D2, NOW, 2, 1)]


def test_insight_from_a_callers_function(metrics):
    def respond(prompt):
        return json.dumps({"summary": f"{prompt.count('layer=')} lines", "severity": "medium"})

    rows = insights.insights_for_latest_run(metrics, instant(NOW), respond=respond).collect()
    assert {(r.table_name, r.summary, r.severity, r.root_cause, r.parse_ok) for r in rows} == {
        ("a", "2 lines", "medium", "", True), ("b", "3 lines", "medium", "", True)}


def test_no_run_is_lost_to_an_unreadable_answer(metrics):
    assert insights.insights_for_latest_run(metrics.where("false"), instant(NOW)).count() == 0
    rows = insights.insights_for_latest_run(metrics, instant(NOW), respond=lambda prompt: "sorry").collect()
    assert {(r.table_name, r.summary, r.severity, r.raw_response, r.parse_ok, r.failed_check_count) for r in rows} == {
        ("a", "", "unknown", "sorry", False, 2), ("b", "", "unknown", "sorry", False, 2)}
