"""Source tables through bronze, silver and gold to checks and an insight, twice."""

import json
from datetime import datetime
from functools import partial
from pathlib import Path

import pytest

from lakeassay import RunContext, project
from lakeassay.operators import monitor
from lakeassay.plans.bronze import load_all, load_table
from lakeassay.plans.jobs import run_together
from lakeassay.plans.layers import build_gold, build_silver
from lakeassay.plans.suite import check_tables, write_insight
from lakeassay.sources import tables

LAYOUTS = {
    "studies": "nct_id string, brief_title string, official_title string, overall_status string, phase string, "
               "study_type string, last_update_posted_date date",
    "sponsors": "nct_id string, name string, lead_or_collaborator string",
    "conditions": "nct_id string, name string",
    "interventions": "nct_id string, intervention_type string, name string",
    "eligibilities": "nct_id string, gender string, minimum_age string, maximum_age string",
    "facilities": "nct_id string, name string, city string, state string, country string",
    "outcomes": "id int, nct_id string, outcome_type string, title string",
    "outcome_analyses": "id int, outcome_id int",
}
FIRST = {
    "studies": [("N1", " One ", "Long one", "Recruiting ", "P1", "Drug", datetime(2024, 5, 1).date()),
                ("N2", "Two", "Long two", "DONE", "P2", "Drug", datetime(2024, 5, 2).date())],
    "sponsors": [("N1", " Acme", "LEAD"), ("N9", "Lost", "lead")],
    "conditions": [("N1", "flu"), ("N1", " cold "), ("N2", "flu")],
    "interventions": [("N1", "DRUG", "aspirin"), ("N1", "Drug ", "tea")],
    "eligibilities": [("N1", "All", "18", "60")],
    "facilities": [("N1", "Clinic", "Oslo", None, "Norway")],
    "outcomes": [(1, "N1", "PRIMARY", "t"), (2, "N2", "secondary", "u")],
    "outcome_analyses": [(10, 1), (11, 2), (12, None)],
}
DAY1, DAY2, DAY3 = (RunContext(f"day{d}", datetime(2024, 5, d + 9)) for d in (1, 2, 3))
DB = "trials"


@pytest.fixture(scope="module")
def read(spark):
    def reader(data):
        return lambda table: spark.createDataFrame(data[table], LAYOUTS[table])

    return reader


@pytest.fixture(scope="module")
def loads(spark, read):
    first = load_all(spark, read(FIRST), DAY1, database=DB)
    second = {
        **FIRST,
        "studies": [*FIRST["studies"], ("N3", "Three", "Long three", "done", "P1", "Device", datetime(2024, 5, 9).date())],
        "conditions": [("N1", "flu"), ("N3", "gout")],
        "facilities": [],
        "outcomes": [(1, "N1", "PRIMARY", "changed"), (2, "N2", "secondary", "u")],
    }
    return first, load_all(spark, read(second), DAY2, database=DB)


def bronze(spark, table):
    return spark.table(f"{DB}.bronze_{table}")


def test_loads(spark, loads):
    first, second = ({r.table.removeprefix(f"{DB}.bronze_"): r for r in results} for results in loads)
    assert {r.outcome for r in first.values()} == {"initial"}
    assert first["conditions"].changes == {"insert": 3}
    # Only the study after the watermark is read, and none is marked deleted.
    assert second["studies"].changes == {"insert": 1, "update": 0, "resurrect": 0, "delete": 0, "unchanged": 2}
    assert second["conditions"].changes == {"insert": 1, "update": 0, "resurrect": 0, "delete": 2, "unchanged": 1}
    assert second["outcomes"].changes["update"] == 1
    # An empty extract must not mark everything deleted.
    assert second["facilities"].outcome == "skipped"
    assert bronze(spark, "facilities").where("NOT _is_deleted").count() == 1


def test_reloading_the_same_data_changes_nothing(spark, read, loads):
    before = sorted(map(str, bronze(spark, "sponsors").collect()))
    result = load_table(spark, "sponsors", read(FIRST)("sponsors"), DAY3, database=DB)
    assert result.changes == {"insert": 0, "update": 0, "resurrect": 0, "delete": 0, "unchanged": 2}
    assert sorted(map(str, bronze(spark, "sponsors").collect())) == before


def files(spark, table):
    folders = tables.KeyedTable(spark, f"guard.bronze_{table}").folders
    return {(folder, p.name) for folder in folders.values() for p in Path(folder.removeprefix("file:")).glob("*.parquet")}


def test_first_load_keeps_one_row_per_key(spark):
    rows = [("N1", "Acme", "lead"), ("N1", "Acme", "lead"), ("N2", "Acme", "lead"), ("N1", None, "lead"), ("N1", None, "lead")]
    source = spark.createDataFrame(rows, LAYOUTS["sponsors"])
    first = load_table(spark, "sponsors", source, DAY1, database="guard")
    assert first.changes == {"insert": 3} and spark.table("guard.bronze_sponsors").count() == 3
    again = load_table(spark, "sponsors", source, DAY2, database="guard")
    assert again.changes == {"insert": 0, "update": 0, "resurrect": 0, "delete": 0, "unchanged": 3}
    assert spark.table("guard.bronze_sponsors").groupBy("nct_id", "name").count().where("count > 1").count() == 0


@pytest.fixture(scope="module", autouse=True)
def databases(spark):
    for name in (DB, "guard"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def test_a_merge_rewrites_only_buckets_it_changes(spark):
    def outcomes(changed):
        return spark.createDataFrame([(i, "N1", "primary", "new" if i in changed else "t") for i in range(300)], LAYOUTS["outcomes"])

    load_table(spark, "outcomes", outcomes(()), DAY1, database="guard", buckets=16)
    before = files(spark, "outcomes")
    assert len({folder for folder, _ in before}) == 16
    assert load_table(spark, "outcomes", outcomes(()), DAY2, database="guard").changes["unchanged"] == 300
    assert files(spark, "outcomes") == before
    assert load_table(spark, "outcomes", outcomes((5,)), DAY3, database="guard").changes["update"] == 1
    after = files(spark, "outcomes")
    assert len({folder for folder, _ in before - after}) == 1 and len(before & after) == len(before) - 1
    table = spark.table("guard.bronze_outcomes")
    assert table.count() == 300 and [r.id for r in table.where("title = 'new'").collect()] == [5]


def test_a_new_source_column_reaches_the_table(spark):
    load_table(spark, "conditions", spark.createDataFrame([("N1", "flu"), ("N2", "gout")], LAYOUTS["conditions"]), DAY1, database="guard")
    wider = spark.createDataFrame([("N1", "flu", 3), ("N3", "cold", None)], LAYOUTS["conditions"] + ", grade int")
    with pytest.raises(ValueError, match="new columns: grade"):
        load_table(spark, "conditions", wider, DAY2, database="guard", new_columns="refuse")
    load_table(spark, "conditions", wider, DAY2, database="guard")
    found = {(r.nct_id, r.grade, r._is_deleted) for r in spark.table("guard.bronze_conditions").collect()}
    assert found == {("N1", 3, False), ("N2", None, True), ("N3", None, False)}


def test_loads_of_one_table_at_once_do_not_meet(spark):
    """Two first loads into two databases, from the same source at the same time; nothing stays staged."""
    spark.sql("CREATE DATABASE IF NOT EXISTS guard2")
    source = spark.createDataFrame([("N%d" % i, "All", "18", "60") for i in range(50)], LAYOUTS["eligibilities"])
    before = set(Path(tables.shared_folder(spark)).glob("staged-*"))
    done = run_together([partial(load_table, spark, "eligibilities", source, DAY1, database=d) for d in ("guard", "guard2")])
    assert [r.changes["insert"] for r in done] == [50, 50]
    assert all(spark.table(f"{d}.bronze_eligibilities").count() == 50 for d in ("guard", "guard2"))
    assert set(Path(tables.shared_folder(spark)).glob("staged-*")) == before


def test_layers_checks_and_insight(spark, loads):
    build_silver(spark, database=DB)
    build_gold(spark, database=DB)
    status = {r.overall_status: r.study_count for r in spark.table(f"{DB}.gold_study_status_counts").collect()}
    assert status == {"done": 2, "recruiting": 1}
    coverage = {tuple(r) for r in spark.table(f"{DB}.gold_condition_intervention_summary").collect()}
    assert coverage == {("flu", "drug", 1), ("gout", None, 1), (None, None, 1)}

    check_tables(spark, DAY2, database=DB)
    name = check_tables(spark, DAY3, database=DB)
    metrics = spark.table(name)
    assert metrics.select("run_timestamp").distinct().count() == 2
    newest = monitor.latest_run(metrics)
    assert newest.select("table_name").distinct().count() == 19
    assert newest.where("check_name = 'referential_integrity'").count() == 14
    lost = newest.where("check_name = 'referential_integrity' AND table_name = 'trials.bronze_sponsors'").first()
    assert (lost.metric_value, lost.passed) == (0.5, False)
    assert lost.details == "1 orphan rows out of 2 checked against trials.silver_studies.nct_id"

    write_insight(spark, DAY3, database=DB)
    insights = spark.table(write_insight(
        spark, DAY3, database=DB, respond=lambda prompt: json.dumps({"summary": "from a model", "severity": "low"})))
    # One of the run, by rules, and one of each of its tables.
    assert insights.count() == 1 + 19
    row = insights.where("summary = 'from a model'").first()
    assert row.failed_check_count == newest.where("NOT passed").count()
    assert newest.where("check_name = 'schema_conformity'").count() > 19 and newest.where(
        "check_name = 'schema_conformity' AND NOT passed").count() == 0
    assert row.metrics_run_timestamp == DAY3.as_of


def test_tables_answer_dashboard_sql(spark, loads):
    newest = f"run_timestamp = (SELECT MAX(run_timestamp) FROM {DB}.quality_metrics)"
    score = "ROUND(AVG(CASE WHEN passed THEN 1.0 ELSE 0.0 END) * 100, 1) AS score"
    by_table = spark.sql(f"SELECT table_name, {score} FROM {DB}.quality_metrics WHERE {newest} GROUP BY 1 ORDER BY 2, 1")
    ours = monitor.score_by_table(spark.table(f"{DB}.quality_metrics")).collect()
    assert [(r.table_name, float(r.score)) for r in by_table.collect()] == [tuple(r) for r in ours]
    trend = spark.sql(f"SELECT DATE(run_timestamp) AS run_date, layer, {score} FROM {DB}.quality_metrics GROUP BY 1, 2")
    assert trend.count() == monitor.score_by_layer(spark.table(f"{DB}.quality_metrics")).count()
    severities = spark.sql(f"SELECT DATE(run_timestamp), severity, COUNT(*) AS n FROM {DB}.ai_insights GROUP BY 1, 2")
    assert severities.selectExpr("sum(n)").first()[0] == 1 + 19


def test_suite_covers_the_declared_relations():
    specs = project.quality_specs()
    assert len(specs) == 19
    assert sum(len(s.foreign_keys) for s in specs) == 14
    assert {s.layer for s in specs if s.layer.startswith("gold")} == {
        "gold_study_status", "gold_phase_summary", "gold_condition_intervention"}
