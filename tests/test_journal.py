"""Answers are kept under their prompts: nothing is asked twice for a lost run."""

import json
import os
import sys
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lakeassay import RunContext, project
from lakeassay.model import instant
from lakeassay.operators import insights
from lakeassay.plans import suite
from lakeassay.plans.journal import Journal
from lakeassay.sources import tables

NOW = datetime(2024, 6, 1)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module", autouse=True)
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS asked")


class Model:
    """Writes a file for each call; workers are other processes."""

    def __init__(self, folder, fails=(), kills=()):
        self.folder, self.fails, self.kills = str(folder), tuple(fails), tuple(kills)

    def __call__(self, prompt):
        Path(self.folder, uuid.uuid4().hex).write_text(prompt)
        if any(f in prompt for f in self.kills):
            os._exit(1)
        if any(f in prompt for f in self.fails):
            raise ValueError("no answer")
        return json.dumps({"summary": f"about {prompt[:20]}", "severity": "low"})

    @property
    def calls(self):
        return sorted(p.read_text() for p in Path(self.folder).iterdir())


def prompts(spark, count):
    return spark.createDataFrame([(i, f"prompt {i:03d}") for i in range(count)], "id int, prompt string").repartition(3)


def test_each_prompt_is_asked_once(spark, tmp_path):
    journal, model = Journal(spark, "asked.once"), Model(tmp_path)
    rows = prompts(spark, 20).unionByName(prompts(spark, 5))
    assert journal.ask(rows, model, instant(NOW), commit_every=6) == 20
    assert model.calls == [f"prompt {i:03d}" for i in range(20)]
    assert journal.ask(prompts(spark, 23), model, instant(NOW)) == 3 and len(model.calls) == 23
    answers = journal.answers(rows).collect()
    assert len(answers) == 25 and {json.loads(r.raw_response)["summary"] for r in answers} == {f"about prompt {i:03d}" for i in range(20)}
    # Another model is asked anew.
    assert Journal(spark, "asked.once", "other").ask(prompts(spark, 2), model, instant(NOW)) == 2


def test_a_prompt_that_raises_costs_one_row_and_is_asked_again(spark, tmp_path):
    journal, model = Journal(spark, "asked.raises"), Model(tmp_path, fails=["007"])
    assert journal.answers(prompts(spark, 2)).where("raw_response IS NULL AND error IS NULL").count() == 2
    journal.ask(prompts(spark, 10), model, instant(NOW))
    found = {r.id: (r.raw_response, r.error) for r in journal.answers(prompts(spark, 10)).collect()}
    assert found[7] == (None, "ValueError: no answer") and all(found[i][0] and not found[i][1] for i in range(10) if i != 7)
    assert journal.ask(prompts(spark, 10), Model(tmp_path), instant(NOW)) == 1
    assert journal.answers(prompts(spark, 10)).where("raw_response IS NULL OR error IS NOT NULL").count() == 0
    assert spark.table("asked.raises").count() == 11


def test_a_killed_call_leaves_only_its_last_answers_to_be_asked_again(spark, tmp_path):
    journal, model = Journal(spark, "asked.killed"), Model(tmp_path, kills=["011"])
    with pytest.raises(Exception, match="crashed"):
        journal.ask(prompts(spark, 40), model, instant(NOW), commit_every=5)
    kept = spark.table("asked.killed").count()
    before = len(model.calls)
    assert before - kept < 15
    again = Model(tmp_path)
    assert journal.ask(prompts(spark, 40), again, instant(NOW), commit_every=5) == 40 - kept
    assert len(again.calls) == before + 40 - kept
    assert journal.answers(prompts(spark, 40)).where("raw_response IS NULL").count() == 0


def metrics(spark):
    rows = [("r", datetime(2024, 1, 1), f"silver_{t}", t, "null_rate", "x", 0.1, 0.05, False, "") for t in "abcdef"]
    return spark.createDataFrame(rows, "run_id string, run_timestamp timestamp, layer string, table_name string, check_name string, "
                                       "column_name string, metric_value double, threshold double, passed boolean, details string")


def test_a_lost_insight_asks_nothing_again(spark, tmp_path, monkeypatch):
    metrics(spark).write.mode("overwrite").saveAsTable(project.table_name(project.METRICS_TABLE, "asked"))
    model, run, append = Model(tmp_path, fails=["table=c "]), RunContext("r", NOW), tables.append

    def lost(df, name, **more):
        if name.endswith(project.INSIGHTS_TABLE):
            raise RuntimeError("the driver is gone")
        append(df, name, **more)

    monkeypatch.setattr(tables, "append", lost)
    with pytest.raises(RuntimeError):
        suite.write_insight(spark, run, database="asked", respond=model)
    assert len(model.calls) == 6
    monkeypatch.undo()
    found = spark.table(suite.write_insight(spark, run, database="asked", respond=model)).collect()
    assert len(model.calls) == 7  # the one that raised
    assert {r.table_name: (r.parse_ok, r.severity) for r in found} == {t: (t != "c", "unknown" if t == "c" else "low") for t in "abcdef"}


def test_the_lazy_form_keeps_the_row_too(spark, tmp_path):
    rows = insights.insights_for_latest_run(metrics(spark), F.lit(NOW), respond=Model(tmp_path, fails=["table=b "])).collect()
    assert {(r.table_name, r.parse_ok) for r in rows} == {(t, t != "b") for t in "abcdef"}
