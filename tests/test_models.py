"""Checks and texts against plain Python computing the same on random rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lakeassay import ForeignKey, TableSpec
from lakeassay.functions.text import literal, number_text
from lakeassay.operators.checks import run_checks


def model(rows, parents):
    """`rows` hold key, text, number, parent and delete flag; the active ones count."""
    rows = [r[:4] for r in rows if not r[4]]
    total = len(rows)
    share = lambda part, whole: round(part / whole, 4) if whole else 0.0
    found = {("null_rate", c): share(sum(r[i] is None for r in rows), total) for i, c in enumerate(("k", "t", "x", "p"))}
    found["null_rate", "_is_deleted"] = None
    found["duplicate_rate", "k,t"] = share(total - len({r[:2] for r in rows}), total)
    numbers = [r[2] for r in rows if r[2] is not None]
    spread = statistics.stdev(numbers) if len(numbers) > 1 else 0
    far = sum(abs(n - statistics.mean(numbers)) / spread > 3.0 for n in numbers) if spread else 0
    found["outlier_rate", "x"] = share(far, total)
    children = [r[3] for r in rows if r[3] is not None]
    alive = {k for k, deleted in parents if not deleted}
    found["referential_integrity", "p"] = share(sum(c not in alive for c in children), len(children))
    return found


@pytest.mark.parametrize("seed", range(4))
def test_checks_against_a_plain_python_model(spark, run, seed):
    rng = random.Random(seed)

    def maybe(value, chance=0.15):
        return None if rng.random() < chance else value

    rows = [(
        maybe(rng.choice("abc")), maybe(rng.choice(["u", "v" * 70, "w" * 70])),
        maybe(float(rng.randint(0, 9)) if rng.random() > 0.02 else 500.0), maybe(rng.choice("pqrs")),
        rng.choice([True, False, False, None])) for _ in range(rng.choice([0, 1, 60, 400]))]
    parents = [("p", False), ("p", True), ("q", None), ("r", True), (None, False)]
    df = spark.createDataFrame(rows, "k string, t string, x double, p string, _is_deleted boolean")
    spec = TableSpec("t", keys=("k", "t"), foreign_keys=(ForeignKey("p", "parents", "id"),))
    metrics = run_checks(df, spec, run, references={"parents": spark.createDataFrame(parents, "id string, _is_deleted boolean")})
    found = {(r.check_name, r.column_name): r.metric_value for r in metrics.collect()}
    expected = model(rows, parents)
    del expected["null_rate", "_is_deleted"], found["null_rate", "_is_deleted"]
    assert found == expected


def test_numbers_read_as_python_prints_them(spark):
    rng = random.Random(1)
    values = [round(rng.uniform(-10, 10) * 10 ** rng.randint(-3, 6), 4) for _ in range(500)]
    values += [0.0, 1.0, 0.05, 0.0001, 720.0, 100.5, -0.25, 12345678.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shown = {r.v: r.text for r in df.select("v", F.expr(number_text("v")).alias("text")).collect()}
    assert all(text == repr(v) for v, text in shown.items())


@pytest.mark.parametrize("value", ["it's", "back\\slash", "new\nline", 'double "quote"', "%d {x} $1", ""])
def test_literals_keep_their_text(spark, value):
    assert spark.range(1).select(F.expr(literal(value)).alias("v")).first().v == value
