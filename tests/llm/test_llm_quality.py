import numpy as np
import pytest
from pyspark.sql import functions as F
from text_cases import LONG, documents, empty, given

from lakeassay.llm import common, quality, queries

SF = "/root/testdata/sf0.01"


def test_model_equals_plain_sums(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = docs.where(~common.held_out(F.col("doc_id"))).collect()
    x = {c: np.array([quality.statistics_of(r.text.encode()) for r in rows if known.get(r.doc_id) == c]) for c in (0, 1)}
    model = quality.train(docs, labels, shrinkage=0.2)
    n = {c: len(x[c]) for c in x}
    d = len(quality.STATISTICS)
    cov = {c: np.cov(x[c].T, bias=True) for c in x}
    within = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    within = 0.8 * within + 0.2 * np.diag(np.diag(within)) + 1e-3 * np.eye(d)
    for c in (0, 1):
        assert model.mean[c] == pytest.approx(x[c].mean(axis=0))
        shrunk = 0.8 * cov[c] + 0.2 * within
        assert model.factor[c] @ model.factor[c].T == pytest.approx(shrunk, abs=1e-8)
    some = np.concatenate([x[0][:5], x[1][:5]])
    density = [model.log_prior[c] - 0.5 * np.linalg.slogdet(model.factor[c] @ model.factor[c].T)[1] - 0.5 * np.array(
        [(s - model.mean[c]) @ np.linalg.inv(model.factor[c] @ model.factor[c].T) @ (s - model.mean[c]) for s in some]) for c in (0, 1)]
    assert model.scores(some) == pytest.approx(1 / (1 + np.exp((density[0] - density[1]) / model.temper)), abs=1e-9)


def test_unseen_quarter_is_judged_right(spark):
    known = {r.doc_id: r.quality for r in given(spark, "labels", SF).collect()}
    found = queries.op6_quality(spark, SF).collect()
    assert len(found) == given(spark, "documents", SF).count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    unseen = [r for r in found if r.held_out and r.doc_id in known]
    assert sum(r.predicted == known[r.doc_id] for r in unseen) >= 0.95 * len(unseen)
    good = [r for r in found if known.get(r.doc_id) == 1]
    assert sum(r.predicted for r in good) >= 0.99 * len(good)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    spoilt = labels.withColumn("quality", F.when(common.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.allclose(quality.train(docs, labels).mean, quality.train(docs, spoilt).mean)


def test_odd_documents(spark):
    model = quality.train(given(spark, "documents", SF), given(spark, "labels", SF))
    docs = documents(spark)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text is None or r.text == ""}) == 1
    assert quality.score(empty(spark), model).collect() == []
    assert all(np.isfinite(quality.statistics_of(t)).all() for t in (None, b"", b"\n\n", b"|" * 10**6, LONG.encode(), b"\xff\x00"))


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_labels(spark):
    docs = given(spark, "documents")
    none = quality.train(docs, labelled(spark, []))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    one = quality.train(docs, labelled(spark, [(i, 1, 0) for i in range(100)] + [(None, 0, 0), (3, None, 0)]))
    assert len({round(r.score, 9) for r in quality.score(docs, one).collect()}) == 1
    twice = quality.train(docs, given(spark, "labels").unionAll(given(spark, "labels")))
    assert np.allclose(twice.mean, quality.train(docs, given(spark, "labels")).mean)
    with pytest.raises(Exception, match="neither 0 nor 1"):
        quality.train(docs, labelled(spark, [(i, 2, 0) for i in range(50)]))
