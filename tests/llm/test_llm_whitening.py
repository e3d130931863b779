import math
from fractions import Fraction

import numpy as np
import pytest
from text_cases import SF, given

from lakeassay.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, id string, d string, x string, n string, whitened string, identity_error string"


def table(spark, vectors, ids=None):
    ids = ids if ids is not None else range(len(vectors))
    return spark.createDataFrame([(i, v, 1, *["own"] * 6) for i, v in zip(ids, vectors)], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def check(found, vectors, components=16):
    """Hold result rows of one length, as (id, row) with id an index of `vectors`, against exact sums and numpy's eigenvalues."""
    x = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in vectors.items()}
    fit = sorted({tuple(v) for v in x.values()})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in total]
    centred = np.array([[float(c - m) for c, m in zip(v, mean)] for v in fit])
    covariance = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    rank = int((values > 1e-9 * max(values.max(), 1e-300)).sum()) if values.max() > 1e-9 else 0
    count = min(components, rank)
    assert sorted(r.vec_id for r in found) == sorted(x)
    for r in found:
        assert r.n == n
        assert int(r.deviation) == sum((n * c - s) ** 2 for c, s in zip(x[r.vec_id], total))
        assert len(r.whitened) == len(r.explained) == count
        assert np.allclose(r.explained, values[:count] / np.trace(covariance), rtol=1e-9)
        assert r.identity_error < 1e-9
        wanted = np.array([float(c - m) for c, m in zip(x[r.vec_id], mean)]) @ vectors_[:, :count] / np.sqrt(values[:count])
        assert np.allclose(np.abs(r.whitened), np.abs(wanted), atol=1e-6)
    return values[:count]


def test_linear_algebra():
    rng = np.random.default_rng(1)
    for size, rank in ((1, 1), (2, 2), (7, 7), (20, 5), (33, 33)):
        a = rng.normal(size=(size, rank)) * np.geomspace(1, 1e-3, rank)
        matrix = a @ a.T
        factor, order = whitening.pivoted_cholesky(matrix)
        assert factor.shape == (size, rank) and np.allclose(factor, np.tril(factor))
        assert np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], atol=1e-12)
        values, vectors = whitening.eigen(matrix)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-10)
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
        assert np.allclose(matrix @ vectors, vectors * values, atol=1e-12)
    values, vectors = whitening.eigen(np.zeros((3, 3)))
    assert len(values) == 0 and vectors.shape == (3, 0)


@pytest.mark.parametrize("model_bytes", [whitening.MODEL_BYTES, 0])
def test_equals_exact_sums_and_numpy(spark, model_bytes, monkeypatch):
    monkeypatch.setattr(whitening, "GROUP_ROWS", 40)
    rng = np.random.default_rng(2)
    wide = (rng.normal(size=(200, 20)) @ rng.normal(size=(20, 20))).tolist()
    narrow = rng.normal(size=(30, 3)).tolist()
    odd = [None, [], [1.0, None, 2.0], [math.nan, 1.0, 2.0], [math.inf, 0.0, 0.0], [1e300, 0.0, 0.0]]
    vectors = wide + narrow + odd + [wide[0]] * 60 + [narrow[1]]
    found = whitening.whiten(table(spark, vectors).repartition(4), model_bytes=model_bytes).collect()
    kept = {i: v for i, v in enumerate(vectors) if usable(v) and max(map(abs, v)) < 1e200}
    assert len(found) == len(kept) == 200 + 30 + 61
    for length in (20, 3):
        ids = {i for i, v in kept.items() if len(v) == length}
        check([r for r in found if r.vec_id in ids], {i: kept[i] for i in ids})


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(40, 4)) * [1.0, 1e6, 1e11, 1e15]).tolist()
    found = whitening.whiten(table(spark, vectors)).collect()
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    total = [sum(c) for c in zip(*x)]
    assert {r.vec_id: int(r.deviation) for r in found} == {i: sum((40 * c - s) ** 2 for c, s in zip(v, total)) for i, v in enumerate(x)}


def test_equal_constant_and_single_vectors_and_empty_table(spark):
    assert whitening.whiten(table(spark, []).where("false")).collect() == []
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 5):
        rows = whitening.whiten(table(spark, vectors)).collect()
        assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in rows] == [(1, 0, [], [], 0.0)] * len(vectors)
    constant = {i: [float(i), 7.0, float(i) * 2] for i in range(9)}  # one direction only
    check(whitening.whiten(table(spark, list(constant.values()))).collect(), constant)


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = whitening.whiten(table(spark, [[1.0], [2.0], [2.0], [3.0]], [None, 2**60 + 1, 2**60 + 1, None])).collect()
    assert sorted((r.vec_id or 0) for r in rows) == [0, 0, 2**60 + 1, 2**60 + 1]
    assert {r.n for r in rows} == {3}


def test_given_vectors(spark):
    rows = queries.op12_whitening(spark, SF).collect()
    vectors = {r.vec_id: r.embedding for r in given(spark, "embeddings").collect()}
    assert len(rows) == 16 * len(vectors)
    assert rows[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    found = whitening.whiten(given(spark, "embeddings")).collect()
    check(found, vectors)
    flat = {(r.vec_id, r.component): r for r in rows}
    for r in found:
        for k, (w, e) in enumerate(zip(r.whitened, r.explained), 1):
            one = flat[r.vec_id, k]
            assert (one.n, one.deviation, one.whitened, one.explained, one.identity_error) == (r.n, int(r.deviation), w, e, r.identity_error)
