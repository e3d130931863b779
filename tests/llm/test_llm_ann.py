import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from text_cases import given

from lakeassay.llm import ann, queries


def plain(rows, queries_, top=20):
    out = {}
    for q, x in queries_:
        scored = sorted(((-float(np.dot(x, v)), i) for i, v in rows if i != q))
        out[q] = [(i, -s) for s, i in scored[:top]]
    return out


def by_query(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_agreement_is_the_lowered_footrule_distance():
    dice = random.Random(2)
    k, pivots = 6, 15
    orders = np.array([dice.sample(range(pivots), k) for _ in range(40)], np.int32)
    a, b = orders[:10], orders[10:]
    found = ann.agreement(a, ann.inverted_file(b, pivots))
    place = lambda order, p: list(order).index(p) if p in order else k
    for i in range(10):
        for j in range(30):
            footrule = sum(abs(place(a[i], p) - place(b[j], p)) for p in range(pivots))
            assert footrule == 2 * sum(k - x for x in range(k)) - 2 * found[i, j]


def test_postings_hold_each_row_once_for_each_of_its_pivots():
    dice = random.Random(3)
    order = np.array([dice.sample(range(9), 4) for _ in range(25)], np.int32)
    postings = ann.inverted_file(order, 9)
    for p in range(9):
        part = slice(postings.starts[p], postings.starts[p + 1])
        wanted = {(i, 4 - list(row).index(p)) for i, row in enumerate(order) if p in row}
        assert len(postings.rows[part]) == len(wanted) and set(zip(postings.rows[part], postings.weights[part])) == wanted


def test_a_query_sees_the_postings_of_the_pivots_it_visits_only():
    order = np.array([[0, 1], [2, 3], [3, 0]], np.int32)
    postings = ann.inverted_file(order, 5)
    assert ann.agreement(np.array([[0]]), postings).tolist() == [[2, 0, 1]]
    assert ann.agreement(np.array([[4, 3], [3, 4]]), postings).tolist() == [[0, 1, 1], [0, 1, 2]]


def test_nearest_pivots_are_in_order():
    dice = np.random.default_rng(9)
    x, pivots = dice.integers(-2, 3, (50, 4)).astype(float), dice.integers(-2, 3, (12, 4)).astype(float)
    products = x @ pivots.T
    for k in (1, 5, 12):
        for row, near in zip(products, ann.nearest_pivots(x, pivots, k)):
            assert len(set(near)) == k and sorted(row[near], reverse=True) == sorted(row, reverse=True)[:k]
            assert all((-row[a], a) < (-row[b], b) for a, b in zip(near, near[1:]))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_given_vectors(spark, sf):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in given(spark, "embeddings", f"/root/testdata/{sf}").collect()]
    found = by_query(queries.op7_nearest_neighbours(spark, f"/root/testdata/{sf}").collect())
    wanted = plain(rows, [x for x in rows if x[0] % 20 == 0])
    assert set(found) == set(wanted)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) / 20 for q in wanted]
    assert np.mean(hits) >= 0.9
    vectors = dict(rows)
    for q, near in found.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0])) and q not in dict(near)
        assert all(s == pytest.approx(vectors[q] @ vectors[i], abs=1e-12) for i, s in near)


def test_many_near_copies_are_all_seen(spark, monkeypatch):
    """Thousands of vectors around one place, searched with few reranked at first."""
    monkeypatch.setattr(ann, "RERANK", 64)
    dice = np.random.default_rng(5)
    centre = dice.normal(size=16)
    x = np.concatenate([centre + 0.01 * dice.normal(size=(1500, 16)), dice.normal(size=(1500, 16))])
    rows = [(i, v) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    found = by_query(ann.nearest(df, F.col("vec_id") % 50 == 0).collect())
    wanted = plain(rows, [r for r in rows if r[0] % 50 == 0])
    assert np.mean([len(dict(found[q]).keys() & dict(wanted[q]).keys()) / 20 for q in wanted]) >= 0.9


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]),
            (6, [1.0, None]), (7, [math.nan, 1.0]), (8, [math.inf, 1.0]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (9, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    found = by_query(ann.nearest(df, F.col("vec_id") % 20 == 0, top=3).collect())
    assert found == {0: [(1, 0.5), (2, 0.5), (20, 0.0)], 20: [(1, 0.5), (2, 0.5), (0, 0.0)]}
    assert ann.nearest(df.where("vec_id > 2 and vec_id < 9"), F.col("vec_id") % 20 == 0).collect() == []
    assert ann.nearest(df.limit(0), F.lit(True)).collect() == []
    assert ann.nearest(df, F.lit(False)).collect() == []
    assert ann.nearest(df.where("vec_id = 0"), F.lit(True)).collect() == []


def test_vectors_of_each_length_are_searched(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    monkeypatch.setattr(ann, "HELD", 100)
    dice = np.random.default_rng(7)
    rows = [(i, dice.normal(size=(4, 4, 6)[i % 3])) for i in range(600)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    found = by_query(ann.nearest(df, F.col("vec_id") % 10 == 0, top=5).collect())
    assert set(found) == set(range(0, 600, 10))
    for n in (4, 6):
        own = [r for r in rows if len(r[1]) == n]
        for q, near in plain(own, [r for r in own if r[0] % 10 == 0], top=5).items():
            assert [i for i, _ in found[q]] == [i for i, _ in near]


def test_rows_of_one_vector_are_found_by_their_smallest_ids(spark, monkeypatch):
    """A third of all rows hold one vector; no result needs more of them than the first few."""
    monkeypatch.setattr(ann, "BLOCK", 100)
    dice = np.random.default_rng(11)
    same = dice.integers(-3, 4, 8).astype(float)
    rows = [(i, same if i % 3 == 0 else dice.integers(-3, 4, 8).astype(float)) for i in range(900)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows if v.any()], "vec_id long, embedding array<double>")
    rows = [r for r in rows if r[1].any()]
    found = by_query(ann.nearest(df, F.col("vec_id") % 10 == 0, top=6).collect())
    wanted = plain(rows, [r for r in rows if r[0] % 10 == 0], top=6)
    assert found.keys() == wanted.keys()
    for q in wanted:
        if q % 3 == 0:
            assert [i for i, _ in found[q]] == [i for i, _ in wanted[q]]
    hits = [len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) / 6 for q in wanted]
    assert np.mean(hits) >= 0.9


def test_more_results_than_rows_reranked_at_once(spark, monkeypatch):
    monkeypatch.setattr(ann, "RERANK", 4)
    dice = np.random.default_rng(13)
    rows = [(i, dice.normal(size=5)) for i in range(60)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    found = by_query(ann.nearest(df, F.col("vec_id") == 7, top=100).collect())
    assert [i for i, _ in found[7]] == [i for i, _ in plain(rows, [rows[7]], top=100)[7]]
