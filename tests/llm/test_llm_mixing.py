from collections import Counter, defaultdict

import pytest
from text_cases import SF, documents, empty, given, python_nodes, size_of

from lakeassay.llm import mixing, queries


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Share by weight; whatever passes its cap is fixed there and the rest shared again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: cap * sizes[s] for s in over}
        left -= sum(cap * sizes[s] for s in over)
        free -= over
    return out


def check(docs, found, text="text"):
    rows = docs.collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += size_of(r[text])
    wanted, got, most = targets(sizes), Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert r.taken == r["size"] * r.copies and 0 <= r.copies <= 2
        got[r.source] += r.taken
        most[r.source] = max(most[r.source], r["size"])
    assert len(found) == len(rows)
    for s in sizes:
        assert abs(got[s] - wanted[s]) <= most[s] / 2 + 1e-6


def test_given_documents(spark):
    check(given(spark, "documents", "/root/testdata/sf0.01"), mixing.mix(given(spark, "documents", "/root/testdata/sf0.01")).collect())


def test_odd_documents(spark):
    docs = documents(spark, 20).where("length(text) < 1000 or text is null")
    found = mixing.mix(docs)
    assert found.columns.count("size") == 1
    check(docs, found.collect())
    assert mixing.mix(empty(spark)).collect() == [] and mixing.mixed(empty(spark)).collect() == []


def test_reruns_and_other_partitions_agree(spark, conf):
    docs = documents(spark, 10)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.copies)
    first = sorted(mixing.mix(docs).collect(), key=key)
    conf(spark__sql__shuffle__partitions="3")
    again = sorted(mixing.mix(docs.repartition(7)).collect(), key=key)
    assert [(r.doc_id, r.copies) for r in first] == [(r.doc_id, r.copies) for r in again]


def test_one_hot_source_and_repeated_rows(spark):
    rows = [(i, "a b c " * (i % 9 + 1), "hot") for i in range(3000)] + [(7, "x y", "one")] * 301 + [(9, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(docs, mixing.mix(docs).collect())


def test_equal_rows_are_numbered_by_salt(spark, monkeypatch):
    """The shares of equal rows do not depend on how many tasks number them."""
    rows = [(i, "a b " * (i % 5 + 1), "hot") for i in range(200)] + [(7, "x y z", "hot")] * 500 + [(8, "u v", "one")] * 77 + [(9, "", None)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    key = lambda r: (r.doc_id, r.copies)
    first = sorted(mixing.mix(docs).collect(), key=key)
    monkeypatch.setattr(mixing, "EQUAL", 30)
    again = mixing.mix(docs.repartition(5)).collect()
    check(docs, again)
    assert [key(r) for r in first] == [key(r) for r in sorted(again, key=key)]


def test_many_sources_in_several_ranges(spark, conf):
    conf(spark__sql__shuffle__partitions="6", spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(f"s{i:03d}" if i else None, (i * 37) % 91) for i in range(400)]
    sources = spark.createDataFrame(rows, "source string, source_size long")
    found = mixing.source_targets(sources, (3, 1, 2), 1.5, 2.0).collect()
    wanted = targets(dict(rows))
    order = sorted(s for s, _ in rows if s) + [None]
    assert len(found) == len(rows) and all(r.target == pytest.approx(wanted[r.source]) and order[r["rank"] - 1] == r.source for r in found)
    assert mixing.source_targets(sources.limit(0), (3, 1, 2), 1.5, 2.0).collect() == []


def test_the_mix_repeats_documents(spark):
    docs = documents(spark, 3)
    copies = sum(r.copies for r in mixing.mix(docs).collect())
    out = mixing.mixed(docs)
    assert out.schema.names == docs.schema.names and out.count() == copies


def test_copies_are_unbiased(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 40 + 1), "a" if i % 2 else "b") for i in range(400)], "doc_id long, text string, source string")
    total = Counter()
    for seed in range(8):
        for r in mixing.mix(docs, seed=seed).collect():
            total[r.doc_id % 2, r.doc_id % 40 < 20] += r.copies / 8
            ratio = r.target / r.source_size
    groups = {(x, y): sum(1 for i in range(400) if (i % 2, i % 40 < 20) == (x, y)) for x in (0, 1) for y in (False, True)}
    by = {r.doc_id % 2: r.target / r.source_size for r in mixing.mix(docs).collect()}
    for (x, y), n in groups.items():
        assert total[x, y] / n == pytest.approx(by[x], abs=0.12), ratio


def test_only_dataframe_operations(spark):
    assert not python_nodes(queries.op3_mixing(spark, SF))


def test_names_that_the_operator_uses_itself(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", i, "n") for i in range(20)], "doc_id long, text string, __llm_source string, __llm_k0 long, __llm_number string")
    found = mixing.mix(docs, source="__llm_source").collect()
    assert len(found) == 20 and all(r["__llm_k0"] == r.doc_id and r["__llm_number"] == "n" and r["__llm_source"] == "s" for r in found)
    mixed = mixing.mixed(docs, source="__llm_source")
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in found)
