import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from conftest import executed_plan
from pyspark.sql import functions as F
from text_cases import LONG, TEXTS, WORD, components, documents, empty, given

from lakeassay.llm import queries, simhash


def naive(text, shingle=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    count = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(count)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


@pytest.mark.parametrize("text", [t for t in TEXTS if t != LONG] + ["a b c d a b c d a b", "x " * 50])
def test_fingerprint_counts_every_shingle(text):
    assert simhash.fingerprint_of(text.encode() if text is not None else None, 4) & (2**64 - 1) == naive(text)


def test_fingerprint_in_chunks_equals_one_chunk(monkeypatch):
    whole = simhash.fingerprint_of(LONG.encode(), 4)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint_of(" ".join(LONG.split()[:300]).encode(), 4) & (2**64 - 1) == naive(" ".join(LONG.split()[:300]))
    monkeypatch.setattr(simhash, "CHUNK", 1000)
    assert simhash.fingerprint_of(LONG.encode(), 4) == whole


@pytest.mark.parametrize("distinct", [1, 10**6, 10**9, 10**12])
@pytest.mark.parametrize("distance", [0, 1, 4])
def test_close_pairs_share_a_set_of_blocks(distinct, distance):
    masks, sets = simhash.block_scheme(distinct, distance)
    assert sum(masks) == 2**64 - 1
    dice = random.Random(distinct)
    for _ in range(200):
        differ = sum(1 << b for b in dice.sample(range(64), distance))
        assert any(not differ & sum(masks[b] for b in blocks) for blocks in sets)


@pytest.mark.parametrize("distinct", [500, 10**7, 10**11])
def test_links_are_all_close_pairs_once(spark, distinct):
    dice = random.Random(7)
    base = [dice.getrandbits(64) for _ in range(60)] + [0]
    values = {b ^ sum(1 << x for x in dice.sample(range(64), dice.randint(0, 6))) for b in base for _ in range(8)} | {0, 1, 2**64 - 1}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, distinct).collect()
    wanted = {(a, b) for a in signed for b in signed if a > b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    assert len(found) == len(wanted) and {tuple(r) for r in found} == wanted


def signed(v):
    return int(np.uint64(v).astype(np.int64))


def distance(a, b):
    return bin((a ^ b) & (2**64 - 1)).count("1")


@pytest.mark.parametrize("distinct", [500, 10**9])
def test_linked_components_equal_plain_python(spark, distinct):
    dice = random.Random(distinct)
    values = {dice.getrandbits(64) for _ in range(30)}
    for _ in range(250):  # chains and clusters: each new one is near some other
        near = dice.choice(sorted(values))
        values.add(near ^ sum(1 << x for x in dice.sample(range(64), dice.randint(1, 7))))
    values = [signed(v) for v in values]
    found = {r.node: r.root for r in simhash.linked_components(spark.createDataFrame([(v,) for v in values], "fp long"), 4, distinct).collect()}
    roots = components(dict.fromkeys(values) | {v: v for v in values}, lambda a, b: distance(a, b) <= 4)
    alone = {v for v in values if not any(v != w and distance(v, w) <= 4 for w in values)}
    assert found == {v: r for v, r in roots.items() if v not in alone}


def test_a_dense_group_has_few_links(spark):
    values = [signed(sum(1 << x for x in bits)) for n in (1, 2, 3) for bits in combinations(range(64), n)][:6000]
    df = spark.createDataFrame([(v, v) for v in values], "fp long, label long")
    assert simhash.outward_links(df, 4, len(values)).count() == 6000
    found = simhash.linked_components(df.select("fp"), 4, len(values)).collect()
    assert len(found) == 6000 and {r.root for r in found} == {min(values)}


def test_pivots_join_a_dense_group_before_its_pairs_meet(spark):
    dice, center = random.Random(3), random.Random(4).getrandbits(64)
    group = {center ^ sum(1 << x for x in dice.sample(range(64), dice.randint(1, 3))) for _ in range(3000)}
    values = [signed(v) for v in group | {dice.getrandbits(64) for _ in range(500)}]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    labelled = simhash.pivot_components(df, 4, len(values))
    a, b = labelled.alias("a"), labelled.alias("b")
    apart = a.join(b, F.expr("a.label <> b.label AND bit_count(a.fp ^ b.fp) <= 4")).count()
    pairs = a.join(b, F.expr("a.fp <> b.fp AND bit_count(a.fp ^ b.fp) <= 4")).count()
    assert labelled.count() == len(values) and pairs > 500_000 and apart < pairs / 100
    assert labelled.where("label > fp").count() == 0
    roots = components(dict.fromkeys(values) | {v: v for v in values}, lambda x, y: distance(x, y) <= 4)
    found = {r.node: r.root for r in simhash.linked_components(df, 4, len(values)).collect()}
    assert found == {v: roots[v] for v in found} and set(found) >= {signed(v) for v in group}


def test_dense_groups_meet_pivots_once_and_others_never(spark, monkeypatch):
    dice, calls, whole = random.Random(11), [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda pairs: calls.append(pairs.count()) or whole(pairs))
    base = [dice.getrandbits(64) for _ in range(400)]
    pairs = {v ^ 1 << dice.randrange(64) for v in base} | set(base)
    group = {base[0] ^ sum(1 << x for x in dice.sample(range(64), 2)) for _ in range(600)}
    for values, turns in ((pairs, 0), (pairs | group, 1)):
        calls.clear()
        df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
        labelled = simhash.pivot_components(df, 4, len(values))
        assert len(calls) == turns and labelled.count() == len(values)
        assert all(n <= simhash.PIVOTS * 5 * len(values) for n in calls)
        roots = components({signed(v): signed(v) for v in values}, lambda a, b: distance(a, b) <= 4)
        found = {r.node: r.root for r in simhash.linked_components(df, 4, len(values)).collect()}
        assert set(found) >= {signed(v) for v in values} and found == {v: roots[v] for v in found}


def test_few_edges_take_one_task(spark, conf):
    conf(**{"spark__sql__shuffle__partitions": "40", "spark__sql__adaptive__coalescePartitions__enabled": "false"})
    chain = spark.range(200).select((F.col("id") + 1).alias("src"), F.col("id").alias("dst"))
    found = simhash.components(chain)
    assert len(found.inputFiles()) == 1 and found.groupBy("root").count().collect() == [(0, 200)]


def test_a_hub_is_split_over_tasks(spark, conf):
    conf(**{"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
            "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16k",
            "spark__sql__adaptive__coalescePartitions__enabled": "false"})
    star = spark.range(1, 40_001).select(F.col("id").alias("src"), F.lit(0).cast("long").alias("dst"))
    both = star.unionByName(star.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = simhash.staged(both.groupBy("src").agg(F.min("dst").alias("low")))
    assert "skew=true" in executed_plan(simhash.staged(both).join(least, "src"))
    assert simhash.components(star).groupBy("root").count().collect() == [(0, 40_000)]


def test_names_that_operators_use_themselves(spark):
    docs = spark.createDataFrame([(1, "a b c d e", "x", 5), (2, "a b c d e", "y", 6), (3, "other words", None, 7)],
                                 "`a.b` long, __llm_text string, __llm_k0 string, `_kept_1` int")
    kept = simhash.keep_one(docs, "a.b", "__llm_text")
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [(1, "a b c d e", "x", 5), (3, "other words", None, 7)]
    found = simhash.near_duplicates(docs, "a.b", "__llm_text").collect()
    assert sorted((r["a.b"], r.component_id) for r in found) == [(1, 1), (2, 1), (3, 3)]


def test_components_of_long_chains(spark):
    chain = [(i + 1, i) for i in range(0, 300)] + [(1000 + i, 999) for i in range(50)] + [(5000, 4000), (5000, 4500)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert found == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 999 for i in range(50)}, 5000: 4000, 4500: 4000}
    assert simhash.components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_components_on_given_documents(spark):
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    prints = {k: naive(t) for k, t in texts.items()}
    roots = components(prints, lambda a, b: bin(a ^ b).count("1") <= 4)
    found = queries.op1_simhash(spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(k, f"{v:016x}", roots[k]) for k, v in prints.items()}
    assert len(found) == len(texts)


def test_odd_documents(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(found) == documents(spark).count()
    blank = [r for r in found if r.fingerprint == "0" * 16]
    assert len(blank) == 6 and {r.component_id for r in blank} == {0}
    assert {r.component_id for r in found if r.doc_id is None} == {0, None}  # "no id" has no id to name it by
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_one_of_each_component_stays(spark):
    docs = documents(spark, 2)
    kept = simhash.keep_one(docs)
    assert kept.schema.names == docs.schema.names
    rows = kept.collect()
    prints = {i: naive(r.text) for i, r in enumerate(docs.collect())}
    roots = components(prints, lambda a, b: bin(a ^ b).count("1") <= 4)
    assert len(rows) == len(set(roots.values())) and {naive(r.text) for r in rows} <= set(prints.values())
    # Two texts of id 5 are two documents; each row that stays has its component's smallest id.
    ids = [r.doc_id for r in docs.collect()]
    lowest = {root: min((ids[i] for i in roots if roots[i] == root and ids[i] is not None), default=None) for root in set(roots.values())}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(i for i in lowest.values() if i is not None)
    assert [r.text for r in rows if r.doc_id is None] == ["no id"]
    assert simhash.keep_one(empty(spark)).collect() == []
