import re
import time
from collections import Counter

import pytest
from compare import connect, difference, duck_result, spark_result
from pyspark.sql import functions as F
from text_cases import SF, WORD, documents, empty, given, python_nodes

from lakeassay.llm import oracles, queries, rules

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("place", [23, 6, 2])
def test_measures_equal_plain_python(spark, monkeypatch, place):
    """With few bits for places and hashes, texts are too long or windows collide, and are sorted as they are."""
    monkeypatch.setattr(rules, "PLACE", place)
    docs = documents(spark).select("doc_id", "text", "n_words").unionByName(
        given(spark, "documents").limit(60).select("doc_id", "text", F.lit("x").alias("n_words")))
    if place < 23:
        docs = docs.where("length(text) < 20000 or text is null")
    found = rules.measured(docs, BASE)
    for r in found.collect():
        assert tuple(r[m] for m in BASE) == measures(r.text), (r.text or "")[:80]


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    """All windows hash alike, so only their words tell them apart."""
    monkeypatch.setattr(rules.F, "xxhash64", lambda *parts: F.lit(0).cast("long"))
    texts = ["a b c d a b c", "a b c d e f g", "x x x x", "a b a b a b", "a b c x b c a b c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.n_repeat_words for r in rules.measured(df, ["n_repeat_words"]).collect()] == [measures(t)[4] for t in texts]


def verdict(text):
    words, chars, symbols, dup, repeat = measures(text)
    text = text or ""
    base = words < 50 or 100 * repeat > 50 * words
    lines = sum(1 for x in text.split("\n") if WORD.search(x))
    lettered = sum(1 for w in WORD.findall(text) if re.search("[A-Za-z\x80-\U0010ffff]", w))
    bad = (10 * symbols > words or 2 * dup > lines or chars < 2 * words or chars > 20 * words
           or len(re.findall("[A-Z]", text)) > len(re.findall("[a-z]", text)) or 10 * lettered < 7 * words)
    return base, not base and not bad


def test_verdicts(spark):
    for docs in (documents(spark), given(spark, "documents")):
        found = rules.base_and_verdict(docs).collect()
        assert len(found) == docs.count()
        for r in found:
            assert (r.base_failed, r.kept) == verdict(r.text)
    assert rules.base_and_verdict(empty(spark)).collect() == []


def test_equals_sql(spark):
    found = queries.op10_quality_rules(spark, SF)
    assert difference(spark_result(found), duck_result(connect(SF), oracles.ORACLES["op10_quality_rules"])) is None


def test_every_order_keeps_the_same(spark):
    docs = given(spark, "documents")
    every = (*rules.BASE_RULES, *rules.RULES)
    kept = [sorted((r.doc_id, r.kept) for r in rules.cascade(docs, order).collect()) for order in (every, every[::-1])]
    assert kept[0] == kept[1] == sorted((r.doc_id, r.kept) for r in rules.quality_rules(docs).collect())


def test_order_puts_cheap_rejections_first(spark):
    slow = rules.Rule("slow", ("n_repeat_words",), lambda c: c["n_repeat_words"] < 0)
    good = rules.Rule("good", ("n_symbols",), lambda c: c["n_symbols"] >= 0)
    docs = given(spark, "documents")
    assert [r.name for r in rules.cheapest_first(docs, (slow, good))] == ["good", "slow"]
    assert rules.cheapest_first(empty(spark), (slow, good)) == [slow, good]


def test_the_order_is_the_same_each_time_and_counts_what_is_known(spark):
    docs = given(spark, "documents")
    orders = [[r.name for r in rules.cheapest_first(docs)] for _ in range(3)]
    assert orders[0] == orders[1] == orders[2] and sorted(orders[0]) == sorted(r.name for r in rules.RULES)
    # Two rules that reject the same: the one whose measure is there already comes first.
    dear = rules.Rule("a dear one", ("n_repeat_words",), lambda c: c["n_repeat_words"] >= 0)
    cheap = rules.Rule("cheap", ("n_symbols",), lambda c: c["n_symbols"] >= 0)
    assert [r.name for r in rules.cheapest_first(docs, (dear, cheap))] == ["cheap", "a dear one"]
    assert [r.name for r in rules.cheapest_first(docs, (dear, cheap), known=("n_repeat_words",))] == ["a dear one", "cheap"]


def test_texts_of_colliding_windows_take_about_linear_time(spark, monkeypatch):
    monkeypatch.setattr(rules, "PLACE", 8)
    text = " ".join(f"w{i % 9000}" for i in range(30_000))
    start = time.time()
    assert rules.measured(spark.createDataFrame([(text,)], "text string"), ["n_repeat_words"]).first().n_repeat_words == 30_000
    assert time.time() - start < 30


def test_names_that_the_rules_use_themselves(spark):
    docs = given(spark, "documents").limit(50).withColumn("__llm_body", F.lit("own")).withColumn("__llm_words", F.col("doc_id"))
    for found in (rules.base_and_verdict(docs), rules.cascade(docs, rules.RULES), rules.measured(docs, ["n_words"])):
        assert {(r["__llm_body"], r["__llm_words"] == r.doc_id) for r in found.collect()} == {("own", True)}


def test_later_measures_are_not_taken_for_rejected_texts(spark):
    """The second rule would fail on texts that the first rejects."""
    first = rules.Rule("first", ("n_words",), lambda c: c["n_words"] < 3)
    second = rules.Rule("second", ("n_symbols", "n_words"), lambda c: F.when(c["n_symbols"].isNull(), F.lit(False)).otherwise(
        F.when(c["n_words"] < 3, F.raise_error(F.lit("seen"))).otherwise(False)))
    df = spark.createDataFrame([("a",), ("a b c d",), (None,)], "text string")
    assert [r.kept for r in rules.cascade(df, (first, second)).collect()] == [False, True, False]


def test_only_dataframe_operations(spark):
    assert not python_nodes(queries.op10_quality_rules(spark, SF))
