import hashlib

import pytest
from compare import connect, difference, duck_result, spark_result
from text_cases import SF, documents, empty, given, without_shared_lines

from lakeassay.llm import linededup, oracles, queries


@pytest.mark.parametrize("least", [1, 2, 3, 10])
def test_equals_plain_python(spark, least):
    docs = documents(spark, 3)
    rows = docs.collect()
    wanted = without_shared_lines([r.text for r in rows], least)
    found = linededup.drop_shared_lines(docs, min_documents=least)
    assert sorted(found.columns) == sorted({*docs.columns, "n_lines", "n_dropped"})
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()], key=key) == sorted(
        [(r.doc_id, *w) for r, w in zip(rows, wanted)], key=key)


def test_given_documents_equal_plain_python_and_sql(spark):
    rows = given(spark, "documents").collect()
    wanted = {(r.doc_id, a, b, hashlib.sha256(t.encode()).hexdigest()) for r, (a, b, t) in zip(
        rows, without_shared_lines([r.text for r in rows], 10))}
    found = queries.op2_line_dedup(spark, SF)
    assert {tuple(r) for r in found.collect()} == wanted
    assert difference(spark_result(found), duck_result(connect(SF), oracles.ORACLES["op2_line_dedup"])) is None


def test_empty_table(spark):
    assert linededup.drop_shared_lines(empty(spark)).collect() == []


def test_a_line_counts_once_for_each_document(spark):
    docs = spark.createDataFrame([(1, "a\na\nA\nb"), (2, "a\nc")], "doc_id long, text string")
    found = {r.doc_id: r.text for r in linededup.drop_shared_lines(docs, min_documents=3).collect()}
    assert found == {1: "a\na\nA\nb", 2: "a\nc"}
    found = {r.doc_id: (r.text, r.n_dropped) for r in linededup.drop_shared_lines(docs, min_documents=2).collect()}
    assert found == {1: ("b", 3), 2: ("c", 1)}


def test_names_that_the_operator_uses_itself(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, "x"), (2, "a\nc", 6, "y")], "doc_id long, __llm_text string, __llm_k0 long, __llm_new string")
    found = linededup.drop_shared_lines(docs, text="__llm_text", min_documents=2)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted(map(tuple, found.collect())) == [(1, "b", 5, "x", 2, 1), (2, "c", 6, "y", 2, 1)]
