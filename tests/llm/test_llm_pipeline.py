import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_llm_mixing import targets
from test_llm_simhash import naive
from text_cases import SF, components, documents, empty, given, size_of, without_shared_lines

import __spark_entry__ as driver
import corpus_pipeline
from lakeassay.llm import quality


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = given(spark, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF))
        out.append(docs)
    return out


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_are_registered(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in driver.queries() if name.startswith("op")}


def test_quality_stage(spark, outputs):
    model = quality.train(given(spark, "documents"), given(spark, "labels"))
    kept = [r for r in given(spark, "documents").collect() if model.scores(np.array([quality.statistics_of(r.text.encode())]))[0] >= 0.7]
    assert rows(outputs[0]) == Counter(tuple(r) for r in kept)
    good = {r.doc_id for r in given(spark, "labels").where("quality = 1").collect()}
    assert len(good & {r.doc_id for r in kept}) >= 0.97 * len(good)


def test_line_stage(outputs):
    before = outputs[0].collect()
    wanted = without_shared_lines([r.text for r in before], 10)
    assert rows(outputs[1]) == Counter((r.doc_id, w[2], *tuple(r)[2:]) for r, w in zip(before, wanted))


def test_near_duplicate_stage(outputs):
    before = {r.doc_id: r for r in outputs[1].collect()}
    prints = {k: naive(r.text) for k, r in before.items()}
    roots = components(prints, lambda a, b: bin(a ^ b).count("1") <= 4)
    assert rows(outputs[2]) == Counter(tuple(before[k]) for k in set(roots.values()))


def test_mixing_stage(outputs):
    before = {r.doc_id: r for r in outputs[2].collect()}
    after = rows(outputs[3])
    sizes, taken, most = Counter(), Counter(), Counter()
    for r in before.values():
        sizes[r.source] += size_of(r.text)
        most[r.source] = max(most[r.source], size_of(r.text))
    for r, n in after.items():
        assert tuple(before[r[0]]) == r and n <= 2
        taken[r[3]] += n * size_of(r[1])
    wanted = targets(sizes)
    assert all(abs(taken[s] - wanted[s]) <= most[s] / 2 + 1e-6 for s in sizes)


def test_tokenizing_stage(outputs):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    wanted = Counter()
    for r, n in rows(outputs[3]).items():
        ids = library.encode_ordinary(r[1])
        wanted[r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest()] += n
    assert rows(outputs[4]) == wanted


def test_run_applies_all_stages(spark, outputs):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(outputs[-1])


def test_stages_stand_odd_documents(spark):
    for docs in (documents(spark), empty(spark)):
        names = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.staged(stage(spark, docs, SF))
            assert docs.columns == names
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
