import base64
import hashlib
import random
import uuid

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from text_cases import LONG, SF, TEXTS, documents, empty, given

from lakeassay.llm import bpe, queries

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_hash_is_minimal_and_perfect(vocabulary):
    assert sorted(vocabulary.slots) == list(range(len(vocabulary.tokens)))
    assert all(vocabulary.whole(token) == rank for rank, token in enumerate(vocabulary.tokens))
    assert vocabulary.whole(b" no such token in there") == -1 and vocabulary.whole(b"") == -1


def test_merging_finds_the_vocabulary_s_own_tokens(vocabulary):
    ranks = {t: r for r, t in enumerate(vocabulary.tokens)}
    for token in random.Random(1).sample(vocabulary.tokens, 500):
        assert b"".join(vocabulary.tokens[i] for i in bpe.merged(token, ranks.get)) == token
    with pytest.raises(ValueError):
        bpe.merged(b"ab", {b"a": 0}.get)


def test_equals_the_library(vocabulary, library):
    encoder, dice = bpe.Encoder(vocabulary, PATTERN), random.Random(3)
    texts = [t or "" for t in TEXTS] + ["<|endoftext|>", "don't I'LL  it's", "a" * 3000, "😀👍🏽" * 20, "x\n \ny  z\r\n\t", "é" * 500, LONG]
    texts += ["".join(dice.choice(" \n\ta'sé1.!日 　\x1c\x85B☃") for _ in range(dice.randint(0, 30))) for _ in range(5000)]
    for text in texts:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), repr(text[:80])


def test_memory_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 10)
    encoder = bpe.Encoder(vocabulary, PATTERN)
    for i in range(50):
        text = f"some text {i} with wörds{i} and more{i}"
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_decoding_in_steps(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe.Decoder, "STEP", 3)
    decoder = bpe.Decoder(vocabulary.tokens)
    for text in ("", "a", "some wörds, 日本語 and more\n" * 5):
        assert decoder.decode(np.array(library.encode_ordinary(text), np.int64)).decode() == text
    for ids in ([len(vocabulary.tokens)], [-1]):
        with pytest.raises(ValueError):
            decoder.decode(np.array(ids))


def test_one_encoder_serves_all_batches_and_tasks_of_a_worker(spark, vocabulary, library, tmp_path, monkeypatch, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="100")
    made = bpe.Encoder.__init__

    def counted(self, *args):
        (tmp_path / uuid.uuid4().hex).touch()
        made(self, *args)

    monkeypatch.setattr(bpe.Encoder, "__init__", counted)
    docs = spark.range(0, 2000, 1, 2).select(F.concat(F.lit("text number "), "id").alias("text"))
    rows = docs.coalesce(1).select("text", bpe.round_trip(F.col("text"), vocabulary, PATTERN).alias("r")).collect()
    assert all(tuple(r.r) == digests(r.text, library) for r in rows) and len(rows) == 2000
    assert len(list(tmp_path.iterdir())) == 1


def digests(text, library):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_given_documents(spark, library):
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    assert {tuple(r) for r in queries.op9_byte_bpe(spark, SF).collect()} == {(k, *digests(t, library)) for k, t in texts.items()}


def test_round_trip_of_odd_documents(spark, vocabulary, library):
    docs = documents(spark)
    both = docs.withColumn("ids", bpe.encode(F.col("text"), vocabulary, PATTERN)).withColumn("back", bpe.decode(F.col("ids"), vocabulary))
    for r in both.collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.back) == (r.text or "").encode()
    trips = docs.select("text", bpe.round_trip(F.col("text"), vocabulary, PATTERN).alias("r")).collect()
    assert all(tuple(r.r) == digests(r.text, library) for r in trips)
    assert empty(spark).select(bpe.encode(F.col("text"), vocabulary, PATTERN)).collect() == []
    assert spark.sql("select cast(null as array<int>) ids").select(bpe.decode(F.col("ids"), vocabulary).alias("b")).first().b is None
