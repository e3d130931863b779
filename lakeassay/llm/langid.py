"""Language identification by unigrams over a fixed vocabulary, summed over all segmentations of each word."""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeassay.llm.common import bounded_broadcast, held_out

#: What a text has no language by.
UNDETERMINED = "und"
#: A word is a run of letters and the marks on them, as vowel signs and accents that are characters of their own.
WORDS = regex.compile(r"[\p{L}\p{M}]++")
START = "▁"  # how the vocabulary marks the start of a word
#: Distinct words that a worker remembers, in rows of up to ROW_BYTES together, and characters of text that it works on at a time.
MEMORY, ROW_BYTES, CHUNK = 1 << 20, 1 << 27, 1 << 21
#: Characters, or states of the forward sums, that are worked on at a time.
CELLS, BLOCK = 1 << 21, 1 << 12
#: A model of L languages takes 8 * L * pieces bytes; more than this is an error.
MODEL_LIMIT = 1 << 28


@dataclass(frozen=True)
class Pieces:
    """The pieces of a vocabulary by id (None: not usable in text), and the ids of single bytes."""

    texts: list[str | None]
    byte_ids: list[int]


def read_pieces(model: bytes) -> Pieces:
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    other = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)
    return Pieces([None if other(i) else sp.id_to_piece(i) for i in range(sp.vocab_size())],
                  [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])


def _points(words: list[str], n: int) -> np.ndarray:
    """The code points of words of n characters, a row for each."""
    return np.array(words, f"<U{n}").view(np.uint32).reshape(len(words), n).astype(np.uint64)


class PieceIndex:
    """Finds the ids of many substrings at once, by 64-bit polynomial hashes in a table.

    No two pieces share a hash (that is checked). Hashes whose slot is taken are kept apart, sorted.
    """

    BASE, SPREAD, BITS = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), 18

    def __init__(self, texts: list[str | None]):
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, text in enumerate(texts):
            if text:
                by_length[len(text)].append(i)
        self.longest = max(by_length, default=1)
        self.keys, self.ids = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
        hashes, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        for n, some in by_length.items():
            hashes.append(self.prefixes(_points([texts[i] for i in some], n))[:, n])
            ids.append(np.array(some, np.int32))
        hashes, ids = np.concatenate(hashes), np.concatenate(ids)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces have the same hash")
        slots = self.slot(hashes)
        self.keys[slots], self.ids[slots] = hashes, ids
        apart = np.flatnonzero(self.ids[slots] != ids)
        apart = apart[np.argsort(hashes[apart])]
        self.more_keys, self.more_ids = hashes[apart], ids[apart]
        self.powers = np.cumprod(np.concatenate(([1], np.full(self.longest, self.BASE))).astype(np.uint64))

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * self.SPREAD) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def prefixes(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros((len(points), points.shape[1] + 1), np.uint64)
        for j in range(points.shape[1]):
            out[:, j + 1] = out[:, j] * self.BASE + points[:, j] + np.uint64(1)
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slots = self.slot(hashes)
        ids = np.where(self.keys[slots] == hashes, self.ids[slots], np.int32(-1))
        if len(self.more_keys):
            # Only what fell on a slot that others share can be among these.
            at = np.flatnonzero((ids < 0).ravel() & (self.ids[slots] >= 0).ravel())
            apart = hashes.ravel()[at]
            place = np.minimum(np.searchsorted(self.more_keys, apart), len(self.more_keys) - 1)
            ids.ravel()[at] = np.where(self.more_keys[place] == apart, self.more_ids[place], np.int32(-1))
        return ids

    def substrings(self, points: np.ndarray) -> list[np.ndarray]:
        """Ids, -1 for none, of all substrings of words of one length: a matrix of words and starts for each length from 1 on."""
        hashes = self.prefixes(points)
        return [self.find(hashes[:, m:] - hashes[:, :-m] * self.powers[m]) for m in range(1, min(self.longest, points.shape[1]) + 1)]


def letter_words(text: str | None) -> list[str]:
    """The words of a text, in lower case and composed as far as Unicode has composed characters. Some may be marks only."""
    return WORDS.findall(unicodedata.normalize("NFC", (text or "").lower()))


def spelled(word: str) -> str | None:
    """A word as the vocabulary writes it; None if it has no letter."""
    return START + word if any(map(str.isalpha, word)) else None


def _piece_counts(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    """Rows of lang, text to rows of lang, piece, amount, summed within the task."""
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = sp.vocab_size()
    totals: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(size, np.int64))
    words: dict[str, Counter] = defaultdict(Counter)

    def flush(lang: str) -> None:
        # A word stands alone here, so the library adds the mark of its start itself.
        met = [(w, n) for w, n in words.pop(lang).items() if any(map(str.isalpha, w))]
        for (_, n), ids in zip(met, sp.encode([w for w, _ in met], num_threads=1)):
            np.add.at(totals[lang], ids, n)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words[lang].update(letter_words(text.as_py()))
            if sum(map(len, words.values())) > MEMORY:
                for full in list(words):
                    flush(full)
    for lang in list(words):
        flush(lang)
    for lang, counts in totals.items():
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(counts[ids])],
                                         names=["lang", "piece", "amount"])


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities of pieces (rows) in languages (columns)."""

    languages: list[str]
    log_p: np.ndarray


def train(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
          smoothing: float = 0.1) -> LanguageModel:
    """Piece probabilities of each language, from all texts with a language that are not held out.

    Words are cut by the vocabulary's own segmentation and pieces counted in Spark, summed within each task
    first; the driver gets at most one number per language and piece. `smoothing` is added to every count.
    """
    with open(path, "rb") as file:
        model = file.read()
    pieces = read_pieces(model)
    learn = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull() & ~held_out(F.col(f"`{id_column}`")))
    counted = (learn.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
               .mapInArrow(lambda batches: _piece_counts(batches, model), "lang string, piece long, amount long")
               .groupBy("lang", "piece").agg(F.sum("amount").alias("amount")))
    # Batches, not rows: a model of many languages arrives as it is sent.
    languages = sorted(r.lang for r in learn.select(F.col(f"`{lang}`").cast("string").alias("lang")).distinct()
                       .limit(MODEL_LIMIT // (8 * len(pieces.texts)) + 1).collect())
    if 8 * len(languages) * len(pieces.texts) > MODEL_LIMIT:
        raise ValueError(f"more languages than a model of {MODEL_LIMIT} bytes holds")
    counts = np.full((len(pieces.texts), max(1, len(languages))), smoothing)
    column = {name: i for i, name in enumerate(languages)}
    found = counted.toArrow()
    np.add.at(counts, (found["piece"].to_numpy(), np.array([column[x] for x in found["lang"].to_pylist()], np.int64)),
              found["amount"].to_numpy())
    return LanguageModel(languages, np.log(counts / counts.sum(axis=0)))


class Scorer:
    """Log probabilities of words in every language, over all their segmentations."""

    #: Probabilities of words are carried times this to the power of their length, to stay within range.
    SCALE = 256.0

    def __init__(self, pieces: Pieces, model: LanguageModel):
        self.pieces, self.model, self.index = pieces, model, PieceIndex(pieces.texts)
        lengths = np.array([len(t or "") for t in pieces.texts])
        self.scaled = np.exp(model.log_p + lengths[:, None] * np.log(self.SCALE))
        self.row: dict[str, int] = {}
        self.rows, self.used = np.zeros((0, len(model.languages))), 0

    def learn(self, words: set[str]) -> None:
        """Score words not met yet. A word without a letter has row -1."""
        new = [w for w in words if w not in self.row]
        languages = self.rows.shape[1]
        if len(self.row) + len(new) > min(MEMORY, ROW_BYTES // (8 * max(1, languages))):
            self.row, self.used, new = {}, 0, list(words)
        by_length: dict[int, list[str]] = defaultdict(list)
        for w in new:
            if spelled(w) is None:
                self.row[w] = -1
            else:
                by_length[len(w) + 1].append(w)
        need = self.used + sum(map(len, by_length.values()))
        if need > len(self.rows):
            more = np.zeros((max(need, 2 * len(self.rows)) - len(self.rows), languages))
            self.rows = np.concatenate((self.rows, more))
        for n, group in by_length.items():
            step = max(1, CELLS // max(n, (self.index.longest + 1) * max(1, languages)))
            for k in range(0, len(group), step):
                some = group[k : k + step]
                self.rows[self.used : self.used + len(some)] = self.forward([START + w for w in some])
                self.row.update(zip(some, range(self.used, self.used + len(some))))
                self.used += len(some)

    def forward(self, words: list[str]) -> np.ndarray:
        """The log probability of words of one length: the sum over all ways to write them as pieces.

        The state after j characters sums the ways to write them; it needs only as many states before as the longest
        piece has characters, whatever the length of the word. A character that is no piece is written as its bytes, so every
        word has a way. States are brought back to a middle range from time to time.
        """
        n, longest = len(words[0]), self.index.longest
        points, kept = _points(words, n), longest + 1
        state = np.zeros((kept, len(words), self.rows.shape[1]))
        state[0] = 1.0
        log = np.zeros(state.shape[1:])
        for start in range(0, n, BLOCK):
            base, end = max(0, start - longest), min(n, start + BLOCK)
            ids = self.index.substrings(points[:, base:end])
            for j in range(start + 1, end + 1):
                now = state[j % kept]
                now[:] = 0.0
                for m in range(1, min(longest, j) + 1):
                    found = ids[m - 1][:, j - m - base]
                    at = np.flatnonzero(found >= 0)
                    if len(at):
                        now[at] += state[(j - m) % kept, at] * self.scaled[found[at]]
                spelt = np.flatnonzero(ids[0][:, j - 1 - base] < 0)
                for i in spelt:
                    octets = [self.pieces.byte_ids[b] for b in words[i][j - 1].encode("utf-8", "surrogatepass")]
                    now[i] += state[(j - 1) % kept, i] * np.exp(self.model.log_p[octets].sum(axis=0)) * self.SCALE
                # Bytes make a state drop fast, pieces slowly.
                low = np.arange(len(words)) if j % 32 == 0 else spelt
                if len(low):
                    top = np.maximum(state[:, low].max(axis=0), np.finfo(float).tiny)
                    state[:, low] /= top
                    log[low] += np.log(top)
        return log + np.log(np.maximum(state[n % kept], np.finfo(float).tiny)) - n * np.log(self.SCALE)

    def predict(self, texts: list[list[str]]) -> list[tuple[str, float]]:
        out = []
        for words in texts:
            at = np.fromiter(map(self.row.__getitem__, words), np.int64, len(words))
            at = at[at >= 0]
            if not len(at) or not self.model.languages:
                out.append((UNDETERMINED, 0.0))
                continue
            total = self.rows[at].sum(axis=0)
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def predict(docs: DataFrame, model: LanguageModel, path: str, text: str = "text", lang_column: str = "lang_pred",
            score_column: str = "score") -> DataFrame:
    """The documents with their most probable language and its posterior under equal priors.

    Only the text is looked at, all of it, word by word whatever their length: texts without spaces too. A text that is
    null or has no letter, or a model without languages, gives "und" and 0. Letters count in lower case, with their marks and in
    composed form; ties go to the first language in order. The added columns replace those of the same name. A worker keeps
    one scorer for all its batches, with the words it has met up to a bound of words and bytes.
    """
    with open(path, "rb") as file:
        vocabulary = file.read()
    # Plain values: a broadcast is read where the library may not be installed.
    shared = bounded_broadcast(docs.sparkSession, {"model": (model.languages, model.log_p), "pieces": vocabulary}, model.log_p.nbytes, MODEL_LIMIT,
                               "the language model")

    @F.pandas_udf("lang string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = shared.value  # of this worker process: it keeps what is added to it
        if "scorer" not in held:
            held["scorer"] = Scorer(read_pieces(held["pieces"]), LanguageModel(*held["model"]))
        scorer = held["scorer"]
        for texts in batches:
            out, waiting, size = [], [], 0
            for t in texts:
                waiting.append(letter_words(t))
                size += len(t or "")
                if size > CHUNK:
                    scorer.learn(set().union(*waiting))
                    out += scorer.predict(waiting)
                    waiting, size = [], 0
            scorer.learn(set().union(*waiting))
            yield pd.DataFrame(out + scorer.predict(waiting), columns=["lang", "score"])

    added = (lang_column.lower(), score_column.lower())
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    found = docs.withColumn("__llm_found", identified(F.col(f"`{text}`")))
    return found.select(*kept, F.col("__llm_found.lang").alias(lang_column), F.col("__llm_found.score").alias(score_column))
