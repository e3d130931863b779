"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lakeassay.llm.common import bounded_broadcast

#: Pre-tokens, and chunks between spaces, whose ids a worker remembers at a time.
MEMORY = 1 << 20
#: A vocabulary of more bytes than this is not broadcast; the public ones have a few megabytes.
VOCABULARY_LIMIT = 1 << 28
GOLDEN, WORD64 = 0x9E3779B97F4A7C15, (1 << 64) - 1


def _displaced(digest: int, shift: int, size: int) -> int:
    return ((((digest ^ (shift * GOLDEN & WORD64)) * GOLDEN) & WORD64) >> 29) % size


@dataclass(frozen=True)
class Vocabulary:
    """The tokens of a rank file by rank, and a minimal perfect hash of them: every slot holds one rank."""

    tokens: list[bytes]
    shifts: list[int]
    slots: list[int]

    def whole(self, piece: bytes) -> int:
        """The rank of a piece that is a token, else -1.

        A piece's bucket either names its slot or displaces its digest to it; the token there decides.
        """
        if not self.tokens:
            return -1
        digest = xxhash.xxh3_64_intdigest(piece)
        shift = self.shifts[(digest >> 32) % len(self.shifts)]
        rank = self.slots[-shift - 1 if shift < 0 else _displaced(digest, shift, len(self.slots))]
        return rank if self.tokens[rank] == piece else -1


def read_vocabulary(path: str) -> Vocabulary:
    """Read a rank file (a base64 token and its rank on each line) and build the hash.

    There are as many buckets as tokens. Those of several tokens are placed from the largest down: each tries
    shifts until all its tokens fall on free slots. Buckets of one token then name the slots that are left.
    """
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in (x.split() for x in lines if x.strip()))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"the ranks in {path} are not 0, 1, 2 and so on")
    tokens = [token for _, token in ranked]
    size = len(tokens)
    buckets: dict[int, list[tuple[int, int]]] = {}
    for rank, token in enumerate(tokens):
        digest = xxhash.xxh3_64_intdigest(token)
        buckets.setdefault((digest >> 32) % size, []).append((digest, rank))
    shifts, slots = [0] * size, [-1] * size
    singles = []
    for bucket, members in sorted(buckets.items(), key=lambda x: -len(x[1])):
        if len(members) == 1:
            singles.append((bucket, members[0][1]))
            continue
        for shift in range(1 << 20):
            at = {_displaced(digest, shift, size) for digest, _ in members}
            if len(at) == len(members) and all(slots[x] < 0 for x in at):
                break
        else:
            raise ValueError("two tokens have the same digest")
        shifts[bucket] = shift
        for digest, rank in members:
            slots[_displaced(digest, shift, size)] = rank
    for (bucket, rank), slot in zip(singles, [x for x, rank in enumerate(slots) if rank < 0]):
        shifts[bucket], slots[slot] = -slot - 1, rank
    return Vocabulary(tokens, shifts, slots)


def merged(piece: bytes, rank_of) -> list[int]:
    """The ranks that a piece's bytes merge into: always the pair of lowest rank, leftmost first.

    Bytes are a linked list of parts. Pairs wait in a heap as one number of rank, start and end; a pair whose
    parts have changed since it was put there is skipped.
    """
    n = len(piece)
    shift = n.bit_length() + 1
    mask = (1 << shift) - 1
    after, before = list(range(1, n + 1)), list(range(-1, n))
    pair_end = list(range(2, n + 2))  # where the pair that starts here ends now
    heap = [(r << shift | i) << shift | i + 2 for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
    heapify(heap)
    part_rank: list[int | None] = [None] * n  # of merged parts, by start
    while heap:
        pair = heappop(heap)
        left, end = pair >> shift & mask, pair & mask
        if pair_end[left] != end:
            continue
        part_rank[left] = pair >> 2 * shift
        pair_end[after[left]] = 0
        after[left] = end
        if end < n:
            before[end] = left
            pair_end[left] = far = after[end]
            if (r := rank_of(piece[left:far])) is not None:
                heappush(heap, (r << shift | left) << shift | far)
        else:
            pair_end[left] = 0
        if (first := before[left]) >= 0:
            pair_end[first] = end
            if (r := rank_of(piece[first:end])) is not None:
                heappush(heap, (r << shift | first) << shift | end)
    ids, at = [], 0
    while at < n:
        rank = part_rank[at]
        if rank is None:
            rank = rank_of(piece[at : at + 1])
        if rank is None:
            raise ValueError(f"byte {piece[at]} is not in the vocabulary")
        ids.append(rank)
        at = after[at]
    return ids


class Pieces(dict):
    """The ids of each pre-token, four bytes each: by the perfect hash if it is a token, else by merging its bytes."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.whole = vocabulary.whole
        # Merging asks for the ranks of parts; only what is no token as a whole comes to that.
        self.rank_of = {token: rank for rank, token in enumerate(vocabulary.tokens)}.get
        self.written = [rank.to_bytes(4, "little") for rank in range(len(vocabulary.tokens))]

    def __missing__(self, piece: str) -> bytes:
        octets = piece.encode()
        rank = self.whole(octets)
        self[piece] = ids = self.written[rank] if rank >= 0 else b"".join([self.written[r] for r in merged(octets, self.rank_of)])
        return ids


class Chunks(dict):
    """The ids of a space and what follows up to the next one; None if white space touches a space.

    A pre-token never reaches over the space that starts the next one, unless white space runs on there.
    """

    def __init__(self, pieces: Pieces, split):
        super().__init__()
        self.pieces, self.split = pieces, split

    def __missing__(self, chunk: str) -> bytes | None:
        ids = None
        if chunk and not chunk[0].isspace() and not chunk[-1].isspace():
            found = self.split(" " + chunk)
            ids = self.pieces[found[0]] if len(found) == 1 else b"".join([self.pieces[p] for p in found])
        self[chunk] = ids
        return ids


class Encoder:
    """Encodes texts one after another, remembering what it has met; and decodes."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        # In the pattern, white space is Unicode's property of that name.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                   .replace(r"\S", r"\P{White_Space}")).findall
        self.pieces = Pieces(vocabulary)
        self.chunks = Chunks(self.pieces, self.split)
        self.decoder = Decoder(vocabulary.tokens)

    def encode(self, text: str | None) -> np.ndarray:
        for memory in (self.pieces, self.chunks):
            if len(memory) > MEMORY:
                memory.clear()
        text = text or ""
        start, *rest = text.split(" ")
        tail = b""
        if rest:
            found = list(map(self.chunks.__getitem__, rest))
            if not start or start[-1].isspace() or None in found:
                start = text
            else:
                tail = b"".join(found)
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(start))) + tail, "<u4")


class Decoder:
    """The bytes that ids stand for, looked up in one buffer of all tokens."""

    #: Ids looked up at a time.
    STEP = 1 << 16

    def __init__(self, tokens: list[bytes]):
        self.octets = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < len(self.sizes):
            raise ValueError(f"an id of {ids.min()} to {ids.max()} is not in the vocabulary")
        out = []
        for i in range(0, len(ids), self.STEP):
            some = ids[i : i + self.STEP]
            sizes = self.sizes[some]
            # Where each byte is: its token's start, and how far into the token it is.
            begins = np.cumsum(sizes) - sizes
            out.append(self.octets[np.repeat(self.starts[some] - begins, sizes) + np.arange(int(sizes.sum()))].tobytes())
        return b"".join(out)


def _shared(vocabulary: Vocabulary, pattern: str):
    """A broadcast of plain values, to which each worker process adds the encoder it makes of them."""
    size = sum(map(len, vocabulary.tokens)) + 100 * len(vocabulary.tokens)
    value = {"vocabulary": (vocabulary.tokens, vocabulary.shifts, vocabulary.slots), "pattern": pattern}
    return bounded_broadcast(SparkSession.active(), value, size, VOCABULARY_LIMIT, "the vocabulary")


def _encoder(shared) -> Encoder:
    """The encoder of this worker process: later batches and tasks find what earlier ones met."""
    held = shared.value
    if "encoder" not in held:
        held["encoder"] = Encoder(Vocabulary(*held["vocabulary"]), held["pattern"])
    return held["encoder"]


def encode(text: Column, vocabulary: Vocabulary, pattern: str) -> Column:
    """The token ids of a text column, as array<int>; a null or empty text has none.

    Each match of `pattern` is encoded by itself, without special tokens. The vocabulary, a file of fixed size, is broadcast.
    A worker keeps one encoder, with up to MEMORY pre-tokens and as many chunks between spaces, for all its
    batches. Rows are independent: repeated rows give equal ids, an empty table none; a very long text is held whole.
    """
    shared = _shared(vocabulary, pattern)

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            encoder = _encoder(shared)
            yield pd.Series([encoder.encode(t).astype(np.int32) for t in texts], dtype=object)

    return encoded(text)


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes that token ids stand for; null ids give null, no ids no bytes, unknown ids an error."""

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary.tokens)
        for rows in batches:
            yield pd.Series([None if r is None else decoder.decode(np.asarray(r, np.int64)) for r in rows], dtype=object)

    return decoded(ids)


def round_trip(text: Column, vocabulary: Vocabulary, pattern: str) -> Column:
    """Encode, then decode the ids: a struct of n_tokens, ids_sha256 (little-endian 32-bit ids) and decoded_sha256.

    Both steps run in one pass over the text, and only the digests leave it. Null, empty, repeated and very long texts are as in
    `encode`; no ids and no bytes have the digests of nothing.
    """
    shared = _shared(vocabulary, pattern)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            encoder, rows = _encoder(shared), []
            for text in texts:
                ids = encoder.encode(text)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(encoder.decoder.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
