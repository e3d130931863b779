"""Near-duplicate documents by SimHash: pigeonhole blocks find all fingerprints within a bit distance."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeassay.llm.common import KEYS, hashable, row_key, shielded, staged

SEED = 42
BITS = 64
#: Shingles whose bits are counted at a time.
CHUNK = 1 << 15
#: Fingerprints of a set of blocks that make it a dense group, and how many of them then stand for the group.
DENSE, PIVOTS = 256, 32
#: Edges that are worth a task of their own.
EDGES_PER_TASK = 1 << 17


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    """The SimHash of a UTF-8 text as a signed 64-bit number; 0 if it has no words."""
    words = (text or b"").lower().split()  # on bytes, both know ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        votes, total = _votes([xxhash.xxh64_intdigest(joined, SEED)]), 1
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        total = len(words) - shingle + 1
        starts = np.concatenate(([0], gaps[: total - 1] + 1))
        ends = np.concatenate((gaps[shingle - 1 :], [len(joined)]))
        votes, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
        for at in range(0, total, CHUNK):
            pairs = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist())
            votes += _votes([digest(joined[a:b], SEED) for a, b in pairs])
    bits = np.packbits(2 * votes > total, bitorder="little")
    return int(bits.view(np.int64)[0])


def _votes(hashes: list[int]) -> np.ndarray:
    octets = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """The SimHash column of a text column."""

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return simhash(text.cast("binary"))


def as_hex(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


def block_scheme(distinct: int, distance: int, per_block: int = 64) -> tuple[list[int], list[tuple[int, ...]]]:
    """How to cut fingerprints into blocks, and which sets of blocks to join on.

    Of m blocks, a pair within the distance agrees on at least m - distance. Joining on every set of that
    many blocks therefore finds all pairs, whatever m is; a larger m gives longer keys and more of them.
    The smallest m whose keys leave `per_block` evenly spread fingerprints to a key is taken.
    """
    for chosen in range(1, BITS - distance + 1):
        m = chosen + distance
        edges = [BITS * i // m for i in range(m + 1)]
        masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
        if distinct <= per_block << (BITS * chosen // m) or chosen == 5 or m == BITS:
            break
    return masks, list(combinations(range(m), chosen))


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >> (BITS - 1) else number


def _keyed(fingerprints: DataFrame, masks: list[int], sets: list[tuple[int, ...]]) -> DataFrame:
    """The rows once for each set of blocks, with the set as `blocks` and `upto`, and the bits of those blocks as `value`."""
    return fingerprints.select("*", F.explode(F.array(*[
        F.struct(
            F.lit(sum(1 << b for b in blocks)).alias("blocks"),
            F.lit((2 << blocks[-1]) - 1).alias("upto"),
            F.col("fp").bitwiseAND(F.lit(_signed(sum(masks[b] for b in blocks)))).alias("value"))
        for blocks in sets])).alias("key")).select(*fingerprints.columns, "key.*")


def links(fingerprints: DataFrame, distance: int, distinct: int) -> DataFrame:
    """All pairs `src` > `dst` of the distinct values of `fp` that differ in 1 to `distance` bits, each once.

    A group of n fingerprints that are all close has n * n / 2 of them; `linked_components` does without.
    """
    masks, sets = block_scheme(distinct, distance)
    keyed = _keyed(fingerprints.select("fp"), masks, sets)
    a, b = keyed.alias("a"), keyed.select("fp", "blocks", "value").alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    agree = sum((F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, 1 << i).otherwise(0) for i, m in enumerate(masks)), F.lit(0))
    # A pair that agrees on more blocks meets under several keys; it counts under the first of them.
    first = agree.bitwiseAND(F.col("a.upto")) == F.col("a.blocks")
    close = (F.col("a.fp") > F.col("b.fp")) & (F.bit_count(differ) <= distance) & first
    same = (F.col("a.blocks") == F.col("b.blocks")) & (F.col("a.value") == F.col("b.value"))
    return a.join(b, same & close).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))


def outward_links(labelled: DataFrame, distance: int, distinct: int) -> DataFrame:
    """For each `fp` that has close fingerprints of another `label`: its `label` and the smallest such label, `other`.

    Pairs meet on the sets of blocks and are verified, and only the smallest label met is kept, in each task before
    the shuffle: at most one row per fingerprint comes out, however many are close to it.
    """
    keyed = _keyed(labelled.select("fp", "label"), *block_scheme(distinct, distance))
    a, b = keyed.alias("a"), keyed.select("fp", "label", "blocks", "value").alias("b")
    same = (F.col("a.blocks") == F.col("b.blocks")) & (F.col("a.value") == F.col("b.value"))
    close = (F.col("a.label") != F.col("b.label")) & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance)
    return (a.join(b, same & close).select(F.col("a.fp").alias("fp"), F.col("a.label").alias("label"), F.col("b.label").alias("other"))
            .groupBy("fp").agg(F.min("label").alias("label"), F.min("other").alias("other")))


def _pivot_links(keyed: DataFrame, dense: DataFrame, distance: int) -> DataFrame:
    """Links `src`, `dst` of fingerprints in dense groups to close ones among PIVOTS that stand for the group.

    Each row meets its group's pivots only, so a group has as many candidates as members. Pivots are drawn by hash from all
    members alike: those with the smallest or largest bits would be outliers, which have few close ones.
    """
    drawn = [F.min_by("fp", F.xxhash64("fp", F.lit(i))) for i in range(PIVOTS)]
    pivots = staged(keyed.join(dense, ["blocks", "value"], "left_semi").groupBy("blocks", "value")
                    .agg(F.array_distinct(F.array(*drawn)).alias("pivots")))

    def close(pivot: Column) -> Column:
        return (pivot != F.col("fp")) & (F.bit_count(pivot.bitwiseXOR(F.col("fp"))) <= distance)

    met = keyed.join(pivots, ["blocks", "value"]).select("fp", F.explode(F.filter("pivots", close)).alias("pivot"))
    return met.select(F.greatest("fp", "pivot").alias("src"), F.least("fp", "pivot").alias("dst"))


def pivot_components(fingerprints: DataFrame, distance: int, distinct: int) -> DataFrame:
    """The distinct values of `fp`, each with a `label` that close ones share: most links of dense groups, found without their pairs.

    Only groups of more than DENSE members are looked at, and once: in the others a fingerprint has at most DENSE candidates,
    and of the dense ones the search for links between labels finds what the pivots missed.
    """
    keyed = _keyed(fingerprints.select("fp"), *block_scheme(distinct, distance))
    dense = staged(keyed.groupBy("blocks", "value").agg(F.count("*").alias("members")).where(F.col("members") > DENSE))
    if dense.isEmpty():
        return fingerprints.select("fp", F.col("fp").alias("label"))
    roots = components(_pivot_links(keyed, dense, distance))
    return staged(fingerprints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("label")))


def linked_components(fingerprints: DataFrame, distance: int, distinct: int) -> DataFrame:
    """The smallest fingerprint reachable from each of the distinct values of `fp` that has a close one: columns `node`, `root`.

    Pivots join most of every dense group first, in one turn however large the input is. Then, as in a minimum spanning forest, every component names one component it is
    linked to and they merge, until none has a link to another: all links count, whatever the pivots missed. Components that have
    a neighbour at least halve in number each time. Later rounds look only at fingerprints that have a close one at all.
    """
    labelled = pivot_components(fingerprints.select("fp"), distance, distinct)
    found = staged(outward_links(labelled, distance, distinct))
    joined = labelled.where("fp <> label")
    close = joined.select("fp").unionByName(joined.select(F.col("label").alias("fp"))).unionByName(found.select("fp")).distinct()
    rooted = staged(labelled.join(close, "fp", "left_semi").select(F.col("fp").alias("node"), F.col("label").alias("root")))
    while not found.isEmpty():
        merged = components(found.select(F.greatest("label", "other").alias("src"), F.least("label", "other").alias("dst")))
        merged = merged.select(F.col("node").alias("root"), F.col("root").alias("lower"))
        rooted = staged(rooted.join(merged, "root", "left").select("node", F.coalesce("lower", "root").alias("root")))
        found = staged(outward_links(rooted.select(F.col("node").alias("fp"), F.col("root").alias("label")), distance, distinct))
    return rooted


def components(pairs: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node: columns `node`, `root`, without the smallest ones themselves.

    Rounds of large-star and small-star: every node hands its neighbours to the smallest one it knows, so
    components become stars after about log(nodes) rounds; rounds end when all are stars. Each round is cut by staged copies.
    The smallest neighbours are written before they are joined, so that Spark can split the neighbours of a hub over many tasks.
    Few edges take few tasks, whatever the number of shuffle partitions.
    """
    edges = staged(pairs.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src > dst").distinct())
    while tangled := _tangled(edges):
        tasks = 1 + tangled // EDGES_PER_TASK
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = staged(both.groupBy("src").agg(F.least("src", F.min("dst")).alias("low")).coalesce(tasks))
        large = staged(both.where("dst > src").join(least, "src")
                       .select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src > dst").distinct().coalesce(tasks))
        least = staged(large.groupBy("src").agg(F.min("dst").alias("low")).coalesce(tasks))
        edges = staged(
            large.join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .unionByName(least.select("src", F.col("low").alias("dst"))).where("src > dst").distinct().coalesce(tasks))
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))


def _tangled(edges: DataFrame) -> int:
    """The number of edges; 0 if they are stars already: every `src` has one `dst`, and none is another's."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("dst").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("in")))
    nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    rows, bent = nodes.agg(F.sum("out"), F.count_if(F.col("out") + F.col("in") > 1)).first()
    return rows if bent else 0


def simhash_components(fingerprints: DataFrame, id_column: str, distance: int = 4) -> DataFrame:
    """Each fingerprint's component: columns `fp`, `root` (its smallest fingerprint), `component_id` (its smallest id).

    Takes rows of an id and `fp`. Equal fingerprints are one node, however many documents hold them.
    """
    nodes = staged(fingerprints.groupBy("fp").agg(F.min(id_column).alias("low_id")))
    roots = linked_components(nodes.select("fp"), distance, nodes.count())
    rooted = (nodes.join(roots, F.col("fp") == F.col("node"), "left")
              .select("fp", "low_id", F.coalesce("root", "fp").alias("root")))
    # Written first: then its size is known, and a component of very many fingerprints can be split over tasks.
    least = staged(rooted.groupBy("root").agg(F.min("low_id").alias("component_id")))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4) -> DataFrame:
    """Every document's fingerprint and component: columns `<id_column>`, `fingerprint`, `component_id`.

    One row for each row of `docs`. The fingerprint is 16 hexadecimal digits; documents whose fingerprints
    differ in at most `distance` bits are linked, and `component_id` is the smallest id reachable over links.
    A text without words (or null) has fingerprint zero and links like any other. Repeated rows stay and
    share a component. A null id never names a component; one whose ids are all null has a null
    `component_id`. Other columns are not looked at.
    """
    fp = staged(docs.select(F.col(f"`{id_column}`").alias("id"), fingerprint(F.col(f"`{text}`"), shingle).alias("fp")))
    found = simhash_components(fp, "id", distance)
    return fp.join(found, "fp").select(F.col("id").alias(id_column), as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 4,
             distance: int = 4) -> DataFrame:
    """The documents, one of each near-duplicate component: its smallest id, nulls last.

    Of rows with that same id, or without ids, the one with the smallest hash of all its columns stays; of rows
    equal in all columns, one. All columns of `docs` come back as they were, whatever their names.
    """
    docs, (id_column, text), restored = shielded(docs, id_column, text)
    marked = docs.select("*", *row_key(docs, hashable(docs)))
    fp = staged(marked.select(F.col(f"`{id_column}`").alias("id"), fingerprint(F.col(f"`{text}`"), shingle).alias("fp"), *KEYS))
    found = simhash_components(fp, "id", distance)
    order = F.struct(F.col("id").isNull().alias("absent"), "id", *KEYS)
    kept = (fp.join(found, "fp").groupBy("root").agg(F.min(order).alias("first"))
            .select(*[F.col(f"first.{k}").alias(k) for k in KEYS]))
    # Rows equal in all columns pass the semi-join together; one of them is taken from the same partition.
    return restored(marked.join(kept, KEYS, "left_semi").dropDuplicates(KEYS).drop(*KEYS))
