"""Approximate nearest neighbours by permutations: vectors are known by the pivots they lie nearest to."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeassay.llm.common import staged

#: Pivots are one in ROWS_PER_PIVOT of the distinct vectors of the table, those of the smallest hashes, within these bounds.
FEWEST_PIVOTS, PIVOTS, ROWS_PER_PIVOT = 256, 2048, 16
#: So many of its nearest pivots describe a row and stand in the inverted file; a query visits the postings of so many.
NEAREST, VISITED = 64, 32
#: An inverted file holds one in FILES of the rows, within these bounds, and fewer if their vectors would hold more than so many numbers.
FILES, BLOCK, LARGEST_BLOCK, BLOCK_NUMBERS = 16, 2048, 65536, 1 << 22
#: Queries that travel together, and numbers that the sums of those searched at once take.
QUERY_BLOCK, HELD = 256, 1 << 16
#: Best rows by footrule that are reranked at once, and how near to the worst of the best a row's agreement must come to be
#: reranked after them.
RERANK, REACH = 512, 0.8

_CELL = "length int, block long, kind int, ids binary, vectors binary"
_PIVOTS, _ROWS, _QUERIES = range(3)


def _usable(vector: Column) -> Column:
    """A vector with a length, numbers only, and not all of them zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The numbers of each vector's k nearest pivots (by inner product), nearest first, ties by number."""
    far = -(vectors @ pivots.T)
    near = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1) if k < far.shape[1] else np.indices(far.shape)[1]
    return np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable"), axis=1)


class InvertedFile(NamedTuple):
    """The postings of all pivots, one after another: `rows` and `weights` from `starts[p]` to `starts[p + 1]` are those of pivot p.

    A weight says how far from the end of the row's order the pivot stands: the first of `places` pivots weighs `places`, the last 1.
    """

    places: int
    size: int
    starts: np.ndarray
    rows: np.ndarray
    weights: np.ndarray


def inverted_file(order: np.ndarray, pivots: int) -> InvertedFile:
    """The inverted file of rows that are described by the pivots in `order`."""
    size, places = order.shape
    entries = np.argsort(order, axis=None, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(order.ravel(), minlength=pivots))])
    return InvertedFile(places, size, starts, (entries // places).astype(np.int32), (places - entries % places).astype(np.int32))


def agreement(order: np.ndarray, postings: InvertedFile) -> np.ndarray:
    """How far the footrule distance of each query and each row lies below that of orders without a common pivot, halved.

    A pivot missing from an order counts as its place k. Then a common pivot at places a and b lowers the distance by
    (k - a) + (k - b) - |a - b|, which is 2 * min(k - a, k - b), so only the postings of the query's pivots are visited.
    Orders of queries may be shorter than those of rows: what they leave out is not counted.
    """
    queries, visited = order.shape
    begin = postings.starts[order].ravel()
    count = postings.starts[order + 1].ravel() - begin
    end = np.cumsum(count)
    entries = np.arange(end[-1]) + np.repeat(begin - (end - count), count)
    own = np.tile(np.arange(postings.places, postings.places - visited, -1, dtype=np.int32), queries)
    cells = postings.rows[entries] + np.repeat(np.repeat(np.arange(queries) * postings.size, visited), count)
    common = np.minimum(postings.weights[entries], np.repeat(own, count))
    return np.bincount(cells, common, queries * postings.size).reshape(queries, postings.size)


def best(agree: np.ndarray, own: np.ndarray, query: np.ndarray, vectors: np.ndarray, ids: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The `top` rows for one query, nearest first, ties by id: their ids and exact inner products.

    The rows that agree most are reranked, and all that tie with the last of them; then, as long as that brings new
    rows, all whose agreement comes within REACH of the worst of the best. So a query among thousands of
    near copies gets to see them all.
    """
    agree = np.where(own, -1, agree)
    others, first, scores = int((~own).sum()), np.zeros(0, np.int64), np.zeros(0)
    if not others:
        return ids[first], scores
    at_once = min(max(RERANK, top), others)
    floor, seen = np.partition(agree, -at_once)[-at_once], np.inf
    while True:
        rows = np.flatnonzero((agree >= floor) & (agree < seen))
        products = np.concatenate([scores, vectors[rows] @ query])
        rows = np.concatenate([first, rows])
        if len(rows) > top:
            near = products >= np.partition(products, -top)[-top]
            rows, products = rows[near], products[near]
        order = np.lexsort((ids[rows], -products))[:top]
        first, scores, seen = rows[order], products[order], floor
        floor = min(floor, REACH * agree[first].min())
        if floor == seen:
            return ids[first], scores


def _matrix(column: pd.Series, dtype) -> np.ndarray:
    return np.stack([np.asarray(x, dtype) for x in column])


def _search(top: int):
    """Tasks get, for each block, its pivots, then its rows and then blocks of queries, one after another."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = pivots = postings = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                vectors = np.frombuffer(row.vectors, np.float64).reshape(-1, row.length)
                ids = np.frombuffer(row.ids, np.int64)
                if row.kind == _PIVOTS:
                    block, pivots, postings = (row.length, row.block), vectors, None
                elif row.kind == _ROWS:
                    held, held_ids = vectors, ids
                    postings = inverted_file(nearest_pivots(vectors, pivots, min(NEAREST, len(pivots))), len(pivots))
                elif postings is not None and block == (row.length, row.block):
                    yield from answers(ids, vectors, held, held_ids, pivots, postings)

    def answers(ids, vectors, held, held_ids, pivots, postings) -> Iterator[pd.DataFrame]:
        order = nearest_pivots(vectors, pivots, min(VISITED, len(pivots)))
        found, step = [], max(1, HELD // postings.size)
        for i in range(0, len(ids), step):
            for j, agree in enumerate(agreement(order[i : i + step], postings), i):
                found.append(best(agree, held_ids == ids[j], vectors[j], held, held_ids, top))
        yield pd.DataFrame({"query_id": np.repeat(ids, [len(x) for x, _ in found]), "vec_id": np.concatenate([x for x, _ in found]),
                            "score": np.concatenate([s for _, s in found])})

    return search


def _packed(rows: DataFrame) -> DataFrame:
    """One row per length, block and kind: ids and vectors as bytes."""

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        return pd.DataFrame([[*key, group["id"].to_numpy(np.int64).tobytes(), _matrix(group["vector"], np.float64).tobytes()]],
                            columns=["length", "block", "kind", "ids", "vectors"])

    return rows.groupBy("length", "block", "kind").applyInPandas(pack, _CELL)


def nearest(vectors: DataFrame, queries: Column, id_column: str = "vec_id", vector: str = "embedding", top: int = 20) -> DataFrame:
    """The `top` nearest other vectors of every query by inner product: query_id, rank from 1, vec_id, score.

    `queries` says which rows are queries; all others and all queries are candidates, but for rows with the
    query's own id. Scores are inner products of the stored numbers in double precision; ties go to the smaller
    id. All candidates come back if there are fewer than `top`. Null, empty and zero vectors, those with null, NaN or
    infinite components, and rows without an id take no part. Vectors are neighbours of those of their own length.
    Equal rows count once; other columns are not looked at.

    Rows are indexed by hash in blocks of one length, each with its own inverted file; of rows with one and the same vector
    those of the `top` + 1 smallest ids, as no query can return others. Each block of queries goes to every block of its length, where it
    visits the postings of its nearest pivots only. Pivots grow with the rows up to PIVOTS, so a query visits a falling
    share of the postings. The pivots of a length travel with its blocks. A task holds one block and one block of queries, the driver
    the number of blocks.
    """
    rows = (vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"),
                           F.coalesce(queries, F.lit(False)).alias("is_query"))
            .where(F.col("id").isNotNull() & _usable(F.col("vector"))))
    rows = staged(rows.groupBy("id", "vector").agg(F.max("is_query").alias("is_query")).withColumn("length", F.size("vector")))
    copy = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    # Spark keeps so many rows of a vector in each task before it shuffles them.
    indexed = staged(rows.withColumn("copy", copy).where(F.col("copy") <= top + 1).withColumn("h", F.xxhash64("id", "vector")))
    asked = rows.where("is_query").groupBy("length").agg(F.count("*").alias("asked"))
    sizes = indexed.groupBy("length").agg(F.count("*").alias("total"), F.count_if(F.col("copy") == 1).alias("distinct"))
    block = F.greatest(F.lit(1), F.least(F.greatest(F.lit(BLOCK), F.least(F.lit(LARGEST_BLOCK), F.floor(F.col("total") / FILES))),
                                         F.floor(F.lit(BLOCK_NUMBERS) / F.col("length"))))
    # Lengths without a query have nothing to find. Spark sees the size of this file, one short row per length.
    lengths = staged(sizes.join(asked, "length").select(
        "length", "distinct", F.ceil(F.col("total") / block).alias("blocks"), F.ceil(F.col("asked") / QUERY_BLOCK).alias("parts"),
        F.greatest(F.lit(FEWEST_PIVOTS), F.least(F.lit(PIVOTS), F.floor(F.col("distinct") / ROWS_PER_PIVOT))).alias("pivots")))
    blocks = lengths.agg(F.sum("blocks")).first()[0]
    if not blocks:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    known = indexed.join(lengths, "length")
    # Twice as many as needed by their hashes, of which the smallest are taken, so that no task ranks all rows.
    share = F.shiftrightunsigned(F.xxhash64("h"), 11) * F.lit(2.0 ** -53)
    by_hash = Window.partitionBy("length").orderBy("share", "h", "id")
    pivots = (known.where("copy = 1").withColumn("share", share).where(F.col("share") * F.col("distinct") <= 2 * F.col("pivots") + 64)
              .withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= F.col("pivots")))
    kind = lambda n: F.lit(n).alias("kind")
    index = _packed(known.select("length", F.pmod("h", F.col("blocks")).alias("block"), kind(_ROWS), "id", "vector"))
    parts = _packed(rows.where("is_query").join(lengths, "length").select(
        "length", F.pmod(F.xxhash64("id", "vector"), F.col("parts")).alias("block"), kind(_QUERIES), "id", "vector"))
    marks = _packed(pivots.select("length", F.lit(0).cast("long").alias("block"), kind(_PIVOTS), "id", "vector"))
    copied = marks.unionByName(parts).drop("block").join(lengths.select("length", "blocks"), "length").select(
        "length", every.alias("block"), "kind", "ids", "vectors")
    found = (index.unionByName(copied).repartition(blocks, "length", "block").sortWithinPartitions("length", "block", "kind")
             .mapInPandas(_search(top), "query_id long, vec_id long, score double"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
