"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeassay.llm.common import bounded_broadcast, staged

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64.0, 1_000_000
#: Entries beyond this have no place in a 64-bit number once scaled.
LARGEST = 2.0**56
#: Sums travel in pieces of so many bits, which 64-bit additions cannot overflow.
LIMB = 40
#: Models of all vector lengths together up to this size are broadcast; beyond it rows meet them in salted groups.
MODEL_BYTES = 64 << 20
#: Rows of such a group.
GROUP_ROWS = 16_384

_SUMS = "d long, i long, limb long, n long, total array<long>"
_MODEL = "d long, model binary"
_PRODUCTS = "d long, n long, total array<double>"


# ---- Linear algebra on one matrix

def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L and an order of rows with `matrix[order][:, order] = L L'`; L has as many columns as the matrix has rank."""
    size = len(matrix)
    order, left = np.arange(size), matrix.diagonal().astype(float).copy()
    factor = np.zeros((size, size))
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(size):
        best = k + int(left[k:].argmax())
        if left[best] <= least:
            return factor[:, :k], order
        for rows in (order, left, factor):
            rows[[k, best]] = rows[[best, k]]
        factor[k, k] = np.sqrt(left[k])
        factor[k + 1 :, k] = (matrix[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def _rounds(count: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of disjoint pairs: a round-robin tournament."""
    ring = np.arange(count + count % 2)
    for _ in range(len(ring) - 1):
        a, b = ring[: len(ring) // 2], ring[: len(ring) // 2 - 1 : -1]
        playing = (a < count) & (b < count)
        yield a[playing], b[playing]
        ring[1:] = np.roll(ring[1:], 1)


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """`factor` with its columns rotated until all are at right angles, by falling length."""
    columns = factor.T.copy()
    near = max(factor.shape[0], 1) * np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p, q in _rounds(len(columns)):
            a, b = columns[p], columns[q]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            due = np.abs(ab) > near * np.sqrt(aa * bb)
            if not due.any():
                continue
            turned = True
            p, q, a, b, aa, bb, ab = (x[due] for x in (p, q, a, b, aa, bb, ab))
            zeta = (bb - aa) / (2 * ab)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cosine = 1.0 / np.hypot(1.0, tangent)
            sine = (cosine * tangent)[:, None]
            cosine = cosine[:, None]
            columns[p], columns[q] = cosine * a - sine * b, sine * a + cosine * b
        if not turned:
            break
    return columns[np.argsort(-(columns * columns).sum(axis=1), kind="stable")].T


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above zero, falling, and their unit eigenvectors as columns, the largest entry of each positive."""
    factor, order = pivoted_cholesky(matrix)
    rotated = one_sided_jacobi(factor)
    length = np.sqrt((rotated * rotated).sum(axis=0))
    vectors = np.empty_like(rotated)
    vectors[order] = rotated / length
    if vectors.size:
        vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return length**2, vectors


# ---- Exact sums

def _gram(y: np.ndarray) -> np.ndarray:
    """Y'Y of whole numbers, exactly: in doubles where no sum can leave their 53 bits, else in wider numbers."""
    most = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if most < 2**53:
        y = y.astype(float)
        return (y.T @ y).astype(np.int64)
    return y.T @ y if most < 2**62 else y.astype(object).T @ y.astype(object)


def _limbs(values: np.ndarray) -> Iterator[np.ndarray]:
    """Whole numbers as 64-bit pieces of LIMB bits, lowest first; the last one carries the sign."""
    if values.dtype != object:
        yield values & ((1 << LIMB) - 1)
        yield values >> LIMB
        return
    while any(v not in (0, -1) for v in values.ravel()):
        yield (values & ((1 << LIMB) - 1)).astype(np.int64)
        values = values >> LIMB
    yield values.astype(np.int64)


class _Sums:
    """Exact sums of rows of whole numbers, by length of vector."""

    def __init__(self) -> None:
        self._rows: dict[tuple[int, int], np.ndarray] = {}
        self._n: dict[int, int] = {}

    def add(self, d: int, n: int, matrix: np.ndarray) -> None:
        self._n[d] = self._n.get(d, 0) + n
        for limb, piece in enumerate(_limbs(matrix)):
            held = self._rows.get((d, limb))
            self._rows[d, limb] = piece if held is None else held + piece

    def batches(self) -> Iterator[pa.RecordBatch]:
        for (d, limb), matrix in self._rows.items():
            count = len(matrix)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, v), pa.int64()) if np.isscalar(v) else pa.array(v, pa.int64())
                 for v in (d, np.arange(count), limb, 0 if limb else self._n[d])]
                + [pa.array(list(matrix), pa.list_(pa.int64()))], names=["d", "i", "limb", "n", "total"])


def _reduced(sums: DataFrame) -> DataFrame:
    """Sums of all tasks, still one row for each row of the matrix."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        d, i, limb = key
        return pd.DataFrame({"d": [d], "i": [i], "limb": [limb], "n": [rows["n"].sum()], "total": [np.sum(np.stack(rows["total"]), axis=0)]})

    return sums.groupBy("d", "i", "limb").applyInPandas(add, _SUMS)


def _matrix(rows: pd.DataFrame) -> tuple[int, np.ndarray]:
    """The number of vectors and the exact matrix that reduced rows of one length spell."""
    matrix = np.zeros((int(rows["i"].max()) + 1, len(rows["total"].iloc[0])), object)
    for i, limb, total in zip(rows["i"], rows["limb"], rows["total"]):
        matrix[i] += np.array([int(v) << (LIMB * int(limb)) for v in total], object)
    return int(rows.loc[rows["i"] == 0, "n"].sum()), matrix


# ---- Passes over the vectors

Batches = Iterable[pa.RecordBatch]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    lengths = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        part = batch.take(pa.array(np.flatnonzero(lengths == d)))
        yield int(d), part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _sum_vectors(batches: Batches) -> Iterator[pa.RecordBatch]:
    sums = _Sums()
    for batch in batches:
        for d, _, x in _by_length(batch):
            small = int(np.abs(x).max(initial=0)) * len(x) < 2**62
            sums.add(d, len(x), (x if small else x.astype(object)).sum(axis=0, keepdims=True))
    yield from sums.batches()


def _sum_products(models: Mapping[int, bytes], batches: Batches) -> Iterator[pa.RecordBatch]:
    sums = _Sums()
    for batch in batches:
        for d, _, x in _by_length(batch):
            sums.add(d, len(x), _gram(x - pickle.loads(models[d])["centre"]))
    yield from sums.batches()


def _whitened(model: dict, x: np.ndarray) -> np.ndarray:
    return ((x - model["centre"]) - model["rest"]) @ model["directions"]


def _sum_whitened(models: Mapping[int, bytes], batches: Batches) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    for batch in batches:
        for d, _, x in _by_length(batch):
            w = np.column_stack([np.ones(len(x)), _whitened(pickle.loads(models[d]), x)])
            n, total = held.get(d, (0, 0.0))
            held[d] = (n + len(x), total + w.T @ w)
    for d, (n, total) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([n], pa.int64()), pa.array([total.ravel()], pa.list_(pa.float64()))],
                                         names=["d", "n", "total"])


def _deviation(model: dict, x: np.ndarray) -> np.ndarray:
    """Sum over the dimensions of (n x - S)^2, exactly."""
    n, y = model["n"], x - model["centre"]
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    if most < 2**62 and most * most * x.shape[1] < 2**62:
        away = n * y - model["surplus"].astype(np.int64)
    else:
        away = n * y.astype(object) - model["surplus"]
    return (away * away).sum(axis=1)


def _apply(models: Mapping[int, bytes], batches: Batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for d, part, x in _by_length(batch):
            model = pickle.loads(models[d])
            count = len(x)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.full(count, d), pa.int64()), pa.array(np.full(count, model["n"]), pa.int64()),
                 pa.array([str(v) for v in _deviation(model, x)], pa.string()),
                 pa.array(list(_whitened(model, x)), pa.list_(pa.float64())),
                 pa.array([model["explained"]] * count, pa.list_(pa.float64()))],
                names=["id", "d", "n", "deviation", "whitened", "explained"])


def _with_models(rows: DataFrame, models: DataFrame, work: Callable, schema: str, limit: int) -> DataFrame:
    """`work(models by length, batches of rows)` over all rows, each beside the model of its length.

    The models of all lengths, of measured size, are broadcast up to `limit` bytes. Beyond that, rows and models meet in
    groups of one length and about GROUP_ROWS rows, so neither many lengths nor one hot length fills a task.
    """
    size = models.agg(F.sum(F.octet_length("model"))).first()[0] or 0
    if size <= limit:
        known = bounded_broadcast(rows.sparkSession, {r["d"]: bytes(r["model"]) for r in models.collect()}, size, limit, "the models")
        return rows.mapInArrow(lambda batches: work(known.value, batches), schema)
    salts = max(1, rows.count() // GROUP_ROWS)
    salted = rows.withColumns({"d": F.size("x").cast("long"), "salt": F.pmod(F.monotonically_increasing_id(), F.lit(salts))})
    copies = models.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        models = {right["d"][0].as_py(): right["model"][0].as_py()} if len(right) else {}
        return pa.Table.from_batches(list(work(models, left.combine_chunks().to_batches() if len(left) else [])), schema=target)

    target = rows.sparkSession.createDataFrame([], schema).toArrow().schema
    return salted.groupBy("d", "salt").cogroup(copies.groupBy("d", "salt")).applyInArrow(group, schema)


def _means(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    n, total = _matrix(rows)
    model = {"n": n, "centre": np.array([v // n for v in total[0]], np.int64)}
    return pd.DataFrame({"d": [key[0]], "model": [pickle.dumps(model)]})


def _fitted(components: int) -> Callable:
    def fit(key: tuple, rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        n, products = _matrix(rows)
        _, total = _matrix(sums)
        centre = np.array([v // n for v in total[0]], object)
        surplus = total[0] - n * centre
        # n^2 times the covariance, in whole numbers: the products are about whole numbers next to the means.
        covariance = ((n * products - np.outer(surplus, surplus)) / (n * n)).astype(float)
        values, vectors = eigen(covariance)
        values, vectors = values[:components], vectors[:, :components]
        model = {"n": n, "centre": centre.astype(np.int64), "surplus": surplus, "rest": (surplus / n).astype(float),
                 "directions": vectors / np.sqrt(values), "explained": values / np.trace(covariance) if len(values) else values}
        return pd.DataFrame({"d": [key[0]], "model": [pickle.dumps(model)]})

    return fit


def _identity_error(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum(np.stack(rows["total"]), axis=0) / rows["n"].sum()
    moments = total.reshape(int(np.sqrt(len(total))), -1)
    mean = moments[0, 1:]
    off = moments[1:, 1:] - np.outer(mean, mean) - np.eye(len(mean))
    return pd.DataFrame({"d": [key[0]], "identity_error": [float(np.abs(off).max(initial=0.0))]})


def quantised(vector: Column) -> Column:
    """A vector's entries as whole numbers; null where the vector is null or empty or an entry is null, not finite or beyond LARGEST."""
    vector = vector.cast("array<double>")
    usable = (F.size(vector) > 0) & F.forall(vector, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c * SCALE).cast("long") + F.lit(OFFSET).cast("long")))


def whiten(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = 16,
           model_bytes: int = MODEL_BYTES) -> DataFrame:
    """Every usable row with its vector's coordinates along the leading principal components, scaled to unit variance.

    Entries c become whole numbers x = floor(64 c) + 1000000. The fit takes each distinct x vector once: n of them, with sums S.
    Components are unit eigenvectors of their covariance (divisor n) by falling eigenvalue e, the largest entry positive.
    Returns the id, `n`, `deviation` (sum over dimensions of (n x - S)^2, exact, as a decimal), `whitened` (x - S/n on each
    component, over sqrt(e)), `explained` (e over the trace) and `identity_error` (the largest absolute entry of the covariance of
    `whitened` over the fit list, less the identity, measured in a pass of its own). The arrays have up to `components` entries:
    as many as the covariance has rank, so none for a single distinct vector.

    Rows whose vector is null or empty or holds a null, non-finite or larger entry than 2^56 (no 64-bit x) are left out.
    Vectors of several lengths are whitened apart, each length by a fit of its own. Repeated rows come back each; null and repeated ids
    are kept as they are; other columns do not matter; an empty table gives no rows.

    Distinct vectors are found by one shuffle and staged. Sums and products are exact whole numbers, so their order does
    not matter: tasks add up d and d x d numbers each, and rows of those matrices are reduced apart. Vectors are centred on the whole
    numbers next to their means before they are multiplied, and the fraction left is taken off exactly. One task then
    factors the d x d matrix of a length. That matrix is all that grows with the width; nothing grows with the rows.
    """
    rows = table.select(F.col(f"`{id_column}`").alias("id"), quantised(F.col(f"`{vector}`")).alias("x")).where("x is not null")
    fit = staged(rows.select("x").distinct())
    sums = staged(_reduced(fit.mapInArrow(_sum_vectors, _SUMS)))
    means = staged(sums.groupBy("d").applyInPandas(_means, _MODEL))
    products = _reduced(_with_models(fit, means, _sum_products, _SUMS, model_bytes))
    models = staged(products.groupBy("d").cogroup(sums.groupBy("d")).applyInPandas(_fitted(components), _MODEL))
    errors = staged(_with_models(fit, models, _sum_whitened, _PRODUCTS, model_bytes).groupBy("d").applyInPandas(
        _identity_error, "d long, identity_error double"))
    id_type = rows.schema["id"].dataType.simpleString()
    applied = _with_models(rows, models, _apply, f"id {id_type}, d long, n long, deviation string, whitened array<double>, explained array<double>",
                           model_bytes)
    return applied.join(errors, "d").select(
        F.col("id").alias(id_column), "n", F.col("deviation").cast("decimal(38,0)").alias("deviation"), "whitened", "explained", "identity_error")
