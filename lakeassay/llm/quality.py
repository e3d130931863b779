"""A quality classifier: regularised quadratic discriminant analysis over statistics of whole texts."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lakeassay.llm.common import held_out

STATISTICS = (
    "words", "word_length", "symbols", "exclamations", "pipes", "capitals", "digits", "punctuation",
    "repeats", "commonest", "vocabulary", "lines")
#: Ratios start from these typical values with the weight of so many words, so that a text of three words
#: is not called odd for one capital.
PRIOR_WORDS = 20.0

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&<>{}[]~^\\=_@")] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:?'\"()-")] = True


def statistics_of(text: bytes | None) -> list[float]:
    """The transformed statistics of one text, in the order of STATISTICS; an empty text has the prior's."""
    text = text or b""
    words = text.split()
    n = len(words)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    counts = Counter(words)
    repeats = sum(map(eq, words, words[1:]))
    commonest = max(counts.values(), default=0)
    length = int(seen.sum() - seen[32] - seen[9:14].sum())
    weight = n + PRIOR_WORDS

    def ratio(amount: float, typical: float) -> float:
        return (amount + typical * PRIOR_WORDS) / weight

    return [
        np.log1p(n),
        np.log(ratio(length, 6.0)),
        np.log(ratio(int(seen[_SYMBOLS].sum()), 0.01)),
        np.log(ratio(int(seen[33]), 0.01)),
        np.log(ratio(int(seen[124]), 0.01)),
        np.log((upper + 0.03 * 6 * PRIOR_WORDS) / (upper + lower + 6 * PRIOR_WORDS)),
        np.log(ratio(int(seen[48:58].sum()), 0.1)),
        np.log(ratio(int(seen[_PUNCTUATION].sum()), 0.2)),
        np.log(ratio(repeats, 0.02)),
        np.log(ratio(commonest, 0.08)),
        np.log(ratio(len(counts), 0.8)) + 0.15 * np.log1p(n),
        np.log(ratio(int(seen[10]), 0.02)),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics_of(t) for t in texts])


def statistics(text: Column) -> Column:
    """The transformed statistics of a text column."""
    return _statistics(text.cast("binary"))


@dataclass(frozen=True)
class QualityModel:
    """Log priors, means and lower Cholesky factors of the covariances of the two classes, low and high quality."""

    log_prior: np.ndarray
    mean: np.ndarray
    factor: np.ndarray
    temper: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of high quality for each row of statistics."""
        density = []
        for c in (0, 1):
            z = np.linalg.solve(self.factor[c], (x - self.mean[c]).T)
            density.append(self.log_prior[c] - np.log(np.diag(self.factor[c])).sum() - 0.5 * (z * z).sum(axis=0))
        return 1.0 / (1.0 + np.exp(np.clip((density[0] - density[1]) / self.temper, -700, 700)))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
          shrinkage: float = 0.1, temper: float = 2.0) -> QualityModel:
    """Fit the classifier on every labelled document that is not held out.

    Spark sums counts, statistics and their products over all labelled rows, so the driver gets a fixed
    2 x (1 + d + d * d) numbers. A class covariance is shrunk by `shrinkage` towards the covariance within both
    classes, and that by as much towards its diagonal; every variance gets a small floor, which keeps constant
    statistics regular. `temper` divides the log-density difference, because the statistics are not independent
    draws. Repeated labels of one document count as their majority, ties as high; null labels and ids are left
    out. Labels other than 0 and 1 are an error. A class without rows takes the other's mean and covariance, so
    that all scores are the prior's; without any labelled row every score is 0.5.
    """
    d = len(STATISTICS)
    # Statistics are joined to labels, not texts: only they are shuffled.
    known = (labels.where(F.col(label).isNotNull()).groupBy(F.col(id_column).alias("id"))
             .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("class"),
                  F.min((F.col(label).isin(0, 1)).cast("int")).alias("valid")))
    known = known.withColumn("class", F.when(F.col("valid") == 1, F.col("class")).otherwise(
        F.raise_error(F.lit("a quality label is neither 0 nor 1")))).drop("valid")
    rows = (docs.where(F.col(f"`{id_column}`").isNotNull() & ~held_out(F.col(f"`{id_column}`")))
            .select(F.col(f"`{id_column}`").alias("id"), statistics(F.col(f"`{text}`")).alias("x")).join(known, "id"))

    def products(x: Column) -> Column:
        return F.flatten(F.transform(x, lambda a: F.transform(x, lambda b: a * b)))

    terms = rows.select("class", F.posexplode(F.concat(F.array(F.lit(1.0)), "x", products(F.col("x")))).alias("term", "value"))
    sums = np.zeros((2, 1 + d + d * d))
    for row in terms.groupBy("class", "term").agg(F.sum("value").alias("value")).collect():
        sums[row["class"], row["term"]] = row["value"]
    return _fitted(sums, shrinkage, temper)


def _fitted(sums: np.ndarray, shrinkage: float, temper: float) -> QualityModel:
    d = len(STATISTICS)
    n, total = sums[:, 0], sums[:, 0].sum()
    if not total:
        return QualityModel(np.zeros(2), np.zeros((2, d)), np.stack([np.eye(d)] * 2), temper)
    mean = np.stack([sums[c, 1 : 1 + d] / n[c] if n[c] else sums[:, 1 : 1 + d].sum(axis=0) / total for c in (0, 1)])
    scatter = [sums[c, 1 + d :].reshape(d, d) - n[c] * np.outer(mean[c], mean[c]) if n[c] else np.zeros((d, d)) for c in (0, 1)]
    within = (scatter[0] + scatter[1]) / total
    within = (1 - shrinkage) * within + shrinkage * np.diag(np.diag(within)) + 1e-3 * np.eye(d)
    factor = [np.linalg.cholesky((1 - shrinkage) * scatter[c] / n[c] + shrinkage * within if n[c] else within) for c in (0, 1)]
    if not n.all():
        factor = [np.linalg.cholesky(within)] * 2
    return QualityModel(np.log((n + 1) / (total + 2)), mean, np.stack(factor), temper)


def score(docs: DataFrame, model: QualityModel, text: str = "text", column: str = "score") -> DataFrame:
    """The documents with their probability of high quality, from the text alone; replaces a column of that name.

    Null and empty texts score as a text with the prior's statistics. The model, a few kilobytes whatever
    the input, travels with the task.
    """

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.scores(np.array([statistics_of(t) for t in texts])))

    return docs.withColumn(column, scored(F.col(f"`{text}`").cast("binary")))
