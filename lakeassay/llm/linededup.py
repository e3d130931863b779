"""Dropping lines that many documents share."""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from lakeassay.llm.common import KEYS, OWN, SPACE, row_key, shielded, staged

#: bytes.strip(None) also strips these six characters only; bytes.lower() changes A-Z only.
BLANK = SPACE.encode()


def _digest(line: bytes) -> bytes | None:
    """The 128-bit hash of a line's key; None for a blank line, which is never dropped."""
    key = line.strip(BLANK).lower()
    return xxhash.xxh3_128_digest(key) if key else None


@F.pandas_udf(ArrayType(BinaryType()))
def _line_keys(texts: pd.Series) -> pd.Series:
    """The distinct line keys of each text."""
    return pd.Series([list({d for line in (t or b"").split(b"\n") if (d := _digest(line))}) for t in texts])


@F.pandas_udf(StructType().add("n_lines", LongType()).add("n_dropped", LongType()).add("kept", StringType()))
def _without(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    rows = []
    for text, keys in zip(texts, dropped):
        text = text or b""
        lines = text.split(b"\n")
        kept = lines
        if keys is not None and len(keys):
            gone = set(keys)
            kept = [line for line in lines if _digest(line) not in gone]
        rows.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode("utf-8", "replace")))
    return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])


def shared_lines(docs: DataFrame, text: str = "text", min_documents: int = 10) -> DataFrame:
    """Keys of non-blank lines found in at least `min_documents` rows of `docs`: columns `line_key`, `n_documents`.

    A key counts once for each row, and counts are summed before they are shuffled.
    """
    keys = docs.select(F.explode(_line_keys(F.col(f"`{text}`").cast("binary"))).alias("line_key"))
    return keys.groupBy("line_key").agg(F.count("*").alias("n_documents")).where(F.col("n_documents") >= min_documents)


def drop_shared_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_documents: int = 10) -> DataFrame:
    """The documents without lines that at least `min_documents` of them share.

    A text is split at newlines (a null text is one empty line). Lines are compared without the ASCII white
    space around them and with A-Z in lower case. All copies of a shared line go, also within one document;
    blank lines stay; the others stay as they were, in order. Returns the columns of `docs`, with the text
    replaced (a null text becomes empty), and `n_lines` and `n_dropped`, which replace columns of those names.
    Each row is a document: rows with the same id count one by one. A document that loses all its lines stays,
    with an empty text. An empty table gives an empty result, and a text of any length is one row.

    Only hashes of lines are shuffled for counting. A document's shared lines come back to it by a hash of id
    and text, so copies of one text under many ids do not meet in one task.
    """
    docs, (id_column, text), restored = shielded(docs, id_column, text)
    body = F.col(f"`{text}`").cast("binary")
    marked = docs.select("*", *row_key(docs, [id_column, text]))
    # Copies that agree on id and text lose the same lines; one of them is enough to say which.
    keys = marked.select(*KEYS, F.explode(_line_keys(body)).alias("line_key"))
    # Staged, the shared keys come to the join over a shuffle of their own. Spark can then split a line that stands
    # in a third of all documents over many tasks; keys straight from their count would stay in that count's partitions.
    gone = (keys.join(staged(shared_lines(docs, text, min_documents)), "line_key", "left_semi")
            .groupBy(*KEYS).agg(F.collect_set("line_key").alias(f"{OWN}gone")))
    cleaned = marked.join(gone, KEYS, "left").withColumn(f"{OWN}new", _without(body, F.col(f"{OWN}gone")))
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]

    def column(name: str) -> Column:
        return F.col(f"{OWN}new.kept").alias(name) if name == text else F.col(f"`{name}`")

    return restored(cleaned.select(*map(column, names), F.col(f"{OWN}new.n_lines"), F.col(f"{OWN}new.n_dropped")))
