"""How far the sources of each language differ in their words: an audit over a cube of (source, source, term) cells."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeassay.llm.common import staged

#: A term is a run of ASCII letters and of bytes above ASCII; the text is lower-cased before.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Probabilities are whole billionths.
UNIT = 1_000_000_000
#: A task counts up to so many different (source, term) pairs before it hands them on.
HELD = 250_000

_COUNTS = "lang string, source string, term binary, n long, docs long"
_CELL = "lang string, bi long, gi long, bj long, gj long, partial long, seen long"


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Occurrences and documents of each term per language and source, summed over as many rows as fit in memory."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    seen = 0

    def flushed() -> Iterator[pd.DataFrame]:
        for (lang, source), (occurrences, documents) in held.items():
            terms = list(occurrences)
            yield pd.DataFrame({"lang": lang, "source": source, "term": terms, "n": list(occurrences.values()),
                                "docs": [documents[t] for t in terms]})
        held.clear()

    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["body"]):
            terms = TERM.findall(text.lower())  # bytes.lower() changes A-Z only
            if not terms:
                continue
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            before = len(occurrences)
            occurrences.update(terms)
            documents.update(set(terms))
            seen += len(occurrences) - before
            if seen >= HELD:
                yield from flushed()
                seen = 0
    yield from flushed()


def _probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 * kept)); the product needs more than 64 bits."""
    wide = "decimal(20,0)"
    share = F.call_function("div", (count + 2).cast(wide) * F.lit(UNIT).cast("decimal(10,0)"), (total + 2 * kept).cast(wide))
    return F.lit(1).cast("long") + share


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def kept_terms(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_documents: int = 10) -> DataFrame:
    """Counts `n` of each (lang, source, term), for the terms found in at least `min_documents` rows of their language.

    `lang_n` is the term's count in the whole language, and `first` is 1 on one row of each (lang, term). Tasks sum
    their rows before the one shuffle, which is by language and term, so the rows of a hot source spread over all
    tasks; a term's rows are one for each source and task that has it. Terms that are too rare end there.
    """
    body = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))],
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))
    counts = (body.mapInPandas(_counted, _COUNTS).withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
              .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    term = Window.partitionBy("lang", "term")
    return (counts.withColumns({"lang_docs": F.sum("docs").over(term), "lang_n": F.sum("n").over(term),
                                "first": (F.row_number().over(term.orderBy("source")) == 1).cast("int")})
            .where(F.col("lang_docs") >= min_documents).select("lang", "source", "term", "n", "lang_n", "first"))


def _groups(docs: DataFrame, kept: DataFrame, lang: str, source: str, group_block: int, term_block: int) -> DataFrame:
    """One row per (lang, source): totals, the block `gb` it is in, its place `gi` there, and the blocks of its language."""
    found = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"))]).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.groupBy("lang").agg(F.sum("first").alias("terms"), F.sum("n").alias("lang_total"))
    found = found.join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    langs = (found.groupBy("lang").agg(F.count("*").alias("sources")).join(sizes, "lang", "left").fillna(0, ["terms", "lang_total"])
             .select("lang", "terms", "lang_total", F.ceil(F.col("sources") / group_block).alias("group_blocks"),
                     F.greatest(F.lit(1), F.ceil(F.col("terms") / term_block)).alias("term_blocks")))
    blocked = found.join(langs, "lang").withColumn("gb", F.pmod(F.xxhash64("source"), F.col("group_blocks")))
    place = Window.partitionBy("lang", "gb").orderBy("source")
    zero = F.when(F.col("terms") > 0, _probability(F.lit(0), F.col("total"), F.greatest(F.col("terms"), F.lit(1)))).otherwise(1)
    return blocked.withColumns({"gi": F.row_number().over(place).cast("long") - 1, "zero": zero})


def _cell(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Partial divergences of one cell, over the terms that any source of its two blocks has.

    Rows without a term head the slices: they name every source of both blocks and its probability of a term it lacks.
    """
    lang, block, bi, bj = key
    heads, body = rows[rows["term"].isna()], rows[rows["term"].notna()]
    codes, terms = pd.factorize(body["term"])
    if (not len(terms) and block) or heads["gb"].nunique() < len({bi, bj}):  # nothing to add, or a block that got no source
        return pd.DataFrame(columns=[c.split()[0] for c in _CELL.split(", ")])

    def dense(gb: int) -> np.ndarray:
        zero = heads.loc[heads["gb"] == gb].sort_values("gi")["p"].to_numpy(np.uint64)
        slice_ = np.repeat(zero[:, None], len(terms), axis=1)
        here = (body["gb"] == gb).to_numpy()
        slice_[body["gi"].to_numpy()[here], codes[here]] = body["p"].to_numpy(np.uint64)[here]
        return slice_

    left = dense(bi)
    right = left if bi == bj else dense(bj)
    out = []
    for i, p in enumerate(left):
        start = i + 1 if bi == bj else 0
        q = right[start:]
        apart = np.maximum(p, q) - np.minimum(p, q)
        partial = (apart * apart // (p + q)).sum(axis=1, dtype=np.uint64).astype(np.int64)
        out.append(pd.DataFrame({"gi": i, "gj": np.arange(start, len(right)), "partial": partial}))
    return pd.concat(out).assign(lang=lang, bi=bi, bj=bj, seen=len(terms))


def source_divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", *, min_documents: int = 10,
                      top_terms: int = 10, group_block: int = 32, term_block: int = 8192) -> DataFrame:
    """How far each source's words are from those of every other source of its language, and by which terms.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased. A language keeps the V terms found in at
    least `min_documents` of its rows. With N occurrences of kept terms in a source, a term found c times there has
    p = 1 + floor(10^9 (c + 2) / (N + 2V)), also where c is 0; the language as a whole likewise. Two probabilities differ by
    f = floor((p - q)^2 / (p + q)). All of it is integer arithmetic, so reruns and other partitionings agree.

    Returns lang, source, part, item, value and rank. Part `pair` has every other source of the language as item and f
    summed over all kept terms; part `term` has the `top_terms` terms that are likelier in the source than in its language
    by the largest f. Ranks go by value, then by item; sources without terms take part. Null texts, languages and sources
    count as empty; rows count one by one, repeated or not; a language with one source has no pairs; an empty table gives
    no rows. Columns of other names do not matter.

    The sum over terms is cut three ways: sources of a language are hashed to blocks of about `group_block`, its kept terms to
    blocks of about `term_block`, and a task owns a cell of two source blocks and one term block, to which the slices
    are copied. A slice holds only terms a source has, so work follows the text; terms that no source of a cell has need
    no cell, as each adds the same amount. Partial sums are reduced along the terms. A hot source is one row per kept
    term. Nothing reaches the driver.
    """
    kept = staged(kept_terms(docs, text, lang, source, min_documents))
    groups = staged(_groups(docs, kept, lang, source, group_block, term_block))
    # Both sides are read from files, so Spark sees their sizes, and splits the hot source where it must shuffle.
    rows = kept.join(groups, ["lang", "source"]).withColumn("p", _probability(F.col("n"), F.col("total"), F.col("terms")))

    q = _probability(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (rows.withColumn("q", q).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _difference(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms))

    columns = ["lang", "block", "gb", "gi", "term", "p", "group_blocks"]
    body = rows.withColumn("block", F.pmod(F.xxhash64("term"), F.col("term_blocks"))).select(columns)
    heads = (groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)))
             .withColumns({"term": F.lit(None).cast("string"), "p": F.col("zero")}).select(columns))
    cells = (body.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)))
             .select("lang", "block", F.least("gb", "other").alias("bi"), F.greatest("gb", "other").alias("bj"), "gb", "gi", "term", "p"))
    sums = (cells.groupBy("lang", "block", "bi", "bj").applyInPandas(_cell, _CELL)
            .groupBy("lang", "bi", "gi", "bj", "gj").agg(F.sum("partial").alias("partial"), F.sum("seen").alias("seen")))

    left = groups.select("lang", F.col("gb").alias("bi"), "gi", "source", F.col("zero").alias("p"), "terms")
    right = groups.select("lang", F.col("gb").alias("bj"), F.col("gi").alias("gj"), F.col("source").alias("item"), F.col("zero").alias("q"))
    apart = (sums.join(left, ["lang", "bi", "gi"]).join(right, ["lang", "bj", "gj"])
             .withColumn("value", F.col("partial") + (F.col("terms") - F.col("seen")) * _difference(F.col("p"), F.col("q"))))
    both = apart.select("lang", "value", F.explode(F.array(
        F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).alias("e"))
    pairs = (both.select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
             .withColumn("rank", F.row_number().over(by_value)))
    return pairs.unionByName(terms)
