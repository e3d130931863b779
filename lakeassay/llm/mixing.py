"""Mixing sources to target weights: weighted pivotal rounding of copy numbers over a reduction tree.

All steps are DataFrame operations. No task gets more than a chunk of fractions at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeassay.llm.common import KEYS, OWN, hashable, row_key, shielded, staged, word_count

#: Fractions that one step of the tree rounds together, on average.
FAN = 64
#: Equal rows that one task numbers, on average.
EQUAL = 65536
DECIDED = "array<struct<k0:bigint,k1:bigint,rank:bigint,extra:int>>"


def _running(rows: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """`rows` with the sums over the rows before each in `order`, which tells all rows apart; no task gets all of them.

    Rows are cut into ranges, whose sums are added up over the ranges, one row each, and then within each range. The sums are of whole
    numbers, so they do not depend on the cuts.
    """
    ranged = staged(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(ranged.groupBy("range").agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()]).select(
        "range", *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(f"_{k}") for k in sums]))
    within = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(starts, "range").withColumns({k: F.col(f"_{k}") + F.coalesce(F.sum(v).over(within), F.lit(0)) for k, v in sums.items()})
            .drop("range", *[f"_{k}" for k in sums]))


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets of sources: takes `source`, `source_size`; adds `rank` from 1 and `target`.

    Sources in order of code points, null last, have the weights in turn and share `share` times all sizes.
    No target passes `cap` times its source's size; what would is shared by the others by weight. That is the
    level L at which min(cap * size, L * weight) adds up to the whole. Sources are ranked, and added up in the order in which they
    reach their caps, by ranges, so their number has no bound. The driver gets three totals and the level.
    """
    ranked = _running(sources, [F.col("source").asc_nulls_last()], {"rank": F.lit(1).cast("long")}).withColumn("rank", F.col("rank") + 1)
    turn = (F.col("rank") - 1) % len(weights)
    ranked = (ranked.withColumn("turn", turn).withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), "turn"))
              .withColumn("most", F.col("source_size") * F.lit(float(cap))))
    # Weights are added up as counts of sources in each turn.
    taken = {f"turn{i}": (F.col("turn") == i).cast("long") for i in range(len(weights))}
    rows = _running(ranked, [F.col("most") / F.col("weight"), F.col("rank")], {**taken, "sizes": F.col("source_size")})
    whole, *turns = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), *[F.coalesce(F.sum(v), F.lit(0)) for v in taken.values()]).first()
    left = F.lit(float(whole) * float(share)) - F.col("sizes") * F.lit(float(cap))
    onwards = sum(((F.lit(n) - F.col(f"turn{i}")) * F.lit(float(w)) for i, (n, w) in enumerate(zip(turns, weights))), F.lit(0.0))
    level = staged(rows.withColumn("level", left / onwards).withColumn("capped", F.col("level") * F.col("weight") >= F.col("most")))
    shared = F.lit(level.where("not capped").agg(F.max("level")).first()[0]).cast("double") * F.col("weight")
    return level.withColumn("target", F.when(F.col("capped"), F.col("most")).otherwise(shared)).select(
        "source", "source_size", "rank", "target")


def _uniform(*parts: Column) -> Column:
    """A number from 0 to 1 that depends on the parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0 ** -53)


def _meet(held: Column, new: Column, seed: int) -> Column:
    """One pivotal step: move mass between two fractions until one is whole; hold on to the other.

    The words that both stand for, w * p, stay the same in sum, and each p keeps its expectation.
    """
    up = F.least((1 - held.p) * held.w, new.p * new.w)
    down = F.least(held.p * held.w, (1 - new.p) * new.w)
    raises = _uniform(F.lit(seed), held.k0, held.k1, new.k0, new.k1) * (up + down) < down
    held_whole = F.when(raises, (1 - held.p) * held.w <= new.p * new.w).otherwise(held.p * held.w <= (1 - new.p) * new.w)
    moved = F.when(raises, up).otherwise(-down)
    bounded = lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
    extra = F.when(raises == held_whole, 1).otherwise(0)
    whole = lambda x: F.struct(x.k0.alias("k0"), x.k1.alias("k1"), x["rank"].alias("rank"), extra.alias("extra"))

    def holding(x: Column, p: Column, other: Column) -> Column:
        return F.struct(x.k0.alias("k0"), x.k1.alias("k1"), x["rank"].alias("rank"), x.w.alias("w"), bounded(p).alias("p"),
                        F.concat(held.decided, F.array(whole(other))).alias("decided"))

    return F.when(held_whole, holding(new, new.p - moved / new.w, held)).otherwise(holding(held, held.p + moved / held.w, new))


def _rounded(fractions: DataFrame, chunks: int, seed: int) -> DataFrame:
    """`extra` (0 or 1) for every fraction: columns k0, k1, rank, extra.

    Takes k0, k1, rank (of the source), w > 0, p and chunk. Each step rounds the fractions of a chunk one after
    another, from the largest document down, so that neighbours in size meet and the one that is left tends to be
    small; that one goes on to a chunk of the next step, until each source has one left, which goes to the nearer
    whole number. So the words a source takes miss its target by half of one document at most. Every step is written once, which also bounds what a lost executor costs.
    """
    found = []
    while True:
        row = F.struct("w", "k0", "k1", "rank", "p")
        grouped = fractions.groupBy("rank", "chunk").agg(F.sort_array(F.collect_list(row), asc=False).alias("rows"))
        first = F.col("rows")[0]
        start = F.struct(first.k0.alias("k0"), first.k1.alias("k1"), first["rank"].alias("rank"), first.w.alias("w"),
                         first.p.alias("p"), F.array().cast(DECIDED).alias("decided"))
        step = staged(grouped.select("chunk", F.aggregate(
            F.slice("rows", 2, F.size("rows")), start, lambda held, new: _meet(held, new, seed)).alias("held"))
            .select("chunk", "held.*"))
        found.append(step.select(F.explode("decided").alias("d")).select("d.*"))
        if chunks == 1:
            found.append(step.select("k0", "k1", "rank", (F.col("p") >= 0.5).cast("int").alias("extra")))
            break
        chunks = -(-chunks // FAN)
        fractions = step.select("k0", "k1", "rank", "w", "p", F.floor(F.col("chunk") / FAN).cast("bigint").alias("chunk"))
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.unionByName(more)
    return all_found


def _decided(docs: DataFrame, source: str, text: str, weights: Sequence[float], share: float, cap: float, seed: int) -> DataFrame:
    """The documents with the added columns under names of their own."""
    # Equal rows are told apart by number only, so that any of them may take any of their shares. Their places are written with
    # them, so that they are the same whenever they are read.
    docs = staged(docs.withColumn(f"{OWN}place", F.monotonically_increasing_id()))
    columns = [c for c in hashable(docs) if c != f"{OWN}place"]
    sized = staged(docs.select(*row_key(docs, columns), F.col(f"`{source}`").cast("string").alias("source"),
                               word_count(F.col(f"`{text}`")).alias("size")).groupBy(*KEYS, "source", "size")
                   .agg(F.count("*").alias("rows")))
    per_source = staged(sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                                    F.count("*").alias("distinct"), F.max("rows").alias("equal")))
    targets = staged(source_targets(per_source.select("source", "source_size"), weights, share, cap))
    # Whether they are broadcast is up to Spark, by the bytes it finds in the file, names included.
    targets = targets.withColumnRenamed("source", f"{OWN}source")
    most, equal = per_source.agg(F.max("distinct"), F.max("equal")).first()
    rows = sized.join(targets, F.col("source").eqNullSafe(F.col(f"{OWN}source"))).drop(f"{OWN}source")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (rows.withColumn("base", F.floor(ratio).cast("int")).withColumn("fraction", (ratio - F.floor(ratio)) * F.col("rows"))
            .withColumn("whole", F.floor("fraction").cast("long")).withColumn("p", F.col("fraction") - F.col("whole")))
    chunks = max(1, -(-(most or 0) // FAN))
    fractions = rows.where("size > 0 and p > 0").select(
        F.col(KEYS[0]).alias("k0"), F.col(KEYS[1]).alias("k1"), "rank", F.col("size").cast("double").alias("w"), "p",
        F.pmod(F.col(KEYS[0]), F.lit(chunks)).alias("chunk"))
    extra = _rounded(fractions, chunks, seed)
    rows = (rows.join(extra.select(F.col("k0").alias(KEYS[0]), F.col("k1").alias(KEYS[1]), "extra"), KEYS, "left")
            # A text without words has nothing to balance, so it is drawn by itself.
            .withColumn("extra", F.coalesce("extra", (_uniform(F.lit(seed), *KEYS) < F.col("p")).cast("int"))))
    shares = rows.select(*KEYS, *[F.col(c).alias(OWN + c) for c in ("size", "source_size", "target", "base", "whole", "extra")])
    # Equal rows are numbered within a salt each, on from the number of those in the salts before.
    salt = F.pmod(F.col(f"{OWN}place"), F.lit(max(1, -(-(equal or 0) // EQUAL)))).alias(f"{OWN}salt")
    salted = docs.select("*", *row_key(docs, columns), salt)
    before = Window.partitionBy(*KEYS).orderBy(f"{OWN}salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.groupBy(*KEYS, f"{OWN}salt").agg(F.count("*").alias("n"))
              .select(*KEYS, f"{OWN}salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"{OWN}start")))
    number = F.row_number().over(Window.partitionBy(*KEYS, f"{OWN}salt").orderBy(f"{OWN}place"))
    numbered = salted.withColumn(f"{OWN}number", number).join(starts.join(shares, KEYS), [*KEYS, f"{OWN}salt"]).withColumn(
        f"{OWN}number", F.col(f"{OWN}number") + F.col(f"{OWN}start"))
    more = (F.when(F.col(f"{OWN}number") <= F.col(f"{OWN}whole"), 1)
            .when(F.col(f"{OWN}number") == F.col(f"{OWN}whole") + 1, F.col(f"{OWN}extra")).otherwise(0))
    return numbered.withColumn(f"{OWN}copies", F.col(f"{OWN}base") + more)


def mix(docs: DataFrame, source: str = "source", text: str = "text", weights: Sequence[float] = (3, 1, 2),
        share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """How often a mix takes each document: adds size, source_size, target, copies and taken.

    Sizes are counted in words (null text: none). Sources in order of code points, null last, have `weights` in
    turn and share `share` times all words; none gets more than `cap` times its own. A document's expected
    number of copies is its source's target over its source's size; copies are that number rounded down or up, by
    pivotal rounding that keeps each source's words, so `taken` = size * copies adds up to the target but for
    half a document. A document without words is rounded by itself and takes none. Repeated rows are documents
    of their own. The choice depends on the rows and `seed` only: reruns and other partitionings agree. Added
    columns replace those of the same name; an empty table gives an empty result.
    """
    added = {"size": F.col(f"{OWN}size"), "source_size": F.col(f"{OWN}source_size"), "target": F.col(f"{OWN}target"),
             "copies": F.col(f"{OWN}copies"), "taken": F.col(f"{OWN}size") * F.col(f"{OWN}copies")}
    docs, (source, text), restored = shielded(docs, source, text)
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    return restored(_decided(docs, source, text, weights, share, cap, seed).select(*kept, *[v.alias(k) for k, v in added.items()]))


def mixed(docs: DataFrame, source: str = "source", text: str = "text", weights: Sequence[float] = (3, 1, 2),
          share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """The mix itself: each document as many times as `mix` takes it, with the columns of `docs` as they were."""
    docs, (source, text), restored = shielded(docs, source, text)
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{OWN}copies"))).alias(f"{OWN}copy")
    return restored(_decided(docs, source, text, weights, share, cap, seed).where(F.col(f"{OWN}copies") > 0)
                    .select(*[F.col(f"`{c}`") for c in docs.columns], copies).drop(f"{OWN}copy"))
