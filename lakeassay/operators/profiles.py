"""Profiles of the parts of a table, which add up to the profile of the whole.

A part is a set of rows that is written once. Its profile therefore never changes: when other parts are
replaced, only theirs are measured again. Outlier counts depend on the mean and spread of the whole table; each part keeps, beside
its count, the values next to the limits, which tell whether the count still holds when the limits move a little.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeassay.functions import quoted
from lakeassay.functions.text import literal, name
from lakeassay.operators.checks import BATCH_COLUMNS, numeric_columns

#: The profile of a part's rows as such stands under this column name: their number, and their distinct keys as `filled`.
ROWS = ""


def _number(column: str) -> str:
    return f"double({name(column)})"


def _known(column: str) -> str:
    # NaN would make the mean and the spread NaN and so hide every outlier.
    return f"if(isnan({_number(column)}), NULL, {_number(column)})"


def _long(rows: DataFrame, part: str, wanted: Mapping[str, Mapping[str, str]], active: str) -> DataFrame:
    """One row per part and column of the aggregates `wanted`, by column and field; `active` rows count, but each part has rows."""
    frames = []
    columns = list(wanted)
    for start in range(0, len(columns), BATCH_COLUMNS):
        batch = columns[start : start + BATCH_COLUMNS]
        terms = [F.expr(f"{sql.replace('{active}', active)} AS {field}_{i}") for i, c in enumerate(batch) for field, sql in wanted[c].items()]
        sums = rows.groupBy(quoted(part).alias("part")).agg(*terms)
        fields = [f"struct({literal(c)} AS column_name, " + ", ".join(f"{f}_{i} AS {f}" for f in wanted[c]) + ")" for i, c in enumerate(batch)]
        frames.append(sums.selectExpr("part", f"inline(array({', '.join(fields)}))"))
    return reduce(DataFrame.unionByName, frames)


def profile_parts(rows: DataFrame, part: str, columns: Sequence[str], *, keys: str, timestamp: str | None = None, active: str = "true") -> DataFrame:
    """Per part and column: `total` active rows, `filled` ones, `nan`, and count `n`, `mean` and second central moment `m2` of numbers.

    `latest` is the newest `timestamp`, under that column. The row under ROWS has the part's distinct `keys` as `filled`.
    One aggregate over the parts, with one row per part and column in the shuffle.
    """
    numbers = set(numeric_columns(rows))
    where = "FILTER (WHERE {active})"

    def of(column: str) -> dict[str, str]:
        known = _known(column) if column in numbers else "CAST(NULL AS double)"
        return {
            "total": f"count(1) {where}", "filled": f"count({name(column)}) {where}",
            "nan": f"count(if(isnan({_number(column)}), 1, NULL)) {where}" if column in numbers else "0L",
            "n": f"count({known}) {where}", "mean": f"avg({known}) {where}",
            "m2": f"var_pop({known}) {where} * count({known}) {where}",
            "latest": f"max(try_cast({name(column)} AS timestamp)) {where}" if column == timestamp else "CAST(NULL AS timestamp)"}

    wanted = list(dict.fromkeys([*columns, *([timestamp] if timestamp else [])]))
    # Rows of one key are in one part, so grouping by both needs no shuffle where the table is stored by the key.
    kinds = (rows.groupBy(quoted(part).alias("part"), quoted(keys)).agg(F.expr(f"count(1) FILTER (WHERE {active}) AS n"))
             .groupBy("part").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("filled")))
    kinds = kinds.selectExpr("part", f"{literal(ROWS)} AS column_name", "total", "filled", "0L AS nan", "0L AS n",
                             "CAST(NULL AS double) AS mean", "CAST(NULL AS double) AS m2", "CAST(NULL AS timestamp) AS latest")
    return kinds.unionByName(_long(rows, part, {c: of(c) for c in wanted}, active)) if wanted else kinds


def combined(profiles: DataFrame) -> DataFrame:
    """The profile of the whole per column, with `std`, the sample deviation, in place of `m2`.

    Moments are merged two at a time, in the order of the parts, so reruns agree.
    """
    moment = F.struct("part", F.col("n").cast("double").alias("n"), "mean", "m2")
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), ((a["n"] * a["mean"] + b["n"] * b["mean"]) / n).alias("mean"),
                        (a["m2"] + b["m2"] + F.when(a["n"] > 0, apart * apart * a["n"] * b["n"] / n).otherwise(0.0)).alias("m2"))

    sums = profiles.groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in ("total", "filled", "nan")], F.max("latest").alias("latest"),
        F.array_sort(F.collect_list(F.when(F.col("n") > 0, moment))).alias("moments"))
    whole = sums.withColumn("whole", F.aggregate("moments", start, merge))
    return whole.select("column_name", "total", "filled", "nan", "latest", F.col("whole.n").cast("long").alias("n"),
                        F.when(F.col("whole.n") > 0, F.col("whole.mean")).alias("mean"),
                        F.when(F.col("whole.n") > 1, F.sqrt(F.col("whole.m2") / (F.col("whole.n") - 1))).alias("std"))


def _far(value: str, mean: str, std: str, limit: float) -> str:
    return f"coalesce(abs(try_divide({value} - {mean}, {std})) > {limit!r}D, false)"


def count_tails(rows: DataFrame, part: str, spreads: Mapping[str, tuple[float, float]], limit: float, *, active: str = "true") -> DataFrame:
    """Per part and column, how many active values lie `far` from the mean, and the values next to either limit on both sides."""

    def of(column: str, mean: float, std: float) -> dict[str, str]:
        x, m = _known(column), f"{mean!r}D"
        far = _far(_known(column), m, f"{std!r}D", limit)
        where = "FILTER (WHERE {active} AND "
        return {"far": f"count(1) {where}{far})",
                "inner_low": f"min({x}) {where}NOT {far})", "inner_high": f"max({x}) {where}NOT {far})",
                "outer_low": f"max({x}) {where}{far} AND {x} < {m})", "outer_high": f"min({x}) {where}{far} AND {x} > {m})"}

    return _long(rows, part, {c: of(c, *s) for c, s in spreads.items()}, active).withColumn("z_limit", F.lit(limit))


def still_hold(tails: DataFrame, spreads: DataFrame, limit: float) -> DataFrame:
    """Those counts that another mean and spread (`column_name`, `mean`, `std`) leave as they are: no value has changed sides.

    The deviation of a value rises and falls with the value, so the values next to the limits speak for all others.
    """
    def far(c: str) -> str:
        return _far(c, "mean", "std", limit)

    inside = [f"({c} IS NULL OR NOT {far(c)})" for c in ("inner_low", "inner_high")]
    outside = [f"({c} IS NULL OR ({far(c)} AND {c} {side} mean))" for c, side in (("outer_low", "<"), ("outer_high", ">"))]
    return (tails.where(F.col("z_limit") == limit).join(spreads, "column_name")
            .where(" AND ".join(inside + outside)).drop("mean", "std"))
