"""Business aggregates over cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeassay.functions import quoted


def distinct_counts(df: DataFrame, by: list[str], key: str, *, name: str = "study_count") -> DataFrame:
    """Distinct keys per group. Order is left to readers: a written table does not keep it."""
    return df.groupBy(*map(quoted, by)).agg(F.count_distinct(quoted(key)).alias(name))


def study_status_counts(studies: DataFrame) -> DataFrame:
    return distinct_counts(studies, ["overall_status"], "nct_id")


def phase_summary(studies: DataFrame) -> DataFrame:
    return distinct_counts(studies, ["phase", "study_type"], "nct_id")


def _childless(values: DataFrame, keys: DataFrame) -> DataFrame:
    """The studies that have none of the values."""
    return keys.join(values.select("nct_id"), "nct_id", "left_anti")


def condition_intervention_summary(studies: DataFrame, conditions: DataFrame, interventions: DataFrame) -> DataFrame:
    """Studies per pair of condition and intervention type; null where a study has none.

    Each child is read once and reduced to distinct values before the two meet, so each
    study comes out once per pair and a plain count is already the distinct count.

    Left joins are written as an inner join plus the studies without children, which come
    from the same distinct values. Spark can split a skewed key on either side of an inner
    join, but never on the right of a left join, where a study with very many children
    would sit. For the split both inputs must come straight from a shuffle: hence the join
    on a struct, by which nothing below it is partitioned yet.
    """
    keys = studies.select("nct_id").where("nct_id IS NOT NULL").distinct()
    names = conditions.select("nct_id", F.col("name").alias("condition_name")).where("nct_id IS NOT NULL").distinct()
    types = interventions.select("nct_id", "intervention_type").where("nct_id IS NOT NULL").distinct()

    study = F.struct("nct_id").alias("study")
    # One side without children of unknown studies is enough to keep them out of an inner join.
    named = names.unionByName(_childless(names, keys), allowMissingColumns=True).select(study, "condition_name")
    typed = (types.join(keys, "nct_id", "left_semi").unionByName(_childless(types, keys), allowMissingColumns=True)
             .select(study, "intervention_type"))
    return (
        named.join(typed, "study")
        .groupBy("condition_name", "intervention_type")
        .agg(F.count(F.lit(1)).alias("study_count")))
