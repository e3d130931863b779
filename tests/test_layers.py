import random
from datetime import datetime

import pytest
from conftest import executed_plan
from pyspark.sql import functions as F

from lakeassay import project
from lakeassay.functions import with_row_hash
from lakeassay.model import SilverSpec
from lakeassay.operators import gold, silver


def bronze(spark, rows, layout):
    df = spark.createDataFrame(rows, layout + ", _ingested_at timestamp, _is_deleted boolean")
    return with_row_hash(df)


T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_standardise_studies(spark):
    df = bronze(spark, [
        ("N1", " Title ", None, " RECRUITING", " P1 ", "X ", "2024-03-01", T0, False),
        ("N1", " Newer ", "o", " DONE", " P2 ", "Y ", "junk", T1, False),
        ("N2", "gone", None, "a", "b", "c", None, T0, True),
        ("N3", "unknown", None, "a", "b", "c", None, T0, None),
        (None, "no key", None, "a", "b", "c", None, T0, False),
    ], "nct_id string, brief_title string, official_title string, overall_status string, phase string, "
       "study_type string, last_update_posted_date string")
    result = silver.standardise(df, project.SILVER["studies"])
    assert result.columns[-3:] == ["_ingested_at", "_row_hash", "_is_deleted"]
    rows = result.collect()
    assert [(r.nct_id, r.brief_title, r.official_title, r.overall_status, r.phase, r.study_type, r.last_update_posted_date)
            for r in rows] == [("N1", "Newer", "o", "done", "P2", "y", None)]


def test_dedupe_before_or_after_cleaning(spark):
    df = bronze(spark, [("N1", "a", T0, False), ("N1", " a", T0, False)], "nct_id string, name string")
    raw = SilverSpec(keys=("nct_id", "name"), required=("nct_id",), trim=("name",))
    assert silver.standardise(df, raw).count() == 2
    normalised = SilverSpec(keys=("nct_id", "name"), required=("nct_id",), trim=("name",), dedupe="normalised")
    assert silver.standardise(df, normalised).count() == 1
    with pytest.raises(ValueError):
        SilverSpec(keys=("a",), required=(), dedupe="later")


def test_required_column_is_tested_on_the_survivor(spark):
    df = bronze(spark, [(1, "N1", "t", "x", T0, False), (1, None, "t", "x", T1, False)],
                "id int, nct_id string, outcome_type string, title string")
    assert silver.standardise(df, project.SILVER["outcomes"]).count() == 0


def test_trim_removes_spaces_only(spark):
    df = spark.createDataFrame([("\t x ",)], "v string")
    spec = SilverSpec(keys=("v",), required=(), trim=("v",))
    assert silver.clean_columns(df, spec).first().v == "\t x"


def test_every_source_table_has_a_clean_up(spark):
    assert set(project.SILVER) == set(project.KEYS)
    assert all(project.SILVER[t].keys == keys for t, keys in project.KEYS.items())


def test_distinct_counts_ignore_repeats_and_keep_null_groups(spark):
    df = spark.createDataFrame(
        [("N1", "a"), ("N1", "a"), ("N2", "a"), ("N3", None)], "nct_id string, overall_status string")
    assert [tuple(r) for r in gold.study_status_counts(df).collect()] == [("a", 2), (None, 1)]


def _coverage(studies, conditions, interventions):
    groups = {}
    for s in {s for s in studies if s is not None}:
        for c in {n for k, n in conditions if k == s} or {None}:
            for i in {t for k, t in interventions if k == s} or {None}:
                groups.setdefault((c, i), set()).add(s)
    return sorted(((c, i, len(v)) for (c, i), v in groups.items()), key=str)


def test_coverage_against_a_plain_python_model(spark):
    rng = random.Random(3)
    for _ in range(3):
        studies = [rng.choice(["a", "b", "c", "d", "e", None]) for _ in range(8)]
        conditions = [(rng.choice("abcxy"), rng.choice(["k", "l", None])) for _ in range(12)]
        interventions = [(rng.choice("abcxy"), rng.choice(["drug", "device", None])) for _ in range(8)]
        result = gold.condition_intervention_summary(
            spark.createDataFrame([(s,) for s in studies], "nct_id string"),
            spark.createDataFrame(conditions, "nct_id string, name string"),
            spark.createDataFrame(interventions, "nct_id string, intervention_type string"))
        assert sorted((tuple(r) for r in result.collect()), key=str) == _coverage(studies, conditions, interventions)


def test_study_with_a_third_of_all_conditions_is_split(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")

    def study(share):
        return F.concat(F.lit("N"), share.cast("string")).alias("nct_id")

    number = F.col("id")
    studies = spark.range(2000).select(study(number))
    conditions = spark.range(150000).repartition(16).select(
        study(F.when(number % 3 == 0, 7).otherwise(number % 2000)), F.concat(F.lit("c"), number).alias("name"))
    interventions = spark.range(3000).select(
        study(number % 1900), F.concat(F.lit("t"), number % 5).alias("intervention_type"))
    result = gold.condition_intervention_summary(studies, conditions, interventions)
    assert "SortMergeJoin(skew=true)" in executed_plan(result)
    hot = result.where("condition_name = 'c3'").collect()
    assert {r.intervention_type: r.study_count for r in hot} == {"t2": 1}
