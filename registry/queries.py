"""Every registered query: a name and a function of the session and the data folder."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from lakeassay import project
from lakeassay.functions import active_rows, latest_per_key, with_row_hash
from lakeassay.model import DefectSpec, ForeignKey, SilverSpec, TableSpec
from lakeassay.operators import checks, defects, gold, ingest, insights, monitor, silver
from lakeassay.plans.bronze import Origin, load
from lakeassay.plans.incremental import check_changed
from lakeassay.plans.jobs import run_together
from lakeassay.plans.journal import Journal
from lakeassay.plans.suite import staged_suite
from lakeassay.sources import csv, jdbc, tables
from registry import frames, shapes
from registry.frames import RUN, given, moment, plain, shaped

Query = Callable[[SparkSession, str], DataFrame]

DIRTY = TableSpec("orders", "bronze_orders", keys=("o_orderkey",), timestamp="o_orderdate",
                  skip_null_columns=())
DIRTY_EXPECTED = StructType([
    StructField("o_orderkey", LongType()),
    StructField("o_custkey", StringType()),
    StructField("o_totalprice", DoubleType()),
    StructField("o_clerk", StringType()),
])
LINES = TableSpec("lineitem", "bronze_lineitem")


def _dirty(spark, sf):
    return shaped(spark, sf, shapes.DIRTY)


def _subject(spec: TableSpec) -> checks.Subject:
    return checks.Subject(spec.name, spec.layer, RUN)


# Ingest ---------------------------------------------------------------------------------

def lineage_stamp(spark, sf):
    return plain(ingest.stamp_lineage(
        given(spark, sf, "orders"), system="files", schema="tpch", table="orders",
        ingested_at=moment(shapes.LOADED_AT)))


def row_hash(spark, sf):
    return with_row_hash(given(spark, sf, "lineitem"))


def row_hash_safe(spark, sf):
    """Hashes that tell rows apart which the joined form confuses: the nations' names hold separators here."""
    key = F.col("n_nationkey")
    odd = given(spark, sf, "nation").select(
        "n_nationkey",
        F.concat(F.lit("a"), F.when(key % 2 == 0, "||b").otherwise("")).alias("left"),
        F.when(key % 5 != 0, F.concat(F.when(key % 2 == 0, "").otherwise("b||"), F.lit('say "c"\\'))).alias("right"))
    return with_row_hash(odd, mode="safe")


def _loaded_part(spark, sf):
    return given(spark, sf, "orders").where(F.col("o_orderdate") < F.lit(shapes.WATERMARK_BEFORE).cast("timestamp_ntz"))


def high_watermark(spark, sf):
    return ingest.high_watermark(_loaded_part(spark, sf), "o_orderdate")


def incremental_extract(spark, sf, inclusive=False):
    newest = high_watermark(spark, sf).first()["max_watermark"]
    return ingest.after_watermark(given(spark, sf, "orders"), "o_orderdate", newest, inclusive=inclusive)


def _merged(spark, sf, target=frames.orders_target, source=frames.orders_source, keys=("o_orderkey",), full=True):
    return ingest.merge_snapshot(
        target(spark, sf), source(spark, sf), keys, as_of=moment(shapes.RELOADED_AT), full_extract=full)


def cdc_merge(spark, sf):
    return plain(_merged(spark, sf))


def cdc_merge_incremental(spark, sf):
    return plain(_merged(spark, sf, full=False))


def cdc_merge_repeated_keys(spark, sf):
    return plain(_merged(spark, sf, frames.lines_target, frames.lines_source, ("l_orderkey", "l_linenumber")))


def cdc_merge_new_column(spark, sf):
    return plain(_merged(spark, sf, source=frames.orders_wider_source))


def cdc_change_summary(spark, sf):
    return ingest.change_summary(_merged(spark, sf, target=frames.orders_deleted_target))


def cdc_resurrect(spark, sf):
    return plain(_merged(spark, sf, target=frames.orders_deleted_target).where("_op = 'resurrect'"))


def cdc_soft_delete(spark, sf):
    return plain(_merged(spark, sf).where("_op = 'delete'"))


def cdc_surplus_keys(spark, sf):
    return ingest.surplus_keys(frames.lines_source(spark, sf), ("l_orderkey", "l_linenumber"))


def load_full_extracts(spark, sf):
    """Orders loaded twice into a table of files, whole each time, as readers see it then."""
    spec = TableSpec(f"{frames.scratch_database(spark)}.orders", keys=("o_orderkey",))
    origin = Origin("files", "tpch", "orders")
    load(spark, spec, given(spark, sf, "orders"), frames.FIRST_RUN, origin, buckets=8)
    load(spark, spec, frames.orders_changed(spark, sf), frames.SECOND_RUN, origin)
    return plain(spark.table(spec.name))


def load_repeated_keys(spark, sf):
    """Line items, whose keys repeat, loaded twice: the second load's surplus rows beside its changes."""
    spec = TableSpec(f"{frames.scratch_database(spark)}.lines", keys=("l_orderkey", "l_linenumber"))
    origin = Origin("files", "tpch", "lineitem")
    result = load(spark, spec, given(spark, sf, "lineitem"), frames.FIRST_RUN, origin)
    changed = given(spark, sf, "lineitem").withColumn("l_tax", F.when(F.col("l_orderkey") % 7 == 0, 0.5).otherwise(F.col("l_tax")))
    again = load(spark, spec, changed.where("l_orderkey % 10 <> 0"), frames.SECOND_RUN, origin)
    counts = {"first_insert": result.changes["insert"], "first_surplus": result.surplus, **again.changes, "surplus": again.surplus}
    loaded = spark.table(spec.name).agg(F.count("*").alias("row_count"), F.count_if("_is_deleted").alias("deleted"), F.sum("l_tax").cast("decimal(18,2)").alias("tax"))
    return loaded.withColumns({k: F.lit(v).cast("long") for k, v in counts.items()})


def load_events_by_watermark(spark, sf):
    """Events up to a day, then all of them: the second load reads only what came after the newest loaded one."""
    spec = TableSpec(f"{frames.scratch_database(spark)}.events", keys=("event_id",), watermark="ts")
    origin = Origin("files", "tpch", "events")
    events = given(spark, sf, "events")
    load(spark, spec, events.where(F.col("ts") < F.lit(shapes.EVENTS_BEFORE).cast("timestamp_ntz")), frames.FIRST_RUN, origin)
    load(spark, spec, events, frames.SECOND_RUN, origin)
    return plain(spark.table(spec.name))


def csv_roundtrip(spark, sf):
    orders = given(spark, sf, "orders")
    path = f"{tables.scratch_folder(spark, 'csv')}/orders"
    csv.write_csv(orders, path)
    return csv.read_csv(spark, path, orders.schema)


def csv_rejects(spark, sf):
    """Orders as lines of text, some of them broken: what is kept, and what is rejected and why."""
    path = f"{tables.scratch_folder(spark, 'csv')}/orders"
    shaped(spark, sf, shapes.ORDER_LINES).write.text(path)
    layout = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", IntegerType()),
                         StructField("o_orderstatus", StringType()), StructField("o_orderpriority", StringType())])
    found = csv.split_csv(spark, path, layout, header=False)
    kept = found.kept.select(F.concat_ws(",", *layout.fieldNames()).alias("record"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(found.rejected.drop("file"))


def jdbc_balanced_ranges(spark, sf):
    """The ranges that a scan of orders by a text key is split into, held against the rows themselves."""
    rows = given(spark, sf, "orders").select(F.concat(F.lit("NCT"), "o_orderkey").alias("nct_id"))
    sample = rows.orderBy(F.xxhash64("nct_id")).limit(4000).orderBy("nct_id").collect()
    conditions = jdbc.range_predicates("nct_id", jdbc.quantile_boundaries([r[0] for r in sample], 16))
    hits = [F.expr(c).cast("int") for c in conditions]
    counts = rows.select(sum(hits, F.lit(0)).alias("covered"), F.explode(F.array(*[F.when(h == 1, i) for i, h in enumerate(hits)])).alias("part"))
    parts = counts.where("part IS NOT NULL").groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("covered") == 1).alias("once"))
    return parts.agg(F.sum("n").alias("row_count"), F.sum("once").alias("covered_once"), F.count("*").alias("parts"),
                     (F.max("n") < 2 * F.median("n")).alias("balanced"))


# Cleaning -------------------------------------------------------------------------------

def silver_dedupe(spark, sf):
    return plain(latest_per_key(frames.lines_target(spark, sf), ("l_orderkey", "l_linenumber")))


def silver_dedupe_normalised(spark, sf):
    spec = SilverSpec(
        keys=project.KEYS["interventions"], required=("nct_id",), lower_trim=("intervention_type",),
        trim=("name",), dedupe="normalised")
    return plain(silver.standardise(frames.bronze(spark, sf, "interventions"), spec))


def silver_trim_lower(spark, sf):
    spec = SilverSpec(keys=("nct_id",), required=(), trim=("brief_title", "phase"), lower_trim=("overall_status",))
    raw = shaped(spark, sf, shapes.TRIAL["studies"])
    return silver.clean_columns(raw, spec)


def silver_parse_ts(spark, sf):
    spec = SilverSpec(keys=("nct_id",), required=(), timestamps=("last_update_posted_date",))
    raw = shaped(spark, sf, shapes.TRIAL["studies"])
    return plain(silver.clean_columns(raw, spec))


def silver_key_not_null(spark, sf):
    return silver.require_columns(shaped(spark, sf, shapes.TRIAL["studies"]), "nct_id")


def silver_metadata_last(spark, sf):
    rows = frames.bronze(spark, sf, "facilities")
    return plain(silver.lineage_last(rows.select(*sorted(rows.columns))))


def silver_like(table, spark, sf):
    return plain(frames.silver(spark, sf, table))


# Aggregates -----------------------------------------------------------------------------

def gold_status_counts(spark, sf):
    return gold.study_status_counts(frames.silver(spark, sf, "studies"))


def gold_phase_summary(spark, sf):
    return gold.phase_summary(frames.silver(spark, sf, "studies"))


def gold_condition_intervention(spark, sf):
    return gold.condition_intervention_summary(*(
        frames.silver(spark, sf, t) for t in ("studies", "conditions", "interventions")))


# Checks ---------------------------------------------------------------------------------

def dq_null_rate(spark, sf):
    return plain(checks.null_rate(active_rows(_dirty(spark, sf)), _subject(DIRTY)))


def dq_duplicate_rate(spark, sf):
    return plain(checks.duplicate_rate(active_rows(_dirty(spark, sf)), _subject(DIRTY), keys=DIRTY.keys))


def dq_duplicate_rate_all_columns(spark, sf):
    return plain(checks.duplicate_rate(active_rows(_dirty(spark, sf)), _subject(DIRTY)))


def dq_schema_conformity(spark, sf):
    """The layout check beside the null rates of the same columns."""
    spec = TableSpec(DIRTY.name, DIRTY.layer, expected_schema=DIRTY_EXPECTED, skip_null_columns=())
    return plain(checks.run_checks(_dirty(spark, sf), spec, RUN, checks=("null_rate", "schema_conformity")))


def dq_outlier_rate(spark, sf):
    return plain(checks.outlier_rate(active_rows(_dirty(spark, sf)), _subject(DIRTY)))


def dq_outlier_rate_events(spark, sf):
    return plain(checks.outlier_rate(given(spark, sf, "events"), checks.Subject("events", "bronze_events", RUN)))


def dq_freshness(spark, sf):
    return plain(checks.freshness(active_rows(_dirty(spark, sf)), _subject(DIRTY), "o_orderdate"))


def _integrity(spark, sf, include_deleted):
    return plain(checks.referential_integrity(
        given(spark, sf, "lineitem"), shaped(spark, sf, shapes.PARENTS), _subject(LINES),
        column="l_orderkey", ref_table="orders", ref_column="o_orderkey", ref_include_deleted=include_deleted))


def dq_orphan_rows(spark, sf):
    return checks.orphan_rows(given(spark, sf, "documents"), given(spark, sf, "labels"), column="doc_id", ref_column="doc_id")


def dq_run_all(spark, sf):
    spec = TableSpec(
        DIRTY.name, DIRTY.layer, keys=DIRTY.keys, timestamp=DIRTY.timestamp, expected_schema=DIRTY_EXPECTED,
        foreign_keys=(ForeignKey("o_custkey", "customer", "c_custkey"),), skip_null_columns=())
    return plain(checks.run_checks(
        _dirty(spark, sf), spec, RUN, references={"customer": given(spark, sf, "customer")}))


def dq_run_all_include_deleted(spark, sf):
    spec = TableSpec(DIRTY.name, DIRTY.layer, keys=DIRTY.keys, timestamp=DIRTY.timestamp,
                     include_deleted=True, skip_null_columns=())
    return plain(checks.run_checks(_dirty(spark, sf), spec, RUN))


GIVEN_SPECS = [
    TableSpec("customer", "bronze_customer", keys=("c_custkey",),
              foreign_keys=(ForeignKey("c_nationkey", "nation", "n_nationkey"),)),
    TableSpec("orders", "bronze_orders", keys=("o_orderkey",), timestamp="o_orderdate",
              foreign_keys=(ForeignKey("o_custkey", "customer", "c_custkey"),)),
    TableSpec("lineitem", "bronze_lineitem", keys=("l_orderkey", "l_linenumber"), timestamp="l_shipdate",
              foreign_keys=(ForeignKey("l_orderkey", "orders", "o_orderkey"),
                            ForeignKey("l_partkey", "part", "p_partkey"),
                            ForeignKey("l_suppkey", "supplier", "s_suppkey"))),
    TableSpec("part", "bronze_part", keys=("p_partkey",)),
    TableSpec("supplier", "bronze_supplier", keys=("s_suppkey",),
              foreign_keys=(ForeignKey("s_nationkey", "nation", "n_nationkey"),)),
    TableSpec("nation", "bronze_nation", keys=("n_nationkey",),
              foreign_keys=(ForeignKey("n_regionkey", "region", "r_regionkey"),)),
    TableSpec("region", "bronze_region", keys=("r_regionkey",)),
    TableSpec("events", "bronze_events", keys=("event_id",), timestamp="ts"),
    TableSpec("documents", "bronze_documents", keys=("text",),
              foreign_keys=(ForeignKey("doc_id", "labels", "doc_id"),)),
    TableSpec("labels", "bronze_labels", keys=("doc_id",),
              foreign_keys=(ForeignKey("doc_id", "documents", "doc_id"),)),
    TableSpec("pages", "bronze_pages", keys=("page_id",)),
    TableSpec("benchmark", "bronze_benchmark", keys=("item_id",)),
    TableSpec("conversations", "bronze_conversations", keys=("conv_id", "turn")),
    TableSpec("embeddings", "bronze_embeddings", keys=("vec_id",)),
]


def dq_suite_given(spark, sf):
    """The suite over the given tables as they are, several of them at a time."""
    return plain(staged_suite({s.name: given(spark, sf, s.name) for s in GIVEN_SPECS}, GIVEN_SPECS, RUN, staging=tables.Staging(spark)))


def staged_layers(spark, sf, staging):
    """The nineteen tables of the project, built from the given ones and written once, and the columns by which some are in buckets.

    Loaded and cleaned tables are in buckets of their first key column if its values are even enough. Then neither cleaning
    nor checks of keys shuffle them.
    """
    def together(planned, buckets=None):
        results = run_together([
            partial(staging.stage, df, *(buckets or {}).get(short.partition("_")[2], ())) for short, df in planned.items()])
        return dict(zip(planned, results))

    def bucketed(table, df):
        return project.KEYS[table][0], tables.even_buckets(df, project.KEYS[table][0])

    loaded = {t: frames.bronze(spark, sf, t) for t in project.KEYS}
    buckets = dict(zip(loaded, run_together([partial(bucketed, t, df) for t, df in loaded.items()])))
    with tables.small_splits(spark):
        bronze = together({f"bronze_{t}": df for t, df in loaded.items()}, buckets)
    clean = together({
        f"silver_{t}": silver.standardise(bronze[f"bronze_{t}"], spec) for t, spec in project.SILVER.items()}, buckets)
    studies = clean["silver_studies"]
    totals = together({
        "gold_study_status_counts": gold.study_status_counts(studies),
        "gold_phase_summary": gold.phase_summary(studies),
        "gold_condition_intervention_summary": gold.condition_intervention_summary(
            studies, clean["silver_conditions"], clean["silver_interventions"]),
    })
    gathered = {
        project.table_name(f"{stage}_{t}"): column
        for t, (column, count) in buckets.items() if count for stage in ("bronze", "silver")}
    return {project.table_name(short): df for short, df in {**bronze, **clean, **totals}.items()}, gathered


def dq_suite(spark, sf):
    """All checks of all nineteen tables as one run, with the layouts the project declares.

    The tables go once they are checked; the metrics stay for whoever reads the result.
    """
    kept = tables.Staging(spark)
    with tables.Staging(spark) as staging:
        layers, gathered = staged_layers(spark, sf, staging)
        metrics = staged_suite(layers, project.quality_specs(expected=project.LAYOUTS), RUN, staging=staging, gathered=gathered)
        return plain(kept.stage(metrics.coalesce(1)))


def dq_incremental(spark, sf):
    """Orders loaded and checked twice; the second check reads only buckets that the second load wrote."""
    spec = TableSpec(f"{frames.scratch_database(spark)}.orders", "bronze_orders", keys=("o_orderkey",), timestamp="o_orderdate")
    table, origin, staging = tables.KeyedTable(spark, spec.name), Origin("files", "tpch", "orders"), tables.Staging(spark)
    load(spark, spec, given(spark, sf, "orders"), frames.FIRST_RUN, origin, buckets=32)
    check_changed(spark, table, spec, RUN, staging=staging)
    load(spark, spec, frames.orders_changed(spark, sf).where("o_orderkey % 50 <> 1"), frames.SECOND_RUN, origin)
    return plain(check_changed(spark, table, spec, RUN, staging=staging).metrics.withColumn("table_name", F.lit("orders")))


# Insights -------------------------------------------------------------------------------

def _newest(spark, sf):
    return monitor.latest_run(frames.metrics(spark, sf))


def insight_ranked_metrics(spark, sf):
    return plain(insights.ranked_metrics(frames.metrics(spark, sf)))


def insight_pass_fail(spark, sf):
    return plain(insights.pass_fail_counts(frames.metrics(spark, sf)))


def insight_rows(spark, sf):
    metrics = frames.metrics(spark, sf)
    return plain(insights.insight_rows(metrics, insights.rule_based_responses(metrics), RUN.timestamp))


def insight_rows_of_parts(spark, sf):
    """One answer for each run and table, some of which cannot be read."""
    metrics = frames.metrics(spark, sf)
    parts = metrics.select(*insights.PART).distinct()
    responses = parts.select(*monitor.RUN, "table_name", F.expr(shapes.PART_RESPONSE).alias("raw_response"))
    return plain(insights.insight_rows(metrics, responses, RUN.timestamp))


def insight_whole_suite(spark, sf):
    """The summaries of a run of more than 150 metrics, which hold every one of them."""
    return plain(insights.metric_lines(dq_suite(spark, sf)))


def insight_latest(spark, sf):
    return plain(insights.insights_for_latest_run(frames.metrics(spark, sf), RUN.timestamp))


def _counted(prompt):
    """What stands for a model here: it counts, and fails on one table."""
    if " table=t1 " in prompt:
        raise ValueError("no answer")
    return json.dumps({"summary": f"{len(prompt)} characters", "severity": "low"})


def insight_journal(spark, sf):
    """The journal after all prompts were asked twice: answers once, failures twice."""
    journal = Journal(spark, f"{frames.scratch_database(spark)}.answers", "counter")
    asking = insights.prompts(frames.metrics(spark, sf))
    for run in (frames.FIRST_RUN, frames.SECOND_RUN):
        journal.ask(asking, _counted, run.timestamp, commit_every=60)
    return spark.table(journal.table).groupBy("prompt_hash", "raw_response", "error").agg(F.count("*").alias("asked"))


# Defects --------------------------------------------------------------------------------

def inject_nulls(spark, sf):
    return defects.inject_nulls(given(spark, sf, "orders"), "o_orderkey", ["o_custkey", "o_totalprice"], 0.05, seed=7)


def inject_duplicates(spark, sf):
    return defects.inject_duplicates(given(spark, sf, "orders"), "o_orderkey", 0.03, seed=5)


def inject_exact_duplicates(spark, sf):
    """How many orders, and how many different ones, there are with copies of exactly three in a hundred."""
    copied = defects.inject_exact_duplicates(given(spark, sf, "orders"), 0.03, seed=5, bucket_rows=1000)
    per_key = copied.groupBy("o_orderkey").agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("row_count"), F.count("*").alias("kinds"))


def inject_outliers(spark, sf):
    return defects.inject_outliers(given(spark, sf, "orders"), "o_orderkey", "o_totalprice", 0.01, seed=11)


def inject_stale(spark, sf):
    return defects.inject_stale(
        given(spark, sf, "orders"), "o_orderkey", "o_orderdate", moment(shapes.AS_OF), 0.02, seed=13)


def inject_schema_drift(spark, sf):
    return defects.drop_columns(given(spark, sf, "orders"), "o_orderstatus")


CORRUPTION = DefectSpec(
    key="o_orderkey", null_columns=("o_custkey", "o_totalprice", "o_orderstatus"), outlier_column="o_totalprice",
    stale_column="o_orderdate", drop_columns=("o_orderpriority",), seed=42)


def inject_all(spark, sf):
    return defects.corrupt(given(spark, sf, "orders"), CORRUPTION, moment(shapes.AS_OF))


def inject_then_check(spark, sf):
    spec = TableSpec("orders", "corrupted_orders", keys=("o_orderkey",), timestamp="o_orderdate")
    return plain(checks.run_checks(inject_all(spark, sf), spec, RUN))


def _on_metrics(query, spark, sf):
    return plain(query(frames.metrics(spark, sf)))


def _on_insights(query, spark, sf):
    return plain(query(frames.insights(spark, sf)))


def mon_run_baseline(spark, sf):
    """Runs of which some share a day, each against the seven days before its own instant."""
    metrics = frames.metrics(spark, sf).withColumn("run_timestamp", F.expr(shapes.TWO_A_DAY))
    return plain(monitor.run_baseline(metrics))


QUERIES: dict[str, Query] = {
    "lineage_stamp": lineage_stamp,
    "row_hash": row_hash,
    "row_hash_safe": row_hash_safe,
    "high_watermark": high_watermark,
    "incremental_extract": incremental_extract,
    "incremental_extract_inclusive": partial(incremental_extract, inclusive=True),
    "cdc_merge": cdc_merge,
    "cdc_merge_incremental": cdc_merge_incremental,
    "cdc_merge_repeated_keys": cdc_merge_repeated_keys,
    "cdc_merge_new_column": cdc_merge_new_column,
    "cdc_change_summary": cdc_change_summary,
    "cdc_resurrect": cdc_resurrect,
    "cdc_soft_delete": cdc_soft_delete,
    "cdc_surplus_keys": cdc_surplus_keys,
    "load_full_extracts": load_full_extracts,
    "load_repeated_keys": load_repeated_keys,
    "load_events_by_watermark": load_events_by_watermark,
    "csv_roundtrip": csv_roundtrip,
    "csv_rejects": csv_rejects,
    "jdbc_balanced_ranges": jdbc_balanced_ranges,
    "active_rows": lambda spark, sf: active_rows(_dirty(spark, sf)),
    "active_rows_strict": lambda spark, sf: active_rows(_dirty(spark, sf), null_is_active=False),
    "include_deleted_rows": lambda spark, sf: active_rows(_dirty(spark, sf), include_deleted=True),
    "silver_dedupe": silver_dedupe,
    "silver_dedupe_normalised": silver_dedupe_normalised,
    "silver_trim_lower": silver_trim_lower,
    "silver_parse_ts": silver_parse_ts,
    "silver_key_not_null": silver_key_not_null,
    "silver_metadata_last": silver_metadata_last,
    **{f"silver_{t}_like": partial(silver_like, t) for t in project.KEYS},
    "gold_status_counts": gold_status_counts,
    "gold_phase_summary": gold_phase_summary,
    "gold_condition_intervention": gold_condition_intervention,
    "dq_null_rate": dq_null_rate,
    "dq_duplicate_rate": dq_duplicate_rate,
    "dq_duplicate_rate_all_columns": dq_duplicate_rate_all_columns,
    "dq_schema_conformity": dq_schema_conformity,
    "dq_outlier_rate": dq_outlier_rate,
    "dq_outlier_rate_events": dq_outlier_rate_events,
    "dq_freshness": dq_freshness,
    "dq_referential_integrity": partial(_integrity, include_deleted=False),
    "dq_ref_include_deleted": partial(_integrity, include_deleted=True),
    "dq_orphan_rows": dq_orphan_rows,
    "dq_run_all": dq_run_all,
    "dq_run_all_include_deleted": dq_run_all_include_deleted,
    "dq_suite_given": dq_suite_given,
    "dq_suite": dq_suite,
    "dq_incremental": dq_incremental,
    "mon_quality_score": partial(_on_metrics, monitor.quality_score),
    "mon_failed_checks": partial(_on_metrics, monitor.failed_checks),
    "mon_score_by_layer": partial(_on_metrics, monitor.score_by_layer),
    "mon_score_by_stage": partial(_on_metrics, monitor.score_by_stage),
    "mon_score_by_table": partial(_on_metrics, monitor.score_by_table),
    "mon_failing_checks": partial(_on_metrics, monitor.failing_checks),
    "mon_ri_failures": partial(_on_metrics, monitor.referential_failures),
    "mon_null_hotspots": partial(_on_metrics, monitor.null_hotspots),
    "mon_latest_insight": partial(_on_insights, monitor.latest_insight),
    "mon_severity_trend": partial(_on_insights, monitor.severity_trend),
    "mon_score_alerts": partial(_on_metrics, monitor.score_alerts),
    "mon_rolling_baseline": partial(_on_metrics, monitor.rolling_baseline),
    "mon_run_baseline": mon_run_baseline,
    "insight_latest_run": lambda spark, sf: plain(_newest(spark, sf)),
    "insight_ranked_metrics": insight_ranked_metrics,
    "insight_pass_fail": insight_pass_fail,
    "insight_metric_lines": partial(_on_metrics, insights.metric_lines),
    "insight_top_failures": partial(_on_metrics, insights.top_failures),
    "insight_prompt": partial(_on_metrics, insights.prompts),
    "insight_parse": lambda spark, sf: insights.parse_responses(shaped(spark, sf, shapes.RESPONSES)),
    "insight_rule_based": partial(_on_metrics, insights.rule_based_responses),
    "insight_rows": insight_rows,
    "insight_rows_of_parts": insight_rows_of_parts,
    "insight_whole_suite": insight_whole_suite,
    "insight_latest": insight_latest,
    "insight_journal": insight_journal,
    "inject_nulls": inject_nulls,
    "inject_duplicates": inject_duplicates,
    "inject_exact_duplicates": inject_exact_duplicates,
    "inject_outliers": inject_outliers,
    "inject_stale": inject_stale,
    "inject_schema_drift": inject_schema_drift,
    "inject_all": inject_all,
    "inject_then_check": inject_then_check,
}
