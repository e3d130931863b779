"""From metric rows to written insights.

Every step works on all runs at once; restrict the metrics with `latest_run` to treat
only the newest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lakeassay.functions.text import iso_text, literal, number_text, share, truth_text
from lakeassay.operators.monitor import RUN, latest_run
from lakeassay.schemas import INSIGHT_SCHEMA, RESPONSE_SCHEMA, SEVERITIES

PROMPT_TEMPLATE = (Path(__file__).parent.parent / "prompts" / "quality_insight.md").read_text(encoding="utf-8")

# Wording that readers of the summaries and prompts rely on.
DOMAIN = "AACT clinical trials with CDC-aware Bronze and Silver layers"
NO_FAILURES = "No failing checks in the latest run."

# Likely cause and next step per kind of check, for insights made without a model.
EXPLANATIONS = {
    "null_rate": (
        "values are missing at the source or were lost on load",
        "compare the column's nulls with the source table"),
    "duplicate_rate": (
        "the same key was loaded more than once",
        "review the business key and the merge of this table"),
    "schema_conformity": (
        "a column was dropped or changed its type upstream",
        "align the expected schema with the source"),
    "outlier_rate": (
        "values are far from the usual range, as after a change of unit",
        "inspect the extreme values of the column"),
    "freshness_hours": (
        "the load has not delivered new records",
        "check the last runs of the ingest job"),
    "referential_integrity": (
        "child rows arrived without their parent or the parent was deleted",
        "reload the referenced table, then list the orphan rows"),
}


# What one prompt is about: a table in one run. Its metrics are as many as it has columns and checks,
# so no task ever holds a whole run.
PART = (*RUN, "layer", "table_name")
ORDER = ("passed", "check_name", "column_name", "metric_value", "details")


def ranked_metrics(metrics: DataFrame) -> DataFrame:
    """All metrics with their position within their run and table in `rank`, failures first."""
    window = Window.partitionBy(*PART).orderBy(*ORDER)
    return metrics.withColumn("rank", F.row_number().over(window))


def _counts() -> list[Column]:
    structural = F.col("check_name").isin("referential_integrity", "schema_conformity")
    return [
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_check_count"),
        F.count_if(~F.col("passed")).alias("failed_check_count"),
        F.count_if(~F.col("passed") & structural).alias("failed_structural_count")]


def pass_fail_counts(metrics: DataFrame) -> DataFrame:
    """Checks per run."""
    return metrics.groupBy(*RUN).agg(*_counts())


def _line(**fields: str) -> str:
    """`label=value` parts as SQL; the values are SQL over the fields of a collected metric."""
    parts = [f"concat({literal(label + '=')}, coalesce({value}, 'None'))" for label, value in fields.items()]
    return f"concat_ws(' | ', {', '.join(parts)})"


def _parts(metrics: DataFrame, domain: str) -> DataFrame:
    """Per run and table: `metrics_summary` and `sample_failures`, from one pass over the metrics.

    Every metric of the table has its line in the summary, and every failure one in the list. The metrics of a
    table are collected once, as values; their texts are made from that.
    """
    # The labels of the lines.
    line = _line(
        layer="layer", table="table_name", check="m.check_name", column="m.column_name",
        value=number_text("m.metric_value"), threshold=number_text("m.threshold"),
        passed=truth_text("m.passed"), details="m.details")
    failure = _line(
        layer="layer", table="table_name", column="m.column_name", check="m.check_name",
        value=number_text("m.metric_value"), threshold=number_text("m.threshold"), details="m.details")
    collected = metrics.groupBy(*PART).agg(
        *_counts(), F.array_sort(F.collect_list(F.struct(*ORDER, "threshold"))).alias("found"))
    parts = collected.withColumns({
        "lines": F.expr(f"array_join(transform(found, m -> {line}), '\n')"),
        "failures": F.expr(f"array_join(transform(filter(found, m -> NOT m.passed), m -> {failure}), '\n')")}).drop("found")
    of_run = Window.partitionBy(*RUN)  # one row per table
    headline = F.concat(
        F.lit("Latest run timestamp: "), F.expr(iso_text("run_timestamp")),
        F.format_string("\nTotal checks: %d | Passed: %d | Failed: %d\n", *[
            F.sum(c).over(of_run) for c in ("total_checks", "passed_check_count", "failed_check_count")]),
        F.lit(f"Dataset domain: {domain}"),
        F.format_string("\nChecks of this table: %d | Passed: %d | Failed: %d",
                        "total_checks", "passed_check_count", "failed_check_count"))
    return parts.select(
        *PART, F.concat_ws("\n", headline, "lines").alias("metrics_summary"),
        F.coalesce(F.nullif("failures", F.lit("")), F.lit(NO_FAILURES)).alias("sample_failures"))


def metric_lines(metrics: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """Per run and table: a headline and one line per metric, failures first, as `metrics_summary`."""
    return _parts(metrics, domain).drop("sample_failures")


def top_failures(metrics: DataFrame) -> DataFrame:
    """Per run and table: its failures as text, or a sentence saying that there are none."""
    return _parts(metrics, DOMAIN).drop("metrics_summary")


def prompts(metrics: DataFrame, template: str = PROMPT_TEMPLATE, *, domain: str = DOMAIN) -> DataFrame:
    """Per run and table: the template with its two placeholders filled in."""
    filled = F.replace(F.lit(template), F.lit("{{METRICS_SUMMARY}}"), F.col("metrics_summary"))
    filled = F.replace(filled, F.lit("{{SAMPLE_FAILURES}}"), F.col("sample_failures"))
    return _parts(metrics, domain).select(*PART, filled.alias("prompt"))


def respond_with(prompt_rows: DataFrame, respond: Callable[[str], str]) -> DataFrame:
    """Add `raw_response` from a caller's function, called on the executors, and `error` where it raised instead.

    A prompt that fails costs its own row only. A task that is repeated asks its prompts again; `plans.journal` keeps answers.
    """
    schema = StructType([*prompt_rows.schema.fields, StructField("raw_response", StringType()), StructField("error", StringType())])

    def attempt(prompt: str) -> tuple[str | None, str | None]:
        try:
            return respond(prompt), None
        except Exception as failure:  # whatever the caller's function raises
            return None, f"{type(failure).__name__}: {failure}"

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [attempt(prompt) for prompt in batch["prompt"]]
            yield batch.assign(raw_response=[a for a, _ in answers], error=[e for _, e in answers])

    return prompt_rows.mapInPandas(answer, schema)


def rule_based_responses(metrics: DataFrame) -> DataFrame:
    """Per run: a response made from the counts and the first failure, in the JSON a model gives."""
    first = F.min(F.struct("passed", "layer", "table_name", *ORDER[1:])).alias("first")
    counted = metrics.groupBy(*RUN).agg(*_counts(), first).select("*", "first.*")
    failed, total = F.col("failed_check_count"), F.col("total_checks")
    failed_share = F.expr(share("failed_check_count", "total_checks"))
    severity = (
        F.when(failed == 0, "low")
        .when(failed_share >= 0.5, "critical")
        .when((failed_share >= 0.2) | (F.col("failed_structural_count") > 0), "high")
        .otherwise("medium"))
    cause, action = F.lit("the check failed"), F.lit("review the check")
    for check, (why, step) in EXPLANATIONS.items():
        cause = F.when(F.col("check_name") == check, why).otherwise(cause)
        action = F.when(F.col("check_name") == check, step).otherwise(action)
    where = F.concat(F.col("layer"), F.lit(" "), F.col("table_name"), F.lit("."), F.col("column_name"))
    clean = failed == 0
    summary = F.when(clean, F.format_string("All %d checks passed.", total)).otherwise(F.concat(
        F.format_string("%d of %d checks failed. The first is ", failed, total),
        F.col("check_name"), F.lit(" on "), where, F.lit(" at "), F.expr(number_text("metric_value")), F.lit(".")))
    response = F.struct(
        summary.alias("summary"),
        F.when(clean, "").otherwise(F.concat(where, F.lit(": "), cause)).alias("root_cause"),
        F.when(clean, "").otherwise(F.concat(where, F.lit(": "), action)).alias("suggested_action"),
        severity.alias("severity"))
    return counted.select(*RUN, F.to_json(response).alias("raw_response"))


def parse_responses(responses: DataFrame, column: str = "raw_response") -> DataFrame:
    """Split responses into their four fields; `parse_ok` says whether the whole text is one JSON object.

    Code fences around the JSON are removed. Text after the object, or a second object, makes
    a response unreadable, like text that is no JSON. Missing texts become empty, and a
    severity that is missing or none of the known ones becomes `unknown`.
    """
    bare = F.regexp_replace(column, r"^\s+|\s+$", "")
    unfenced = F.regexp_replace(bare, r"^`+|`+$", "")
    unlabelled = F.regexp_replace(F.regexp_replace(unfenced, r"^json", ""), r"^\s+|\s+$", "")
    cleaned = F.when(bare.startswith("```"), unlabelled).otherwise(bare)
    # The parser stops after the first value. Within brackets it has to read on to the closing one, and no text
    # that closes a bracket early also fits within braces.
    listed = F.from_json(F.concat(F.lit("["), column, F.lit("]")), ArrayType(RESPONSE_SCHEMA))
    held = F.from_json(F.concat(F.lit('{"whole":'), column, F.lit("}")), "whole string")
    only = F.when((F.size(listed) == 1) & held["whole"].isNotNull(), F.get(listed, 0))
    parsed = responses.withColumn(column, cleaned).withColumn("_parsed", only)
    known = F.lower(F.trim("_parsed.severity"))
    texts = {c: F.coalesce(F.col(f"_parsed.{c}"), F.lit("")) for c in ("summary", "root_cause", "suggested_action")}
    return parsed.withColumns({
        **texts,
        "severity": F.when(known.isin(*SEVERITIES), known).otherwise("unknown"),
        "parse_ok": F.col("_parsed").isNotNull(),
    }).drop("_parsed")


def insight_rows(metrics: DataFrame, responses: DataFrame, created_at: Column) -> DataFrame:
    """One insight per response, of a run or of one table in it; none is left out.

    A response that cannot be read has empty texts, severity `unknown` and `parse_ok` false.
    Counts are those of the whole run.
    """
    parsed = parse_responses(responses)
    if "table_name" not in parsed.columns:
        parsed = parsed.withColumn("table_name", F.lit(None).cast("string"))
    run = F.struct(*RUN)
    counted = pass_fail_counts(metrics).select(
        run.alias("run"), "run_id", F.col("run_timestamp").alias("metrics_run_timestamp"),
        "passed_check_count", "failed_check_count")
    return (
        counted.join(parsed.withColumn("run", run).drop(*RUN), "run")
        .withColumn("run_timestamp", created_at)
        .select(*[F.col(f.name).cast(f.dataType) for f in INSIGHT_SCHEMA.fields]))


def insights_for_latest_run(metrics: DataFrame, created_at: Column, *,
                            respond: Callable[[str], str] | None = None,
                            template: str = PROMPT_TEMPLATE) -> DataFrame:
    """The insights of the newest run; none without metrics.

    `respond` is asked once for each table of the run. Without it, rules write one insight of the run.
    """
    newest = latest_run(metrics)
    if respond is None:
        responses = rule_based_responses(newest)
    else:
        responses = respond_with(prompts(newest, template), respond).select(*RUN, "table_name", "raw_response")
    return insight_rows(newest, responses, created_at)
