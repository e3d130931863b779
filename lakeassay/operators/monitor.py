"""Monitoring queries over the metrics and insights tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALERT_BELOW = 0.80
BASELINE_DAYS = 7


# What tells runs apart: two runs may carry the same time.
RUN = ("run_id", "run_timestamp")


def latest_run(metrics: DataFrame) -> DataFrame:
    """Rows of the newest run, by time and then by id; none for an empty table.

    A stored metrics table is kept by `run_date`, so only its newest day is read.
    """
    if "run_date" in metrics.columns:
        newest_day = metrics.agg(F.max("run_date"))
        metrics = metrics.where(F.col("run_date") == newest_day.scalar())
    newest = metrics.agg(F.max(F.struct("run_timestamp", "run_id"))).scalar()
    # The time alone first: a comparison that a scan can use.
    return metrics.where(
        (F.col("run_timestamp") == newest["run_timestamp"]) & F.col("run_id").eqNullSafe(newest["run_id"]))


def _score() -> Column:
    passed = F.avg(F.when(F.col("passed"), 1.0).otherwise(0.0).cast("double"))
    return F.round(passed * 100, 1).alias("quality_score_pct")


def quality_score(metrics: DataFrame) -> DataFrame:
    """Percentage of passed checks in the newest run."""
    return latest_run(metrics).agg(_score())


def failed_checks(metrics: DataFrame) -> DataFrame:
    return latest_run(metrics).where(~F.col("passed")).agg(F.count(F.lit(1)).alias("failed_checks"))


def score_by_layer(metrics: DataFrame) -> DataFrame:
    """Score per day and layer over all runs."""
    return (
        metrics.groupBy(F.to_date("run_timestamp").alias("run_date"), "layer")
        .agg(_score()).orderBy("run_date", "layer"))


def score_by_stage(metrics: DataFrame) -> DataFrame:
    """Score per day and per stage: the layer names of tables begin with bronze, silver or gold."""
    stage = F.split_part("layer", F.lit("_"), F.lit(1)).alias("stage")
    return (
        metrics.groupBy(F.to_date("run_timestamp").alias("run_date"), stage)
        .agg(_score()).orderBy("run_date", "stage"))


def score_by_table(metrics: DataFrame) -> DataFrame:
    """Score per table in the newest run, worst first."""
    return latest_run(metrics).groupBy("table_name").agg(_score()).orderBy("quality_score_pct", "table_name")


def failing_checks(metrics: DataFrame) -> DataFrame:
    return (
        latest_run(metrics).where(~F.col("passed"))
        .select("layer", "table_name", "check_name", "column_name", "metric_value", "threshold", "details")
        .orderBy("layer", "table_name", "check_name", "column_name"))


def referential_failures(metrics: DataFrame) -> DataFrame:
    """Foreign key failures of all runs, newest first."""
    return (
        metrics.where("check_name = 'referential_integrity' AND metric_value > 0")
        .orderBy(F.desc("run_timestamp"), "layer", "table_name", "column_name")
        .select("layer", "table_name", "column_name", F.col("metric_value").alias("orphan_rate"), "details"))


def null_hotspots(metrics: DataFrame, top: int | None = None) -> DataFrame:
    """Columns by null rate in the newest run, highest first; all of them, or the first `top`."""
    ranked = (
        latest_run(metrics).where("check_name = 'null_rate'")
        .select(F.concat_ws(" | ", "layer", "column_name").alias("layer_column"),
                F.col("metric_value").alias("null_rate"))
        .orderBy(F.desc("null_rate"), "layer_column"))
    return ranked if top is None else ranked.limit(top)


def latest_insight(insights: DataFrame) -> DataFrame:
    return (
        insights.select(
            "run_timestamp", "metrics_run_timestamp", "severity", "failed_check_count",
            "passed_check_count", "summary", "root_cause", "suggested_action")
        .orderBy(F.desc("run_timestamp"), F.desc("metrics_run_timestamp")).limit(1))


def severity_trend(insights: DataFrame) -> DataFrame:
    """Insights per day and severity."""
    return (
        insights.groupBy(F.to_date("run_timestamp").alias("run_date"), "severity")
        .agg(F.count(F.lit(1)).alias("insight_count")).orderBy("run_date", "severity"))


def score_alerts(metrics: DataFrame, below: float = ALERT_BELOW) -> DataFrame:
    """Tables whose share of passed checks in the newest run is under the limit."""
    passed = F.sum(F.col("passed").cast("bigint"))
    score = F.try_divide(passed.cast("double"), F.count(F.lit(1)))
    return (
        latest_run(metrics).groupBy("layer", "table_name")
        .agg(score.alias("score"), F.count_if(~F.col("passed")).alias("failed_checks"))
        .where(F.col("score") < below)
        .select("layer", "table_name", F.round("score", 4).alias("score"), "failed_checks",
                F.lit(float(below)).alias("alert_below")))


def rolling_baseline(metrics: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Each metric's daily mean against its mean over the preceding days.

    Runs shrink to one row per metric and day before the window, so a metric that
    is measured very often is no larger there than any other.
    """
    series = ["table_name", "layer", "check_name", "column_name"]
    # A freshness without any record is infinite and would blot out its neighbours.
    value = F.when(F.abs("metric_value") != float("inf"), F.col("metric_value"))
    daily = (
        metrics.groupBy(*series, F.to_date("run_timestamp").alias("run_date"))
        .agg(F.sum(value).alias("total"), F.count(value).alias("runs")))
    day = F.datediff("run_date", F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy(*series).orderBy(day).rangeBetween(-days, -1)
    current = F.try_divide("total", "runs")
    baseline = F.try_divide(F.sum("total").over(before), F.sum("runs").over(before))
    return daily.select(
        *series, "run_date",
        F.round(current, 6).alias("current_value"),
        F.round(baseline, 6).alias("baseline_value"),
        F.round(current - baseline, 6).alias("deviation"))


def run_baseline(metrics: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """Each metric's mean in a run against its mean over the runs of the `days` before that run's instant.

    The frame is a span of time, so two runs on one day have baselines of their own, and the later sees the earlier. Runs of
    the same instant are not in each other's baseline. A metric is one row per run before the window.
    """
    series = ["table_name", "layer", "check_name", "column_name"]
    value = F.when(F.abs("metric_value") != float("inf"), F.col("metric_value"))
    runs = metrics.groupBy(*series, *RUN).agg(F.sum(value).alias("total"), F.count(value).alias("values"))
    before = Window.partitionBy(*series).orderBy(F.unix_micros(F.col("run_timestamp").cast("timestamp"))).rangeBetween(-days * 86_400_000_000, -1)
    current = F.try_divide("total", "values")
    baseline = F.try_divide(F.sum("total").over(before), F.sum("values").over(before))
    return runs.select(
        *series, *RUN, F.round(current, 6).alias("current_value"), F.round(baseline, 6).alias("baseline_value"),
        F.round(current - baseline, 6).alias("deviation"))
