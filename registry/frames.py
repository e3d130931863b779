"""The shapes as Spark DataFrames."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from lakeassay import project
from lakeassay.functions import with_row_hash
from lakeassay.model import RunContext, instant
from lakeassay.operators.ingest import stamp_lineage
from lakeassay.operators.silver import standardise
from lakeassay.sources import tables
from registry import shapes
from registry.shapes import Shape

FIRST_RUN = RunContext("first", datetime.fromisoformat(shapes.LOADED_AT))
SECOND_RUN = RunContext("second", datetime.fromisoformat(shapes.RELOADED_AT))
RUN = RunContext(run_id="registered", as_of=datetime.fromisoformat(shapes.AS_OF))


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shaped(spark: SparkSession, sf_dir: str, shape: Shape, **extra: str) -> DataFrame:
    rows = given(spark, sf_dir, shape.base)
    copies = F.expr(f"CASE WHEN {shape.copy_when} THEN array(0, 1) ELSE array(0) END")
    return rows.select("*", F.explode(copies).alias("_copy")).selectExpr(*shape.selection(**extra))


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, the form the checking SQL returns them in."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields])


def moment(text: str):
    return instant(datetime.fromisoformat(text))


def bronze(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A clinical-trial table as loaded, some keys twice and some rows deleted."""
    shape = shapes.TRIAL[table]
    raw = shaped(spark, sf_dir, shape, _copy="_copy", _flag=shape.deleted)
    stamped = stamp_lineage(
        raw, system=project.SOURCE_SYSTEM, schema=project.SOURCE_SCHEMA, table=table,
        ingested_at=moment(shapes.LOADED_AT) + F.make_dt_interval(F.col("_copy")))
    return with_row_hash(stamped).withColumn("_is_deleted", F.col("_flag")).drop("_copy", "_flag")


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return standardise(bronze(spark, sf_dir, table), project.SILVER[table])


def loaded(df: DataFrame, table: str, at: str) -> DataFrame:
    return with_row_hash(stamp_lineage(df, system="files", schema="tpch", table=table, ingested_at=moment(at)))


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(given(spark, sf_dir, "orders"), "orders", shapes.LOADED_AT)


def orders_deleted_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.col("o_orderkey") % 5 == 2
    return orders_target(spark, sf_dir).withColumns({
        "_is_deleted": gone, "_deleted_at": F.when(gone, moment(shapes.LOADED_AT))})


def orders_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders again: some moved to a new key, some with another price."""
    key = F.col("o_orderkey")
    return given(spark, sf_dir, "orders").withColumns({
        "o_orderkey": F.when(key % 10 == 0, key + 10_000_000_000).otherwise(key),
        "o_totalprice": F.when(key % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))})


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(orders_changed(spark, sf_dir), "orders", shapes.RELOADED_AT)


def scratch_database(spark: SparkSession) -> str:
    """A new database in the shared folder, whose files go when the session ends."""
    name = f"registered_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tables.scratch_folder(spark, 'database')}'")
    return name


def orders_wider_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changed orders with a column that the target lacks."""
    name, value = shapes.NEW_COLUMN
    plain_columns = orders_source(spark, sf_dir).select(*shapes.ORDER_COLUMNS)
    return loaded(plain_columns.withColumn(name, F.expr(value)), "orders", shapes.RELOADED_AT)


def lines_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, whose key repeats and is partly null."""
    number = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))
    return loaded(given(spark, sf_dir, "lineitem").withColumn("l_linenumber", number), "lineitem", shapes.LOADED_AT)


def lines_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber"))
    key = F.col("l_orderkey")
    changed = given(spark, sf_dir, "lineitem").withColumns({
        "l_linenumber": number,
        "l_orderkey": F.when(key % 10 == 0, key + 10_000_000_000).otherwise(key),
        "l_tax": F.when(key % 7 == 0, 0.5).otherwise(F.col("l_tax"))})
    return loaded(changed, "lineitem", shapes.RELOADED_AT)


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(spark, sf_dir, shapes.METRICS)


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped(spark, sf_dir, shapes.INSIGHTS)
