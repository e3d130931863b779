from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeassay.model import DefectSpec, RunContext, TableSpec, instant
from lakeassay.operators import checks, defects

AS_OF = datetime(2024, 6, 1)


@pytest.fixture(scope="module")
def orders(spark):
    number = F.col("id")
    return spark.range(20000).select(
        number.alias("order_id"), (number % 50).alias("customer_id"), (number % 100 + 10).cast("double").alias("amount"),
        F.lit("done").alias("status"), F.lit(datetime(2024, 5, 30)).alias("order_date"), F.lit(1).alias("quantity"))


def share(df, condition):
    return df.where(condition).count() / df.count()


def test_selection_is_repeatable_and_near_its_rate(orders):
    picked = orders.where(defects.selected(orders, "order_id", 0.05, 7))
    assert picked.count() == orders.where(defects.selected(orders, "order_id", 0.05, 7)).count()
    assert abs(picked.count() / 20000 - 0.05) < 0.01
    by_text = orders.withColumn("k", F.col("order_id").cast("string"))
    assert abs(by_text.where(defects.selected(by_text, "k", 0.05, 7)).count() / 20000 - 0.05) < 0.01


def test_selection_survives_large_keys_and_nulls(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,), (-5,), (None,)], "k bigint")
    assert df.where(defects.selected(df, "k", 1.0, 0)).count() == 2


def test_columns_are_emptied_independently(orders):
    df = defects.inject_nulls(orders, "order_id", ["customer_id", "status"], 0.1)
    assert abs(share(df, "customer_id IS NULL") - 0.1) < 0.01
    assert share(df, "customer_id IS NULL AND status IS NULL") < 0.05


def test_duplicates(orders):
    df = defects.inject_duplicates(orders, "order_id", 0.03)
    assert df.columns == orders.columns
    assert abs(df.count() / 20000 - 1.03) < 0.005
    assert df.groupBy("order_id").count().agg(F.max("count")).first()[0] == 2


def test_outliers_keep_the_type(orders):
    df = defects.inject_outliers(orders, "order_id", "amount", 0.01)
    assert abs(share(df, "amount >= 1000") - 0.01) < 0.004
    counted = defects.inject_outliers(orders, "order_id", "customer_id", 0.01)
    assert dict(counted.dtypes)["customer_id"] == "bigint"


def test_stale_dates(orders):
    df = defects.inject_stale(orders, "order_id", "order_date", instant(AS_OF), 0.02)
    assert abs(share(df, "order_date = timestamp '2022-06-02'") - 0.02) < 0.005


def test_drift(orders):
    assert "quantity" not in defects.drop_columns(orders, "quantity").columns


def test_shuffled_rows_are_the_same_rows(orders):
    mixed = [r.order_id for r in defects.shuffle_rows(orders, 3).collect()]
    assert mixed != sorted(mixed) and sorted(mixed) == list(range(20000))


def test_checks_find_what_was_injected(orders):
    spec = DefectSpec(
        key="order_id", null_columns=("customer_id", "amount", "status"), outlier_column="amount",
        stale_column="order_date", drop_columns=("quantity",))
    df = defects.corrupt(orders, spec, instant(AS_OF))
    assert df.columns == ["order_id", "customer_id", "amount", "status", "order_date"]
    run = RunContext("r", datetime(2024, 6, 1))
    found = {(r.check_name, r.column_name): r for r in checks.run_checks(
        df, TableSpec("orders", keys=("order_id",), timestamp="order_date"), run).collect()}
    for column in spec.null_columns:
        assert abs(found["null_rate", column].metric_value - 0.05) < 0.01
    assert found["null_rate", "order_id"].metric_value == 0.0
    assert abs(found["duplicate_rate", "order_id"].metric_value - 0.03 / 1.03) < 0.01
    assert abs(found["outlier_rate", "amount"].metric_value - 0.01) < 0.004
    assert found["freshness_hours", "order_date"].metric_value == 48.0


def counts(df):
    return sorted((str(r), n) for r, n in ((tuple(x[:-1]), x[-1]) for x in df.groupBy(*df.columns).count().collect()))


@pytest.mark.parametrize("bucket_rows", [100, 3000, 10**9])
def test_exact_duplicates_do_not_depend_on_the_partitioning(spark, bucket_rows):
    df = spark.range(7001).select("id", (F.col("id") % 3).alias("a"), F.when(F.col("id") % 4 == 0, "x").alias("b"))
    three, seven = (defects.inject_exact_duplicates(df.repartition(n), 0.13, seed=3, bucket_rows=bucket_rows) for n in (3, 7))
    assert three.columns == df.columns and three.count() == seven.count() == 7001 + int(7001 * 0.13)
    assert counts(three) == counts(seven)
    assert three.distinct().count() == 7001
    other = defects.inject_exact_duplicates(df, 0.13, seed=4, bucket_rows=bucket_rows)
    assert counts(other) != counts(three)
    # With replacement: some rows are drawn twice.
    assert max(n for _, n in counts(three)) > 2


def test_exact_duplicates_of_equal_rows(spark):
    """One row holds a third of the table: it is drawn as often as a third of the copies."""
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"))
    copied = defects.inject_exact_duplicates(df, 0.5, seed=1, bucket_rows=500)
    assert copied.count() == 9000
    assert abs(copied.where("id = -1").count() - 3000) < 150
    marked = defects.inject_exact_duplicates(df, 0.5, seed=1, bucket_rows=500, mark="copy")
    assert marked.where("copy = 0").count() == 6000 and marked.where("copy > 0").count() == 3000


def test_exact_duplicates_of_odd_tables(spark):
    df = spark.sql("SELECT 1 AS a, map('x', 1) AS m UNION ALL SELECT NULL, NULL UNION ALL SELECT 1, map('y', 2)")
    assert defects.inject_exact_duplicates(df, 2.0).count() == 9
    assert defects.inject_exact_duplicates(df, 0.3).count() == 3
    assert defects.inject_exact_duplicates(df.where("false"), 0.5, mark="n").columns == ["a", "m", "n"]


def test_shuffling_does_not_depend_on_the_partitioning(spark, orders):
    ways = [[r.order_id for r in defects.shuffle_rows(orders.repartition(n), 3).collect()] for n in (2, 5)]
    assert ways[0] == ways[1]


def test_corruption_with_an_exact_number_of_copies(orders):
    df = defects.corrupt(orders, DefectSpec(key="order_id", exact_duplicates=True, outlier_column="amount"), instant(AS_OF))
    assert df.count() == 20600 and df.columns == orders.columns
