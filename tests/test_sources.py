from datetime import datetime
from pathlib import Path

import pytest
from conftest import planned
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeassay import project
from lakeassay.functions import with_row_hash
from lakeassay.model import RunContext, SilverSpec, instant
from lakeassay.operators import checks
from lakeassay.operators.ingest import stamp_lineage
from lakeassay.operators.silver import standardise
from lakeassay.plans import bronze
from lakeassay.sources import csv, jdbc, tables


def test_publish_replaces_a_table_that_is_being_read(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    assert not tables.exists(spark, "store.things")
    tables.publish(spark.range(3), "store.things")
    assert tables.exists(spark, "store.things")
    for _ in range(3):
        tables.publish(spark.table("store.things").select((F.col("id") + 1).alias("id")), "store.things")
    assert sorted(r.id for r in spark.table("store.things").collect()) == [3, 4, 5]
    kept = [t.name for t in spark.catalog.listTables("store", "things__v*")]
    assert sorted(kept) == [f"things__v0000000{n}" for n in (1, 2, 3, 4)]


def test_publish_with_another_layout(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    tables.publish(spark.range(3), "store.shape")
    tables.publish(spark.range(2).select(F.lit("x").alias("name")), "store.shape")
    assert spark.table("store.shape").columns == ["name"]


def test_failed_write_leaves_the_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    tables.publish(spark.range(3), "store.safe")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        tables.publish(broken, "store.safe")
    assert spark.table("store.safe").count() == 3
    tables.publish(spark.range(5), "store.safe")
    assert spark.table("store.safe").count() == 5


def test_a_folder_that_a_failed_write_left_is_passed_over(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    assert tables.publish(spark.range(3), "store.Left") == "store.Left__v00000001"
    left = Path(spark.catalog.getDatabase("store").locationUri.removeprefix("file:")) / "left__v00000002" / "_temporary"
    left.mkdir(parents=True)
    assert tables.publish(spark.range(5), "store.Left") == "store.Left__v00000003"
    assert spark.table("store.left").count() == 5 and left.exists()


def test_append(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    tables.append(spark.range(2), "store.log")
    tables.append(spark.range(3), "store.log")
    assert spark.table("store.log").count() == 5


def test_stage_reads_the_source_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    staging = tables.Staging(spark)
    staged = staging.stage(spark.range(10).mapInPandas(touch, "id bigint"))
    assert staged.count() == 10 and not staged.isEmpty() and staged.where("id > 4").count() == 5
    assert seen.value == 10


class Session:
    def __init__(self, **settings):
        self.conf = {key.replace("__", "."): value for key, value in settings.items()}


def test_shared_folder_comes_from_the_session(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    settings = {"spark__checkpoint__dir": "hdfs://c/shared/", "spark__sql__warehouse__dir": "hdfs://c/tables"}
    assert tables.shared_folder(Session(**settings)) == "hdfs://c/shared"
    # Without the setting: the warehouse, which a cluster shares too, never a folder of one machine.
    assert tables.shared_folder(Session(spark__sql__warehouse__dir="hdfs://c/tables")) == "hdfs://c/tables/_shared"


def test_a_cluster_needs_a_folder_that_it_shares():
    for warehouse in ("file:///home/me/warehouse", "/home/me/warehouse", "spark-warehouse"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            tables.shared_folder(Session(spark__master="yarn", spark__sql__warehouse__dir=warehouse))
        assert tables.shared_folder(Session(spark__master="local[8]", spark__sql__warehouse__dir=warehouse)) == f"{warehouse}/_shared"
    assert tables.shared_folder(Session(spark__master="yarn", spark__sql__warehouse__dir="s3a://b/w")) == "s3a://b/w/_shared"


def test_staged_copies_go_with_their_block(spark):
    with tables.Staging(spark) as one, tables.Staging(spark) as other:
        copies = [one.stage(spark.range(3)), other.stage(spark.range(4))]
        assert one.path != other.path and [c.count() for c in copies] == [3, 4]
        assert Path(one.path).exists()
    assert not Path(one.path).exists() and not Path(other.path).exists()


def keyed_rows(spark):
    """Rows of which some repeat a key and some lack one, as a load stamps them."""
    key = F.when(F.col("id") % 50 != 0, F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
    rows = spark.range(2000).select(key.alias("key"), (F.col("id") % 3).cast("string").alias("name"), "id")
    return with_row_hash(stamp_lineage(rows, system="s", schema="c", table="t", ingested_at=instant(datetime(2024, 1, 1))))


def test_neither_cleaning_nor_checks_of_keys_shuffle_a_table_staged_in_buckets(spark, subject):
    rows, spec = keyed_rows(spark), SilverSpec(keys=("key", "name"), required=("key",), trim=("name",))
    with tables.Staging(spark) as staging:
        plain, cut = staging.stage(rows), staging.stage(rows, "key", 4)
        assert sorted(map(str, cut.collect())) == sorted(map(str, rows.collect()))
        clean = staging.stage(standardise(cut, spec), "key", 4)
        assert "Exchange" in planned(standardise(plain, spec)) and "Exchange" not in planned(standardise(cut, spec))
        assert sorted(map(str, clean.collect())) == sorted(map(str, standardise(rows, spec).collect()))
        for staged, same in ((cut, rows), (clean, standardise(rows, spec))):
            for keys in (["key", "name"], ["key"], ["name", "key"], ["name"]):
                found = checks.duplicate_rate(staged, subject, keys=keys, gathered="key")
                assert ("hashpartitioning" in planned(found)) == ("key" not in keys)
                assert found.collect() == checks.duplicate_rate(same, subject, keys=keys).collect()


def test_tables_staged_in_buckets_go_with_their_block(spark):
    before = {t.name for t in spark.catalog.listTables()}
    with tables.Staging(spark) as staging:
        assert staging.stage(spark.range(9), "id", 2).count() == 9
        assert {t.name for t in spark.catalog.listTables()} > before
    assert {t.name for t in spark.catalog.listTables()} == before and not Path(staging.path).exists()


def test_buckets_are_as_many_as_keep_each_small(spark, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 10)
    monkeypatch.setattr(tables, "BUCKET_ROWS", 100)
    rows = spark.range(2000).select("id", F.col("id").cast("string").alias("text"), F.col("id").cast("double").alias("x"))
    for column in ("id", "text"):
        buckets = tables.even_buckets(rows, column)
        held = rows.groupBy(F.pmod(F.hash(column), F.lit(buckets))).count().agg(F.max("count")).first()[0]
        assert 20 <= buckets <= 64 and held <= 100
    assert tables.even_buckets(rows, "x") == 0
    assert tables.even_buckets(rows.limit(5), "id") == 1 and tables.even_buckets(rows.limit(0), "id") == 1


@pytest.mark.parametrize("hot", [7, None])
def test_a_table_with_a_hot_key_is_not_cut_into_buckets(spark, monkeypatch, hot):
    monkeypatch.setattr(tables, "FILE_ROWS", 10)
    rows = spark.range(2000).select(F.when(F.col("id") % 3 != 0, F.col("id")).otherwise(F.lit(hot)).alias("key"))
    assert tables.even_buckets(rows, "key") == 0


def test_tasks_that_deal_rows_out_read_small_pieces_meanwhile(spark):
    option = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(option)
    with pytest.raises(KeyError), tables.small_splits(spark):
        assert int(spark.conf.get(option)) == tables.SPLIT_BYTES
        raise KeyError
    assert spark.conf.get(option) == before


def test_snapshots_stay_until_they_are_dropped(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    names = [tables.publish(spark.range(n), "store.kept") for n in (1, 2, 3, 4)]
    assert [spark.table(n).count() for n in names] == [1, 2, 3, 4]
    assert tables.expire(spark, "store.kept", keep=2) == names[:2]
    assert not tables.exists(spark, names[0]) and spark.table("store.kept").count() == 4
    with pytest.raises(ValueError):
        tables.expire(spark, "store.kept", keep=0)


def test_merge_in_place_needs_a_format_that_supports_it(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    batch = with_row_hash(stamp_lineage(
        spark.range(3), system="s", schema="c", table="t", ingested_at=instant(datetime(2024, 1, 1))))
    batch.write.mode("overwrite").saveAsTable("store.merged")
    # The statement resolves against the table; plain files then refuse it.
    with pytest.raises(PySparkException, match="does not support MERGE INTO TABLE"):
        tables.merge_into(batch, "store.merged", ["id"], as_of=F.current_timestamp(), full_extract=True)
    assert tables.supports_row_changes("delta") and not tables.supports_row_changes("parquet")


def test_merge_in_place_takes_or_refuses_new_columns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    stamped = lambda df: with_row_hash(stamp_lineage(
        df, system="s", schema="c", table="t", ingested_at=instant(datetime(2024, 1, 1))))
    old, new = spark.range(3), spark.range(3).selectExpr("id", "named_struct('x', id) as `added one`")
    stamped(old).write.mode("overwrite").saveAsTable("store.widened")
    merge = lambda df, **more: tables.merge_into(
        stamped(df), "store.widened", ["id"], as_of=F.current_timestamp(), full_extract=True, **more)
    with pytest.raises(ValueError, match="new columns: added one"):
        merge(new, new_columns="refuse")
    assert "added one" not in spark.table("store.widened").columns
    with pytest.raises(PySparkException, match="does not support MERGE INTO TABLE"):
        merge(new)
    assert spark.table("store.widened").schema["added one"].dataType.simpleString() == "struct<x:bigint>"
    with pytest.raises(ValueError, match="no longer has the columns added one"):
        merge(old)


def test_loads_pass_on_what_happens_to_new_columns(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS store")
    table = next(t for t in project.KEYS if t not in project.WATERMARKS)
    rows = spark.range(3).select(*[F.col("id").cast("string").alias(k) for k in project.KEYS[table]])
    rows.write.mode("overwrite").saveAsTable(project.table_name(f"bronze_{table}", "store"))
    with pytest.raises(ValueError, match="no longer|new columns"):
        bronze.load_table(spark, table, rows.withColumn("added", F.lit(1)), RunContext(), database="store", fmt="delta", new_columns="refuse")


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    rows = [(1, 'say "hi", you', "a@b.c", "", datetime(2024, 1, 2, 3, 4, 5)), (2, " padded ", None, "FJ", None)]
    df = spark.createDataFrame(rows, project.CSV_SCHEMAS["customers"])
    csv.write_csv(df, str(tmp_path / "c"))
    back = csv.read_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == rows


def test_csv_with_line_breaks_in_values(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1)], "t string, n int")
    csv.write_csv(df, str(tmp_path / "m"))
    assert csv.read_csv(spark, str(tmp_path / "m"), df.schema, multiline=True).collect() == df.collect()


def test_csv_values_that_do_not_parse_become_null(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,name,category,unit_price\n1,Pen,Home,2.5\nx,Cup,Home,cheap\n")
    rows = csv.read_csv(spark, str(tmp_path / "p.csv"), project.CSV_SCHEMAS["products"]).collect()
    assert [(r.product_id, r.name, r.unit_price) for r in rows] == [(1, "Pen", 2.5), (None, "Cup", None)]


def test_shipped_iso_times_parse(spark, tmp_path):
    (tmp_path / "c.csv").write_text("customer_id,name,email,country,registered_at\n1,A,a@b,FJ,2025-10-28T03:14:06\n")
    row = csv.read_csv(spark, str(tmp_path / "c.csv"), project.CSV_SCHEMAS["customers"]).first()
    assert row.registered_at == datetime(2025, 10, 28, 3, 14, 6)


def test_jdbc_settings():
    source = jdbc.JdbcSource(jdbc.postgres_url("host", "aact"), "me", "secret")
    assert source.options() == {
        "url": "jdbc:postgresql://host:5432/aact", "driver": "org.postgresql.Driver", "user": "me",
        "password": "secret", "fetchsize": "10000"}
    assert "secret" not in repr(source)
    for user, password in (("", "x"), ("x", "")):
        with pytest.raises(ValueError):
            jdbc.JdbcSource("url", user, password)


def test_jdbc_ranges():
    assert jdbc.range_options("id", 1, 900, 8) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "8"}
    assert jdbc.range_options("id", None, None, 8) == {}


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_jdbc_buckets_cover_every_row_once(spark, partitions):
    df = spark.sql("SELECT explode(sequence(-50, 50)) AS h UNION ALL SELECT NULL")
    conditions = jdbc.bucket_predicates("h", partitions)
    assert len(conditions) == partitions
    hits = sum((F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions), F.lit(0))
    assert {r.hits for r in df.select(hits.alias("hits")).collect()} == {1}


def rejected(found):
    return sorted((r.record, r.reason) for r in found.rejected.collect())


def test_lines_that_do_not_parse_are_kept_apart_with_the_reason(spark, tmp_path):
    lines = ["product_id,name,category,unit_price", "1,Pen,Home,2.5", "x,Cup,Home,cheap", "2,Mug,Home", "3,Jar,Home,1.0,more", "",
             '4,"a, ""b""",Home,', ",,,", '5,"say ""hi""",Home,dear', "6,Tin,Home,9.5"]
    (tmp_path / "p.csv").write_text("\n".join(lines) + "\n")
    found = csv.split_csv(spark, str(tmp_path / "p.csv"), project.CSV_SCHEMAS["products"])
    assert sorted((r.product_id or 0, r.name) for r in found.kept.collect()) == [(0, None), (1, "Pen"), (4, 'a, "b"'), (6, "Tin")]
    assert rejected(found) == [
        ("2,Mug,Home", "not 4 values"), ("3,Jar,Home,1.0,more", "more than 4 values"),
        ('5,"say ""hi""",Home,dear', "unit_price: 'dear' is not double"),
        ("x,Cup,Home,cheap", "product_id: 'x' is not int; unit_price: 'cheap' is not double")]
    assert found.kept.count() + found.rejected.count() == len([x for x in lines[1:] if x])
    assert found.kept.columns == project.CSV_SCHEMAS["products"].fieldNames()
    assert {Path(r.file.removeprefix("file:")) for r in found.rejected.collect()} == {tmp_path / "p.csv"}


def test_rejects_of_odd_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("a,b\n")
    empty = csv.split_csv(spark, str(tmp_path / "none.csv"), StructType([StructField("a", IntegerType()), StructField("b", StringType())]))
    assert empty.kept.count() == 0 and empty.rejected.count() == 0
    clash = StructType([StructField("_corrupt_record", StringType()), StructField("n", IntegerType())])
    (tmp_path / "clash.csv").write_text('x,1\n"two\nlines",2\ny,z\n')
    found = csv.split_csv(spark, str(tmp_path / "clash.csv"), clash, header=False, multiline=True)
    assert sorted((r._corrupt_record, r.n) for r in found.kept.collect()) == [("two\nlines", 2), ("x", 1)]
    assert [r[1] for r in rejected(found)] == ["n: 'z' is not int"]


def test_boundaries_cut_a_sample_evenly():
    assert jdbc.quantile_boundaries(list(range(100)), 4) == [25, 50, 75]
    assert jdbc.quantile_boundaries([], 4) == [] and jdbc.quantile_boundaries([1, 2], 1) == []
    assert jdbc.quantile_boundaries(["a"] * 90 + ["b"] * 10, 10) == ["b"]  # one value fills nine parts
    assert jdbc.range_predicates("k", []) == ["1 = 1"]
    assert jdbc.range_predicates("k", ["a'b", "c"]) == ["(k < 'a''b' OR k IS NULL)", "k >= 'a''b' AND k < 'c'", "k >= 'c'"]
    assert jdbc.range_predicates("n", [5]) == ["(n < 5 OR n IS NULL)", "n >= 5"]
    assert jdbc.sample_query("t", "k", 0.01) == "SELECT k AS sampled FROM t TABLESAMPLE SYSTEM (1) WHERE k IS NOT NULL ORDER BY k"
    assert jdbc.sample_query("t", "k", 1) == "SELECT k AS sampled FROM t WHERE k IS NOT NULL ORDER BY k"
    for bad in (lambda: jdbc.quantile_boundaries([1], 0), lambda: jdbc.sample_query("t", "k", 0)):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("partitions", [2, 7, 16])
def test_ranges_cover_every_row_once_and_evenly(spark, tmp_path, partitions):
    # Text keys that crowd together, some nulls.
    rows = spark.range(20000).select(F.when(F.col("id") % 50 != 0, F.concat(F.lit("NCT0"), F.expr("cast(id * id as string)"))).alias("k"))
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    sample = sorted(r.k for r in table.where("k is not null and pmod(xxhash64(k), 10) = 0").collect())
    conditions = jdbc.range_predicates("k", jdbc.quantile_boundaries(sample, partitions))
    assert len(conditions) == partitions
    hits = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions]
    assert table.select(sum(hits, F.lit(0)).alias("n")).distinct().collect() == [(1,)]
    sizes = sorted(table.where(c).count() for c in conditions)
    assert sum(sizes) == 20000 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    # Bare comparisons: a store that has an index, or here the files' statistics, can use them.
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual" in table.where(conditions[-1])._jdf.queryExecution().executedPlan().toString()
