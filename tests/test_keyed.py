"""Tables in buckets of their key: snapshots that share folders, merges that leave the table where it is."""

import re
from datetime import datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import executed_plan, planned
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakeassay import RunContext, TableSpec
from lakeassay.functions import key_text, latest_per_key, with_row_hash
from lakeassay.operators.ingest import stamp_lineage
from lakeassay.plans import bronze
from lakeassay.plans.bronze import Origin, load
from lakeassay.sources import tables

RUNS = [RunContext(f"r{d}", datetime(2024, 3, d + 1)) for d in range(9)]
FROM = Origin("s", "c", "t")


@pytest.fixture(scope="module", autouse=True)
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS keyed")


def spec(name, **more):
    return TableSpec(f"keyed.{name}", keys=("a", "b"), **more)


def rows(spark, count, changed=(), without=()):
    data = [(f"k{i}", i if i % 5 else None, "new" if i in changed else "old") for i in range(count) if i not in without]
    return spark.createDataFrame(data, "a string, b int, v string")


def content(spark, name):
    return sorted((r.a, r.b or 0, r.v, r._is_deleted) for r in spark.table(f"keyed.{name}").collect())


def wanted(count, changed=(), deleted=()):
    return sorted((f"k{i}", i if i % 5 else 0, "new" if i in changed else "old", i in deleted) for i in range(count))


def test_unchanged_buckets_are_shared(spark):
    load(spark, spec("shared"), rows(spark, 200), RUNS[0], FROM, buckets=16)
    table = tables.KeyedTable(spark, "keyed.shared")
    first = table.folders
    assert table.buckets == 16 and len(first) == 16
    done = load(spark, spec("shared"), rows(spark, 200, changed=[7], without=[9]), RUNS[1], FROM)
    assert done.changes == {"insert": 0, "update": 1, "resurrect": 0, "delete": 1, "unchanged": 198}
    moved = {b for b in first if table.folders[b] != first[b]}
    assert 1 <= len(moved) <= 2 and table.folders.keys() == first.keys()
    assert content(spark, "shared") == wanted(200, [7], [9])
    # Spark would put every row in the bucket it is in: the file names say so.
    for bucket, folder in table.folders.items():
        names = [p.name for p in Path(folder.removeprefix("file:")).glob("*.parquet")]
        assert len(names) == 1 and re.search(rf"_{bucket:05d}\.c000", names[0])


def test_a_load_that_fails_halfway_changes_nothing(spark, monkeypatch):
    load(spark, spec("broken"), rows(spark, 50), RUNS[0], FROM, buckets=4)
    before, base = content(spark, "broken"), Path(spark.catalog.getDatabase("keyed").locationUri.removeprefix("file:"))

    def files():
        return {p for p in (base / "broken__files").rglob("*") if p.is_file()}

    kept, merged = files(), bronze.merged_buckets
    monkeypatch.setattr(bronze, "merged_buckets", lambda *a, **b: merged(*a, **b).withColumn(
        "v", F.when(F.col("a") == "k3", F.raise_error(F.lit("lost"))).otherwise(F.col("v"))))
    with pytest.raises(PySparkException, match="lost"):
        load(spark, spec("broken"), rows(spark, 50, changed=[3, 4, 5, 6]), RUNS[1], FROM)
    assert content(spark, "broken") == before and files() == kept
    monkeypatch.undo()

    # Or after all is written, before the last step.
    show = tables._show
    monkeypatch.setattr(tables, "_show", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(spark, spec("broken"), rows(spark, 50, changed=[3, 4, 5, 6]), RUNS[1], FROM)
    assert content(spark, "broken") == before and files() > kept
    monkeypatch.setattr(tables, "_show", show)
    assert tables.expire(spark, "keyed.broken", keep=3) == ["keyed.broken__v00000002"]
    assert content(spark, "broken") == before and files() == kept

    assert load(spark, spec("broken"), rows(spark, 50, changed=[3, 4]), RUNS[2], FROM).changes["update"] == 2
    assert content(spark, "broken") == wanted(50, [3, 4])


def test_readers_during_a_load_see_one_state(spark, monkeypatch):
    load(spark, spec("read"), rows(spark, 50), RUNS[0], FROM, buckets=4)
    before, seen, show = content(spark, "read"), [], tables._show
    reader = spark.table("keyed.read")
    reader.explain("simple")

    def last_step(*what, **more):
        seen.append(content(spark, "read"))
        show(*what, **more)

    monkeypatch.setattr(tables, "_show", last_step)
    load(spark, spec("read"), rows(spark, 60, changed=range(60)), RUNS[1], FROM)
    assert seen == [before]
    assert sorted((r.a, r.b or 0, r.v, r._is_deleted) for r in reader.collect()) == before
    assert content(spark, "read") == wanted(60, range(60))


def test_expire_spares_folders_that_a_kept_snapshot_shares(spark):
    table = tables.KeyedTable(spark, "keyed.old")
    folders = []
    for day in range(4):
        load(spark, spec("old"), rows(spark, 100, changed=range(day)), RUNS[day], FROM, **({} if day else {"buckets": 8}))
        folders.append(set(table.folders.values()))
    gone, shared = folders[0] - folders[3], folders[0] & folders[3]
    assert gone and shared
    assert tables.expire(spark, "keyed.old", keep=1) == [f"keyed.old__v0000000{n}" for n in (1, 2, 3)]
    assert content(spark, "old") == wanted(100, range(3))
    there = {f for all_ in folders for f in all_ if Path(f.removeprefix("file:")).exists()}
    assert there == folders[3]
    load(spark, spec("old"), rows(spark, 100, changed=range(9)), RUNS[5], FROM)
    assert content(spark, "old") == wanted(100, range(9))


def exchanges_over_files(plan):
    """The exchanges of a final plan that have a scan of a bucketed table below them and no join in between."""
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    depth = [len(re.match(r"[\s:+\-*|]*", line)[0]) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if "Exchange" not in line:
            continue
        for j in range(i + 1, len(lines)):
            if depth[j] <= depth[i] or "Join" in lines[j]:
                break
            if "FileScan" in lines[j] and "__v0" in lines[j]:
                found.append(line)
    return found


def test_neither_pass_shuffles_the_table(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="32")
    load(spark, spec("still"), rows(spark, 100), RUNS[0], FROM, buckets=4)
    table = tables.KeyedTable(spark, "keyed.still")
    stamped = with_row_hash(stamp_lineage(rows(spark, 120, changed=[1, 2]), system="s", schema="c", table="t", ingested_at=RUNS[1].timestamp))
    path = tables.scratch_folder(spark, "batch") + "/rows"
    latest_per_key(stamped, ("a", "b")).withColumn(tables.KEY, key_text(stamped, ("a", "b"))).write.parquet(path)
    batch = spark.read.parquet(path)
    for full in (True, False):
        one = bronze.changes_by_bucket(table, batch, RUNS[1], None, full_extract=full)
        two = bronze.merged_buckets(table, batch, RUNS[1], None, full_extract=full, new_columns="add")
        some = bronze.merged_buckets(table, batch, RUNS[1], [1, 3], full_extract=full, new_columns="add")
        for df in (one, two, some):
            plan = executed_plan(df)
            assert "Bucketed: true" in plan and "SortMergeJoin" in plan
            assert exchanges_over_files(plan) == []
        assert executed_plan(two).split("== Initial Plan ==")[0].count("Exchange") == 1  # of the batch
    assert exchanges_over_files(executed_plan(table.rows.groupBy("v").count())) != []  # the helper finds what it looks for


def written(monkeypatch, spark):
    """What later loads write into tables: the final plan, and how many folders hold staged rows meanwhile."""
    found, write, shared = [], tables.KeyedTable._write, Path(tables.shared_folder(spark))
    before = set(shared.glob("staged-*"))

    def noted(table, df, *rest):
        found.append((executed_plan(df).split("== Initial Plan ==")[0], sum(any(f.rglob("*.parquet")) for f in set(shared.glob("staged-*")) - before)))
        write(table, df, *rest)

    monkeypatch.setattr(tables.KeyedTable, "_write", noted)
    return found


def test_loads_shuffle_no_rows(spark, monkeypatch):
    monkeypatch.setattr(tables, "DEALT_ROWS", 1)
    found = written(monkeypatch, spark)
    twice = rows(spark, 500).unionByName(rows(spark, 100, changed=range(50)))
    assert load(spark, spec("dealt"), twice, RUNS[0], FROM, buckets=4).surplus == 100
    done = load(spark, spec("dealt"), rows(spark, 500, changed=range(400), without=[7]), RUNS[1], FROM)
    assert done.changes["delete"] == 1 and done.changes["update"] > 300 and done.surplus == 0
    assert len(content(spark, "dealt")) == 500 and {r for r in content(spark, "dealt") if r[3]} <= {("k7", 7, v, True) for v in ("old", "new")}
    assert {r for r in content(spark, "dealt") if not r[3]} == {r for r in wanted(500, range(400)) if r[0] != "k7"}
    assert len(found) == 2
    for plan, staged in found:
        assert "Bucketed: true" in plan and "Exchange" not in plan
        assert staged == 1  # the extract as read is gone by then
    files = [p.name for f in tables.KeyedTable(spark, "keyed.dealt").folders.values() for p in Path(f.removeprefix("file:")).glob("*.parquet")]
    assert len(files) == 4 and all(name.endswith(".zstd.parquet") for name in files)


def test_rows_are_shuffled_where_dealing_them_out_makes_tiny_files(spark, monkeypatch):
    data = spark.range(4000).withColumn("k", F.col("id").cast("string"))
    monkeypatch.setattr(tables, "DEALT_ROWS", 100)
    assert tables.spread(data, "k", 8, 4000, 100_000).rdd.getNumPartitions() == 5
    assert tables.spread(data, "k", 2, 4000, 100_000).rdd.getNumPartitions() == 8
    for buckets, size in ((41, 100_000), (8, 6 * tables.DEAL_BYTES)):
        few = tables.spread(data, "k", buckets, 4000, size)
        assert "hashpartitioning(k#" in planned(few) and few.rdd.getNumPartitions() == buckets


def test_a_hot_key_is_cut_down_before_it_is_dealt_out(spark, monkeypatch):
    staged, stage = [], tables.Staging.stage

    def noted(self, df, by=None, buckets=0):
        copy = stage(self, df, by, buckets)
        if by:
            staged.append((copy.count(), buckets))
        return copy

    monkeypatch.setattr(tables.Staging, "stage", noted)
    even = spark.range(3000).selectExpr("concat('k', id) AS a", "1 AS b", "cast(id AS string) AS v")
    hot = even.unionByName(spark.range(3000).selectExpr("'k7' AS a", "1 AS b", "concat('more', id) AS v"))
    stamped = with_row_hash(hot)
    kept = sorted(map(tuple, latest_per_key(stamped, ("a", "b")).select("a", "b", "v").collect()))
    for name, data, surplus in (("even", even, 0), ("hot", hot, 3000)):
        assert load(spark, spec(name), data, RUNS[0], FROM, bucket_bytes=10_000).surplus == surplus
        again = load(spark, spec(name), data, RUNS[1], FROM, bucket_bytes=10_000)
        assert again.changes["unchanged"] == 3000 and again.surplus == surplus
    assert [n for n, _ in staged] == [3000] * 4 and min(buckets for _, buckets in staged) > 20
    assert sorted(map(tuple, spark.table("keyed.hot").select("a", "b", "v").collect())) == kept


def test_a_batch_that_outgrew_the_table_is_dealt_out_by_its_size(spark, monkeypatch):
    load(spark, spec("outgrown"), rows(spark, 10), RUNS[0], FROM, bucket_bytes=1 << 20)
    asked, spread = [], tables.spread
    monkeypatch.setattr(tables, "spread", lambda df, column, buckets, *rest: asked.append(buckets) or spread(df, column, buckets, *rest))
    done = load(spark, spec("outgrown"), rows(spark, 900, changed=[3]), RUNS[1], FROM, bucket_bytes=10_000)
    assert done.changes == {"insert": 890, "update": 1, "resurrect": 0, "delete": 0, "unchanged": 9}
    assert asked[0] >= 4 and content(spark, "outgrown") == wanted(900, [3])


def test_a_first_extract_may_be_empty(spark):
    assert load(spark, spec("nothing"), rows(spark, 5).where("a = ''"), RUNS[0], FROM).changes == {"insert": 0}
    assert load(spark, spec("nothing"), rows(spark, 5), RUNS[1], FROM).changes["insert"] == 5
    assert content(spark, "nothing") == wanted(5)


def test_buckets_follow_the_size(spark):
    load(spark, spec("grown"), rows(spark, 100), RUNS[0], FROM, bucket_bytes=1 << 30)
    table = tables.KeyedTable(spark, "keyed.grown")
    assert table.buckets == 1
    load(spark, spec("grown"), rows(spark, 110), RUNS[1], FROM, bucket_bytes=1 << 30)
    assert table.buckets == 1
    load(spark, spec("grown"), rows(spark, 3000), RUNS[2], FROM, bucket_bytes=2000)
    assert table.buckets >= 4 and len(table.folders) == table.buckets
    assert content(spark, "grown") == wanted(3000)
    load(spark, spec("grown"), rows(spark, 3000, changed=[0]), RUNS[3], FROM, buckets=2)
    assert table.buckets > 2 and content(spark, "grown") == wanted(3000, [0])


def test_buckets_count_rows_in_memory_not_files(spark):
    alike = spark.range(20_000).selectExpr("concat('k', id) AS a", "1 AS b", "repeat('same ', 40) AS v")
    options = {"bucket_bytes": 1 << 20}
    load(spark, spec("alike"), alike, RUNS[0], FROM, **options)
    load(spark, spec("named"), alike, RUNS[0], FROM, buckets=3, **options)  # three are the least
    load(spark, spec("small"), alike, RUNS[0], FROM, buckets=3)
    assert [tables.KeyedTable(spark, f"keyed.{t}").buckets > 6 for t in ("alike", "named", "small")] == [True, True, False]
    assert tables.KeyedTable(spark, "keyed.small").buckets == 3
    load(spark, spec("small"), alike, RUNS[1], FROM, **options)
    assert load(spark, spec("small"), alike.where("a <> 'k7'"), RUNS[2], FROM, **options).changes["delete"] == 1
    assert spark.table("keyed.small").where("NOT _is_deleted").count() == 19_999


def test_staged_files_hold_a_bounded_number_of_rows(spark):
    with tables.Staging(spark) as staging:
        staged = staging.stage(spark.range(0, 3 * tables.FILE_ROWS, 1, 1).selectExpr("1 AS x"))
        assert len(staged.inputFiles()) == 3 and staged.count() == 3 * tables.FILE_ROWS


def test_surplus_rows_are_counted(spark):
    twice = rows(spark, 20).unionByName(rows(spark, 5, changed=range(5)))
    assert load(spark, spec("surplus"), twice, RUNS[0], FROM).surplus == 5
    done = load(spark, spec("surplus"), twice.unionByName(twice), RUNS[1], FROM)
    assert done.surplus == 30 and done.changes["unchanged"] == 20


def test_new_columns_are_null_in_shared_buckets(spark):
    load(spark, spec("wider"), rows(spark, 40), RUNS[0], FROM, buckets=8)
    wider = rows(spark, 40, changed=[3]).withColumn("w", F.lit(7))
    with pytest.raises(ValueError, match="new columns: w"):
        load(spark, spec("wider", watermark=None), wider, RUNS[1], FROM, new_columns="refuse")
    load(spark, TableSpec("keyed.wider", keys=("a", "b"), watermark="b"), wider.where("a = 'k43' or b = 39").withColumn("b", F.lit(50)), RUNS[1], FROM)
    found = {(r.a, r.b, r.w) for r in spark.table("keyed.wider").where("w is not null or a = 'k39'").collect()}
    assert found == {("k39", 39, None), ("k39", 50, 7)}
    assert spark.table("keyed.wider").count() == 41


def test_watermark_of_the_spec(spark):
    first = TableSpec("keyed.marked", keys=("a",), watermark="b")
    data = rows(spark, 40).where("b is not null")
    assert load(spark, first, data.where("b < 20"), RUNS[0], FROM, buckets=4).changes == {"insert": 16}
    done = load(spark, first, data.where("b > 10"), RUNS[1], FROM)
    assert done.changes == {"insert": 16, "update": 0, "resurrect": 0, "delete": 0, "unchanged": 16}
    assert load(spark, first, data, RUNS[2], FROM).outcome == "skipped"
    assert spark.table("keyed.marked").where("_is_deleted").count() == 0
    with pytest.raises(ValueError, match="no key"):
        load(spark, TableSpec("keyed.none"), data, RUNS[0], FROM)


def test_key_text_tells_keys_apart(spark):
    keys = [(None, None), ("", None), (None, ""), ("", ""), ("-", None), ("1:", "a"), ("1", ":a"), ("a", "1"), ("a1:1", None)]
    df = spark.createDataFrame(keys, "a string, b string")
    assert df.select(key_text(df, ("a", "b")).alias("k")).distinct().count() == len(keys)
    assert df.where(key_text(df, ("a", "b")).isNull()).count() == 0
    kinds = {"int": 5, "bigint": 5, "decimal(10,2)": Decimal("5.00"), "decimal(12,4)": Decimal("5.0000"), "double": -0.0, "float": 0.0,
             "binary": b"\xff\x00", "timestamp": datetime(2024, 1, 1, tzinfo=timezone.utc)}
    texts = {}
    for kind, value in kinds.items():
        one = spark.createDataFrame([(value,)], f"x {kind}")
        texts[kind] = one.select(key_text(one, ["x"])).first()[0]
    assert texts["int"] == texts["bigint"] == texts["decimal(10,2)"] == texts["decimal(12,4)"] == "1:5"
    assert texts["double"] == texts["float"]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        one = spark.createDataFrame([(kinds["timestamp"],)], "x timestamp")
        assert one.select(key_text(one, ["x"])).first()[0] == texts["timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
