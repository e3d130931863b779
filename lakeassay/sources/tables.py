"""Named tables: snapshots that replace each other, appends, and staged copies."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, IntegralType, StringType, StructField

from lakeassay.functions import latest_per_key, quoted
from lakeassay.functions.text import name as quoted_name
from lakeassay.operators.ingest import merged_columns

# Table formats, by name, whose connectors implement MERGE.
ROW_LEVEL_FORMATS = ("delta", "iceberg")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that every executor can reach.

    A cluster names it in `spark.checkpoint.dir`; without that it is a folder in the warehouse, which must then be in a
    store that the cluster shares: a path of the driver's machine is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.conf.get("spark.master", None) or "local"
        if not master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {warehouse} is a local one")
        folder = f"{warehouse}/_shared"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder, removed with all it holds when the session ends."""
    path = scratch_path(spark, name)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


#: Rows of a staged file. Tasks read at most about thirty files however well they compress, as Spark counts 4 MB for opening one.
FILE_ROWS = 1 << 16
#: Rows of a bucket of a staged table: what one task sorts, or groups, of it.
BUCKET_ROWS = 1 << 20
#: Slots in which rows are counted before they are dealt out, and so the largest number of buckets.
SLOTS = 1 << 12
#: Bytes of a file that a task which deals rows out to buckets reads: it sorts them by bucket, and should do so in memory.
SPLIT_BYTES = 32 << 20


def even_buckets(df: DataFrame, column: str) -> int:
    """Into how many buckets of `column` to cut `df`, so that none is large; 0 if some value holds too many rows for that.

    A bucket holds at most BUCKET_ROWS and an eighth of the rows, unless that is less than a file.
    """
    kind = df.schema[column].dataType
    if not (isinstance(kind, IntegralType) or kind == StringType()):
        return 0
    slot = F.pmod(F.hash(quoted(column)), F.lit(SLOTS)).alias("slot")
    counts = df.groupBy(slot).agg(F.count(F.lit(1)).alias("rows")).collect()
    most = min(BUCKET_ROWS, max(sum(r["rows"] for r in counts) // 8, FILE_ROWS))
    buckets = 1
    while buckets <= SLOTS:
        # The slots are a multiple of the buckets, and counted by the hash that Spark deals rows to buckets by.
        held = dict.fromkeys(range(buckets), 0)
        for r in counts:
            held[r["slot"] % buckets] += r["rows"]
        if max(held.values()) <= most:
            return buckets
        buckets *= 2
    return 0


@contextmanager
def small_splits(spark: SparkSession) -> Iterator[None]:
    """Let tasks read files in pieces of SPLIT_BYTES at most, for all jobs of the session meanwhile."""
    option = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(option)
    read = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(option, str(min(read, SPLIT_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(option, before)


class Staging:
    """A fresh place for copies that later steps read, removed with all of them when the block ends, or else the session.

    A staged DataFrame shows all readers the same rows and survives lost executors. Two
    blocks never share a path, so loads of one table at the same time do not meet.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._tables: list[str] = []
        self.path = scratch_folder(spark, "staged")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.remove()

    def stage(self, df: DataFrame, by: str | None = None, buckets: int = 0) -> DataFrame:
        """Write `df` once and read it back; with `buckets`, cut into as many by the column `by`.

        Rows are dealt out as they are written, so steps that bring equal values of `by` together need no shuffle.
        """
        name = uuid.uuid4().hex
        path = f"{self.path}/{name}"
        writer = df.write.option("maxRecordsPerFile", FILE_ROWS).option("compression", "zstd")
        if not buckets:
            writer.parquet(path)
            return self._spark.read.schema(df.schema).parquet(path)
        table = f"{quoted_name(self._spark.catalog.currentDatabase())}.staged_{name}"
        self._tables.append(table)
        writer.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(table)
        return self._spark.table(table)

    def remove(self) -> None:
        while self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop()}")
        remove(self._spark, self.path)


def split_name(name: str) -> tuple[str | None, str]:
    database, _, table = name.rpartition(".")
    return database or None, table


def exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def publish(df: DataFrame, name: str, *, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> str:
    """Replace the table `name` by `df`, which may read the table it replaces.

    The rows go to a table of their own, and the view `name` is pointed at it as the last
    step, so readers see the old rows or the new ones and a failed write changes nothing.
    Older snapshots stay until `expire` drops them. One writer at a time. Formats with
    versions of their own are overwritten.
    """
    spark = df.sparkSession
    if supports_row_changes(fmt):
        writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return name
    database, table = split_name(name)
    catalog, version = spark.catalog, max(_versions(spark, database, table), default=0) + 1
    base = catalog.getDatabase(database or catalog.currentDatabase()).locationUri.rstrip("/")
    # Tasks that outlive a failed write may leave its folder behind, which no table can be written to.
    while _is_there(spark, f"{base}/{table.lower()}__v{version:08d}"):
        version += 1
    snapshot = f"{name}__v{version:08d}"
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(snapshot)
    _show(spark, name, snapshot, "*")
    return snapshot


def _show(spark: SparkSession, name: str, snapshot: str, columns: str, **properties: str) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in {"snapshot": snapshot, **properties}.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT {columns} FROM {snapshot}")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def shown(spark: SparkSession, name: str) -> str:
    """The snapshot that a published table shows."""
    return _properties(spark, name)["snapshot"]


def is_keyed(spark: SparkSession, name: str) -> bool:
    """Whether a table is stored in buckets of its key."""
    return "keys" in _properties(spark, name)


def expire(spark: SparkSession, name: str, keep: int) -> list[str]:
    """Drop all but the newest `keep` snapshots of a published table, up to the one it shows; returns the names dropped.

    Snapshots that a failed load left behind go as well, so no load may be under way. Folders of a dropped snapshot
    that a kept one shares stay. Readers of an older snapshot fail afterwards, so this is never done on the way.
    """
    if keep < 1:
        raise ValueError("the snapshot that the table shows must stay")
    database, table = split_name(name)
    current = shown(spark, name)
    names = [f"{name}__v{version:08d}" for version in _versions(spark, database, table)]
    kept = [n for n in names if n <= current][-keep:]
    old = [n for n in names if n not in kept]
    used = {folder for n in kept for folder in _folders(spark, n).values()}
    for snapshot in old:
        folders = set(_folders(spark, snapshot).values())
        located = spark.sql(f"DESCRIBE EXTENDED {snapshot}").where("col_name = 'Location'").first()["data_type"]
        base = spark._jvm.org.apache.hadoop.fs.Path(located).toString()
        spark.sql(f"DROP TABLE IF EXISTS {snapshot}")
        if folders and not any(folder.startswith(f"{base}/") for folder in used):
            folders.add(base)  # with the marks that writing leaves
        for folder in folders - used:
            remove(spark, folder)
    return old


def _is_there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _versions(spark: SparkSession, database: str | None, table: str) -> list[int]:
    prefix = f"{table}__v"
    names = [t.name for t in spark.catalog.listTables(database, f"{prefix}*")]
    return sorted(int(n[len(prefix):]) for n in names if n[len(prefix):].isdigit())


KEY, BUCKET = "_key", "_key_bucket"
#: Buckets of a new table are cut to hold about so many bytes each, as rows in memory: a merge sorts a bucket's old rows beside its new ones.
BUCKET_BYTES = 128 << 20
#: Bytes of rows in memory that a task deals out to buckets as it writes them: it sorts them by bucket first.
DEAL_BYTES = 256 << 20
#: Rows of a file that such a task writes for a bucket, at least, on average.
DEALT_ROWS = 1000
#: Partitions named in one statement.
_AT_ONCE = 1000


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes in a task's memory, however well files compress it."""
    fixed, sizes = 8, []
    for field in df.schema.fields:
        fixed += 8
        if not isinstance(field.dataType, AtomicType) or isinstance(field.dataType, (StringType, BinaryType)):
            value = quoted(field.name)
            sizes.append(F.coalesce(F.octet_length(value if isinstance(field.dataType, BinaryType) else value.cast("string")), F.lit(0)))
            fixed += 4  # texts are filled up to eight bytes
    return sum(sizes, F.lit(fixed)).cast("long")


def slot_sizes(df: DataFrame, column: str) -> list[tuple[int, int]]:
    """How many rows, and bytes of them in memory, there are in each slot of `column` that has any."""
    slot = F.pmod(F.hash(quoted(column)), F.lit(SLOTS)).alias("slot")
    counts = df.groupBy(slot).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes"))
    return [(r["rows"], r["bytes"]) for r in counts.collect()]


def spread(df: DataFrame, column: str, buckets: int, rows: int, size: int) -> DataFrame:
    """`df`, of so many rows and bytes in memory, over as many tasks as can write it in `buckets` of `column`.

    Each task writes a file for each bucket, which takes about a third of the disk that shuffling the rows takes. Where that made tiny
    files, the rows are shuffled to their bucket.
    """
    fewest, most = -(-size // DEAL_BYTES), rows // (DEALT_ROWS * buckets)
    if fewest > most or not most:
        return df.repartition(buckets, column)
    return df.coalesce(max(fewest, min(most, df.sparkSession.sparkContext.defaultParallelism)))


def with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """Add the bucket of each row's KEY: the one that Spark's own bucketing by that column puts it in."""
    return df.withColumn(BUCKET, F.pmod(F.hash(KEY), F.lit(buckets)))


class KeyedTable:
    """A table of plain files in buckets of its key, whose snapshots share every bucket that did not change.

    Readers use the view `name`. It shows one snapshot: an external table, bucketed by KEY (the key as one text) and
    partitioned by the bucket, whose partitions may lie in folders that earlier snapshots wrote. A load writes the buckets it
    changes to a fresh folder, adds the others where they are, and points the view at the new snapshot as the last step. Nothing that a
    reader may be reading is written to, and a load that fails before the last step changes nothing. One writer at a time.
    A join on KEY with rows partitioned alike does not shuffle the table.
    """

    def __init__(self, spark: SparkSession, name: str, fmt: str = "parquet") -> None:
        self._spark, self.name, self._fmt = spark, name, fmt

    @property
    def rows(self) -> DataFrame:
        """All rows with their KEY and bucket."""
        return self._spark.table(shown(self._spark, self.name))

    @property
    def buckets(self) -> int:
        """How many buckets the table is cut into."""
        described = self._spark.sql(f"DESCRIBE EXTENDED {shown(self._spark, self.name)}")
        return int(described.where("col_name = 'Num Buckets'").first()["data_type"])

    @property
    def folders(self) -> dict[int, str]:
        """Where the rows of each bucket are. A folder is written once, so its rows never change."""
        return {int(spec): folder for spec, folder in _folders(self._spark, shown(self._spark, self.name)).items()}

    @property
    def keys(self) -> tuple[str, ...]:
        """The columns that KEY stands for."""
        return tuple(unquote(k) for k in _properties(self._spark, self.name)["keys"].split(","))

    def create(self, df: DataFrame, buckets: int, keys: Sequence[str]) -> None:
        """Make `df`, which has KEY for its `keys` and may read this table, all of its rows."""
        self._write(with_bucket(df, buckets).repartition(buckets, KEY), buckets, keys, {})

    def replace(self, df: DataFrame, touched: Sequence[int]) -> None:
        """Put `df`, which has KEY and may read this table, in place of the `touched` buckets; columns it adds are null elsewhere."""
        kept = {bucket: folder for bucket, folder in self.folders.items() if bucket not in set(touched)}
        self._write(with_bucket(df, self.buckets), self.buckets, self.keys, kept)

    def _write(self, df: DataFrame, buckets: int, keys: Sequence[str], shared: Mapping[int, str]) -> None:
        database, table = split_name(self.name)
        catalog = self._spark.catalog
        snapshot = f"{self.name}__v{max(_versions(self._spark, database, table), default=0) + 1:08d}"
        base = catalog.getDatabase(database or catalog.currentDatabase()).locationUri.rstrip("/")
        folder = f"{base}/{table}__files/{split_name(snapshot)[1]}-{uuid.uuid4().hex}"
        writer = df.write.format(self._fmt).partitionBy(BUCKET).bucketBy(buckets, KEY).option("path", folder)
        if self._fmt == "parquet":
            writer = writer.option("compression", "zstd")
        try:
            writer.saveAsTable(snapshot)
        except Exception:
            remove(self._spark, folder)
            raise
        places = [f"PARTITION ({BUCKET} = {bucket}) LOCATION '{place}'" for bucket, place in shared.items()]
        for start in range(0, len(places), _AT_ONCE):
            self._spark.sql(f"ALTER TABLE {snapshot} ADD {' '.join(places[start : start + _AT_ONCE])}")
        data = [c for c in df.columns if c not in (KEY, BUCKET)]
        columns = [c for c in data if not c.startswith("_")] + [c for c in data if c.startswith("_")]
        _show(self._spark, self.name, snapshot, ", ".join(map(quoted_name, columns)), keys=",".join(quote(k, safe="") for k in keys))


def _folders(spark: SparkSession, table: str) -> dict[str, str]:
    """Where the partitions of a table with one partition column are; none for a table without."""
    if not any(c.isPartition for c in spark.catalog.listColumns(table)):
        return {}
    database, name = split_name(table)
    option, catalog = spark._jvm.scala.Option, spark._jsparkSession.sessionState().catalog()
    found = catalog.listPartitions(spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier(name, option.apply(database)), option.empty())
    partitions = [found.apply(i) for i in range(found.size())]
    return {p.spec().head()._2(): spark._jvm.org.apache.hadoop.fs.Path(p.location()).toString() for p in partitions}


def supports_row_changes(fmt: str) -> bool:
    return fmt in ROW_LEVEL_FORMATS


def _add_columns(spark: SparkSession, name: str, fields: Sequence[StructField]) -> None:
    if fields:
        columns = ", ".join(f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def merge_into(source: DataFrame, name: str, keys: Sequence[str], *, as_of: Column, full_extract: bool,
               new_columns: str = "add") -> None:
    """Merge a stamped batch into a table whose format supports row-level changes.

    One MERGE with the rules of `merge_snapshot`. It rewrites only files that hold changed
    rows, where plain files mean writing the whole table again. Columns that only the source
    has are added to the table first, as MERGE leaves out what the table does not know.
    """
    table = source.sparkSession.table(name)
    merged_columns(table, source, new_columns)
    known = set(table.columns)
    _add_columns(source.sparkSession, name, [f for f in source.schema.fields if f.name not in known])
    target = split_name(name)[1]
    batch = latest_per_key(source, keys).alias("batch")

    def old(column: str) -> Column:
        return F.col(f"{target}.{column}")

    same_key = reduce(and_, [old(k).eqNullSafe(F.col(f"batch.{k}")) for k in keys])
    deleted = F.coalesce(old("_is_deleted"), F.lit(False))
    differs = ~old("_row_hash").eqNullSafe(F.col("batch._row_hash"))
    merge = batch.mergeInto(name, same_key).whenMatched(deleted | differs).updateAll().whenNotMatched().insertAll()
    if full_extract:
        merge = merge.whenNotMatchedBySource(~deleted).update({"_is_deleted": F.lit(True), "_deleted_at": as_of})
    merge.merge()


def append(df: DataFrame, name: str, *, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.format(fmt).mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)

