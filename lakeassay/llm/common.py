"""What the operators share: words, row keys, staged tables and the split of labelled rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
SPACE = " \t\n\x0b\x0c\r"
#: Prefix of the columns that operators add for themselves and drop again.
OWN = "__llm_"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, else one in the warehouse, if the cluster shares that."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.conf.get("spark.master", None) or "local"
    if not master.startswith("local") and (warehouse.startswith("file:") or "://" not in warehouse):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse {warehouse} is a local one")
    return f"{warehouse}/_shared".rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Write `df` once to a fresh place in the shared folder and read it back, which cuts its lineage.

    Results may read the copy for as long as the session lives; it is removed when that ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    copy = spark._jvm.org.apache.hadoop.fs.Path(path)
    copy.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(copy)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder in the shared folder, removed with all it holds when the session ends."""
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def row_key(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the named columns that tell rows apart, nulls included."""
    parts = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(0), *parts).alias(f"{OWN}k0"), F.xxhash64(F.lit(1), *parts).alias(f"{OWN}k1")]


KEYS = [f"{OWN}k0", f"{OWN}k1"]


def shielded(df: DataFrame, *names: str) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """`df` with those columns renamed whose names begin as the operators' own do, what `names` are called there, and a
    function that gives a result the old names back."""
    renamed = {c: f"_kept_{i}" + "_" * max(map(len, df.columns)) for i, c in enumerate(df.columns) if c.lower().startswith(OWN)}
    safe = df.toDF(*[renamed.get(c, c) for c in df.columns]) if renamed else df
    return safe, [renamed.get(n, n) for n in names], lambda result: result.withColumnsRenamed({v: k for k, v in renamed.items()})


def hashable(df: DataFrame) -> list[str]:
    """The columns Spark can hash and compare."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the quarter that no model may learn from; a null id does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def word_count(text: Column) -> Column:
    """Number of words; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def bounded_broadcast(spark: SparkSession, value, size: int, limit: int, what: str):
    """Broadcast a model whose size in bytes is known and below its stated limit."""
    if size > limit:
        raise ValueError(f"{what} takes {size} bytes; at most {limit} may be sent to every executor")
    return spark.sparkContext.broadcast(value)
