"""CSV files with a header and a declared layout."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeassay.functions import quoted

# Quotes are doubled inside quoted values, and whitespace around values is data. Null is
# written as nothing and empty text as a pair of quotes. To keep them apart on reading, the
# text that stands for null must be one that is not empty and never occurs.
_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
_READ = {
    "header": "true",
    "escape": '"',
    "multiLine": "false",
    "mode": "PERMISSIVE",
    "nullValue": "\u0000",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_WRITE).csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, *, multiline: bool = False) -> DataFrame:
    """Rows with the declared types; values that do not parse become null.

    `multiline` is for values that hold line breaks. Such files cannot be split between
    tasks, so it is off by default.
    """
    options = {**_READ, "multiLine": str(multiline).lower()}
    return spark.read.schema(schema).options(**options).csv(path)


class CsvRows(NamedTuple):
    """What a file holds: rows that parse, and `rejected` lines with `file`, `record` and `reason`."""

    kept: DataFrame
    rejected: DataFrame


def split_csv(spark: SparkSession, path: str, schema: StructType, *, multiline: bool = False, header: bool = True) -> CsvRows:
    """The rows whose every value has its declared type, and the other lines as they stand, each with the reason.

    Together they are all lines that are not blank. A line is rejected for values that do not parse and for more or
    fewer values than columns. Text columns take any value. Nothing is counted or dropped on the way: whoever reads the
    rejected lines decides. Each of the two reads the files once.
    """
    record = "_corrupt_record"
    while record in schema.fieldNames():
        record += "_"
    # Every value is looked at, also of columns that the reader of the result does not ask for.
    options = {**_READ, "multiLine": str(multiline).lower(), "header": str(header).lower(), "columnNameOfCorruptRecord": record,
               "columnPruning": "false"}
    declared = StructType([StructField(f.name, f.dataType) for f in schema.fields] + [StructField(record, StringType())])
    rows = spark.read.schema(declared).options(**options).csv(path)
    # Spark refuses scans that want the rejected text and nothing else, as a mere count would: this holds for every row.
    read = F.hash(quoted(schema.fieldNames()[0])) >= F.lit(-(2**31))
    kept = rows.where(quoted(record).isNull() & read).drop(record)
    rejected = rows.where(quoted(record).isNotNull() & read).select("*", F.col("_metadata.file_path").alias("_file"))
    return CsvRows(kept, _explained(rejected, schema, record))


def _explained(rejected: DataFrame, schema: StructType, record: str) -> DataFrame:
    """Lines with their reason, from comparing the values as text with the values that were parsed."""
    count = len(schema.fields)
    texts = StructType([StructField(f"c{i}", StringType()) for i in range(count + 1)])
    split = F.from_csv(quoted(record), ", ".join(f"c{i} string" for i in range(count + 1)), {k: v for k, v in _READ.items() if k != "header"})

    def lost(i: int) -> Column:
        field, text = schema.fields[i], F.col(f"_texts.c{i}")
        told = F.concat(F.lit(f"{field.name}: '"), text, F.lit(f"' is not {field.dataType.simpleString()}"))
        return F.when(text.isNotNull() & quoted(field.name).isNull(), told)

    reasons = F.array_compact(F.array(*map(lost, range(count))))
    reason = (F.when(F.col(f"_texts.{texts.fieldNames()[-1]}").isNotNull(), f"more than {count} values")
              .when(F.size(reasons) > 0, F.array_join(reasons, "; ")).otherwise(f"not {count} values"))
    return (rejected.withColumn("_texts", split)
            .select(F.col("_file").alias("file"), quoted(record).alias("record"), reason.alias("reason")))
