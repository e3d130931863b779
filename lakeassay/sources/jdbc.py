"""Parallel reads from a database. Credentials come from the caller and are not kept."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10000


@dataclass(frozen=True)
class JdbcSource:
    """Connection settings; the password stays out of the printed form."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = FETCH_SIZE

    def __post_init__(self) -> None:
        if not self.user:
            raise ValueError("database user is empty")
        if not self.password:
            raise ValueError("database password is empty")

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "fetchsize": str(self.fetch_size),
        }


def postgres_url(host: str, database: str, port: int = 5432) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def range_options(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Stride options for a numeric, date or timestamp column; none for an empty table."""
    if lower is None or upper is None:
        return {}
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def bucket_predicates(integer_expression: str, partitions: int) -> list[str]:
    """One condition per partition over an integer SQL expression of the database.

    For keys that have no even range, such as text: pass the database's hash of the key,
    for example `hashtext(nct_id)`. Together the conditions cover every row, nulls included.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    # The sign of MOD follows the hash, which may be negative.
    bucket = f"ABS(MOD({integer_expression}, {partitions}))"
    rest = [f"{bucket} = {i}" for i in range(1, partitions)]
    return [f"({bucket} = 0 OR {bucket} IS NULL)", *rest]


def quantile_boundaries(sample: Sequence, partitions: int) -> list:
    """Values that cut a sorted sample into `partitions` parts of about equal size; fewer where one value fills several.

    The sample must be in the order of whoever will compare with the boundaries: a database sorts text by its own rules.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    cuts = [sample[len(sample) * i // partitions] for i in range(1, partitions)] if sample else []
    return list(dict.fromkeys(c for c in cuts if c != sample[0]))


def range_predicates(column: str, boundaries: Sequence) -> list[str]:
    """One condition per range between the boundaries, on the bare column, so that an index serves each.

    The boundaries are texts or numbers that rise in the order of the column. Together the conditions cover every row
    once; nulls go with the first.
    """
    def literal(value) -> str:
        return str(value) if isinstance(value, (int, Decimal)) else "'" + str(value).replace("'", "''") + "'"

    if not boundaries:
        return ["1 = 1"]
    edges = [literal(b) for b in boundaries]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(edges, edges[1:])]
    return [f"({column} < {edges[0]} OR {column} IS NULL)", *middle, f"{column} >= {edges[-1]}"]


def sample_query(table: str, column: str, share: float) -> str:
    """SQL for a sorted sample of a column: a share of the table's blocks, as most databases sample by name."""
    if not 0 < share <= 1:
        raise ValueError("the share of a sample is above 0 and at most 1")
    sampled = f"{table} TABLESAMPLE SYSTEM ({share * 100:g})" if share < 1 else table
    return f"SELECT {column} AS sampled FROM {sampled} WHERE {column} IS NOT NULL ORDER BY {column}"


def read_table(spark: SparkSession, source: JdbcSource, table: str, *,
               partition_column: str | None = None, partitions: int = 1,
               bucket_expression: str | None = None, split_column: str | None = None, sample_share: float = 0.001) -> DataFrame:
    """A table as a lazy scan; filters on it reach the database.

    `partition_column` splits the scan into equal ranges between the column's bounds, which
    one small query fetches. `split_column` splits it into ranges of about equally many rows, for text and for numbers that
    are spread unevenly: the driver fetches a sorted sample of `sample_share` of that column, to be chosen so that it has
    some hundred values per partition. `bucket_expression` splits by a database-side hash instead, which no index serves.
    """
    predicates = None
    if bucket_expression:
        predicates = bucket_predicates(bucket_expression, partitions)
    elif split_column and partitions > 1:
        sample = spark.read.format("jdbc").options(**source.options()).option("query", sample_query(table, split_column, sample_share)).load()
        predicates = range_predicates(split_column, quantile_boundaries([r[0] for r in sample.collect()], partitions))
    if predicates:
        connection = {k: v for k, v in source.options().items() if k != "url"}
        return spark.read.jdbc(source.url, table, predicates=predicates, properties=connection)
    options = source.options()
    if partition_column and partitions > 1:
        options |= _range_of(spark, options, table, partition_column, partitions)
    return spark.read.format("jdbc").options(**options).option("dbtable", table).load()


def _range_of(spark: SparkSession, options: Mapping[str, str], table: str, column: str, partitions: int) -> dict[str, str]:
    query = f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"
    bounds = spark.read.format("jdbc").options(**options).option("query", query).load().first()
    return range_options(column, bounds["low"], bounds["high"], partitions)
