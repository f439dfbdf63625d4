"""Extraction from a relational source in parallel ranges of one numeric column."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SplitRange:
    lower: int
    upper: int
    partitions: int


def split_range(lower: int | None, upper: int | None, partitions: int) -> SplitRange | None:
    """Ranges of at least one value each; None when there is nothing to read."""
    if lower is None or upper is None:
        return None
    lower, upper = int(lower), int(upper)
    return SplitRange(lower, upper, max(1, min(partitions, upper - lower)))


def range_bounds(df: DataFrame, column: str, partitions: int) -> DataFrame:
    """The same decision as one row of a DataFrame: lower, upper, partitions, stride."""
    limits = df.agg(F.min(column).cast("bigint").alias("lower"), F.max(column).cast("bigint").alias("upper"))
    count = F.greatest(F.lit(1), F.least(F.lit(partitions), F.col("upper") - F.col("lower"))).cast("bigint")
    sized = limits.filter("lower IS NOT NULL").withColumn("partitions", count)
    return sized.withColumn("stride", F.expr("greatest(1, (upper - lower) div partitions)"))


def source_query(table: str, columns: Sequence[str], time_column: str, start: str, end: str) -> str:
    """Rows of a half-open time window; the source evaluates it, so only they travel."""
    return (
        f"SELECT {', '.join(columns)} FROM {table} "
        f"WHERE {time_column} >= TIMESTAMP '{start}' AND {time_column} < TIMESTAMP '{end}'"
    )


def partitioned_read(spark: SparkSession, url: str, query: str, column: str, partitions: int,
                     properties: dict[str, str]) -> DataFrame:
    """Read ``query`` in ``partitions`` ranges of ``column``: one query for the limits, then one per range."""
    limits = spark.read.jdbc(url, f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM ({query}) q) b", properties=properties)
    lower, upper = limits.first()
    ranges = split_range(lower, upper, partitions)
    if ranges is None:
        return spark.read.jdbc(url, f"({query}) q", predicates=["1 = 0"], properties=properties)
    return spark.read.jdbc(
        url,
        f"({query}) q",
        column=column,
        lowerBound=ranges.lower,
        upperBound=ranges.upper,
        numPartitions=ranges.partitions,
        properties=properties,
    )


def key_predicates(column: str, keys: Sequence[str], size: int = 1000) -> Iterator[str]:
    """IN lists of at most ``size`` keys (sources limit them), one per read task."""
    for start in range(0, len(keys), size):
        quoted = ", ".join("'" + key.replace("'", "''") + "'" for key in keys[start : start + size])
        yield f"{column} IN ({quoted})"


def read_keys(spark: SparkSession, url: str, table: str, column: str, keys: Sequence[str],
              properties: dict[str, str]) -> DataFrame:
    """Fetch only the listed documents. The list travels inside SQL: for lists beyond some ten thousand keys read the
    window instead and keep the listed ones with :func:`fisclake.sources.scans.listed`."""
    predicates = list(key_predicates(column, keys)) or ["1 = 0"]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def source_count(spark: SparkSession, url: str, query: str, key: str, properties: dict[str, str]) -> DataFrame:
    """One row ``total``: counted by the source."""
    return spark.read.jdbc(url, f"(SELECT COUNT({key}) AS total FROM ({query}) q) c", properties=properties)
