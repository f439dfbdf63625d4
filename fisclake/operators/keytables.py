"""Keys of a layer kept in buckets, so that layers are compared, and batches looked up, without shuffling what is stored."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.keys import PARTITION, partition_key
from fisclake.sources.storage import exists

#: Partition of keys too short to say their month.
NO_MONTH = "none"


@dataclass(frozen=True)
class KeyTable:
    """The distinct keys of a layer: ``name`` in the catalog, stored below ``path``, partitioned by month of the key and bucketed by key.

    Tables that are compared must have the same number of ``buckets``. A bucket of a month should fit into a task: some hundred bytes a key.
    """

    name: str
    path: str
    buckets: int = 64


def _month(key: str) -> Column:
    return F.when(F.char_length(key) >= 6, partition_key(key)).otherwise(NO_MONTH)


def _keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct keys as text in small letters. NULL is no key."""
    return df.select(F.lower(F.col(key).cast("string")).alias("chave")).filter("chave IS NOT NULL").distinct()


def open_keys(spark: SparkSession, table: KeyTable) -> DataFrame:
    """The table as a DataFrame. A catalog that doesn't know it yet learns it from its folder."""
    if not spark.catalog.tableExists(table.name):
        spark.sql(
            f"""CREATE TABLE {table.name} (chave STRING, {PARTITION} STRING) USING parquet PARTITIONED BY ({PARTITION})
                CLUSTERED BY (chave) INTO {table.buckets} BUCKETS LOCATION '{table.path}'"""
        )
        if exists(spark, table.path):
            spark.catalog.recoverPartitions(table.name)
    return spark.table(table.name)


def in_months(keys: DataFrame, months: Sequence[str] | None) -> DataFrame:
    """The keys of these months, by partition; all without ``months``."""
    return keys if months is None else keys.filter(F.col(PARTITION).isin(*months))


def key_months(df: DataFrame, key: str = "chave") -> list[str]:
    """The months that the keys of a batch belong to: some, out of all in the table."""
    return sorted(row[0] for row in _keys(df, key).select(_month("chave")).distinct().collect())


def new_keys(df: DataFrame, table: KeyTable, key: str = "chave") -> DataFrame:
    """Distinct keys of a batch that the table lacks. Only the batch is shuffled, once and into the table's buckets; of the table the
    batch's months are read where they lie. (Spark would push an anti-join below the repartition, an outer join it leaves above.)"""
    spark = df.sparkSession
    stored = in_months(open_keys(spark, table), key_months(df, key)).select("chave", F.lit(True).alias("known"))
    joined = _keys(df, key).repartition(table.buckets, "chave").join(stored, "chave", "left")
    return joined.filter("known IS NULL").select("chave")


def add_keys(df: DataFrame, table: KeyTable, key: str = "chave") -> None:
    """File the keys of a batch. Those that are there are left alone, so a batch may come again; no keys: nothing is written.

    A write that was cut off and runs again may leave a key twice, which changes no comparison.
    """
    fresh = new_keys(df, table, key).withColumn(PARTITION, _month("chave"))
    fresh.repartition(table.buckets, "chave").sortWithinPartitions(PARTITION).write.insertInto(table.name)


def missing_keys(spark: SparkSession, left: KeyTable, right: KeyTable, months: Sequence[str] | None = None) -> DataFrame:
    """Keys (``chave``, month) of ``left`` that ``right`` lacks: bucket against bucket, nothing is shuffled, other months aren't read.

    Each task holds the same bucket of both sides; equal keys meet in it whatever their number.
    """
    if left.buckets != right.buckets:
        raise ValueError(f"{left.name} has {left.buckets} buckets, {right.name} {right.buckets}")
    known = in_months(open_keys(spark, right), months).select("chave")
    return in_months(open_keys(spark, left), months).join(known, "chave", "left_anti")


def key_audit(spark: SparkSession, pairs: Iterable[tuple[str, KeyTable, KeyTable]], months: Sequence[str] | None = None) -> DataFrame:
    """Keys that silver lacks, for each (table, bronze keys, silver keys): table, key; see ``plans.audits.bronze_silver_audit``."""
    result = None
    for name, bronze, silver in pairs:
        rows = missing_keys(spark, bronze, silver, months).select(F.lit(name).alias("table"), F.col("chave").alias("key"))
        result = rows if result is None else result.unionByName(rows)
    return result if result is not None else spark.createDataFrame([], "table string, key string")
