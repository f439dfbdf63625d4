"""Comparisons between layers: what is missing, what is there twice, what does not add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fisclake.functions.keys import PARTITION


def missing_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose ``columns`` do not occur in ``right``.

    The right side is reduced to distinct keys first; that happens before its shuffle, so a key repeated a million times
    travels once. Only keys are compared; the rows, which may hold whole documents, are looked up by the few keys that are missing.
    """
    keys = list(columns)
    absent = left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")
    alike = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return left.alias("l").join(absent.alias("r"), alike, "left_semi")


def missing_in_silver(bronze: DataFrame, silver: DataFrame, bronze_key: str = "CHAVE", silver_key: str = "chave") -> DataFrame:
    """Bronze rows that never reached silver; keys compare without regard to case."""
    keyed = bronze.withColumn("__key", F.lower(bronze_key))
    loaded = silver.select(F.lower(silver_key).alias("__key"))
    return missing_rows(keyed, loaded, ["__key"]).drop("__key")


def distinct_keys_except(left: DataFrame, right: DataFrame, left_key: str, right_key: str, name: str = "chave") -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks, both compared as text. NULL is a key like any other.

    Each key travels once per side and task: both sides meet in a single shuffle, merged before it.
    """
    wanted = left.select(F.col(left_key).cast("string").alias(name), F.lit(False).alias("__found"))
    present = right.select(F.col(right_key).cast("string").alias(name), F.lit(True).alias("__found"))
    return wanted.unionAll(present).groupBy(name).agg(F.max("__found").alias("__found")).filter("NOT __found").select(name)


def _key_sides(expected: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """One row per key with 1 or 0 for ``listed`` and ``found``: both lists meet in a single shuffle."""
    sides = expected.select(key, F.lit(1).alias("listed"), F.lit(0).alias("found")).unionByName(
        table.select(key, F.lit(0).alias("listed"), F.lit(1).alias("found"))
    )
    return sides.groupBy(key).agg(F.max("listed").alias("listed"), F.max("found").alias("found"))


def compare_key_lists(expected: DataFrame, table: DataFrame, key: str = "chave") -> DataFrame:
    """Missing and extra keys: one row per key that only one side has, with ``side``."""
    side = F.when(F.col("found") == 0, "missing").otherwise("extra").alias("side")
    return _key_sides(expected, table, key).filter("listed <> found").select(key, side)


def key_list_totals(expected: DataFrame, table: DataFrame, key: str = "chave") -> DataFrame:
    """One row: keys listed, keys found in the table, missing, extra."""
    return _key_sides(expected, table, key).agg(
        F.sum("listed").cast("bigint").alias("listed"),
        F.sum("found").cast("bigint").alias("found"),
        F.count_if(F.expr("listed > found")).alias("missing"),
        F.count_if(F.expr("found > listed")).alias("extra"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("count")).filter("count > 1")


def duplicate_records(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of repeated keys.

    Keys are counted first (merged before the shuffle) and joined back. A window would sort each key in one task; a join
    with a hot key is split by adaptive execution.
    """
    return df.join(duplicate_keys(df, keys).drop("count"), list(keys))


def count_by(df: DataFrame, *columns: str | Column, name: str = "count") -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias(name)).orderBy(*columns)


def documents_by_partition(df: DataFrame, key: str = "chave", partition: str = PARTITION) -> DataFrame:
    """Distinct documents per partition."""
    return df.select(partition, key).distinct().groupBy(partition).agg(F.count("*").alias("documents"))


def counts_side_by_side(left: DataFrame, right: DataFrame, by: str, left_name: str, right_name: str) -> DataFrame:
    """Rows per value of ``by`` on both sides, 0 where a side has none. NULL is a value like any other."""
    def side(df: DataFrame, a: int, b: int) -> DataFrame:
        return df.groupBy(by).agg((F.count("*") * a).alias(left_name), (F.count("*") * b).alias(right_name))

    both = side(left, 1, 0).unionByName(side(right, 0, 1))
    return both.groupBy(by).agg(F.sum(left_name).alias(left_name), F.sum(right_name).alias(right_name))


def reconcile_partitions(left: DataFrame, right: DataFrame, key: str = "chave", partition: str = PARTITION) -> DataFrame:
    """Distinct documents per partition on both sides and their difference; a side without the partition counts 0."""
    distinct = (df.select(partition, key).distinct() for df in (left, right))
    joined = counts_side_by_side(*distinct, partition, "left_documents", "right_documents")
    return joined.withColumn("difference", F.col("left_documents") - F.col("right_documents"))


def differing_partitions(reconciled: DataFrame, partition: str = PARTITION) -> DataFrame:
    return reconciled.filter("difference <> 0").orderBy(F.desc("difference"), partition)


def daily_totals(df: DataFrame, day: Column, key: str) -> DataFrame:
    """Per day: rows, distinct keys, repeated rows."""
    per_key = df.groupBy(day.alias("day"), key).agg(F.count("*").alias("__rows"))
    totals = per_key.groupBy("day").agg(F.sum("__rows").alias("total"), F.count(key).alias("distinct_keys"))
    return totals.withColumn("repeated", F.col("total") - F.col("distinct_keys"))


def totals_with_grand_total(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per group plus one row over everything, whose group columns are NULL."""
    everything = F.grouping_id() == 2 ** len(columns) - 1
    rolled = df.rollup(*columns).agg(F.count("*").alias("total"), everything.alias("is_total"), F.grouping_id().alias("level"))
    return rolled.filter("level = 0 OR is_total").drop("level")


def compare_totals(source: DataFrame, lake: DataFrame, on: str) -> DataFrame:
    """Groups whose totals differ between the source and the lake (both sides: ``on``, ``total``)."""
    joined = source.select(on, F.col("total").alias("source_total")).join(
        lake.select(on, F.col("total").alias("lake_total")), on, "full"
    )
    filled = joined.na.fill(0, ["source_total", "lake_total"])
    compared = filled.withColumn("difference", F.col("source_total") - F.col("lake_total"))
    return compared.filter("difference <> 0")
