"""A copy of a table that follows the original."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.keys import PARTITION
from fisclake.operators.audit import counts_side_by_side
from fisclake.operators.sinks import NO_VALUE, write_partitioned
from fisclake.sources.scans import read_table
from fisclake.sources.storage import exists, partition_inventory, remove


def changed_partitions(spark: SparkSession, path: str, since: str | None = None, partition: str = PARTITION) -> DataFrame:
    """Partitions with a file modified at or after ``since`` (all of them without it)."""
    inventory = partition_inventory(spark, path, [partition])
    return inventory if since is None else inventory.filter(F.col("mtime") >= F.lit(since).cast("timestamp"))


def mirror(spark: SparkSession, source: str, target: str, since: str | None = None, partition: str = PARTITION) -> int:
    """Copy the changed partitions over those of the target; returns their number."""
    changed = [row[partition] for row in changed_partitions(spark, source, since, partition).select(partition).collect()]
    if changed:
        table = read_table(spark, source, [partition], [f"{partition}={value}" for value in changed])
        write_partitioned(table, target, [partition], mode="overwrite", partitionOverwriteMode="dynamic")
    return len(changed)


def verify_mirror(spark: SparkSession, source: str, target: str, partition: str = PARTITION) -> DataFrame:
    """Rows per partition on both sides."""
    filled = counts_side_by_side(*(read_table(spark, path, [partition]) for path in (source, target)), partition, "source_rows", "target_rows")
    return filled.withColumn("equal", F.col("source_rows") == F.col("target_rows"))


def partition_digests(table: DataFrame, partition: str = PARTITION) -> DataFrame:
    """Rows of each partition, and a sum and an exclusive or of their hashes: equal for equal rows in any order and any files."""
    columns = sorted((c for c in table.columns if c.lower() != partition.lower()), key=str.lower)
    # A null changes no hash by itself.
    row = F.xxhash64(*(x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))))
    hashed = table.select(partition, row.alias("hash"))
    return hashed.groupBy(partition).agg(F.count("*").alias("rows"), F.sum(F.col("hash").cast("decimal(38,0)")).alias("total"), F.bit_xor("hash").alias("folded"))


def compare_mirror(spark: SparkSession, source: str, target: str, partition: str = PARTITION) -> DataFrame:
    """Every partition of either side: rows on both and whether their content is equal. A changed value is found, an equal count or not."""
    sides = [partition_digests(read_table(spark, path, [partition]), partition) for path in (source, target)]
    a, b = (side.alias(name) for side, name in zip(sides, "ab", strict=True))
    both = a.join(b, F.col(f"a.{partition}").eqNullSafe(F.col(f"b.{partition}")), "full")
    equal = F.coalesce((F.col("a.rows") == F.col("b.rows")) & (F.col("a.total") == F.col("b.total")) & (F.col("a.folded") == F.col("b.folded")), F.lit(False))
    return both.select(
        F.coalesce(f"a.{partition}", f"b.{partition}").alias(partition), F.coalesce("a.rows", F.lit(0)).alias("source_rows"), F.coalesce("b.rows", F.lit(0)).alias("target_rows"), equal.alias("equal")
    )


def synchronise(spark: SparkSession, source: str, target: str, partition: str = PARTITION) -> DataFrame:
    """Make the content of ``target`` that of ``source``: partitions whose content differs are copied, those the source has lost are removed, the
    others aren't touched. Returns what was done: the partition and ``action`` (copied or removed). Run again after a failure, it does the rest."""
    if exists(spark, target):
        differing = compare_mirror(spark, source, target, partition).filter("NOT equal").collect()  # a row per partition
    else:
        own = partition_digests(read_table(spark, source, [partition]), partition)
        differing = own.select(partition, F.col("rows").alias("source_rows")).collect()
    folder = {row[partition]: f"{partition}={NO_VALUE if row[partition] is None else row[partition]}" for row in differing}
    copied = [row[partition] for row in differing if row.source_rows]
    lost = [row[partition] for row in differing if not row.source_rows]
    if copied:
        table = read_table(spark, source, [partition], [folder[value] for value in copied])
        write_partitioned(table, target, [partition], mode="overwrite", partitionOverwriteMode="dynamic")
    for value in lost:
        remove(spark, f"{target}/{folder[value]}")
    done = [(value, "copied") for value in copied] + [(value, "removed") for value in lost]
    return spark.createDataFrame(done, f"{partition} string, action string")
