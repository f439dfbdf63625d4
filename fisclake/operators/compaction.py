"""File sizes: which partitions have too many or too few files, and their rewrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fisclake.functions.keys import PARTITION
from fisclake.operators.audit import counts_side_by_side
from fisclake.operators.sinks import DAY, NO_VALUE, ROW_GROUP_BYTES, ROWS_PER_FILE, VerificationError, recover, swap_folders
from fisclake.sources.scans import read_table
from fisclake.sources.storage import child_folders, exists, files, partition_inventory

# Fixed values of the health test: megabytes per file, and how far the number of files may be off.
TARGET_MB = 160
MAXIMUM_MB = 256
TOLERANCE = 0.15
ARCHIVE_MB = 300
ARCHIVE_FILES = 2


def _megabytes(size: str | Column) -> Column:
    return (F.col(size) if isinstance(size, str) else size) / F.lit(1024 * 1024)


def ideal_files(size: str | Column = "bytes") -> Column:
    megabytes = _megabytes(size)
    return F.greatest(
        F.round(megabytes / TARGET_MB).cast("int"), F.round(megabytes / MAXIMUM_MB).cast("int"), F.lit(1)
    )


def plan(inventory: DataFrame) -> DataFrame:
    """Adds to an inventory (``files``, ``bytes``): the ideal number of files and whether the present one will do."""
    ideal = inventory.withColumn("ideal_files", ideal_files())
    low = F.floor(F.col("ideal_files") * (1 - TOLERANCE))
    high = F.floor(F.col("ideal_files") * (1 + TOLERANCE))
    return ideal.withColumn("healthy", F.col("files").between(low, high))


def newest_partitions(inventory: DataFrame, name: str = PARTITION, count: int | None = 2) -> DataFrame:
    """The ``count`` newest partitions (the weekly run takes all)."""
    ordered = inventory.orderBy(F.desc(name))
    return ordered if count is None else ordered.limit(count)


def day_rewrite_plan(inventory: DataFrame, finished: DataFrame | None, keys: Sequence[str] = ("year", "month", "day")) -> DataFrame:
    """Files per day at the maximum size; days already rewritten are left out."""
    files = F.greatest(F.ceil(_megabytes("bytes") / MAXIMUM_MB).cast("int"), F.lit(1))
    planned = inventory.withColumn("target_files", files)
    return planned if finished is None else planned.join(finished.select(*keys).distinct(), list(keys), "left_anti")


def archive_files(size: str | Column = "bytes") -> Column:
    """Files of one archived month: none above the archive size, at least two."""
    return F.greatest(F.ceil(_megabytes(size) / ARCHIVE_MB).cast("int"), F.lit(ARCHIVE_FILES))


def spread(df: DataFrame, sizes: DataFrame, tasks: int, key: str, partition: str = PARTITION) -> DataFrame:
    """Distribute each partition over its number of files (``sizes``: partition, ``ideal_files``) by the hash of ``key``.

    All partitions are rewritten by one job of ``tasks`` tasks, the sum of ``ideal_files``: each file has a task of its own, numbered by
    a running sum over the partitions. Rows without key (unanswered events, all in the partition of NULL) go by their whole content.
    """
    column = next((name for name in df.columns if name.lower() == key.lower()), None)
    whole = F.xxhash64(*df.columns)
    hashed = F.when(F.col(column).isNotNull(), F.xxhash64(column)).otherwise(whole) if column else whole
    before = Window.orderBy("__name").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    numbered = sizes.select(_name(partition).alias("__name"), F.col("ideal_files").alias("__files")).withColumn(
        "__first", F.coalesce(F.sum("__files").over(before), F.lit(0))
    )
    salted = df.withColumn("__name", _name(partition)).join(numbered, "__name", "left")
    task = (F.coalesce("__first", F.lit(0)) + F.pmod(hashed, F.coalesce("__files", F.lit(1)))).cast("int")
    return salted.repartitionById(tasks, task).select(*df.columns)


def _name(partition: str) -> Column:
    """Partition value as its folder says it."""
    return F.coalesce(F.col(partition).cast("string"), F.lit(NO_VALUE))


def compact(spark: SparkSession, path: str, key: str = "chave", partition: str = PARTITION,
            inventory: DataFrame | None = None) -> DataFrame:
    """Rewrite the unhealthy partitions of a table in one job, verify them all, then swap each in by renaming.

    Healthy partitions are not read. Returns the plan that was carried out. Old folders wait outside the table until the new ones are in place; what a failed
    run left there is put right first.
    """
    replaced = f"{path}_replaced"
    for name in child_folders(spark, replaced):
        recover(spark, f"{path}/{name}", f"{replaced}/{name}")
    found = plan(inventory if inventory is not None else partition_inventory(spark, path, [partition]))
    rows = found.collect()  # one row per partition; the listing would be read again, and show other files, once they are swapped
    sizes = spark.createDataFrame(rows, found.schema)
    planned = [row for row in rows if not row.healthy]
    if planned:
        unhealthy = [row[partition] for row in planned]
        folders = [f"{path}/{partition}={value}" for value in unhealthy]
        table = read_table(spark, path, [partition], [f"{partition}={value}" for value in unhealthy])
        staging = f"{path}_compacted"
        tasks = sum(row.ideal_files for row in planned)
        compacted = spread(table, sizes.filter("NOT healthy"), tasks, key, partition).write.mode("overwrite").option("compression", "lz4")
        compacted.option("maxRecordsPerFile", ROWS_PER_FILE).option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(partition).parquet(staging)
        require_same_partition_rows(table, read_table(spark, staging, [partition]), partition)
        for value, folder in zip(unhealthy, folders, strict=True):
            swap_folders(spark, f"{staging}/{partition}={value}", folder, f"{replaced}/{partition}={value}")
    return sizes


def require_same_partition_rows(table: DataFrame, copy: DataFrame, partition: str) -> None:
    """Raise if any partition has another number of rows in the copy."""
    differing = counts_side_by_side(table, copy, partition, "before", "after").filter("before <> after").select(partition).take(5)
    if differing:
        raise VerificationError(f"rows differ in partitions {[row[partition] for row in differing]}")


def consolidate_month(spark: SparkSession, folders: Sequence[str], target: str) -> None:
    """Many day folders into one month folder of evenly filled files."""
    listing = None
    for folder in folders:
        one = files(spark, folder)
        listing = one if listing is None else listing.unionByName(one)
    count = listing.agg(archive_files(F.sum("bytes")).alias("files")).first().files
    spark.read.parquet(*folders).repartition(count).write.mode("overwrite").option("compression", "lz4").parquet(target)


_JOURNAL = "year string, month string, day string, bytes long, state string"


def rewrite_days(spark: SparkSession, path: str, journal: str, most: int | None = None, together: int = 10, keys: Sequence[str] = DAY) -> DataFrame:
    """Rewrite the days of an archive with full files, each once; returns the journal of all runs.

    ``together`` days are rewritten by one job, in which each file to be has a task; each day is then verified, swapped in by renaming and noted in the
    ``journal`` with its new size. A run that is cut off, or ends after ``most`` days, is resumed by the next one: days noted with the size they have are
    left alone, one that has grown since is rewritten again.
    """
    replaced = f"{path}_replaced"
    inventory = partition_inventory(spark, path, list(keys))
    sizes = {tuple(row[k] for k in keys): row for row in inventory.collect()}  # a row per day
    for name in child_folders(spark, replaced):
        recover(spark, f"{path}/{name.replace('+', '/')}", f"{replaced}/{name}")
    finished = spark.createDataFrame([], _JOURNAL)
    if exists(spark, journal):
        finished = spark.read.schema(_JOURNAL).parquet(journal).filter("state = 'done'")
    current = finished.join(inventory.select(*keys, "bytes"), [*keys, "bytes"], "left_semi")
    planned = sorted(day_rewrite_plan(inventory, current, keys).collect(), key=lambda row: tuple(row[k] for k in keys))[:most]
    for begin in range(0, len(planned), together):
        part = planned[begin : begin + together]
        folders = ["/".join(f"{k}={row[k]}" for k in keys) for row in part]
        table = read_table(spark, path, list(keys), folders)
        whole = F.concat_ws("/", *(F.col(k) for k in keys))
        targets = spark.createDataFrame([("/".join(row[k] for k in keys), row.target_files) for row in part], "__day string, ideal_files int")
        dealt = spread(table.withColumn("__day", whole), targets, sum(row.target_files for row in part), "", "__day").drop("__day")
        staged = f"{path}_staged"
        dealt.write.mode("overwrite").option("compression", "lz4").option("parquet.block.size", ROW_GROUP_BYTES).partitionBy(*keys).parquet(staged)
        require_same_partition_rows(table.withColumn("__day", whole), read_table(spark, staged, list(keys)).withColumn("__day", whole), "__day")
        stamps = {tuple(row[k] for k in keys): row.bytes for row in partition_inventory(spark, staged, list(keys)).collect()}
        for row, folder in zip(part, folders, strict=True):
            swap_folders(spark, f"{staged}/{folder}", f"{path}/{folder}", f"{replaced}/{folder.replace('/', '+')}")
            day = tuple(row[k] for k in keys)
            spark.createDataFrame([(*day, stamps[day], "done")], _JOURNAL).coalesce(1).write.mode("append").parquet(journal)
    return spark.read.schema(_JOURNAL).parquet(journal) if sizes else spark.createDataFrame([], _JOURNAL)
