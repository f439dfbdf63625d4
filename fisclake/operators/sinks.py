"""Writes: silver appends, day archives, hand-overs, safe replacement."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.dates import timestamp, with_parsed_day
from fisclake.functions.keys import PARTITION
from fisclake.operators.repair import deduplicate, deduplication_report
from fisclake.sources.scans import read_table
from fisclake.sources.storage import existing_partitions, exists, move, publish_folders, remove

DAY = ("year", "month", "day")
#: Folder value of a partition column that is NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Row-group size and rows per file of the silver tables.
ROW_GROUP_BYTES = 500 * 1024 * 1024
ROWS_PER_FILE = 4_200_000


# Numbers of the source that are text in the lake. A family has some of them.
TEXT_COLUMNS = ("NSU", "NSUDF", "NSUSVD", "NSUAUT", "NSUAN", "CSTAT", "MODELO", "TPEMIS")


class VerificationError(RuntimeError):
    """A rewritten table is not what it should be; the original is untouched."""


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str] = (PARTITION,), mode: str = "append",
                      columns: Sequence[str] = (), **options: object) -> None:
    """Write a partitioned table with few, full files.

    ``columns``: SQL expressions that make the table's columns of those of ``df`` after its rows were moved and sorted; columns that hardly any row fills
    then cost no shuffle.

    Rows are brought together by partition value, and adaptive execution splits a value that holds too much (a third of
    all rows may lie in one month) and merges small ones; a fixed number of tasks would do neither.
    """
    settings = {"compression": "lz4", "parquet.block.size": ROW_GROUP_BYTES, "maxRecordsPerFile": ROWS_PER_FILE, **options}
    balanced = df.hint("rebalance", *partitions)  # without columns: evenly filled tasks
    if columns:
        balanced = balanced.sortWithinPartitions(*partitions).selectExpr(*columns)
    balanced.write.mode(mode).options(**settings).partitionBy(*partitions).parquet(path)


def write_once(df: DataFrame, path: str) -> bool:
    """Write unless the folder is there already; False if it was.

    The folder gets its name when it is complete. One that a failed job left, still with its temporary files, doesn't count.
    """
    spark = df.sparkSession
    if exists(spark, path) and not exists(spark, f"{path}/_temporary"):
        return False
    writing = f"{path}_writing"
    df.write.mode("overwrite").option("compression", "lz4").parquet(writing)
    if exists(spark, path):
        remove(spark, path)
    move(spark, writing, path)
    return True


def archive_new_days(df: DataFrame, path: str, stamp: str = "DHPROC") -> None:
    """Append the days the archive lacks, under ``year=/month=/day=``; days it has are left alone.

    New days are written beside the archive and moved into it whole, one after another: after a failure the archive holds a day completely
    or not at all, and the next run brings the rest. Rows whose time is none go to ``<path>_rejected``, once each however often they are delivered.
    """
    spark = df.sparkSession
    rejects = df.filter(timestamp(stamp).isNull())
    if exists(spark, f"{path}_rejected"):
        rejects = rejects.exceptAll(spark.read.schema(df.schema).parquet(f"{path}_rejected"))
    write_partitioned(rejects, f"{path}_rejected", ())
    dated = with_parsed_day(df, stamp)
    present = existing_partitions(spark, path, DAY)
    if present is not None:  # older folders are called month=4, newer ones month=04
        padded = present.select("year", *(F.lpad(name, 2, "0").alias(name) for name in ("month", "day")))
        dated = dated.join(padded, list(DAY), "left_anti")
    staged = f"{path}_staged"
    write_partitioned(dated, staged, DAY, mode="overwrite")
    publish_folders(spark, staged, path, len(DAY))


def hand_over(df: DataFrame, path: str, batch: str, text_columns: Sequence[str] = TEXT_COLUMNS, rename: dict[str, str] | None = None,
              stamp: str = "DHPROC") -> None:
    """Give a family's documents or events to the older day layout: keys as text, one write for all days.

    ``batch`` names what is handed over (a day, a delivery): done once, it adds nothing when run again; see ``streaming.incremental.append_batch``. Rows whose time
    is none have no place there; they go to ``<path>_rejected``.
    """
    from fisclake.streaming.incremental import append_batch  # which itself writes by this module

    alike = harmonise(df, text_columns, rename)
    append_batch(with_parsed_day(alike, stamp), batch, path, f"{path}_handed", DAY)
    append_batch(alike.filter(timestamp(stamp).isNull()), batch, f"{path}_rejected", f"{path}_handed_rejected", ())


def harmonise(df: DataFrame, text_columns: Sequence[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Bring folders of different age to one schema: these columns become text, those get their new name."""
    present = {name.lower(): name for name in df.columns}
    casts = {present[c.lower()]: F.col(present[c.lower()]).cast("string") for c in text_columns if c.lower() in present}
    return df.withColumns(casts).withColumnsRenamed(rename or {})


def swap_folders(spark: SparkSession, staged: str, path: str, old: str | None = None) -> None:
    """Put a finished folder in the place of another by renaming.

    The old data are removed last, so a failure at any point leaves one complete copy under ``path`` or ``old`` (``path_old``), which
    ``recover`` puts right. Where ``path`` lies inside a table, ``old`` must lie outside.
    """
    old = old or f"{path}_old"
    recover(spark, path, old)
    move(spark, path, old)
    try:
        move(spark, staged, path)
    except OSError:
        move(spark, old, path)
        raise
    remove(spark, old)


def recover(spark: SparkSession, path: str, old: str) -> None:
    """Finish a swap that was cut off: old data come back if nothing has taken their place, and go otherwise."""
    if exists(spark, old):
        if exists(spark, path):
            remove(spark, old)
        else:
            move(spark, old, path)


def staged_swap(spark: SparkSession, path: str, write: Callable[[str], None], verify: Callable[[str], None]) -> None:
    """Replace a folder safely: write beside it, verify, swap. A swap that failed before is recovered first."""
    recover(spark, path, f"{path}_old")
    staged = f"{path}_staged"
    if exists(spark, staged):
        remove(spark, staged)
    write(staged)
    verify(staged)
    swap_folders(spark, staged, path)


def require_same_rows(spark: SparkSession, path: str, copy: str) -> int:
    """Number of rows of both folders; raises if they differ. Counts come from the file footers."""
    before, after = spark.read.parquet(path).count(), spark.read.parquet(copy).count()
    if before != after:
        raise VerificationError(f"{copy} has {after} rows, {path} has {before}")
    return after


def rewrite_without(spark: SparkSession, path: str, column: str, partition: str = PARTITION) -> None:
    """Rewrite a table without one column; columns, rows and partitions are verified before the swap."""
    table = read_table(spark, path, [partition])
    if column.lower() not in (name.lower() for name in table.columns):
        return

    def verify(copy: str) -> None:
        if column.lower() in (name.lower() for name in spark.read.parquet(copy).columns):
            raise VerificationError(f"{copy} still has {column}")
        require_same_rows(spark, path, copy)
        lost = existing_partitions(spark, path, [partition]).subtract(existing_partitions(spark, copy, [partition]))
        if not lost.isEmpty():
            raise VerificationError(f"{copy} lacks partitions of {path}")

    staged_swap(spark, path, lambda copy: write_partitioned(table.drop(column), copy, [partition]), verify)


def rewrite_deduplicated(spark: SparkSession, path: str, keys: Sequence[str], partition: str = PARTITION) -> Row:
    """Remove repeated keys from every partition of a table; returns the report. A clean table is left as it is."""
    table = read_table(spark, path, [partition])
    within = [partition, *keys]
    report = deduplication_report(table, within).first()

    def verify(copy: str) -> None:
        rows = spark.read.parquet(copy).count()
        if rows != report.after:
            raise VerificationError(f"{copy} has {rows} rows, {report.after} are expected")

    if report.removed:
        staged_swap(spark, path, lambda copy: write_partitioned(deduplicate(table, within), copy, [partition]), verify)
    return report


def new_items(df: DataFrame, table: DataFrame | None, keys: Sequence[str] = ("chave", "nItem")) -> DataFrame:
    """Rows whose key the table does not have yet: loading a batch twice adds nothing.

    The keys are looked up where they lie, task by task. Left to itself, Spark takes two of a wide table's hundreds of columns for next to
    nothing and sends all keys through the driver to every executor.
    """
    if table is None:
        return df
    return df.join(table.select(*keys).distinct().hint("shuffle_hash"), list(keys), "left_anti")
