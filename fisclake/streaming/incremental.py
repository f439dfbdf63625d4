"""Incremental loads with Structured Streaming.

A checkpoint remembers which files were seen: a file is loaded once, however late it arrives, and no folder has to be
scanned back or moved to a done folder.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fisclake.functions.keys import PARTITION
from fisclake.operators.audit import missing_rows
from fisclake.operators.parse import accepted, rejected
from fisclake.operators.repair import deduplicate
from fisclake.operators.sinks import VerificationError, write_partitioned
from fisclake.registry import DocumentType
from fisclake.sources.scans import read_table
from fisclake.sources.storage import exists, mark, publish

BATCH = "lote"


def file_stream(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("recursiveFileLookup", True).parquet(path)


def run_available(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> list[dict]:
    """Process everything there is now and stop; a scheduler calls this as often as wanted. Returns the progress of the last batches."""
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [json.loads(step.json) for step in query.recentProgress]


def append_batch(df: DataFrame, batch: int | str, path: str, signs: str, partitions: Sequence[str] = (PARTITION,),
                 columns: Sequence[str] = ()) -> bool:
    """Append one batch so that its rows arrive once even if it is run again after a failure at any point; returns whether they were computed now.

    The batch is written beside the signs, marked *ready*, and its files are moved into the table under the batch's name; then it is
    *done*. A run that finds it ready goes on moving, one that finds it done does nothing. Rows are never compared, so a key that an earlier batch
    brought arrives again with this one, crash or not. ``columns``: see ``write_partitioned``.
    """
    spark = df.sparkSession
    staged, ready, done = (f"{signs}/{batch}-{step}" for step in ("staged", "ready", "done"))
    if exists(spark, done):
        return False
    computed = not exists(spark, ready)
    if computed:
        write_partitioned(df, staged, partitions, mode="overwrite", columns=columns)
        mark(spark, ready)
    if exists(spark, staged):
        publish(spark, staged, path, f"lote-{batch}-")
    mark(spark, done)
    return computed


def load_documents(inbox: DataFrame, targets: Sequence[tuple[DocumentType, str]], checkpoint: str) -> None:
    """Load new files of a family: every kind found in a batch goes to its own table, what cannot be filed beside it.

    Each kind takes its own rows out of the batch, so no chain of folders is needed. The batch is read once per kind; its
    text kept on local disks would have to be written and read as well, and be lost with an executor.
    """

    def process(batch: DataFrame, number: int) -> None:
        for kind, path in targets:
            signs = f"{checkpoint}/written/{kind.silver}"
            append_batch(accepted(batch, kind), number, path, signs)
            append_batch(rejected(batch, kind), number, f"{path}_rejected", f"{signs}_rejected", ())

    run_available(inbox, process, checkpoint)


def load_rows(stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str]) -> None:
    """Load the rows of a stream into one table."""

    def process(batch: DataFrame, number: int) -> None:
        append_batch(batch, number, path, f"{checkpoint}/written", partitions)

    run_available(stream, process, checkpoint)


def load_new_keys(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partitions: Sequence[str]) -> None:
    """Load only rows whose ``keys`` the table does not have yet, however late they come; the table is the memory.

    Rows with equal keys within one batch are reduced to the smallest.
    """

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = deduplicate(batch, keys)
        if exists(spark, path):
            fresh = missing_rows(fresh, read_table(spark, path, partitions), keys)
        write_partitioned(fresh, path, partitions)

    run_available(stream, process, checkpoint)


def hour_counts(stream: DataFrame, time: str, lateness: str = "2 days") -> DataFrame:
    """Rows per hour; rows later than ``lateness`` behind the newest one no longer count: see :func:`split_late`."""
    hours = stream.withWatermark(time, lateness).groupBy(F.window(time, "1 hour"))
    return hours.agg(F.count("*").alias("documents")).select(F.col("window.start").alias("hour"), "documents")


def write_counts(stream: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Store updated counts per batch; :func:`latest_counts` gives the last one of every key."""

    def process(batch: DataFrame, number: int) -> None:
        batch.withColumn(BATCH, F.lit(f"{number:08d}")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(BATCH).parquet(path)

    return run_available(stream, process, checkpoint, mode="update")


def latest_counts(spark: SparkSession, path: str, key: str = "hour") -> DataFrame:
    stored = spark.read.parquet(path)
    return stored.groupBy(key).agg(F.max_by("documents", BATCH).alias("documents"))


def split_late(stream: DataFrame, time: str, on_time: str, late: str, checkpoint: str, lateness: str = "2 days", partitions: Sequence[str] = ()) -> None:
    """File the rows of a stream that come later than ``lateness`` behind the newest row of all earlier batches in a table of their own, the others in
    ``on_time``, which stateful operators read. Rows without a time are never late.

    A batch's watermark is kept with its number, so that a batch run again is divided as before; both appends happen once.
    """
    marks = f"{checkpoint}/newest"

    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = batch.agg(F.max(F.col(time).cast("timestamp")).alias("newest")).withColumn("batch", F.lit(number).cast("long"))
        own.write.mode("overwrite").parquet(f"{marks}/lote={number}")
        newest = spark.read.schema("newest timestamp, batch long").parquet(f"{marks}/*").filter(F.col("batch") < number)
        limit = newest.agg((F.max("newest") - F.expr(f"INTERVAL {lateness}")).alias("limit"))  # one row
        judged = batch.crossJoin(F.broadcast(limit)).withColumn("late", F.coalesce(F.col(time).cast("timestamp") < F.col("limit"), F.lit(False)))
        for path, kept, name in ((on_time, ~F.col("late"), "on_time"), (late, F.col("late"), "late")):
            append_batch(judged.filter(kept).select(*batch.columns), number, path, f"{checkpoint}/{name}", partitions)

    run_available(stream, process, f"{checkpoint}/split")


def dropped_rows(progress: Sequence[dict]) -> int:
    """Rows that the stateful operators of a query dropped because of their watermark."""
    return sum(operator["numRowsDroppedByWatermark"] for step in progress for operator in step["stateOperators"])


def write_counts_of_all(stream: DataFrame, path: str, checkpoint: str) -> None:
    """:func:`write_counts` over rows that :func:`split_late` let pass; raises if its watermark drops a row all the same."""
    dropped = dropped_rows(write_counts(stream, path, checkpoint))
    if dropped:
        raise VerificationError(f"{dropped} rows were dropped by the watermark and are in no table")


def unique_within(stream: DataFrame, key: str, time: str, lateness: str = "2 days") -> DataFrame:
    """The first row of every key; a repeat within ``lateness`` is dropped, and the state holds no more than that.

    So are rows older than that behind the newest one: :func:`split_late` files them, :func:`load_new_keys` loads them too.
    """
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])
