"""Hours that a table lacks are extracted again and put in, each once."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.dates import hour_parts
from fisclake.operators.sinks import write_partitioned
from fisclake.sources.scans import read_table
from fisclake.sources.storage import existing_partitions, exists

HOUR = ("ano", "mes", "dia", "hora")
#: More runs of missing hours than this aren't asked for one by one, but by their first and last hour.
RUNS = 100
_SIGNS = "attempt string, hour timestamp_ntz, documents long"


def hours_stored(spark: SparkSession, path: str) -> DataFrame:
    """The hours a table has, from its folders alone."""
    present = existing_partitions(spark, path, HOUR)
    if present is None:
        return spark.createDataFrame([], "hour timestamp_ntz")
    return present.select(F.to_timestamp_ntz(F.concat_ws("", *HOUR), F.lit("yyyyMMddHH")).alias("hour")).filter("hour IS NOT NULL").distinct()


def hour_grid(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every hour of the half-open window from ``start`` to ``end``."""
    return spark.range(1).selectExpr(f"explode(sequence(TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{end}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour")


def work_items(spark: SparkSession, path: str, signs: str, attempt: str, start: str, end: str) -> list[datetime.datetime]:
    """Hours of the window that the table lacks and this attempt hasn't extracted yet, in order."""
    missing = hour_grid(spark, start, end).join(hours_stored(spark, path), "hour", "left_anti")
    if exists(spark, signs):
        done = spark.read.schema(_SIGNS).parquet(signs).filter(F.col("attempt") == attempt)
        missing = missing.join(done, "hour", "left_anti")
    return sorted(row.hour for row in missing.collect())  # hours of a window


def _literal(hour: datetime.datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{hour:%Y-%m-%d %H:%M:%S}'")


def during(time: Column, hours: Sequence[datetime.datetime]) -> Column:
    """Whether ``time`` lies in one of some hours (in order): as ranges, which reach the source."""
    hour = datetime.timedelta(hours=1)
    runs: list[list[datetime.datetime]] = []
    for h in hours:
        if runs and runs[-1][1] == h:
            runs[-1][1] = h + hour
        else:
            runs.append([h, h + hour])
    if len(runs) > RUNS:
        within = (time >= _literal(hours[0])) & (time < _literal(hours[-1] + hour))
        return within & F.date_trunc("hour", time).cast("timestamp_ntz").isin(*map(_literal, hours))
    wanted = F.lit(False)
    for first, last in runs:
        wanted = wanted | ((time >= _literal(first)) & (time < _literal(last)))
    return wanted


def rebuild_hours(source: DataFrame, path: str, signs: str, attempt: str, start: str, end: str, time: str) -> DataFrame:
    """Extract the hours that the table lacks again and put them in; returns what was done, an hour a row: ``hour`` and ``documents``.

    Only the missing hours are read from ``source`` (columns of the table, and ``time``: a timestamp without zone), and only their folders are written: each is replaced as a
    whole, so that a run broken off may be repeated. A sign per (hour, attempt) keeps hours that the source doesn't have either from being asked for
    again by the same attempt.
    """
    spark = source.sparkSession
    hours = work_items(spark, path, signs, attempt, start, end)
    if hours:
        rows = source.filter(during(F.col(time), hours)).withColumns(hour_parts(time))
        write_partitioned(rows, path, HOUR, mode="overwrite", partitionOverwriteMode="dynamic")
        asked = spark.createDataFrame([(h,) for h in hours], "hour timestamp_ntz")
        stored = read_table(spark, path, HOUR).select(F.to_timestamp_ntz(F.concat_ws("", *HOUR), F.lit("yyyyMMddHH")).alias("hour"))
        found = stored.filter(F.col("hour").isin(*map(_literal, hours))).groupBy("hour").agg(F.count("*").alias("documents"))
        counted = asked.join(found, "hour", "left").na.fill(0, ["documents"])
        counted.select(F.lit(attempt).alias("attempt"), "hour", "documents").coalesce(1).write.mode("append").parquet(signs)
    done = spark.read.schema(_SIGNS).parquet(signs) if exists(spark, signs) else spark.createDataFrame([], _SIGNS)
    return done.filter((F.col("attempt") == attempt) & F.col("hour").isin(*map(_literal, hours))).select("hour", "documents") if hours else done.select("hour", "documents").limit(0)
