"""Days, hours and months that should be there and are not."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.sources.storage import entries


def _present(df: DataFrame, day: Column) -> DataFrame:
    return df.select(day.cast("date").alias("day")).filter("day IS NOT NULL").distinct()


def missing_days(df: DataFrame, day: Column) -> DataFrame:
    """Days without rows between the first and the last day."""
    present = _present(df, day)
    limits = present.agg(F.min("day").alias("first"), F.max("day").alias("last")).filter("first IS NOT NULL")
    calendar = limits.select(F.explode(F.sequence("first", "last")).alias("day"))
    return calendar.join(present, "day", "left_anti")


def missing_recent_days(df: DataFrame, day: Column, today: str, days: int = 10) -> DataFrame:
    """Days without rows among the ``days`` before ``today``."""
    window = f"explode(sequence(DATE'{today}' - {days}, DATE'{today}' - 1)) AS day"
    return df.sparkSession.range(1).selectExpr(window).join(_present(df, day), "day", "left_anti")


def missing_hours(df: DataFrame, time: Column, start: str, end: str) -> DataFrame:
    """Hours without rows in the half-open window from ``start`` to ``end``."""
    present = df.select(F.date_trunc("hour", time).cast("timestamp_ntz").alias("hour")).distinct()
    hours = f"explode(sequence(TIMESTAMP_NTZ'{start}', TIMESTAMP_NTZ'{end}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour"
    calendar = df.sparkSession.range(1).selectExpr(hours)
    return calendar.join(present, "hour", "left_anti")


def months_present(df: DataFrame, month: Column, year: int) -> DataFrame:
    """The twelve months of a year as ``yyyyMM`` and whether each has rows."""
    months = [(f"{year}{number:02d}",) for number in range(1, 13)]
    calendar = df.sparkSession.createDataFrame(months, "month string")
    present = df.select(month.alias("month")).distinct().withColumn("present", F.lit(True))
    return calendar.join(present, "month", "left").na.fill(False, ["present"])


def late_folders(newest: DataFrame, today: datetime.date) -> DataFrame:
    """Folders whose newest day is not yesterday."""
    yesterday = (today - datetime.timedelta(days=1)).strftime("%Y%m%d")
    return newest.withColumn("is_current", F.col("newest") == yesterday)


def folder_alerts(spark: SparkSession, directories: Sequence[str], today: datetime.date) -> DataFrame:
    """The newest folder of each directory (names end with ``yyyyMMdd`` and sort by it) and what is wrong with it: ``newest``, ``files`` and ``folders`` in it,
    ``wrong_date`` (not yesterday, or no folder at all) and ``empty`` (nothing in it, which a listing of files can't tell)."""
    named = spark.createDataFrame([(d.rstrip("/"),) for d in directories], "directory string")
    inside = entries(spark, [d.rstrip("/") for d in directories]).filter("folder").groupBy("directory").agg(F.max("name").alias("newest"))
    newest = named.join(inside, "directory", "left").collect()  # a row per directory
    paths = {f"{row.directory}/{row.newest}": row.directory for row in newest if row.newest is not None}
    content = entries(spark, list(paths)).groupBy("directory").agg(F.count_if(~F.col("folder")).alias("files"), F.count_if("folder").alias("folders"))
    found = spark.createDataFrame([(row.directory, row.newest) for row in newest], "directory string, newest string")
    joined = found.join(content.withColumnRenamed("directory", "path"), F.concat_ws("/", "directory", "newest") == F.col("path"), "left").drop("path")
    yesterday = (today - datetime.timedelta(days=1)).strftime("%Y%m%d")
    counted = joined.na.fill(0, ["files", "folders"]).withColumn("wrong_date", F.coalesce(F.right("newest", F.lit(8)) != yesterday, F.lit(True)))
    return counted.withColumn("empty", F.col("newest").isNotNull() & (F.col("files") + F.col("folders") == 0))
