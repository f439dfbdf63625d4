"""Text logs of earlier audits: ``[yyyy-MM-dd HH:mm:ss] message``, a message of one or more lines, and sections of messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fisclake.session import shared_folder

# The line format of the log, and the messages that begin a table's or a folder's section.
LINE = r"^\[(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})\] (.*)$"
SECTION = r"(?:Processando documento(?: com (?:NSU|NSUDF|NSUSVD))?|Verificando diretório): *(.*?) *$"

_SPLIT = ["file", "block"]


def carried(lines: DataFrame, values: dict[str, Column], order: str = "place") -> DataFrame:
    """Adds columns that hold, for each line of a file, the last value that is not null on it or a line before it.

    ``lines`` has ``file``, ``block`` (where its split of the file begins) and ``place`` (its order in the split). Values are handed down within a
    split by one task each, and from split to split by the last of each: no task orders a whole file.
    """
    within = Window.partitionBy(*_SPLIT).orderBy(order)
    own = lines.withColumns({f"own_{name}": F.last(value, ignorenulls=True).over(within) for name, value in values.items()})
    names = [f"own_{name}" for name in values]
    # The last line of a split holds the last value of each.
    ends = own.groupBy(*_SPLIT).agg(*(F.max_by(c, order).alias(f"end_{c}") for c in names))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    before = ends.select(*_SPLIT, *(F.last(f"end_{c}", ignorenulls=True).over(earlier).alias(f"before_{c}") for c in names))
    whole = own.join(before, _SPLIT)
    return whole.select(*lines.columns, *(F.coalesce(f"own_{n}", f"before_own_{n}").alias(n) for n in values))


def read_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line: ``file``, ``block`` and ``place`` (their order), ``at`` (time of its entry), ``first`` (whether it begins one), ``message``
    and ``section``.

    Lines without a time stamp belong to the entry before them and have its time; those before any entry of their file have none. A section
    begins with an entry that names a table or folder and goes on to the next one; lines before the first have none. Empty lines are lines.
    """
    # Splits as large as Spark makes them; written once, so that places stay the same.
    text = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "value"
    )
    folder = shared_folder(spark, "log")
    text.write.parquet(folder)
    lines = spark.read.schema(text.schema).parquet(folder)
    stamped = F.try_to_timestamp(F.regexp_extract("value", LINE, 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    parsed = lines.select("file", "block", "place", stamped.alias("stamp"), "value").withColumn("first", F.col("stamp").isNotNull())
    parsed = parsed.withColumn("message", F.when(F.col("first"), F.regexp_extract("value", LINE, 2)).otherwise(F.col("value")))
    named = F.when(F.col("first") & F.col("message").rlike(SECTION), F.regexp_extract("message", SECTION, 1))
    return carried(parsed.drop("value"), {"at": F.col("stamp"), "section": named}).drop("stamp")


def measured(log: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """Log lines that match ``pattern``; its groups become the columns ``names``."""
    groups = {name: F.regexp_extract("message", pattern, i + 1) for i, name in enumerate(names)}
    return log.filter(F.col("message").rlike(pattern)).withColumns(groups)
