"""Sharding by proportional stratified interleaving: every shard repeats the mixture of the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fisclake.llm.shared import stored

#: Rows that one task ranks at a time, about; beyond that they are cut into ranges of what they are ordered by.
ROWS_PER_BIN = 100_000


def shuffle_key(seed: int, *columns: Column) -> Column:
    """60 pseudo-random bits that depend on the seed and the columns alone."""
    said = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("-")) for c in columns))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long")


def ranked(df: DataFrame, groups: list[str], bins: int, order: list[str]) -> DataFrame:
    """Adds ``position`` (from 0, by ``order`` within the groups) and ``members`` (rows of the group); a row stands for ``copies`` rows.

    Ranges of (groups, order) are the bins, so neither a large group nor a value that many rows share fills one of them; no two rows may be equal
    in all of it. Rows are ranked within bins, and the counts of the bins, added up, give where each begins. The bins are written, because both
    have to see the same. The running sum sees a row per bin.
    """
    df = stored(df.repartitionByRange(bins, *groups, *order).withColumn("bin", F.spark_partition_id()), "shard-bins")
    counts = df.groupBy(*groups, "bin").agg(F.sum("copies").alias("inside"))
    along = Window.partitionBy(*groups)
    before = Window.unboundedPreceding, -1
    offset = F.coalesce(F.sum("inside").over(along.orderBy("bin").rowsBetween(*before)), F.lit(0))
    offsets = counts.select(*groups, "bin", offset.alias("offset"), F.sum("inside").over(along).alias("members"))
    within = Window.partitionBy(*groups, "bin").orderBy(*order).rowsBetween(*before)
    return (
        df.withColumn("nth", F.coalesce(F.sum("copies").over(within), F.lit(0)))
        .join(offsets, [*groups, "bin"])
        .withColumn("position", F.col("offset") + F.col("nth"))
        .drop("bin", "nth", "offset")
    )


def expanded(df: DataFrame, rows_per_bin: int) -> DataFrame:
    """A row for each of the ``copies``, with the ``position`` of its own. Many copies are first cut into runs that different tasks unfold."""
    last = F.col("copies") - 1
    runs = df.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(rows_per_bin).cast("long"))))
    spread = runs.filter(F.col("copies") > rows_per_bin).repartition("id", "key", "start")
    return (
        runs.filter(F.col("copies") <= rows_per_bin)
        .unionAll(spread)
        .withColumn("nth", F.explode(F.sequence("start", F.least(F.col("start") + rows_per_bin - 1, last))))
        .withColumn("position", F.col("position") + F.col("nth"))
        .withColumn("copies", F.lit(1).cast("long"))
        .drop("start", "nth")
    )


def assign_shards(
    documents: DataFrame, n_shards: int, seed: int = 42, id_column: str = "doc_id", text: str = "text", source: str = "source", rows_per_bin: int = ROWS_PER_BIN
) -> DataFrame:
    """Shard and slot of every row: ``id_column``, ``source``, ``size``, ``text_crc32``, ``shard``, ``slot``.

    Rows of a source are shuffled by a seeded key and take fractional ranks (rank - 0.5) / rows of the source; all rows sorted by
    fractional rank and cut into equal runs are the shards. Row counts differ by one at most, and so does the count of a source in a
    shard from its share, but for rounding.

    Null text: size 1, CRC 0. Null source: a source of its own. Null or repeated ids: kept; ties of the key go by id, CRC and size, and rows
    of a source alike in all these are interchangeable: they are counted before they are ranked, however many there are. No rows: no rows. Other columns of ``documents``, whatever their names, are not looked at.
    """
    ties = ["id", "text_crc32", "size"]
    rows = stored(
        documents.select(
            F.col(id_column).alias("id"),
            F.col(source).cast("string").alias("source"),
            F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("stratum"),
            (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        )
        .groupBy("source", "stratum", *ties)
        .agg(F.count("*").alias("copies"))
        .withColumn("key", shuffle_key(seed, F.col("id"), F.col("text_crc32"), F.col("size"))),
        "shard-rows",
    )
    total = rows.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    bins = max(8, -(-total // rows_per_bin))
    in_source = expanded(ranked(rows, ["stratum"], bins, ["key", *ties]), rows_per_bin)
    spread = in_source.withColumn("fraction", (F.col("position") + 0.5) / F.col("members")).drop("position", "members").withColumn("all", F.lit(0))
    placed = ranked(spread, ["all"], bins, ["fraction", "stratum", "key", *ties])
    shard = F.expr(f"position * {n_shards} div {max(total, 1)}")
    return placed.withColumn("shard", shard.cast("int")).select(
        F.col("id").alias(id_column),
        "source",
        "size",
        "text_crc32",
        "shard",
        (F.col("position") - F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")).alias("slot"),
    )
