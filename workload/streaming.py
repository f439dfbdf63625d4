"""Incremental loads: every query runs its streams until nothing is left and reads back what they wrote."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.dates import hour_parts
from fisclake.operators.replay import rebuild_hours
from fisclake.operators.sinks import write_partitioned
from fisclake.registry import DOCUMENTS
from fisclake.session import shared_folder
from fisclake.sources import scans
from fisclake.streaming.incremental import (
    file_stream,
    hour_counts,
    latest_counts,
    load_documents,
    load_new_keys,
    load_rows,
    split_late,
    unique_within,
    write_counts,
    write_counts_of_all,
)
from workload.documents import ORDERS_SQL, bronze, table
from workload.register import Register

query = Register()
QUERIES, SQL = query.queries, query.sql

HOURS = ["ano", "mes", "dia", "hora"]


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return file_stream(spark, sf_dir, schema, "events.parquet").withColumn("at", F.col("ts").cast("timestamp"))


@query(
    """SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia, strftime(ts, '%H') AS hora,
              count(*) AS documentos, max(event_id) AS maior_nsu FROM events GROUP BY 1, 2, 3, 4"""
)
def stream_hourly_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New files land in hour folders; the second run finds nothing new."""
    folder = shared_folder(spark, "hourly")
    path, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    for _ in range(2):
        placed = event_stream(spark, sf_dir).withColumns(hour_parts("ts")).select("event_id", *HOURS)
        load_rows(placed, path, checkpoint, HOURS)
    stored = scans.read_table(spark, path, HOURS)
    return stored.groupBy(*HOURS).agg(F.count("*").alias("documentos"), F.max("event_id").alias("maior_nsu"))


@query("SELECT date_trunc('hour', ts) AS hour, count(*) AS documents FROM events GROUP BY 1")
def stream_hour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "counts")
    write_counts(hour_counts(event_stream(spark, sf_dir), "at"), f"{folder}/table", f"{folder}/checkpoint")
    return latest_counts(spark, f"{folder}/table").select(F.col("hour").cast("timestamp_ntz").alias("hour"), "documents")


@query("SELECT event_type, count(*) AS documentos, count(DISTINCT event_id) AS nsus FROM events GROUP BY 1")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice and stored once."""
    folder = shared_folder(spark, "dedup")
    events = table(spark, sf_dir, "events")
    events.unionByName(events).write.parquet(f"{folder}/inbox")
    stream = file_stream(spark, f"{folder}/inbox", events.schema).withColumn("at", F.col("ts").cast("timestamp"))
    unique = unique_within(stream, "event_id", "at").select("event_id", "event_type")
    load_rows(unique, f"{folder}/table", f"{folder}/checkpoint", ["event_type"])
    stored = spark.read.parquet(f"{folder}/table")
    return stored.groupBy("event_type").agg(F.count("*").alias("documentos"), F.count_distinct("event_id").alias("nsus"))


@query(
    f"""WITH {ORDERS_SQL} SELECT bpe_kind AS tipo, substr(chave, 3, 4) AS chave_particao, count(*) AS documentos
    FROM orders_x GROUP BY 1, 2"""
)
def stream_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and three runs: both kinds of the family end up complete and once."""
    folder = shared_folder(spark, "tickets")
    batch = bronze(spark, sf_dir, "bpe")
    targets = [(DOCUMENTS[name], f"{folder}/{name}") for name in ("BPe", "BPeTA")]
    first = F.substring("CHAVE", 3, 2).between("95", "97")
    for wave in (batch.filter(first), None, batch.filter(~first)):
        if wave is not None:
            wave.write.mode("append").parquet(f"{folder}/inbox")
        load_documents(file_stream(spark, f"{folder}/inbox", batch.schema), targets, f"{folder}/checkpoint")
    result = None
    for kind, path in targets:
        keys = spark.read.parquet(path).select(F.lit(kind.name).alias("tipo"), F.substring("chave", 3, 4).alias("chave_particao"))
        result = keys if result is None else result.unionByName(keys)
    return result.groupBy("tipo", "chave_particao").agg(F.count("*").alias("documentos"))


@query(
    """SELECT strftime(ts, '%d') AS dia, count(*) AS documentos, count(*) FILTER (event_type = 'error') AS atrasados FROM events GROUP BY 1"""
)
def stream_late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file that arrives weeks late is loaded like any other: what counts is that it was not seen before."""
    folder = shared_folder(spark, "late")
    events = table(spark, sf_dir, "events").withColumn("dia", F.date_format("ts", "dd"))
    for late in (False, True):
        events.filter((F.col("event_type") == "error") == late).write.mode("append").parquet(f"{folder}/inbox")
        stream = file_stream(spark, f"{folder}/inbox", events.schema)
        load_rows(stream, f"{folder}/table", f"{folder}/checkpoint", ["dia"])
    stored = scans.read_table(spark, f"{folder}/table", ["dia"])
    return stored.groupBy("dia").agg(
        F.count("*").alias("documentos"), F.count_if(F.col("event_type") == "error").alias("atrasados")
    )


@query("SELECT strftime(ts, '%d') AS dia, count(*) AS documentos, count(DISTINCT event_id) AS nsus FROM events GROUP BY 1")
def stream_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest days come first; then everything comes twice, most of it weeks late. Each event is stored once."""
    folder = shared_folder(spark, "keys")
    path, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    events = table(spark, sf_dir, "events").withColumn("dia", F.date_format("ts", "dd"))
    for wave in (events.filter("dia > '20'"), events.unionByName(events)):
        wave.write.mode("append").parquet(f"{folder}/inbox")
        load_new_keys(file_stream(spark, f"{folder}/inbox", events.schema), path, checkpoint, ["event_id"], ["dia"])
    stored = scans.read_table(spark, path, ["dia"])
    return stored.groupBy("dia").agg(F.count("*").alias("documentos"), F.count_distinct("event_id").alias("nsus"))


LATE_SQL = """w AS (SELECT *, (day(ts) > 20 AND event_id % 2 = 0) AS early FROM events),
       d AS (SELECT *, coalesce(NOT early AND ts < (SELECT max(ts) - INTERVAL 2 DAY FROM w WHERE early), false) AS late FROM w)"""


def _two_waves(spark: SparkSession, sf_dir: str, folder: str) -> Iterator[DataFrame]:
    """Half of the newest days comes first, everything else after it; what lies two days behind is late by then."""
    events = table(spark, sf_dir, "events")
    early = (F.dayofmonth("ts") > 20) & (F.col("event_id") % 2 == 0)
    for wave in (early, ~early):
        events.filter(wave).write.mode("append").parquet(f"{folder}/inbox")
        inbox = file_stream(spark, f"{folder}/inbox", events.schema).withColumn("at", F.col("ts").cast("timestamp"))
        split_late(inbox, "at", f"{folder}/on_time", f"{folder}/late", f"{folder}/checkpoint")
        yield file_stream(spark, f"{folder}/on_time", inbox.schema)


@query(
    f"""WITH {LATE_SQL} SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (NOT late) AS documents, count(*) FILTER (late) AS late,
        count(*) AS delivered FROM d GROUP BY 1"""
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour, and beside them the rows that came too late to be counted: together all that were delivered."""
    folder = shared_folder(spark, "late_rows")
    for on_time in _two_waves(spark, sf_dir, folder):
        write_counts_of_all(hour_counts(on_time, "at"), f"{folder}/table", f"{folder}/counting")
    hour = F.col("hour").cast("timestamp_ntz").alias("hour")
    counted = latest_counts(spark, f"{folder}/table").select(hour, "documents", F.lit(0).cast("long").alias("late"))
    late = spark.read.parquet(f"{folder}/late").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("late"))
    both = counted.unionByName(late.withColumn("documents", F.lit(0).cast("long"))).groupBy("hour").agg(F.sum("documents").alias("documents"), F.sum("late").alias("late"))
    return both.withColumn("delivered", F.col("documents") + F.col("late"))


@query(
    f"""WITH {LATE_SQL} SELECT event_type, count(*) FILTER (NOT late) AS documentos, count(*) FILTER (late) AS atrasados FROM d GROUP BY 1"""
)
def stream_dedup_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplication within a watermark that loses no row: what is too late for it is filed."""
    folder = shared_folder(spark, "late_keys")
    for on_time in _two_waves(spark, sf_dir, folder):
        load_rows(unique_within(on_time, "event_id", "at").select("event_id", "event_type"), f"{folder}/table", f"{folder}/loading", ["event_type"])
    stored = spark.read.parquet(f"{folder}/table").groupBy("event_type").agg(F.count_distinct("event_id").alias("documentos"))
    late = spark.read.parquet(f"{folder}/late").groupBy("event_type").agg(F.count("*").alias("atrasados"))
    return stored.join(late, "event_type", "full").na.fill(0)


@query(
    """SELECT date_trunc('hour', ts) AS hour, count(*) AS documents, max(event_id) AS maior_nsu, hour(date_trunc('hour', ts)) % 5 = 0 AS rebuilt,
              CAST(0 AS BIGINT) AS rebuilt_again FROM events GROUP BY 1"""
)
def rebuild_missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that lacks every fifth hour: only those are extracted again, and a second run finds nothing left to do."""
    folder = shared_folder(spark, "rebuilt")
    path, signs = f"{folder}/table", f"{folder}/signs"
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    loaded = events.filter("hour(ts) % 5 <> 0").withColumns(hour_parts("ts"))
    write_partitioned(loaded, path, HOURS)
    window = ("2024-01-01 00:00:00", "2024-01-31 00:00:00")
    first = rebuild_hours(events, path, signs, "a", *window, "ts").filter("documents > 0").select("hour", F.lit(True).alias("rebuilt"))
    second = rebuild_hours(events, path, signs, "a", *window, "ts").agg(F.count("*").alias("rebuilt_again"))
    stored = scans.read_table(spark, path, HOURS).groupBy(F.to_timestamp_ntz(F.concat_ws("", *HOURS), F.lit("yyyyMMddHH")).alias("hour"))
    counted = stored.agg(F.count("*").alias("documents"), F.max("event_id").alias("maior_nsu"))
    return counted.join(first, "hour", "left").na.fill(False, ["rebuilt"]).crossJoin(F.broadcast(second))
