"""Incremental loads: reruns, late files, crashes between write and commit."""

import pytest
from pyspark.sql import functions as F

from fisclake.registry import DOCUMENTS
from fisclake.session import shared_folder
from fisclake.sources.storage import exists, mark
from fisclake.streaming.incremental import append_batch, file_stream, hour_counts, latest_counts, load_documents, load_rows, write_counts
from workload.documents import bronze


@pytest.fixture
def folder(spark):
    return shared_folder(spark, "stream-tests")


@pytest.fixture
def rows(spark):
    return spark.range(10).select(F.col("id"), F.concat(F.lit("p"), F.col("id") % 2).alias("part"))


def test_rerun_and_late_file(spark, folder, rows):
    for wave, expected in ((rows, 10), (None, 10), (rows.withColumn("id", F.col("id") + 100), 20)):
        if wave is not None:
            wave.write.mode("append").parquet(f"{folder}/inbox")
        load_rows(file_stream(spark, f"{folder}/inbox", rows.schema), f"{folder}/table", f"{folder}/checkpoint", ["part"])
        assert spark.read.parquet(f"{folder}/table").count() == expected


def test_batch_that_ran_before(spark, folder, rows):
    path, signs = f"{folder}/table", f"{folder}/signs"
    append_batch(rows, 0, path, signs, ["part"])
    append_batch(rows, 0, path, signs, ["part"])
    assert spark.read.parquet(path).count() == 10
    append_batch(rows.withColumn("id", F.col("id") + 50), 1, path, signs, ["part"])
    assert spark.read.parquet(path).count() == 20


def test_crash_at_any_step(spark, folder, rows, monkeypatch):
    """Cut off before it is ready, between two moves and before it is done, a batch arrives once."""
    from fisclake.sources import storage
    from fisclake.streaming import incremental

    path, signs = f"{folder}/table", f"{folder}/signs"
    rows = rows.repartition(4)
    for step, name in enumerate(("mark", "move", "mark")):
        real, calls = getattr(storage, name), []

        def broken(*args, real=real, calls=calls, step=step):
            calls.append(args)
            if len(calls) == (1, 2, 2)[step]:
                raise OSError("cut off")
            return real(*args)

        with monkeypatch.context() as patched:
            patched.setattr(incremental if name == "mark" else storage, name, broken)
            with pytest.raises(OSError):
                append_batch(rows, step, path, signs, ["part"])
        append_batch(rows, step, path, signs, ["part"])
        append_batch(rows, step, path, signs, ["part"])
        assert spark.read.parquet(path).count() == 10 * (step + 1)
        assert exists(spark, f"{signs}/{step}-done") and not exists(spark, f"{signs}/{step}-staged")


def test_redelivered_key_arrives_with_or_without_a_crash(spark, folder, rows):
    path, signs = f"{folder}/table", f"{folder}/signs"
    append_batch(rows, 0, path, signs, ["part"])
    mark(spark, f"{signs}/1-started")
    append_batch(rows.filter("id < 4"), 1, path, signs, ["part"])
    assert spark.read.parquet(path).count() == 14


def test_kinds_of_a_family_go_to_their_tables(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "cte").filter("substring(DHPROC, 4, 7) = '03/1997'")
    batch.write.parquet(f"{folder}/inbox")
    names = ("CTe", "CTeSimp", "CTeOS", "GVTe")
    targets = [(DOCUMENTS[name], f"{folder}/{name}") for name in names]
    for _ in range(2):
        load_documents(file_stream(spark, f"{folder}/inbox", batch.schema), targets, f"{folder}/checkpoint")
    counts = {name: spark.read.parquet(path).count() for name, (_, path) in zip(names, targets, strict=True)}
    assert sum(counts.values()) == batch.count() and min(counts.values()) > 0
    assert spark.read.parquet(f"{folder}/CTe").columns[-1] == "chave_particao"


def test_hour_counts_of_two_deliveries_are_added(spark, folder):
    schema = "at timestamp"
    for times in (["2024-01-01 10:05:00", "2024-01-01 10:06:00"], ["2024-01-01 10:59:59", "2024-01-01 11:00:00"]):
        df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("at"))
        df.write.mode("append").parquet(f"{folder}/inbox")
        stream = file_stream(spark, f"{folder}/inbox", spark.createDataFrame([], schema).schema)
        write_counts(hour_counts(stream, "at"), f"{folder}/counts", f"{folder}/checkpoint")
    counts = {row.hour.hour: row.documents for row in latest_counts(spark, f"{folder}/counts").collect()}
    assert counts == {10: 3, 11: 1}
