"""What is left after a run was cut off, and what comes late, is filed once and counted."""

import datetime

import pytest
from pyspark.sql import functions as F

from fisclake.operators import catalog, compaction, replay, sinks
from fisclake.operators import mirror as mirrors
from fisclake.operators.gaps import folder_alerts
from fisclake.plans import batches
from fisclake.plans.audits import section_metrics
from fisclake.plans import load as loads
from fisclake.plans.load import Target
from fisclake.registry import DOCUMENTS, ITEMS, XML
from fisclake.session import shared_folder
from fisclake.sources.auditlog import read_log
from fisclake.sources.storage import entries, exists, mark
from fisclake.streaming import incremental
from workload.documents import bronze

SCHEMA = "n long, at timestamp, ano string, mes string, dia string, hora string"


@pytest.fixture
def folder(spark):
    return shared_folder(spark, "recovery")


def test_the_plan_of_a_compaction_can_be_read(spark, folder):
    table = spark.range(4000).select(F.col("id").cast("string").alias("chave"), (F.col("id") % 2).cast("string").alias("chave_particao"))
    table.repartition(6).write.partitionBy("chave_particao").parquet(folder)
    found = compaction.compact(spark, folder)
    assert sorted((r.chave_particao, r.files, r.ideal_files, r.healthy) for r in found.collect()) == [("0", 6, 1, False), ("1", 6, 1, False)]
    assert sorted((r.files, r.healthy) for r in compaction.compact(spark, folder).collect()) == [(1, True), (1, True)]
    assert spark.read.parquet(folder).count() == 4000


def days(spark, *numbers):
    rows = [(n, f"{n:02d}/01/2024 10:00:00" if n else None) for n in numbers for _ in range(3)]
    return spark.createDataFrame(rows, "n int, DHPROC string")


def test_archive_takes_whole_days_only(spark, folder, monkeypatch):
    """A move that fails half-way leaves the days before it and none in part; the next run brings the rest."""
    moved = []
    real = sinks.publish_folders.__globals__["move"]

    def failing(session, source, target):
        if len(moved) == 2:
            raise OSError("no more")
        moved.append(target)
        real(session, source, target)

    monkeypatch.setitem(sinks.publish_folders.__globals__, "move", failing)
    with pytest.raises(OSError, match="no more"):
        sinks.archive_new_days(days(spark, 1, 2, 3, 4, 0), folder)
    assert spark.read.parquet(folder).groupBy("day").count().filter("count <> 3").count() == 0 and spark.read.parquet(folder).count() == 6
    monkeypatch.undo()
    for _ in range(2):
        sinks.archive_new_days(days(spark, 1, 2, 3, 4, 0), folder)
    assert spark.read.parquet(folder).count() == 12 and spark.read.parquet(f"{folder}_rejected").count() == 3


def test_hand_over_twice(spark, folder):
    for name in ("a", "a", "b"):
        sinks.hand_over(days(spark, 1, 0), folder, name)
    assert spark.read.parquet(folder).count() == 6 and spark.read.parquet(f"{folder}_rejected").count() == 6


def test_a_table_without_name_comes_back(spark, folder):
    spark.range(3).select(F.col("id"), F.lit("x").alias("chave_particao")).write.partitionBy("chave_particao").parquet(folder)
    catalog.create_table(spark, "t_cut_building", folder)
    catalog.replace_table(spark, "t_cut", folder)
    assert spark.table("t_cut").count() == 3 and not spark.catalog.tableExists("t_cut_building")
    catalog.drop_tables(spark, ["t_cut"])


def hourly(spark, *hours):
    return spark.createDataFrame([(h, datetime.datetime(2024, 1, 1 + h // 24, h % 24, 30)) for h in hours for _ in range(2)], "n long, at timestamp_ntz")


def test_replay_only_asks_for_missing_hours(spark, folder):
    path, signs, window = f"{folder}/t", f"{folder}/s", ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert replay.work_items(spark, path, signs, "a", *window) == [datetime.datetime(2024, 1, 1, h) for h in range(24)]
    first = replay.rebuild_hours(hourly(spark, 0, 1, 5), path, signs, "a", *window, "at").collect()
    assert sorted((r.hour.hour, r.documents) for r in first if r.documents) == [(0, 2), (1, 2), (5, 2)] and len(first) == 24
    assert replay.rebuild_hours(hourly(spark, 0, 1, 5, 7), path, signs, "a", *window, "at").collect() == []  # the same attempt has asked
    second = replay.rebuild_hours(hourly(spark, 0, 1, 5, 7), path, signs, "b", *window, "at").collect()
    assert sorted(r.hour.hour for r in second if r.documents) == [7] and len(second) == 21
    assert spark.read.parquet(path).count() == 8


def test_replay_broken_off_between_table_and_sign(spark, folder):
    path, signs, window = f"{folder}/t", f"{folder}/s", ("2024-01-01 00:00:00", "2024-01-01 06:00:00")
    replay.rebuild_hours(hourly(spark, 0, 1), path, f"{folder}/lost", "a", *window, "at")
    replay.rebuild_hours(hourly(spark, 0, 1, 2), path, signs, "a", *window, "at")
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == [0, 0, 1, 1, 2, 2]


def test_missing_hours_reach_the_source_as_ranges(spark, folder):
    hours = [datetime.datetime(2024, 1, 1, h) for h in (1, 2, 3, 7)]
    hourly(spark, *range(24)).write.parquet(folder)
    rows = spark.read.parquet(folder).filter(replay.during(F.col("at"), hours))
    assert sorted({r.n for r in rows.collect()}) == [1, 2, 3, 7]
    assert "PushedFilters: [Or(" in rows._jdf.queryExecution().executedPlan().toString().replace("\n", "")
    many = [datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=2 * n) for n in range(replay.RUNS + 5)]
    kept = hourly(spark, *range(300)).filter(replay.during(F.col("at"), many))
    assert sorted({r.n for r in kept.collect()}) == [2 * n for n in range(replay.RUNS + 5)]


def test_late_rows_are_filed_once(spark, folder, monkeypatch):
    """A batch that fails between its two tables is divided as before when it runs again."""
    schema = "n long, at timestamp"

    def deliver(rows):
        spark.createDataFrame([(n, at and datetime.datetime(2024, 1, *at)) for n, at in rows], schema).coalesce(1).write.mode("append").parquet(f"{folder}/inbox")

    def run():
        stream = incremental.file_stream(spark, f"{folder}/inbox", spark.read.parquet(f"{folder}/inbox").schema)
        incremental.split_late(stream, "at", f"{folder}/on_time", f"{folder}/late", f"{folder}/c")

    deliver([(1, (10, 0)), (2, (10, 1))])
    run()
    deliver([(3, (8, 0)), (4, (8, 1)), (5, (20, 0)), (6, None), (7, (1, 0))])
    real = incremental.append_batch

    def failing(df, batch, path, signs, partitions=()):
        if path.endswith("late"):
            raise RuntimeError("cut off")
        real(df, batch, path, signs, partitions)

    monkeypatch.setattr(incremental, "append_batch", failing)
    with pytest.raises(Exception, match="cut off"):
        run()
    monkeypatch.undo()
    deliver([(8, (18, 0)), (9, (17, 23))])
    run()
    run()
    assert sorted(r.n for r in spark.read.parquet(f"{folder}/on_time").collect()) == [1, 2, 4, 5, 6, 8]
    assert sorted(r.n for r in spark.read.parquet(f"{folder}/late").collect()) == [3, 7, 9]
    counts = incremental.hour_counts(incremental.file_stream(spark, f"{folder}/on_time", spark.read.parquet(f"{folder}/on_time").schema), "at")
    incremental.write_counts_of_all(counts, f"{folder}/counts", f"{folder}/counting")


def test_rows_dropped_by_the_watermark_are_an_error(spark, folder):
    schema = "n long, at timestamp"
    for day in (20, 1):
        spark.createDataFrame([(1, datetime.datetime(2024, 1, day))], schema).coalesce(1).write.mode("append").parquet(f"{folder}/inbox")
        stream = incremental.file_stream(spark, f"{folder}/inbox", spark.read.parquet(f"{folder}/inbox").schema)
        if day == 20:
            incremental.write_counts_of_all(incremental.hour_counts(stream, "at"), f"{folder}/t", f"{folder}/c")
    with pytest.raises(sinks.VerificationError, match="1 rows"):
        incremental.write_counts_of_all(incremental.hour_counts(stream, "at"), f"{folder}/t", f"{folder}/c")


def test_log_lines_without_stamp_belong_to_the_entry_before(spark, folder):
    """Sections and entries go over split borders; nothing is dropped."""
    lines = ["before", *(x for n in range(300) for x in (f"[2024-01-01 10:{n // 60:02d}:{n % 60:02d}] Processando documento: T{n % 3}", f"    em linha {n}", "java.io.Exception", ""))]
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(folder)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        log = read_log(spark, folder)
        assert log.select("block").distinct().count() > 5
        rows = log.orderBy("file", "block", "place").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.message for r in rows][:4] == ["before", "Processando documento: T0", "    em linha 0", "java.io.Exception"] and len(rows) == len(lines)
    assert (rows[0].at, rows[0].section) == (None, None)
    for i, r in enumerate(rows[1:]):
        n = i // 4
        assert (r.section, r.at.minute * 60 + r.at.second, r.first) == (f"T{n % 3}", n, i % 4 == 0)
    found = {r.section: (r.audited, r.errors, r.status) for r in section_metrics(log).collect()}
    assert found == {"": (0, 0, "SUCESSO"), **{f"T{k}": (100, 100, "ATENÇÃO") for k in range(3)}}


def test_empty_folders_are_seen(spark, folder):
    for name in ("a/20240101", "a/20240103", "b/20240102", "c"):
        mark(spark, f"{folder}/{name}")
    spark.range(3).coalesce(1).write.parquet(f"{folder}/b/20240102/x")
    found = {r.directory.rpartition("/")[2]: (r.newest, r.files, r.folders, r.wrong_date, r.empty) for r in folder_alerts(spark, [f"{folder}/{d}" for d in "abcd"], datetime.date(2024, 1, 4)).collect()}
    assert found == {"a": ("20240103", 0, 0, False, True), "b": ("20240102", 0, 1, True, False), "c": (None, 0, 0, True, False), "d": (None, 0, 0, True, False)}
    assert folder_alerts(spark, [], datetime.date(2024, 1, 4)).collect() == []
    assert {(r.name, r.folder) for r in entries(spark, [f"{folder}/a"]).collect()} == {("20240101", True), ("20240103", True)}
    assert not exists(spark, f"{folder}/d")


def test_mirror_finds_a_changed_value_and_a_lost_partition(spark, folder):
    rows = [(n, None if n == 3 else f"x{n}", str(n % 3) if n % 3 else None) for n in range(30)]
    frame = spark.createDataFrame(rows, "n int, t string, chave_particao string")
    sinks.write_partitioned(frame, f"{folder}/a")
    swapped = frame.withColumn("t", F.when(F.col("n") == 4, "x7").when(F.col("n") == 7, "x4").otherwise(F.col("t")))  # equal counts, equal values by column
    lost = frame.limit(2).withColumn("chave_particao", F.lit("9"))
    sinks.write_partitioned(swapped.unionByName(lost).repartition(3), f"{folder}/b")
    found = {r.chave_particao: (r.source_rows, r.target_rows, r.equal) for r in mirrors.compare_mirror(spark, f"{folder}/a", f"{folder}/b").collect()}
    assert found == {None: (10, 10, True), "1": (10, 10, False), "2": (10, 10, True), "9": (0, 2, False)}
    assert {tuple(r) for r in mirrors.synchronise(spark, f"{folder}/a", f"{folder}/b").collect()} == {("1", "copied"), ("9", "removed")}
    assert mirrors.synchronise(spark, f"{folder}/a", f"{folder}/b").collect() == []
    assert sorted(map(str, spark.read.parquet(f"{folder}/b").select("n", "t").collect())) == sorted(map(str, frame.select("n", "t").collect()))
    assert {r.action for r in mirrors.synchronise(spark, f"{folder}/a", f"{folder}/c").collect()} == {"copied"}


def test_day_rewrite_is_resumed(spark, folder, monkeypatch):
    """Cut off in the middle of a job's swaps; every day ends up rewritten, and noted once."""
    path, journal = f"{folder}/days", f"{folder}/journal"
    rows = [(n, "2024", "01", f"{n % 6 + 1:02d}") for n in range(120)]
    spark.createDataFrame(rows, "n int, year string, month string, day string").repartition(3).write.partitionBy(*sinks.DAY).parquet(path)
    real, calls = compaction.swap_folders, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 3:
            raise OSError("cut off")
        real(*args)

    monkeypatch.setattr(compaction, "swap_folders", failing)
    with pytest.raises(OSError, match="cut off"):
        compaction.rewrite_days(spark, path, journal, together=4)
    monkeypatch.undo()
    for _ in range(2):
        noted = compaction.rewrite_days(spark, path, journal, together=4).collect()
    assert sorted(r.day for r in noted) == [f"{d:02d}" for d in range(1, 7)]
    assert sorted(r.n for r in spark.read.parquet(path).collect()) == list(range(120))
    spark.createDataFrame([(500,)], "n int").coalesce(1).write.mode("append").parquet(f"{path}/year=2024/month=01/day=02")
    again = compaction.rewrite_days(spark, path, journal)
    assert sorted(r.day for r in again.collect()) == ["01", "02", "02", "03", "04", "05", "06"] and spark.read.parquet(path).count() == 121


def test_a_batch_that_fails_with_an_os_error_does_not_stop_the_others(spark, folder, monkeypatch):
    spark.range(1).write.parquet(f"{folder}/inbox")
    seen = []

    def failing(session, batch):
        seen.append(batch.path)
        raise OSError("x" * 900)

    monkeypatch.setattr(batches, "load_new_files", failing)
    kind = DOCUMENTS["NFe"]
    report = batches.load_batches(spark, [batches.Batch(kind, f"{folder}/inbox", Target(f"{folder}/t")) for _ in range(2)]).collect()
    assert len(seen) == 2 and [(r.outcome, len(r.reason)) for r in report] == [("failed", 900)] * 2


@pytest.mark.parametrize("kind", [DOCUMENTS["NFe"], ITEMS["NFe"]], ids=["headers", "items"])
def test_documents_are_parsed_again_only_if_some_may_be_refused(spark, sf_dir, folder, monkeypatch, kind):
    """Once for the table; a second time for what is refused if the first has seen any, or was in a run that was cut off before it was filed."""
    parses = []
    real = loads.append_batch

    def counted(df, *rest, **options):
        parses.append(df._jdf.queryExecution().optimizedPlan().toString().count("from_xml") > 0)
        return real(df, *rest, **options)

    def cut_off(df, name, path, *rest, **options):
        if path.endswith("_rejected"):
            raise OSError("no more")
        return real(df, name, path, *rest, **options)

    good = bronze(spark, sf_dir, "nfe").filter("NSUDF < 40")
    broken = F.when(F.col("NSUDF") == 3, F.expr(f"left({XML}, 100)")).when(F.col("NSUDF") == 4, None)
    bad = good.filter("NSUDF < 9").withColumn(XML, broken.when(F.col("NSUDF") == 6, F.replace(XML, F.lit("chNFe"), F.lit("outra"))).otherwise(F.col(XML)))
    refused = lambda target: sorted((int(r.NSUDF), r.reason) for r in spark.read.parquet(target.rejected).collect())
    found = [(3, "malformed"), (4, "malformed"), (6, "no key")]
    monkeypatch.setattr(loads, "append_batch", counted)
    target, late, none = (Target(f"{folder}/{name}") for name in ("table", "late", "none"))
    loads.write_documents(good, kind, target, "a")
    assert parses == [True, False] and refused(target) == []
    loads.write_documents(bad, kind, target, "b")
    assert parses[2:] == [True, True] and refused(target) == found
    loads.write_documents(good.filter("NSUDF % 5 = 0"), kind, none, "c")  # items: documents without any
    loads.write_documents(bad.filter("NSUDF IN (3, 4)"), kind, none, "d")  # no row for the table
    assert refused(none) == found[:2]
    monkeypatch.setattr(loads, "append_batch", cut_off)
    with pytest.raises(OSError, match="no more"):
        loads.write_documents(bad, kind, late, "b")
    monkeypatch.setattr(loads, "append_batch", counted)
    loads.write_documents(bad, kind, late, "b")
    assert parses[-2:] == [True, True] and refused(late) == found
