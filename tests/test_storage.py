"""Sinks, rewrites, tables and the batch load."""

import pytest
from pyspark.sql import functions as F

from fisclake.operators import catalog, compaction, drift, sinks
from fisclake.operators.audit import reconcile_partitions
from fisclake.operators.gates import DuplicateBatchError
from fisclake.operators.mirror import mirror, verify_mirror
from fisclake.plans.audits import full_audit, silver_of
from fisclake.plans.batches import Batch, load_batches
from fisclake.plans.load import Target, load
from fisclake.registry import AUDITED, CANCELLATIONS, DOCUMENTS, ITEMS, XML
from fisclake.session import shared_folder
from fisclake.sources import scans
from fisclake.sources.storage import exists, files, mark, partition_inventory
from fisclake.streaming import incremental
from workload.documents import bronze, bronze_events


@pytest.fixture
def folder(spark):
    return shared_folder(spark, "tests")


@pytest.fixture
def silver(spark):
    data = [(f"53{month}{n:038d}", n, month) for month in ("0512", "2401", "2402") for n in range(20)]
    return spark.createDataFrame(data, "chave string, n int, chave_particao string")


def test_partition_values_stay_text(spark, folder, silver):
    sinks.write_partitioned(silver, folder)
    assert {row.chave_particao for row in spark.read.parquet(folder).collect()} == {"0512", "2401", "2402"}
    inventory = {row.chave_particao: row.files for row in partition_inventory(spark, folder, ["chave_particao"]).collect()}
    assert inventory == {"0512": 1, "2401": 1, "2402": 1}


def test_hot_partition_is_split_on_write(spark, folder):
    """A value that holds far more than the target size is written by several tasks."""
    df = spark.range(400_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("t"), F.lit("2401").alias("chave_particao"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        sinks.write_partitioned(df, folder)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert files(spark, folder).count() > 2
    assert spark.read.parquet(folder).count() == 400_000


def test_write_once(spark, folder, silver):
    assert sinks.write_once(silver, folder) and not sinks.write_once(silver.limit(1), folder)
    assert spark.read.parquet(folder).count() == 60


def test_drop_column(spark, folder, silver):
    sinks.write_partitioned(silver, folder)
    sinks.rewrite_without(spark, folder, "N")
    assert spark.read.parquet(folder).columns == ["chave", "chave_particao"]
    assert spark.read.parquet(folder).count() == 60
    assert not exists(spark, f"{folder}_old") and not exists(spark, f"{folder}_staged")


def test_failed_verification_leaves_the_table(spark, folder, silver):
    silver.write.parquet(folder)
    with pytest.raises(sinks.VerificationError):
        sinks.staged_swap(
            spark, folder, lambda copy: silver.limit(3).write.parquet(copy), lambda copy: sinks.require_same_rows(spark, folder, copy)
        )
    assert spark.read.parquet(folder).count() == 60


def test_compaction_merges_and_keeps_rows(spark, folder, silver):
    silver.repartition(6).write.partitionBy("chave_particao").parquet(folder)
    before = {tuple(row) for row in spark.read.parquet(folder).collect()}
    compaction.compact(spark, folder)
    assert {tuple(row) for row in spark.read.parquet(folder).collect()} == before
    assert {row.files for row in partition_inventory(spark, folder, ["chave_particao"]).collect()} == {1}


def test_compaction_spreads_big_partitions(spark, silver):
    sizes = spark.createDataFrame([("2401", 4), ("2402", 1)], "chave_particao string, ideal_files int")
    spread = compaction.spread(silver, sizes, 5, "CHAVE").withColumn("task", F.spark_partition_id())
    assert spread.count() == 60 and spread.columns == [*silver.columns, "task"]
    assert spread.filter("chave_particao = '2402'").select("task").distinct().count() == 1
    assert spread.filter("chave_particao = '2401'").select("task").distinct().count() == 4


@pytest.mark.parametrize("ideal", [1, 10, 50, 100])
def test_every_file_has_a_task(spark, ideal):
    """As many files as the plan says, NULL partition and rows without key included."""
    rows = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN concat('k', id) END AS chave", "CASE WHEN id % 2 = 0 THEN '2401' END AS chave_particao", "id")
    sizes = spark.createDataFrame([("2401", ideal), (compaction.NO_VALUE, ideal)], "chave_particao string, ideal_files int")
    tasks = compaction.spread(rows, sizes, 2 * ideal, "chave").withColumn("task", F.spark_partition_id())
    per = tasks.groupBy("chave_particao").agg(F.count_distinct("task").alias("n"), F.count("*").alias("rows")).collect()
    assert {(r.chave_particao, r.n, r.rows) for r in per} == {("2401", ideal, 10_000), (None, ideal, 10_000)}


def test_null_partition_compacts_mirrors_and_reconciles(spark, folder, silver):
    rows = silver.unionByName(silver.withColumn("chave_particao", F.lit(None).cast("string")).withColumn("chave", F.lit(None).cast(silver.schema["chave"].dataType)))
    rows.repartition(6).write.partitionBy("chave_particao").parquet(folder)
    compaction.compact(spark, folder)
    assert spark.read.parquet(folder).count() == 120
    assert {row.files for row in partition_inventory(spark, folder, ["chave_particao"]).collect()} == {1}
    mirror(spark, folder, f"{folder}_copy")
    assert verify_mirror(spark, folder, f"{folder}_copy").filter("NOT equal").count() == 0
    table = scans.read_table(spark, folder)
    assert reconcile_partitions(table, scans.read_table(spark, f"{folder}_copy"), "n").filter("difference <> 0").count() == 0


@pytest.mark.parametrize("failing", range(1, 7))
def test_cut_off_compaction_is_recovered(spark, folder, silver, monkeypatch, failing):
    """Whichever rename fails, no reader sees a row twice, and the next run loses none."""
    silver.repartition(6).write.partitionBy("chave_particao").parquet(folder)
    real, calls = sinks.move, []

    def broken(*args):
        calls.append(args)
        if len(calls) == failing:
            raise RuntimeError("cut off")
        real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "move", broken)
        with pytest.raises(RuntimeError):
            compaction.compact(spark, folder)
    assert spark.read.parquet(folder).count() <= 60
    compaction.compact(spark, folder)
    assert spark.read.parquet(folder).count() == 60
    assert {row.files for row in partition_inventory(spark, folder, ["chave_particao"]).collect()} == {1}


def test_cut_off_swap_of_a_table_is_recovered(spark, folder, silver, monkeypatch):
    sinks.write_partitioned(silver, folder)
    real, calls = sinks.move, []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("cut off")
        real(*args)

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "move", broken)
        with pytest.raises(RuntimeError):
            sinks.staged_swap(spark, folder, lambda copy: sinks.write_partitioned(silver.limit(5), copy), lambda copy: None)
    sinks.staged_swap(spark, folder, lambda copy: sinks.write_partitioned(scans.read_table(spark, folder), copy), lambda copy: sinks.require_same_rows(spark, folder, copy))
    assert spark.read.parquet(folder).count() == 60


def test_no_folders_are_no_rows(spark, folder, silver):
    sinks.write_partitioned(silver, folder)
    assert scans.read_table(spark, folder, folders=[]).count() == 0


def test_mirror_follows_changes(spark, folder, silver):
    target = f"{folder}_copy"
    sinks.write_partitioned(silver, folder)
    assert mirror(spark, folder, target) == 3
    sinks.write_partitioned(silver.filter("chave_particao = '2401'"), folder)
    assert {r.chave_particao for r in verify_mirror(spark, folder, target).filter("NOT equal").collect()} == {"2401"}
    mirror(spark, folder, target, since="2000-01-01 00:00:00")
    assert verify_mirror(spark, folder, target).filter("NOT equal").count() == 0
    assert mirror(spark, folder, target, since="2999-01-01 00:00:00") == 0


def test_tables(spark, folder, silver):
    sinks.write_partitioned(silver, folder)
    catalog.replace_table(spark, "t_silver", folder)
    catalog.replace_table(spark, "t_silver", folder)
    assert spark.table("t_silver").count() == 60
    assert {r.chave_particao for r in catalog.partitions(spark, "t_silver").collect()} == {"0512", "2401", "2402"}
    assert not spark.catalog.tableExists("t_silver_building")
    catalog.drop_tables(spark, ["t_silver"])
    assert not spark.catalog.tableExists("t_silver") and exists(spark, folder)


def test_archive_adds_only_new_days(spark, folder):
    days = spark.createDataFrame([("01/02/2024 00:00:00", 1), ("02/02/2024 00:00:00", 2), ("bad", 3)], "DHPROC string, n int")
    sinks.archive_new_days(days.filter("n = 1"), folder)
    sinks.archive_new_days(days, folder)
    sinks.archive_new_days(days, folder)
    assert sorted(row.n for row in spark.read.parquet(folder).collect()) == [1, 2]
    assert [row.n for row in spark.read.parquet(f"{folder}_rejected").collect()] == [3]


def test_write_once_after_a_crash(spark, folder, silver):
    mark(spark, f"{folder}/_temporary/0")
    assert sinks.write_once(silver, folder) and not sinks.write_once(silver.limit(1), folder)
    assert spark.read.parquet(folder).count() == 60


def test_batches_loaded_twice_and_rejected_whole(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "nfcom")
    batch.write.parquet(f"{folder}/good")
    batch.withColumn(XML, F.lit("<broken")).withColumn("NSU", F.col("NSU") + 1_000_000).write.parquet(f"{folder}/broken")
    kind, target = DOCUMENTS["NFCom"], Target(f"{folder}/silver")
    for _ in range(2):
        report = load_batches(spark, [Batch(kind, f"{folder}/{name}", target) for name in ("broken", "good")])
        assert [row.outcome for row in report.collect()] == ["loaded", "loaded"]
    assert spark.read.parquet(target.path).count() == 1500
    assert spark.read.parquet(target.rejected).count() == 1500


def test_files_delivered_later_into_the_same_inbox(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "nfcom")
    kind, target, inbox = DOCUMENTS["NFCom"], Target(f"{folder}/silver"), f"{folder}/in box"
    for part in range(3):
        batch.filter(F.col("NSU") % 3 == part).write.mode("append").parquet(inbox)
        for _ in range(2):
            assert [row.outcome for row in load_batches(spark, [Batch(kind, inbox, target)]).collect()] == ["loaded"]
            read = spark.read.parquet(target.path)
            assert read.count() == read.select("chave").distinct().count() == batch.filter(F.col("NSU") % 3 <= part).count()


@pytest.mark.parametrize("step", ["write_partitioned", "publish", "mark"])
def test_files_delivered_after_a_batch_was_cut_off(spark, folder, sf_dir, monkeypatch, step):
    """Cut off while it is staged, moved or marked: its files and the later ones arrive once each."""
    batch = bronze(spark, sf_dir, "nfcom")
    kind, target, inbox = DOCUMENTS["NFCom"], Target(f"{folder}/silver"), f"{folder}/inbox"
    batch.filter("NSU % 2 = 0").write.parquet(inbox)
    whole, calls = getattr(incremental, step), []

    def cut_off(*args, **options):
        whole(*args, **options)
        calls.append(step)
        raise sinks.VerificationError("cut off")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, step, cut_off)
        assert [row.outcome for row in load_batches(spark, [Batch(kind, inbox, target)]).collect()] == ["failed"]
    assert calls == [step]
    batch.filter("NSU % 2 = 1").write.mode("append").parquet(inbox)
    for _ in range(2):
        assert [row.outcome for row in load_batches(spark, [Batch(kind, inbox, target)]).collect()] == ["loaded"]
    read = spark.read.parquet(target.path)
    assert read.count() == read.select("chave").distinct().count() == batch.count()


def test_month_folder_names(spark):
    df = spark.createDataFrame([("2024", "4"), ("2024", "04"), ("2024", "5"), ("2023", "4")], "year string, month string")
    assert scans.in_month(df, 2024, 4).count() == 2


def test_idempotent_load(spark, silver):
    assert sinks.new_items(silver, silver, ["chave"]).count() == 0
    assert sinks.new_items(silver, silver.filter("n > 4"), ["chave"]).count() == 15
    assert sinks.new_items(silver, None, ["chave"]).count() == 60


def test_batch_load_and_gate(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "mdfe")
    target = Target(f"{folder}/silver")
    counts = load(batch, DOCUMENTS["MDFe"], target)
    assert counts.agg(F.sum("documents")).first()[0] == batch.count()
    assert spark.read.parquet(target.rejected).count() == 0
    with pytest.raises(DuplicateBatchError):
        load(batch.unionByName(batch.limit(1)), DOCUMENTS["MDFe"], target)


def test_drift_finds_only_the_added_tag(spark, sf_dir):
    batch = bronze(spark, sf_dir, "nf3e")
    assert drift.drift(spark, batch, DOCUMENTS["NF3e"]).count() == 0
    extra = batch.withColumn(XML, F.replace(XML, F.lit("<ide>"), F.lit("<ide><novo><a>1</a></novo><Signature><b>1</b></Signature>")))
    assert [row.path for row in drift.drift(spark, extra, DOCUMENTS["NF3e"]).collect()] == ["NF3e.infNF3e.ide.novo.a"]


@pytest.mark.parametrize("name", ["NFe", "NFCe"])
def test_drift_report_tells_headers_from_items(spark, sf_dir, name):
    """A new tag in an item counts for the items, one in the header for the header."""
    kinds = (DOCUMENTS[name], ITEMS[name])
    batch = bronze(spark, sf_dir, DOCUMENTS[name].family)

    def unknown(tag, new):
        changed = batch.withColumn(XML, F.regexp_replace(XML, f"(<{tag}[^>]*>)", f"$1{new}"))
        assert changed.filter(F.col(XML).contains(new)).count() > 0
        return [row.unknown for row in drift.report(spark, [(kind, changed) for kind in kinds]).collect()]

    assert unknown("prod", "<novo>1</novo>") == [0, 1]
    assert unknown("ide", "<novo><a>1</a><b>2</b></novo>") == [2, 0]


def test_paths_of_elements_that_are_sometimes_repeated(spark):
    texts = ["<r><d><x>1</x></d></r>", "<r><d><x>1</x></d><d><y>2</y></d></r>",
             "<r><d><z>1</z></d><d><z>1</z><z>2</z></d><e/></r>", "<r a='1'><f>t</f><f>u</f></r>", "broken <"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert drift.element_paths(df, "t") == ["_a", "d.x", "d[].x", "d[].y", "d[].z", "d[].z[]", "e", "f[]"]
    assert drift.infer_schema(df, "t").simpleString() == (
        "struct<_a:string,d:array<struct<x:string,y:string,z:array<string>>>,e:string,f:array<string>>"
    )


def test_paths_with_prefixes_and_elements_of_different_kinds(spark):
    text = "<r xmlns:ds='u'><ds:Sig a='1'><ds:v>1</ds:v></ds:Sig><d><x>SEM, \\ GTIN:&quot;,</x><y>a</y></d><d><x>7890</x></d><e>true</e></r>"
    df = spark.createDataFrame([(text,), (text.replace("7890", "12.5").replace("SEM", "OUTRO"),)], "t string")
    paths = ["_xmlns:ds", "d[].x", "d[].y", "ds:Sig._a", "ds:Sig.ds:v", "e"]
    assert drift.element_paths(df, "t") == paths
    parsed = df.select(F.expr("from_xml(t, 'document variant', map('singleVariantColumn', 'document'))").alias("p"))
    assert parsed.select(drift._shape(F.col("p.document"))).distinct().count() == 1


def test_events_of_every_family_have_a_request(spark, sf_dir):
    assert bronze_events(spark, sf_dir, "nfce").filter(F.col(XML).contains("<infEvento")).count() == 1500


def test_one_bad_batch_does_not_stop_the_others(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "nfcom")
    batch.write.parquet(f"{folder}/good")
    batch.unionByName(batch.limit(5)).write.parquet(f"{folder}/twice")
    kind, target = DOCUMENTS["NFCom"], Target(f"{folder}/silver")
    report = load_batches(spark, [Batch(kind, f"{folder}/{name}", target) for name in ("twice", "missing", "good")])
    assert [row.outcome for row in report.collect()] == ["failed", "absent", "loaded"]
    assert "1505 rows but 1500 distinct" in report.first().reason
    assert spark.read.parquet(target.path).count() == 1500


def test_full_audit_reads_the_archive(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "mdfe").filter("substring(DHPROC, 4, 7) = '03/1997'")
    kind = DOCUMENTS["MDFe"]
    sinks.archive_new_days(batch, f"{folder}/bronze/{kind.bronze}")
    loaded = batch.filter("NSU % 2 = 0")
    load(loaded, kind, Target(f"{folder}/silver/{kind.silver}"))
    found = full_audit(spark, f"{folder}/bronze", f"{folder}/silver", 1997, 3, [kind])
    assert found.count() == batch.count() - loaded.count() > 0
    assert {row.table for row in found.collect()} == {"mdfe/MDFe"}
    assert full_audit(spark, f"{folder}/bronze", f"{folder}/silver", 1997, 4, [kind]).count() == 0


def test_registry_folders():
    assert len(AUDITED) == 24
    assert DOCUMENTS["NFe"].silver == "nfe/infNFe" and DOCUMENTS["BPeTA"].silver == "bpe/BPeTA"
    assert {kind.bronze for kind in AUDITED} >= {"nfe", "cte_evento", "nfce_cancelamento"}


def test_rewrites_keep_partition_names_where_the_session_infers_types(spark, folder, silver):
    """In a session that reads `0512` as a number the folders must keep their names all the same."""
    setting = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(setting, "true")
    try:
        sinks.write_partitioned(silver, folder)
        sinks.rewrite_without(spark, folder, "n")
        mirror(spark, folder, f"{folder}_copy")
        silver.repartition(4).write.partitionBy("chave_particao").parquet(f"{folder}_many")
        compaction.compact(spark, f"{folder}_many")
    finally:
        spark.conf.set(setting, "false")
    for path in (folder, f"{folder}_copy", f"{folder}_many"):
        found = {row.chave_particao for row in partition_inventory(spark, path, ["chave_particao"]).collect()}
        assert found == {"0512", "2401", "2402"}
        assert spark.read.parquet(path).count() == 60


def test_nothing_is_lost_between_table_and_rejects(spark, folder, sf_dir):
    """Every row of a batch is in exactly one of the two; events without reply count as filed."""
    broken = f"CASE WHEN NSU % 10 = 0 THEN left({XML}, 40) WHEN NSU % 10 = 1 THEN NULL ELSE {XML} END"
    batch = bronze(spark, sf_dir, "nf3e").withColumn(XML, F.expr(broken))
    target = Target(f"{folder}/documents")
    load(batch, DOCUMENTS["NF3e"], target)
    assert spark.read.parquet(target.path).count() == 1200
    kept = spark.read.parquet(target.rejected)
    assert kept.count() == 300 and {row.reason for row in kept.collect()} == {"malformed"}
    events = bronze_events(spark, sf_dir, "nf3e")
    target = Target(f"{folder}/events")
    load(events, CANCELLATIONS["NF3e"], target)
    assert spark.read.parquet(target.path).count() == events.count()
    assert spark.read.parquet(target.path).filter("chave IS NULL").count() > 0
    assert spark.read.parquet(target.rejected).count() == 0


def test_load_reports_only_the_months_of_the_batch(spark, folder, sf_dir):
    batch = bronze(spark, sf_dir, "nfcom")
    target = Target(folder)
    load(batch.filter("substring(CHAVE, 3, 4) = '9701'"), DOCUMENTS["NFCom"], target)
    counts = load(batch.filter("substring(CHAVE, 3, 4) IN ('0003', '9702')"), DOCUMENTS["NFCom"], target)
    assert [row.chave_particao for row in counts.collect()] == ["0003", "9702"]


def test_full_audit_reads_the_months_of_its_keys(spark, folder, sf_dir):
    """Silver is pruned to the partitions of the keys, the one of NULL too; tables compared by sequence number are read whole."""
    kind = DOCUMENTS["NFCom"]
    batch = bronze(spark, sf_dir, "nfcom").select("NSU", "CHAVE")
    filed = batch.select(F.col("CHAVE").alias("chave"), F.col("NSU").cast("string").alias("NSU"), F.substring("CHAVE", 3, 4).alias("chave_particao"))
    gone = filed.filter("NSU % 7 <> 0").withColumn("chave_particao", F.when(F.col("NSU") % 11 > 0, F.col("chave_particao")))
    gone.write.partitionBy("chave_particao").parquet(f"{folder}/silver")
    asked = batch.filter("substring(CHAVE, 3, 4) IN ('9701', '9702')")
    part = silver_of(asked, kind, f"{folder}/silver")
    folders = {name.split("chave_particao=")[1].split("/")[0] for name in part.inputFiles()}
    assert folders == {"9701", "9702", "__HIVE_DEFAULT_PARTITION__"}
    missing = asked.join(part, asked.CHAVE == part.chave, "left_anti")
    assert missing.count() == asked.filter("NSU % 7 = 0").count() > 0
    event = CANCELLATIONS["NFCom"]
    assert silver_of(asked, event, f"{folder}/silver").count() == gone.count()
