"""Gates, audits, repair, profile and gaps on small hand-written rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from fisclake.operators import audit, compaction
from fisclake.operators.gaps import late_folders, missing_days, missing_hours, missing_recent_days, months_present
from fisclake.operators.gates import DuplicateBatchError, require_unique, uniqueness
from fisclake.operators.profile import empty_columns, mostly_null, null_profile
from fisclake.operators.repair import deduplicate, deduplication_report
from fisclake.plans.audits import audit_status, item_audit, log_metrics
from fisclake.sources import jdbc
from fisclake.sources.auditlog import LINE, measured
from fisclake.sources.storage import newest_folder


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_gates(spark):
    clean = spark.createDataFrame([(1, "a"), (2, "a"), (None, None)], "n int, t string")
    assert require_unique(clean, ["n"]) == 3
    assert require_unique(clean) == 3
    twice = clean.unionByName(clean.filter("n = 1"))
    assert rows(uniqueness(twice)) == [(4, 3, False)]
    with pytest.raises(DuplicateBatchError, match="4 rows but 3 distinct by n"):
        require_unique(twice, ["n"])
    assert rows(uniqueness(clean.filter("n > 9"), ["n"])) == [(0, 0, True)]


def test_full_row_gate_tells_null_from_text(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("null", "x")], "a string, b string")
    assert require_unique(df) == 3


def test_missing_and_duplicates(spark):
    bronze = spark.createDataFrame([("K1",), ("k2",), ("K3",), (None,)], "CHAVE string")
    silver = spark.createDataFrame([("k1",), ("k2",), ("k2",)], "chave string")
    assert rows(audit.missing_in_silver(bronze, silver)) == [("K3",), (None,)]
    items = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z")], "chave string, nItem int, v string")
    assert rows(audit.duplicate_keys(items, ["chave", "nItem"])) == [("a", 1, 2)]
    assert rows(audit.duplicate_records(items, ["chave", "nItem"])) == [("a", 1, "x"), ("a", 1, "y")]


def test_key_lists(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("b",)], "chave string")
    table = spark.createDataFrame([("b",), ("c",), ("c",)], "chave string")
    assert rows(audit.compare_key_lists(listed, table)) == [("a", "missing"), ("c", "extra")]
    assert rows(audit.key_list_totals(listed, table)) == [(2, 2, 1, 1)]


def test_numeric_and_text_keys_compare(spark):
    left = spark.createDataFrame([(1,), (2,)], "n int").select(F.col("n").cast("decimal(38,0)"))
    right = spark.createDataFrame([("2",)], "n string")
    assert rows(audit.distinct_keys_except(left, right, "n", "n")) == [("1",)]


def test_reconcile(spark):
    a = spark.createDataFrame([("p", "1"), ("p", "1"), ("q", "2")], "chave_particao string, chave string")
    b = spark.createDataFrame([("p", "1"), ("r", "3")], "chave_particao string, chave string")
    reconciled = audit.reconcile_partitions(a, b)
    assert rows(reconciled) == [("p", 1, 1, 0), ("q", 1, 0, 1), ("r", 0, 1, -1)]
    assert [row.chave_particao for row in audit.differing_partitions(reconciled).collect()] == ["q", "r"]


def test_totals(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "t string")
    assert rows(audit.totals_with_grand_total(df, "t")) == [("a", 2, False), (None, 1, False), (None, 3, True)]
    source = spark.createDataFrame([("a", 3), ("b", 1)], "t string, total bigint")
    lake = spark.createDataFrame([("a", 3), ("c", 2)], "t string, total bigint")
    assert rows(audit.compare_totals(source, lake, "t")) == [("b", 1, 0, 1), ("c", 0, 2, -2)]


def test_deduplicate_keeps_the_smallest_and_all_columns(spark):
    df = spark.createDataFrame([("x", "a", 2), ("y", "a", 1), ("x", "b", 9), ("x", "a", None)], "v string, k string, n int")
    assert rows(deduplicate(df, ["k"])) == [("x", "a", None), ("x", "b", 9)]
    assert deduplicate(df, ["k"]).columns == df.columns
    nulls = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "k string, n int")
    assert rows(deduplicate(nulls, ["k"])) == [("a", 5), (None, 1)]
    assert rows(deduplicate(nulls.select("k"), ["k"])) == [("a",), (None,)]
    assert rows(deduplication_report(df, ["k"])) == [(4, 2, 2, 1)]


def test_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, `c.d` string")
    profile = null_profile(df)
    assert rows(profile) == [("a", 2, 2, 0.0), ("b", 2, 0, 100.0), ("c.d", 2, 1, 50.0)]
    assert [r.column for r in empty_columns(profile).collect()] == ["b"]
    assert [r.column for r in mostly_null(profile, 49.0).collect()] == ["b", "c.d"]
    assert rows(null_profile(df.filter("a > 5")))[0] == ("a", 0, 0, None)


def test_gaps(spark):
    days = spark.createDataFrame([("2024-02-27",), ("2024-03-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    found = [row.day.isoformat() for row in missing_days(days, F.col("d")).orderBy("day").collect()]
    assert found == ["2024-02-28", "2024-02-29"]
    recent = missing_recent_days(days, F.col("d"), "2024-03-02", days=3)
    assert sorted(row.day.isoformat() for row in recent.collect()) == ["2024-02-28", "2024-02-29"]
    assert missing_days(days.filter("d > '2030-01-01'"), F.col("d")).count() == 0
    times = spark.createDataFrame([("2024-01-01 01:30:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    hours = missing_hours(times, F.col("t"), "2024-01-01 00:00:00", "2024-01-01 03:00:00").orderBy("hour").collect()
    assert [row.hour.hour for row in hours] == [0, 2]
    months = months_present(days, F.date_format("d", "yyyyMM"), 2024)
    assert [row.month for row in months.filter("present").orderBy("month").collect()] == ["202402", "202403"]


def test_newest_folders(spark):
    paths = ["/b/nfe/20240101/x.parquet", "/b/nfe/20240103/y.parquet", "/b/cte/20240102/z.parquet"]
    newest = newest_folder(spark.createDataFrame([(p,) for p in paths], "path string"))
    late = late_folders(newest, datetime.date(2024, 1, 4))
    assert rows(late) == [("/b/cte", "20240102", False), ("/b/nfe", "20240103", True)]


@pytest.mark.parametrize(
    ("megabytes", "files", "ideal", "healthy"),
    [(0, 0, 1, True), (0, 1, 1, True), (0, 2, 1, False), (239, 1, 1, True), (240, 1, 2, True), (1600, 8, 10, True),
     (1600, 7, 10, False), (1600, 11, 10, True), (1600, 12, 10, False)],
)
def test_compaction_health(spark, megabytes, files, ideal, healthy):
    inventory = spark.createDataFrame([("0512", files, megabytes * 1024 * 1024)], "chave_particao string, files bigint, bytes bigint")
    row = compaction.plan(inventory).first()
    assert (row.ideal_files, row.healthy) == (ideal, healthy)


def test_archive_files(spark):
    df = spark.createDataFrame([(1,), (600 * 1024 * 1024,), (601 * 1024 * 1024,)], "bytes bigint")
    assert [row[0] for row in df.select(compaction.archive_files()).collect()] == [2, 2, 3]


def test_item_audit_and_status(spark):
    bronze = spark.createDataFrame([("A",), ("B",)], "CHAVE string")
    header = spark.createDataFrame([("A",)], "chave string")
    items = spark.createDataFrame([("A", 1), ("A", 1)], "chave string, nItem int")
    assert rows(item_audit(bronze, header, items)) == [("headers_without_items", 0), ("missing_keys", 1), ("repeated_items", 1)]
    found = spark.createDataFrame([("nfe/det", "1")], "table string, key string")
    assert rows(audit_status(found, ["nfe/det", "cte/CTe"])) == [("cte/CTe", 0, "SUCESSO"), ("nfe/det", 1, "ATENÇÃO")]


def test_log(spark):
    texts = ["[2024-01-01 10:00:00] Total de CHAVEs não encontradas no prata: 7", "noise",
             "[2024-01-01 10:00:01] Duplicidades encontradas: x", "[2024-01-01 10:00:02] Processando documento: NFe"]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    log = raw.filter(F.col("value").rlike(LINE)).select(F.regexp_extract("value", LINE, 2).alias("message"))
    assert rows(log_metrics(log)) == [(1, 0, 7, 1, 0, 0, "ATENÇÃO")]
    assert rows(measured(log, r"prata: (\d+)", ["n"]).select("n")) == [("7",)]


def test_jdbc_sql():
    assert jdbc.source_query("t", ["a", "b"], "c", "2024-01-01 00:00:00", "2024-01-02 00:00:00") == (
        "SELECT a, b FROM t WHERE c >= TIMESTAMP '2024-01-01 00:00:00' AND c < TIMESTAMP '2024-01-02 00:00:00'"
    )
    predicates = list(jdbc.key_predicates("k", ["1", "2'", "3"], size=2))
    assert predicates == ["k IN ('1', '2''')", "k IN ('3')"]
