import uuid

import pytest

from fisclake.operators.keytables import KeyTable, add_keys, key_audit, missing_keys, new_keys, open_keys
from fisclake.plans.load import Target, load
from fisclake.registry import DOCUMENTS
from workload.documents import bronze


def key(month, n):
    return f"35{month}{n:038d}"


@pytest.fixture
def tables(spark, tmp_path):
    names = [f"keys_{side}_{uuid.uuid4().hex[:8]}" for side in ("bronze", "silver")]
    yield [KeyTable(name, f"{tmp_path}/{name}", 4) for name in names]
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def frame(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "chave string")


def said(df):
    return sorted(r["chave"] for r in df.collect())


def test_missing_by_month(spark, tables):
    left, right = tables
    keys = [key(m, n) for m in ("2401", "2402") for n in range(50)]
    add_keys(frame(spark, [*keys, keys[0], None, "abc"]).repartition(5), left)
    add_keys(frame(spark, keys[10:60]), right)
    assert said(missing_keys(spark, left, right)) == sorted([*keys[:10], *keys[60:], "abc"])
    assert said(missing_keys(spark, left, right, ["2401"])) == keys[:10]
    assert said(missing_keys(spark, left, right, ["2403"])) == []
    assert said(missing_keys(spark, right, left)) == []
    audit = key_audit(spark, [("a", left, right), ("b", right, left)], ["2401"]).collect()
    assert sorted((r["table"], r["key"]) for r in audit) == [("a", k) for k in keys[:10]]
    assert key_audit(spark, []).collect() == []


def test_a_batch_that_comes_again_adds_nothing(spark, tables):
    table = tables[0]
    keys = [key("2401", n) for n in range(20)]
    add_keys(frame(spark, keys), table)
    add_keys(frame(spark, [k.upper() for k in keys] + [key("2402", 1)]), table)
    assert open_keys(spark, table).count() == 21
    assert said(new_keys(frame(spark, [keys[0], key("2402", 2), key("2402", 2)]), table)) == [key("2402", 2)]
    add_keys(frame(spark, []), table)
    assert open_keys(spark, table).count() == 21


def test_a_new_catalog_finds_the_stored_keys(spark, tables):
    table = tables[0]
    add_keys(frame(spark, [key("2401", 1), key("2402", 1)]), table)
    spark.sql(f"DROP TABLE {table.name}")
    assert said(open_keys(spark, table)) == [key("2401", 1), key("2402", 1)]


def test_nothing_stored_is_shuffled(spark, tables):
    left, right = tables
    for table in tables:
        add_keys(frame(spark, [key(m, n) for m in ("2401", "2402", "2403") for n in range(30)]), table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = missing_keys(spark, left, right, ["2402"])._jdf.queryExecution().executedPlan().toString()
        batch = new_keys(frame(spark, [key("2402", 99)]), left)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("PartitionFilters: [isnotnull(chave_particao") + plan.count("PartitionFilters: [(chave_particao") == 2
    assert "SortMergeJoin" in batch
    # The batch is shuffled for its distinct keys and into the buckets; the scan of the table has nothing above it but its sort.
    stored = batch[batch.rindex("Sort [chave") :]
    assert "Exchange" not in stored and "FileScan" in stored and "Bucketed: true" in stored


def test_different_buckets_are_refused(spark, tables):
    with pytest.raises(ValueError, match="buckets"):
        missing_keys(spark, tables[0], KeyTable("other", "/tmp/none", 8))


def test_a_load_files_its_keys(spark, tables, tmp_path, sf_dir):
    table = tables[0]
    batch = bronze(spark, sf_dir, "nfe").limit(200)
    kind = DOCUMENTS["NFe"]
    for _ in range(2):
        load(batch, kind, Target(f"{tmp_path}/nfe"), gate=None, name="day", keys=table)
    filed = spark.read.parquet(f"{tmp_path}/nfe").selectExpr("lower(chave) AS chave").filter("chave IS NOT NULL").distinct()
    assert said(open_keys(spark, table)) == said(filed)
