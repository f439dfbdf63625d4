"""One key and one month hold a third of all rows: results stay whole and equal to brute force in pandas."""

import pytest
from pyspark.sql import functions as F

from fisclake.operators import audit
from fisclake.operators.gates import uniqueness
from fisclake.operators.repair import deduplicate, deduplication_report

ROWS = 30_000


@pytest.fixture(scope="module", params=["broadcast", "shuffled"])
def hot(request, spark):
    """Once with joins as Spark chooses them, once with broadcasts switched off, as for lists that are too large."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if request.param == "shuffled":
        spark.conf.set(setting, "-1")
        spark.conf.set(adaptive, "-1")
    chave = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") / 2).cast("int").cast("string"))
    month = F.when(F.col("id") % 3 == 0, "2401").otherwise(F.concat(F.lit("23"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")))
    yield spark.range(ROWS).select(
        chave.alias("chave"), (F.col("id") % 500).cast("int").alias("nItem"), month.alias("chave_particao"), (F.col("id") % 7919).alias("v")
    )
    spark.conf.unset(setting)
    spark.conf.unset(adaptive)


def test_deduplicate(hot):
    found = deduplicate(hot, ["chave", "nItem"]).toPandas().sort_values(["chave", "nItem"]).reset_index(drop=True)
    pandas = hot.toPandas().sort_values(["chave", "nItem", "chave_particao", "v"])
    expected = pandas.drop_duplicates(["chave", "nItem"]).sort_values(["chave", "nItem"]).reset_index(drop=True)
    assert found[list(expected.columns)].equals(expected)
    report = deduplication_report(hot, ["chave", "nItem"]).first()
    assert (report.before, report.after) == (ROWS, len(expected))


def test_duplicate_records_are_whole(hot):
    pandas = hot.toPandas()
    expected = pandas[pandas.duplicated(["chave", "nItem"], keep=False)]
    assert audit.duplicate_records(hot, ["chave", "nItem"]).count() == len(expected)


def test_missing_and_reconciled(hot):
    pandas = hot.toPandas()
    loaded = hot.filter("v % 2 = 0")
    missing = audit.missing_in_silver(hot, loaded, "chave", "chave").count()
    present = set(pandas[pandas.v % 2 == 0].chave)
    assert missing == (~pandas.chave.isin(present)).sum()
    documents = {row.chave_particao: row.left_documents for row in audit.reconcile_partitions(hot, loaded).collect()}
    assert documents == pandas.groupby("chave_particao").chave.nunique().to_dict()


def test_gate(hot):
    row = uniqueness(hot, ["chave"]).first()
    assert (row.total, row.distinct_total) == (ROWS, hot.toPandas().chave.nunique())
