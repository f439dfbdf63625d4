"""The documents of the queries: the texts ``to_xml`` gives, without its writer looking at every field of every row."""

import re

import pytest
from pyspark.sql import functions as F

from fisclake.registry import DOCUMENTS, XML
from workload import documents, storing

ORDERS = [
    (1, 7, "O", 1.005, "1996-01-02"), (14, 7, "P", float("nan"), "1996-01-02"), (3, None, None, None, None), (None, 3, "<&>\"'", -2.5, "1996-01-02"),
    (-3, 1, "]]>\r\n", 1e15, "1996-01-02"), (5, 2, "", 2.0, None), (5, 2, " ", 2.0, "1996-01-02"),
]


@pytest.fixture(scope="module")
def orders(spark):
    df = spark.createDataFrame(ORDERS, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string")
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def written(struct, root):
    return F.to_xml(struct, {"rowTag": root, "indent": "", "declaration": ""})


def test_texts_are_those_of_the_writer(orders):
    status, key = F.col("o_orderstatus"), F.col("o_orderkey").cast("string")
    leaf = documents.escaped(status)
    fields = {"_k": key, "a.b": leaf, "a.c": key, "d._k": key, "d.e": leaf, "f.g.h": leaf, "i": [(F.col("o_orderkey") > 2, {"j": "1"}), {"j": leaf}], "m._k": "2",
              "l.x": documents.Detail(0, 2, "x-{k}"), "l.y": documents.Detail(0, 2, "{v}")}
    detail = F.col("o_orderkey") % 2 == 0
    reference = F.struct(
        key.alias("_k"), F.struct(status.alias("b"), key.alias("c")).alias("a"), F.struct(key.alias("_k"), status.alias("e")).alias("d"),
        F.struct(F.struct(status.alias("h")).alias("g")).alias("f"),
        F.filter(F.array(F.when(F.col("o_orderkey") > 2, F.struct(F.lit("1").alias("j"))), F.struct(status.alias("j"))), lambda i: i.isNotNull()).alias("i"),
        F.struct(F.lit("2").alias("_k")).alias("m"),
        F.struct(F.when(detail, F.concat(F.lit("x-"), key)).alias("x"), F.when(detail, (F.col("o_orderkey") % 1000 + 0.5).cast("string")).alias("y")).alias("l"),
    )
    for row in orders.select(documents.xml(fields, "r").alias("text"), written(reference, "r").alias("writer")).collect():
        assert row.text == row.writer


def test_whole_document(orders):
    text = documents.bronze(orders.sparkSession, "", "nfe", orders.limit(1)).first()[XML]
    item = (
        '<det nItem="1"><prod><cProd>8</cProd><CFOP>5102</CFOP><qCom>1</qCom><vUnCom>1.01</vUnCom><vProd>1.01</vProd></prod>'
        "<imposto><ICMS><ICMS00><CST>00</CST><vBC>1.01</vBC></ICMS00></ICMS></imposto></det>"
    )
    assert text.count("<det ") == 1 and item in text.replace("1.00<", "1.01<") and text.endswith("</infNFe></NFe></nfeProc>\n")


@pytest.mark.parametrize("family", ["nfe", "cte", "bpe", "nfce"])
def test_the_writer_is_asked_for_odd_texts_only(orders, family):
    spark = orders.sparkSession
    plan = documents.bronze(spark, "", family, orders)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_xml(") == len(re.findall(r"o_orderstatus#\d+, \[\^0-9A-Za-z\]\) THEN regexp_extract\(to_xml\(", plan)) > 0
    assert "lambdafunction" not in plan
    events = documents.bronze_events(spark, "", family, family == "nfce", orders)
    assert "to_xml" not in events._jdf.queryExecution().optimizedPlan().toString()


def test_the_refused_inbox_is_made_of_the_stored_one(spark, sf_dir):
    read = []

    def twice(good):
        read.extend(good.inputFiles())
        return good.unionAll(good)

    found = storing._gated(spark, "key", DOCUMENTS["NFCe"], documents.bronze(spark, sf_dir, "nfce").limit(20), twice).collect()
    assert [(row.outcome, row.documentos) for row in found] == [("loaded", 20), ("loaded", 20), ("failed", 0)]
    assert read and all("/good/" in path for path in read)
