"""Work that must not grow into one task, the driver or a shuffle of its own: plans and small rows."""

import pytest
from pyspark.sql import functions as F

from fisclake.operators import audit, drift, structures
from fisclake.operators.sinks import new_items
from fisclake.registry import AUDITED, DOCUMENTS, ITEMS, XML
from workload import auditing, documents

LIKE = ['<a k="{n}"><b>{n}</b><d>Casa {n}</d><d>{n}.5</d></a>'.format(n=n) for n in range(40)]
TEXTS = [
    "<a><b>1</b><b>x</b></a>", "<a><b/><b></b></a>", '<a x="1">t<c>2</c>u</a>', '<a x=" ">  <c> </c></a>', "<a><b>1</b>", "<a>&bad;</a>", "none", "", None,
    '<?xml version="1.0" encoding="UTF-8"?><a xmlns="http://x" xmlns:d="http://y" versao="4.00"><d:b>5</d:b></a>',
    "<a k='v'><b>A &amp; B</b><c>&#233;</c><c>&#49;</c></a>", "<a><q><![CDATA[https://x?p=1|2&z=<3>]]></q></a>",
    "<a><q><![CDATA[]]></q><q><![CDATA[12]]></q></a>", '<a><!-- <x> --><b c="1>2">3</b></a>', "<a><b>a]]>b</b></a>", "<a><b>\x01</b></a>",
    '<a><det n="1"><p>1</p></det><det n="2"><p>2.5</p></det><det n="3"><p>x</p></det></a>',
    '<a><det n="1"><p>1</p></det><det n="2"><p>2</p></det><det n="3"><p>3</p></det></a>',
    f"<a><b>{'53' + '0' * 42}</b><b>1e5</b><c>1,234</c><d>true</d><e>2024-01-01</e><f>E5</f><g>-1.5</g><h>+7</h><i>.5</i><j>5.</j><k>{'9' * 20}</k></a>",
    "<a><b><b><c>1</c></b><b><c>2</c></b></b><b><b><c>3</c></b><b><c>4</c></b></b></a>", "<a><b>1<c/>E3</b></a>", "<a><b>5<c/>2</b><b>u</b></a>",
    "<a><b>NaN</b><c>1d</c><d>0x1F</d><e>1_0</e><f>12:30</f></a>", "<a> 5 <b> y </b><c> 7 </c></a>", "<a><s><x>1</x></s><s><x/></s><s>t</s></a>",
]


@pytest.mark.parametrize("long", [0, 4096])
def test_a_skeleton_has_the_structure_and_types_of_its_document(spark, monkeypatch, long):
    monkeypatch.setattr(drift, "_LONG", long)
    df = spark.createDataFrame([(text,) for text in TEXTS + LIKE], "x string")
    df = df.select("x", drift.skeleton(F.col("x")).alias("s"), drift.skeleton(F.col("x"), typed=True).alias("t"))
    for name in "xst":
        parsed = F.expr(f"from_xml({name}, 'document variant', map('singleVariantColumn', 'document'))")
        df = df.select("*", F.explode(F.array(parsed)).alias(f"parsed_{name}"))
        df = df.withColumn(f"shape_{name}", drift._shape(F.col(f"parsed_{name}.document")))
        df = df.withColumn(f"types_{name}", structures._types(F.schema_of_variant(f"parsed_{name}.document")))
    for row in df.collect():
        assert row.shape_x == row.shape_s == row.shape_t, row.x
        assert row.types_x == row.types_t, row.x


def test_like_documents_are_merged_before_they_are_parsed(spark):
    df = spark.createDataFrame([(text,) for text in LIKE], f"{XML} string")
    assert df.select(drift.skeleton(F.col(XML))).distinct().count() == 1
    assert df.select(drift.skeleton(F.col(XML), typed=True)).distinct().count() == 1
    found = structures.sketch(df, [DOCUMENTS["NF3e"]])
    assert found.first().documents == len(LIKE)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.rindex("from_xml"):]  # below the parser


def test_a_report_reads_the_same_rows_once_for_all_types(spark, sf_dir, monkeypatch):
    passes = []
    once = drift._labelled_paths
    monkeypatch.setattr(drift, "_labelled_paths", lambda df, xml=XML: passes.append(1) or once(df, xml))
    kinds = [DOCUMENTS["NFe"], ITEMS["NFe"], DOCUMENTS["BPe"], DOCUMENTS["BPeTA"]]
    found = drift.report(spark, [(kind, documents.bronze(spark, sf_dir, kind.family)) for kind in kinds])
    assert [(row.document, row.complete) for row in found.collect()] == [("NFe", True), ("NFeDet", True), ("BPe", True), ("BPeTA", True)]
    assert len(passes) == 2


def test_tasks_grow_with_the_rows(spark, sf_dir, monkeypatch):
    rows = documents.table(spark, sf_dir, "orders").count()
    monkeypatch.setattr(documents, "ORDERS_PER_TASK", 50)
    assert documents.orders_for_documents(spark, sf_dir).rdd.getNumPartitions() == -(-rows // 50)


def test_keys_of_a_wide_table_do_not_pass_through_the_driver(spark, tmp_path):
    wide = spark.range(2000).select(F.col("id").alias("k"), *(F.lit(f"text {n}").alias(f"c{n}") for n in range(300)))
    wide.write.parquet(str(tmp_path / "wide"))
    table = spark.read.parquet(str(tmp_path / "wide"))
    batch = spark.range(1000, 3000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    fresh = new_items(batch, table, ["k"])
    assert fresh.count() == 1000
    assert "BroadcastExchange" not in fresh._jdf.queryExecution().executedPlan().toString()


def test_sides_of_a_key_comparison_meet_in_one_shuffle(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([("2",), ("3",), (None,)], "b string")
    assert [row.chave for row in audit.distinct_keys_except(left, right, "a", "b").collect()] == ["1"]
    found = audit.distinct_keys_except(left, right.filter("b IS NOT NULL"), "a", "b")
    assert {row.chave for row in found.collect()} == {"1", None}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan


def test_audit_input_is_joined_once(spark, sf_dir):
    for _, batch, silver in auditing._audit_pairs(spark, sf_dir, AUDITED[:3]):
        for df in (batch, silver):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "Join" not in plan and "Repartition" not in plan


def test_skeletons_are_counted_by_hash(spark):
    """With a text beside the count Spark would sort every skeleton."""
    df = spark.createDataFrame([(text, name) for text in LIKE for name in "ab"], f"{XML} string, f string")
    found = structures.sketch(df, [DOCUMENTS["NF3e"]], F.col("f"))
    row = found.first()
    assert (row.documents, row.first_file, row.last_file) == (2 * len(LIKE), "a", "b")
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.rindex("HashAggregate(") > plan.rindex("SortAggregate(")  # the lowest one


def test_a_status_is_joined_to_orders_and_not_to_their_texts(spark, sf_dir, tmp_path):
    few = documents.table(spark, sf_dir, "orders").limit(20)
    odd = few.limit(3).union(few.limit(1).withColumn("o_orderstatus", F.lit("X"))).union(few.limit(2).withColumn("o_orderkey", F.lit(None).cast("long")))
    few.union(odd.select(few.columns)).write.parquet(str(tmp_path / "orders.parquet"))
    orders = documents.orders_with_status(spark, str(tmp_path))
    batch = documents.bronze(spark, str(tmp_path), "mdfe", orders=orders)
    plain = documents.bronze(spark, str(tmp_path), "mdfe")
    status = documents.table(spark, str(tmp_path), "orders").select(F.col("o_orderkey").cast("decimal(38,0)").alias("NSU"), F.col("o_orderstatus").alias("status"))
    former = plain.join(status, "NSU").select(*batch.columns)
    assert batch.exceptAll(former).count() == former.exceptAll(batch).count() == 0
    plan = batch._jdf.queryExecution().optimizedPlan().toString()
    assert "mdfeProc" in plan[: plan.index("Join")] and "mdfeProc" not in plan[plan.index("Join"):]  # the text is made above
