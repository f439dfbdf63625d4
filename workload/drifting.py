"""Schema inference and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fisclake.layouts.tree import leaf_paths
from fisclake.operators import drift, structures
from fisclake.registry import DOCUMENTS, ITEMS, XML
from fisclake.session import shared_folder
from workload.documents import ORDERS_SQL, bronze, orders_with_status, table
from workload.register import Register

query = Register()
QUERIES, SQL = query.queries, query.sql


def with_new_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NF-e documents in which each order status brings a tag of its own that no layout knows."""
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("decimal(38,0)").alias("NSUDF"), "o_orderstatus")
    batch = bronze(spark, sf_dir, "nfe").join(status, "NSUDF")
    tag = F.concat(F.lit("<infNFe><novo"), "o_orderstatus", F.lit("><valor>1</valor></novo"), "o_orderstatus", F.lit(">"))
    return batch.withColumn(XML, F.regexp_replace(F.col(XML), F.lit("<infNFe[^>]*>"), tag)).drop("o_orderstatus")


@query("SELECT DISTINCT 'NFe' AS document, 'NFe.infNFe.novo' || o_orderstatus || '.valor' AS path FROM orders")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items are no part of the header layout; they count as drift only against it."""
    found = drift.drift(spark, with_new_tags(spark, sf_dir), DOCUMENTS["NFe"])
    return found.filter("NOT path LIKE 'NFe.infNFe.det.%'")


# What a document of the generator holds of a layout with items, written down by hand.
USED = ("protNFe.infProt.chNFe", "protNFe.infProt.cStat", "protNFe.infProt.dhRecbto", "NFe.infNFe._Id", "NFe.infNFe.ide.dhEmi",
        "NFe.infNFe.ide.serie", "NFe.infNFe.det._nItem", "NFe.infNFe.det.prod.cProd", "NFe.infNFe.det.prod.CFOP",
        "NFe.infNFe.det.prod.qCom", "NFe.infNFe.det.prod.vUnCom", "NFe.infNFe.det.prod.vProd",
        "NFe.infNFe.det.imposto.ICMS.ICMS00.CST", "NFe.infNFe.det.imposto.ICMS.ICMS00.vBC", "NFe.infNFe.total.ICMSTot.vNF",
        "NFe.infNFe.emit.CNPJ", "NFe.infNFe.dest.CNPJ", "NFe.infNFe.dest.enderDest.UF", "NFe.infNFe.pag.detPag.tPag",
        "NFe.infNFe.pag.detPag.vPag")


@query(
    f"""SELECT 'NFeDet' AS document, path FROM (SELECT unnest({sorted(drift.official_paths(ITEMS["NFe"]))}) AS path)
        WHERE lower(path) NOT IN {tuple(path.lower() for path in USED)} AND (SELECT count(*) FROM orders WHERE o_orderkey % 5 > 0) > 0"""
)
def schema_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the item layout that no document has."""
    return drift.unused(spark, bronze(spark, sf_dir, "nfe"), ITEMS["NFe"])


@query(
    f"""WITH {ORDERS_SQL} SELECT document, CAST(document = 'CTeSimp' AS BIGINT) AS unknown, document <> 'CTeSimp' AS complete FROM (
          SELECT DISTINCT cte_kind AS document FROM orders_x UNION ALL SELECT DISTINCT bpe_kind FROM orders_x
          UNION ALL SELECT 'MDFe' UNION ALL SELECT 'NF3e' UNION ALL SELECT 'NFCom')"""
)
def schema_drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All types but one are complete: simplified CT-e come with a receipt time that their layout lacks."""
    names = ("CTe", "CTeSimp", "CTeOS", "GVTe", "MDFe", "BPe", "BPeTA", "NF3e", "NFCom")
    batches = [(DOCUMENTS[name], bronze(spark, sf_dir, DOCUMENTS[name].family)) for name in names]
    return drift.report(spark, batches).select("document", "unknown", "complete")


@query(
    f"""WITH {ORDERS_SQL} SELECT document, CAST(document = 'CTeSimp' AS BIGINT) AS unknown, document <> 'CTeSimp' AS complete FROM (
          SELECT DISTINCT cte_kind AS document FROM orders_x UNION ALL SELECT DISTINCT bpe_kind FROM orders_x
          UNION ALL SELECT unnest(['MDFe', 'NF3e', 'NFCom', 'NFe', 'NFeDet', 'NFCe', 'NFCeDet']))"""
)
def schema_drift_report_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 13 variants: the nine of ``schema_drift_report``, and headers and items of NF-e and NFC-e, each against its own layout."""
    batches = [(kind, bronze(spark, sf_dir, kind.family)) for kind in (*DOCUMENTS.values(), *ITEMS.values())]
    return drift.report(spark, batches).select("document", "unknown", "complete")


@query(
    """SELECT unnest(['BPeTA.infBPe._Id', 'BPeTA.infBPe.ide.dhEmi', 'BPeTA.infBPe.ide.serie', 'BPeTA.infBPe.infValorBPe.vBP',
                      'protBPe.infProt.cStat', 'protBPe.infProt.chBPe', 'protBPe.infProt.dhRecbto']) AS path"""
)
def xml_infer_from_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths found in the XML column itself, over all documents."""
    paths = drift.observed_paths(bronze(spark, sf_dir, "bpe"), DOCUMENTS["BPeTA"])
    return spark.createDataFrame([(path,) for path in sorted(paths)], "path string")


@query(
    """SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority',
                      'lines.l_linenumber', 'lines.rate.l_tax', 'tags']) AS path, (SELECT count(*) FROM orders) AS documentos"""
)
def schema_leaf_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of structs are descended, other arrays are leaves."""
    orders = table(spark, sf_dir, "orders")
    item = F.struct(F.lit(1).alias("l_linenumber"), F.struct(F.lit(0.1).alias("l_tax")).alias("rate"))
    nested = orders.withColumn("lines", F.array(item)).withColumn("tags", F.array("o_orderstatus"))
    paths = spark.createDataFrame([(path,) for path in leaf_paths(nested.schema)], "path string")
    return paths.join(nested.agg(F.count("*").alias("documentos")))


@query("SELECT (SELECT count(*) FROM orders) AS documentos, true AS igual")
def schema_ddl_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inferred schema stored as DDL and used to parse."""
    batch = bronze(spark, sf_dir, "nf3e")
    inferred = drift.infer_schema(batch)
    restored = T.StructType.fromDDL(drift.ddl(inferred))
    parsed = batch.select(F.explode(F.array(F.from_xml(XML, restored))).alias("parsed"))
    same = F.lit(leaf_paths(restored) == leaf_paths(inferred)).alias("igual")
    return parsed.groupBy(same).agg(F.count("parsed.protNF3e.infProt.chNF3e").alias("documentos"))


def sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sketch over all families, with faults in three: a new tag in the items of some NF-e, a text for an amount of some MDF-e, a repeated
    group in some NF3-e."""

    def changed(family: str, status: str, pattern: str, new: str) -> DataFrame:
        batch = bronze(spark, sf_dir, family, orders=orders_with_status(spark, sf_dir))
        text = F.when(F.col("status") == status, F.regexp_replace(XML, pattern, new)).otherwise(F.col(XML))
        return batch.withColumn(XML, text).drop("status")

    faults = {
        "nfe": ("F", "<prod>", "<prod><novo>1</novo>"),
        "mdfe": ("O", "<vCarga>[^<]*", "<vCarga>isento"),
        "nf3e": ("P", "(<ide>.*</ide>)", "$1$1"),
    }
    families = dict.fromkeys(kind.family for kind in DOCUMENTS.values())
    parts = []
    for family in families:
        batch = changed(family, *faults[family]) if family in faults else bronze(spark, sf_dir, family)
        parts.append(structures.sketch(batch, [kind for kind in DOCUMENTS.values() if kind.family == family]))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    folder = shared_folder(spark, "sketch")
    whole.write.parquet(folder)
    return spark.read.parquet(folder)


@query(
    f"""WITH {ORDERS_SQL}, faults AS (
          SELECT 'NFeDet' AS document, 'unknown' AS drift, 'NFe.infNFe.det.prod.novo' AS path, count(*) AS documents
          FROM orders_x WHERE o_orderstatus = 'F' AND o_orderkey % 5 > 0
          UNION ALL SELECT 'MDFe', 'type', 'MDFe.infMDFe.tot.vCarga', count(*) FROM orders_x
          UNION ALL SELECT 'NF3e', 'repetition', 'NF3e.infNF3e.ide', count(*) FROM orders_x WHERE o_orderstatus = 'P')
        SELECT 1 AS asked, * FROM faults UNION ALL SELECT 2, * FROM faults
        UNION ALL SELECT 1, 'CTeSimp', 'unknown', 'protCTe.infProt.dhRecbto', count(*) FROM orders_x WHERE cte_kind = 'CTeSimp'"""
)
def schema_drift_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 13 variants from one parse per family against two versions of the official schemas: three kinds of fault are found in both, the
    receipt time of simplified CT-e is new to the first version and known to the second."""
    store = shared_folder(spark, "schemas")
    for kind in DOCUMENTS.values():
        layout = structures.layout_schema(kind.layout)
        if kind.name in ITEMS:  # header and items are one document
            layout = structures.joined(layout, structures.layout_schema(ITEMS[kind.name].layout))
        structures.save_schema(spark, store, kind.name, 1, layout)
        if kind.name == "CTeSimp":
            receipt = T.StructType.fromDDL("protCTe struct<infProt: struct<dhRecbto: string>>")
            structures.save_schema(spark, store, kind.name, 2, structures.joined(layout, receipt))
    folder = shared_folder(spark, "elements")
    structures.elements(sketched(spark, sf_dir)).write.parquet(folder)  # small, and asked twice
    found = spark.read.parquet(folder)
    reports = [
        structures.differences(found, structures.official_schemas(spark, store, version), structures.variants(spark))
        .filter("drift <> 'unused'")
        .select(F.lit(version).alias("asked"), "document", "drift", "path", "documents")
        for version in (1, 2)
    ]
    return reports[0].unionAll(reports[1])


@query(
    """SELECT run, run < 3 AS parsed, count(*) AS documents
       FROM orders, (SELECT unnest([1, 2, 3]) AS run) WHERE run > 1 OR o_orderstatus = 'F' GROUP BY run"""
)
def schema_sketch_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and a run without one: each file is parsed once, and the sketch knows all documents delivered so far."""
    inbox, store = shared_folder(spark, "inbox"), shared_folder(spark, "sketch")
    batch = bronze(spark, sf_dir, "nf3e").withColumn("serie", F.regexp_extract(XML, "<serie>(.)", 1))
    reports = []
    for run, part in enumerate(("serie = 'F'", "serie <> 'F'", None), start=1):
        if part:
            batch.filter(part).write.mode("append").parquet(inbox)
        files = structures.sketch_new_files(spark, store, inbox, [DOCUMENTS["NF3e"]])
        known = structures.stored_sketch(spark, store).agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"))
        reports.append(known.select(F.lit(run).alias("run"), F.lit(files > 0).alias("parsed"), "documents"))
    return reports[0].unionAll(reports[1]).unionAll(reports[2])
