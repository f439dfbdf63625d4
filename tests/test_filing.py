"""Loads read each document by a short layout, what few documents hold beside it, and give the same rows as the whole layout."""

import pytest
from pyspark.sql import functions as F

from fisclake.operators import parse
from fisclake.plans import load as plan
from fisclake.registry import DOCUMENTS, ITEMS, XML
from workload import documents

KEY = "53" + "0512" + "0" * 38


def nfe(body, key=KEY, tag="chNFe"):
    return f'<nfeProc versao="4.00"><NFe><infNFe Id="N">{body}</infNFe></NFe><protNFe><infProt><{tag}>{key}</{tag}><cStat>100</cStat></infProt></protNFe></nfeProc>'


PLAIN = '<ide><natOp>x</natOp></ide><emit><CNPJ>1</CNPJ></emit><det nItem="1"><prod><cProd>P</cProd><vProd>1.5</vProd></prod></det>'
ODD = [
    '<ide><NATOP>upper</NATOP></ide><det nItem="1"><PROD><vprod>2.5</vprod></PROD></det>', "<ide><serie>1</serie>text</ide>", "<ide>text</ide>",
    "<ide/><det/>", '<det nItem="1"/><det nItem="2"><prod/></det><det><prod><vDesc>0.5</vDesc></prod></det>', "<emit><CNPJ><x>1</x></CNPJ></emit>", "<emit><CNPJ a='1'>1</CNPJ></emit>",
    "<emit><CNPJ>1</CNPJ></emit><emit><CNPJ>2</CNPJ><IE>3</IE></emit>", "<!-- <emit> --><emit><CNPJ>1</CNPJ></emit>", "<ide><natOp><![CDATA[<xJust>]]></natOp></ide>",
    "<Signature><b>1</b></Signature><ide><natOp> y </natOp></ide>", "<a:ide xmlns:a='u'><a:natOp>n</a:natOp></a:ide>", "<ide ><natOp\n>z</natOp ></ide>",
    "<ide><NFref><refNFe>1</refNFe></NFref><NFref><refNF><AAMM>2</AAMM></refNF></NFref></ide>", "<total><ICMSTot><vNF>abc</vNF><vBC>1</vBC></ICMSTot></total>",
    '<det nItem="1"><prod><DI><nDI>1</nDI><adi><nAdicao>2</nAdicao></adi></DI><NVE>a</NVE><NVE>b</NVE><vProd>x</vProd></prod><imposto><ICMS><ICMS10><vBC>1</vBC></ICMS10></ICMS></imposto></det>',
    '<det nItem="1"><prod>t</prod></det><det nItem="2">t<prod><cProd>q</cProd></prod></det>', "<emit><CNPJ/></emit>", "<emit><xNome>a &amp; b</xNome></emit>",
]
TEXTS = [
    *(nfe(PLAIN.replace("x", str(n))) for n in range(3)), *map(nfe, ODD), nfe(PLAIN, tag="CHNFE"), nfe(PLAIN, ""), "<?xml version='1.0'?>" + nfe(PLAIN),
    "<!DOCTYPE nfeProc [<!ENTITY e 'v'>]>" + nfe("<ide><natOp>&e;</natOp></ide>"), "<nfeProc><NFe>", nfe("<ide>") + "x", "<nfeProc><NFe/></nfeProc>", "none", "", None,
    nfe(PLAIN).replace("nfeProc", "NFEPROC"), "<x>" + nfe(PLAIN) + "</x>",
]
ALL = ["nfeProc", "NFe", "infNFe", "ide", "natOp", "emit", "CNPJ", "det", "prod", "cProd", "vProd", "protNFe", "infProt", "chNFe", "cStat"]


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [(n, text, KEY, "05/12/2024 13:14:15", "05/12/2024 00:00:00", "1.1.1.1", "E", "D", "DF", "GO") for n, text in enumerate(TEXTS)]
    names = f"NSUDF int, {XML} string, CHAVE string, DHPROC string, DHEMI string, IP_TRANSMISSOR string, EMITENTE string, DESTINATARIO string, "
    return spark.createDataFrame(rows, names + "UF_EMITENTE string, UF_DESTINATARIO string").withColumn("NSUDF", F.col("NSUDF").cast("decimal(38,0)"))


def alike(found, expected):
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in expected.schema]
    key = lambda row: repr(tuple(row))
    assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)


@pytest.mark.parametrize("names", [None, [], ALL, [*ALL, "Signature", "b", "total", "ICMSTot", "xJust"], ["NFe", "ide"]])
def test_every_text_gives_the_same_rows(bronze, names):
    for kind, filing, expected in (
        (DOCUMENTS["NFe"], parse.accepted_filing, parse.accepted(bronze, DOCUMENTS["NFe"])),
        (ITEMS["NFe"], parse.item_filing, parse.items(bronze, ITEMS["NFe"]).filter("chave IS NOT NULL")),
    ):
        used = parse.names_in_use(bronze, kind) if names is None else names
        once = parse.read_once(bronze, DOCUMENTS["NFe"], ITEMS["NFe"], used)
        for batch in (bronze, once):
            found = filing(batch, kind, used)
            alike(found.rows.selectExpr(*found.columns), expected)
    alike(parse.rejected(once, DOCUMENTS["NFe"]), parse.rejected(bronze, DOCUMENTS["NFe"]))


def test_names_are_those_of_a_hundredth_of_the_texts(spark):
    kind = DOCUMENTS["NFe"]
    texts = spark.createDataFrame([(f"<a><b>1</b><c x='2'/>{'<d/>' if n < 2 else ''}{'<e/>' if n == 3 else ''}</a>",) for n in range(200)], f"{XML} string")
    assert parse.names_in_use(texts, kind) == ["a", "b", "c", "d"]
    assert parse.names_in_use(texts.limit(0), kind) == []


def test_columns_that_no_document_fills_are_not_moved(spark, sf_dir):
    batch = documents.bronze(spark, sf_dir, "nfe")
    for kind, filing in ((DOCUMENTS["NFe"], parse.accepted_filing), (ITEMS["NFe"], parse.item_filing)):
        found = filing(batch, kind, parse.names_in_use(batch, kind))
        assert len(found.rows.columns) < 40 and len(found.columns) > 250


def test_a_load_files_what_it_refuses(spark, bronze, tmp_path):
    target, items = plan.Target(f"{tmp_path}/inf"), plan.Target(f"{tmp_path}/det")
    plan.load_with_items(bronze, DOCUMENTS["NFe"], ITEMS["NFe"], target, items, gate=["NSUDF"])
    expected = parse.rejected(bronze, DOCUMENTS["NFe"])
    alike(spark.read.parquet(target.rejected), expected)
    assert spark.read.parquet(target.path).count() == len(TEXTS) - expected.count()
    again = plan.Target(f"{tmp_path}/good")
    plan.load_with_items(bronze.limit(3), DOCUMENTS["NFe"], ITEMS["NFe"], again, plan.Target(f"{tmp_path}/good_det"), gate=["NSUDF"])
    assert spark.read.parquet(again.rejected).schema == expected.schema and spark.read.parquet(again.rejected).count() == 0
    assert spark.read.parquet(again.path).count() == 3
