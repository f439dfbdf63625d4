"""The layouts as data: names by rule, types by rule, pruning."""

from collections import Counter

import pytest
from pyspark.sql import types as T

from fisclake.layouts.tree import CORRUPT, document, group, is_numeric, leaf_paths, many
from fisclake.registry import CANCELLATIONS, DOCUMENTS, EVENTS, ITEMS

ALL = [*DOCUMENTS.values(), *ITEMS.values(), *CANCELLATIONS.values()]


@pytest.mark.parametrize("kind", ALL, ids=lambda kind: f"{kind.name}-{kind.root}")
def test_columns_are_unique_and_have_the_key(kind):
    names = [column.name.lower() for column in kind.layout.columns() + kind.layout.item_columns()]
    repeated = [name for name, n in Counter(names).items() if n > 1]
    assert not repeated
    assert "chave" in names


@pytest.mark.parametrize("kind", ALL, ids=lambda kind: f"{kind.name}-{kind.root}")
def test_every_column_can_be_read_from_the_parse_schema(kind):
    schema = kind.layout.parse_schema()
    for column in kind.layout.columns():
        at = schema
        for name in column.path:
            at = (at.elementType if isinstance(at, T.ArrayType) else at)[name].dataType
    assert CORRUPT in schema.fieldNames()
    assert set(_leaf_types(schema)) == {"string"}


def _leaf_types(kind):
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _leaf_types(f.dataType)
    elif isinstance(kind, T.ArrayType):
        yield from _leaf_types(kind.elementType)
    else:
        yield kind.simpleString()


def test_layout_widths():
    widths = {name: len(kind.layout.columns()) for name, kind in DOCUMENTS.items()}
    assert widths == {
        "NFe": 260,
        "NFCe": 247,
        "CTe": 328,
        "CTeSimp": 125,
        "CTeOS": 184,
        "GVTe": 116,
        "MDFe": 147,
        "BPe": 161,
        "BPeTA": 78,
        "NF3e": 150,
        "NFCom": 160,
    }
    assert len(ITEMS["NFe"].layout.item_columns()) == 522
    assert set(EVENTS) == set(CANCELLATIONS) - {"NFCe"}


@pytest.mark.parametrize(
    ("document_name", "column"),
    [
        ("NFe", "enderDest_CEP"),
        ("NFe", "cobr_fat_nFat"),
        ("NFe", "transp_transporta"),
        ("NFe", "autxml"),
        ("NFCe", "pag_detPag"),
        ("CTe", "toma4_CEP"),
        ("CTe", "gRed_pRedAliq_ibsuf"),
        ("CTeOS", "icms_OutraUFPICMS"),
        ("CTeOS", "icms_UFFimVBCUF"),
        ("MDFe", "infANTT_infPag"),
        ("BPe", "ibscbs_vBC"),
        ("NF3e", "gANEEL_gHistFat"),
        ("NFCom", "ibscbstot_gIBS_vIBS"),
    ],
)
def test_names_that_queries_rely_on(document_name, column):
    names = {c.name.lower() for c in DOCUMENTS[document_name].layout.columns()}
    assert column.lower() in names


@pytest.mark.parametrize("column", ["nItem", "CFOP", "ICMS10_vICMSSTDeson", "PIS_PISST_vPIS", "COFINSOutr_qBCProd", "comb_CIDE_vCIDE",
                                    "gIBSMun_gDif_vDif", "gMonoReten_adRemCBSReten", "impostoDevol_IPI_vIPIDevol", "DI", "NVE"])
def test_item_names(column):
    assert column in {c.name for c in ITEMS["NFe"].layout.item_columns()}


def test_numeric_rule():
    assert is_numeric("prod", "vProd") and is_numeric("ICMS02", "adRemICMS") and is_numeric("vol", "pesoB")
    assert not is_numeric("ide", "verProc") and not is_numeric("vol", "qVol")
    assert not is_numeric("veicProd", "pesoB") and not is_numeric("gGrandFat", "qtdDias")


def test_arrays_and_plain_repeats():
    layout = document(group("a", "b NVE[]", many("c", "vD e"), group("f", "g", prefix="x")))
    columns = {c.name: c.type.simpleString() for c in layout.columns()}
    assert columns == {"a_b": "string", "a_NVE": "array<string>", "a_c": "array<struct<vD:double,e:string>>", "x_g": "string"}


def test_selecting_columns_cuts_the_schema():
    narrow = ITEMS["NFe"].layout.select(["chave", "nItem", "vProd"])
    assert leaf_paths(narrow.parse_schema()) == ["protNFe.infProt.chNFe", "NFe.infNFe.det._nItem", "NFe.infNFe.det.prod.vProd", CORRUPT]
    header = DOCUMENTS["NFe"].layout.select(["pag_detPag"])
    assert [c.name for c in header.columns()] == ["pag_detPag"]


def test_leaf_paths_descend_arrays_of_structs_only(spark):
    schema = T.StructType.fromDDL("a struct<b: array<struct<c: int>>, d: array<string>>, e int")
    assert leaf_paths(schema) == ["a.b.c", "a.d", "e"]


@pytest.mark.parametrize(
    "kind,name,type_",
    [
        ("MDFe", "categCombVeic", "string"),
        ("MDFe", "disp", "array<struct<CNPJForn:string,CNPJPg:string,CPFPg:string,nCompra:double,tpValePed:string,vValePed:string>>"),
        ("CTe", "infdce_chave", "array<string>"),
        ("CTe", "aereo_peri", "array<struct<nONU:string,qTotEmb:string,infTotAP:struct<qTotProd:double,uniAP:string>>>"),
        ("NF3e", "ide_gcompragov_predutor", "string"),
        ("NFCom", "ide_gCompraGov_tpEnteGov", "bigint"),
        ("NFCom", "ide_gCompraGov_tpOperGov", "bigint"),
        ("NFCom", "ide_gCompraGov_pRedutor", "double"),
        *(("NFCom", f"ibscbstot_gibs_{level}_{leaf}", "double") for level, tax in (("gibsmun", "vibsmun"), ("gibsuf", "vibsuf")) for leaf in ("vdevtrib", "vdif", tax)),
    ],
)
def test_names_and_types_of_the_contract(kind, name, type_):
    found = {c.name.lower(): c.type.simpleString() for c in DOCUMENTS[kind].layout.columns()}
    assert found.get(name.lower()) == type_


def test_columns_beyond_the_rule_are_filled(spark):
    """Arrays of one leaf, and numbers that are counted, come out of the XML."""
    from fisclake.operators.parse import parse, project

    mdfe = "<x><MDFe><infMDFe><infModal><rodo><infANTT><valePed><categCombVeic>06</categCombVeic><disp><CNPJForn>1</CNPJForn><nCompra>7</nCompra></disp></valePed></infANTT></rodo></infModal></infMDFe></MDFe></x>"
    cte = "<x><CTe><infCte><infCTeNorm><infDoc><infDCe><chave>a</chave></infDCe><infDCe><chave>b</chave></infDCe></infDoc></infCTeNorm></infCte></CTe></x>"
    nfcom = "<x><NFCom><infNFCom><ide><gCompraGov><tpEnteGov>2</tpEnteGov><pRedutor>1.5</pRedutor></gCompraGov></ide></infNFCom></NFCom></x>"
    for kind, xml, names, expected in (
        ("MDFe", mdfe, ["categCombVeic", "disp"], ("06", [("1", None, None, 7.0, None, None)])),
        ("CTe", cte, ["infDCe_chave"], (["a", "b"],)),
        ("NFCom", nfcom, ["ide_gCompraGov_tpEnteGov", "ide_gCompraGov_pRedutor"], (2, 1.5)),
    ):
        layout = DOCUMENTS[kind].layout
        df = parse(spark.createDataFrame([(xml,)], "xml string"), layout)
        row = project(df, [c for c in layout.columns() if c.name in names]).select(*names).first()
        assert tuple([tuple(x) for x in v] if isinstance(v, list) and v and not isinstance(v[0], str) else v for v in row) == expected
