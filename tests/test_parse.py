"""Edge documents: broken, empty, itemless, with one item, with bad numbers."""

import pytest
from pyspark.sql import functions as F

from fisclake.functions.dates import day_parts, formatted_hour, with_parsed_day
from fisclake.functions.text import clean_xml
from fisclake.operators.parse import documents, items, rejected
from fisclake.registry import CANCELLATIONS, DOCUMENTS, ITEMS, SOURCE_SWITCH, XML
from fisclake.sources.jdbc import split_range

KEY = "53" + "0512" + "0" * 38


def nfe(body: str, key: str = KEY) -> str:
    return (
        f'<nfeProc versao="4.00"><NFe><infNFe Id="N">{body}</infNFe></NFe>'
        f"<protNFe><infProt><chNFe>{key}</chNFe><cStat>100</cStat></infProt></protNFe></nfeProc>"
    )


def item(number: int, value: str = "1.50") -> str:
    return f'<det nItem="{number}"><prod><cProd>P{number}</cProd><vProd>{value}</vProd></prod></det>'


ROWS = [
    (1, nfe(item(1) + item(2))),
    (2, nfe(item(1))),
    (3, nfe("<ide><natOp>x</natOp></ide>")),
    (4, "<nfeProc><NFe>"),
    (5, ""),
    (6, None),
    (7, nfe(item(1, "abc") + item(2, "2.25"))),
    (8, "<nfeProc><NFe/></nfeProc>"),
]


@pytest.fixture(scope="module")
def bronze(spark):
    rows = [(number, text, "05/12/2024 13:14:15", "05/12/2024 00:00:00", "1.1.1.1", "E", "D", "DF", "GO") for number, text in ROWS]
    names = f"n int, {XML} string, DHPROC string, DHEMI string, IP_TRANSMISSOR string, EMITENTE string, DESTINATARIO string, "
    df = spark.createDataFrame(rows, names + "UF_EMITENTE string, UF_DESTINATARIO string")
    return df.withColumn("NSUDF", F.col("n").cast("decimal(38,0)")).withColumn("NSU", F.col("NSUDF")).drop("n")


def test_header_survives_every_edge(bronze):
    rows = {row.NSUDF: row for row in documents(bronze, DOCUMENTS["NFe"]).collect()}
    assert set(rows) == {str(number) for number, _ in ROWS}
    assert rows["1"].chave == KEY and rows["1"].chave_particao == "0512" and rows["1"].versao_xml == "4.00"
    assert rows["1"].DHPROC_FORMATADO == "2024120513"
    assert all(rows[number].chave is None for number in ("4", "5", "6", "8"))
    assert rows["7"].chave == KEY


def test_items_of_every_edge(bronze):
    rows = [(r.NSUDF, r.nItem, r.cProd, r.vProd) for r in items(bronze, ITEMS["NFe"]).orderBy("NSUDF", "nItem").collect()]
    assert rows == [
        ("1", "1", "P1", 1.5),
        ("1", "2", "P2", 1.5),
        ("2", "1", "P1", 1.5),
        ("7", "1", "P1", None),
        ("7", "2", "P2", 2.25),
    ]


def test_narrow_parse_gives_the_same(bronze):
    wide = items(bronze, ITEMS["NFe"]).select("NSUDF", "chave", "nItem", "vProd").collect()
    narrow = items(bronze, ITEMS["NFe"], ["nItem", "vProd"]).select("NSUDF", "chave", "nItem", "vProd").collect()
    assert sorted(map(tuple, wide), key=repr) == sorted(map(tuple, narrow), key=repr)


def test_rejected_documents_keep_their_text(bronze):
    rows = {row.NSUDF: row for row in rejected(bronze, DOCUMENTS["NFe"]).collect()}
    assert {number: row.reason for number, row in rows.items()} == {
        "4": "malformed", "5": "malformed", "6": "malformed", "8": "no key",
    }
    assert rows["4"][XML] == "<nfeProc><NFe>"


def test_ticket_roots_do_not_mix(spark):
    texts = ["<bpeProc><BPe v='1'/></bpeProc>", "<bpeProc><BPeTA v='1'/></bpeProc>", "<bpeProc><BPe></BPe></bpeProc>", None]
    df = spark.createDataFrame([(text,) for text in texts], f"{XML} string")
    assert df.filter(DOCUMENTS["BPe"].route).count() == 2
    assert df.filter(DOCUMENTS["BPeTA"].route).count() == 1


def test_sequence_switch_loses_no_number(spark):
    df = spark.createDataFrame([(SOURCE_SWITCH - 1,), (SOURCE_SWITCH,), (SOURCE_SWITCH + 1,)], "NSU bigint")
    assert df.filter(F.col("NSU") < SOURCE_SWITCH).count() == 1
    assert df.filter(F.col("NSU") >= SOURCE_SWITCH).count() == 2


def test_event_without_reply_has_no_key_except_in_transport(spark):
    nfe_event = f"<procEventoNFe><evento><infEvento><chNFe>{KEY}</chNFe></infEvento></evento></procEventoNFe>"
    cte_event = f"<procEventoCTe><eventoCTe><infEvento><chCTe>{KEY}</chCTe></infEvento></eventoCTe></procEventoCTe>"
    row = ("1", "05/12/2024 13:14:15", "05/12/2024 13:14:15", "ip")
    for name, text, expected in (("NFe", nfe_event, None), ("CTe", cte_event, KEY)):
        kind = CANCELLATIONS[name]
        df = spark.createDataFrame([(text, *row)], f"{XML} string, {kind.sequence} string, DHPROC string, DHEVENTO string, IP_TRANSMISSOR string")
        assert documents(df, kind).first().chave == expected


def test_times(spark):
    df = spark.createDataFrame([("05/12/2024 13:14:15",), ("bad",), (None,), ("31/02/2024 00:00:00",)], "DHPROC string")
    assert df.select(formatted_hour()).first()[0] == "2024120513"
    assert [tuple(r) for r in with_parsed_day(df).select("year", "month", "day").collect()] == [("2024", "12", "05")]
    by_position = df.select(*(c.alias(n) for n, c in day_parts().items())).collect()
    assert tuple(by_position[0]) == ("2024", "12", "05") and tuple(by_position[3]) == ("2024", "02", "31")


def test_clean_xml(spark):
    df = spark.createDataFrame([("a\r\nb<!-- x\ny -->c",), ("<p><b x='1'>in</b></p>",)], "t string")
    assert df.select(clean_xml("t")).first()[0] == "a  bc"
    assert [r[0] for r in df.select(clean_xml("t", ["z", "b"])).collect()] == [None, "<b x='1'>in</b>"]


@pytest.mark.parametrize(
    ("lower", "upper", "n", "expected"),
    [(None, None, 20, None), (5, 5, 20, (5, 5, 1)), (1, 4, 20, (1, 4, 3)), (0, 1000, 20, (0, 1000, 20))],
)
def test_split_range(lower, upper, n, expected):
    result = split_range(lower, upper, n)
    assert (result and (result.lower, result.upper, result.partitions)) == expected
