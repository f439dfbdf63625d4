"""Fiscal documents built from the test tables: one order is one document.

Everything about a document comes from its own row of ``orders``: no shuffle, no group that could grow with the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.dates import SOURCE_FORMAT
from fisclake.layouts.tree import OutputColumn
from fisclake.registry import DOCUMENTS, EVENTS, XML

# Where each kind keeps its answer, its body and its value.
ANSWER = {
    "NFe": ("protNFe", "chNFe"),
    "NFCe": ("protNFe", "chNFe"),
    "CTe": ("protCTe", "chCTe"),
    "CTeSimp": ("protCTe", "chCTe"),
    "CTeOS": ("protCTe", "chCTe"),
    "GVTe": ("protCTe", "chCTe"),
    "MDFe": ("protMDFe", "chMDFe"),
    "BPe": ("protBPe", "chBPe"),
    "BPeTA": ("protBPe", "chBPe"),
    "NF3e": ("protNF3e", "chNF3e"),
    "NFCom": ("protNFCom", "chNFCom"),
}
BODY = {
    "NFe": "NFe.infNFe",
    "NFCe": "NFe.infNFe",
    "CTe": "CTe.infCte",
    "CTeSimp": "CTeSimp.infCte",
    "CTeOS": "CTeOS.infCte",
    "GVTe": "GTVe.infCte",
    "MDFe": "MDFe.infMDFe",
    "BPe": "BPe.infBPe",
    "BPeTA": "BPeTA.infBPe",
    "NF3e": "NF3e.infNF3e",
    "NFCom": "NFCom.infNFCom",
}
VALUE = {
    "NFe": "total.ICMSTot.vNF",
    "NFCe": "total.ICMSTot.vNF",
    "CTe": "vPrest.vTPrest",
    "CTeSimp": "total.vTPrest",
    "CTeOS": "vPrest.vTPrest",
    "GVTe": "detGTV.qCarga",
    "MDFe": "tot.vCarga",
    "BPe": "infValorBPe.vBP",
    "BPeTA": "infValorBPe.vBP",
    "NF3e": "total.vNF",
    "NFCom": "total.vNF",
}
EVENT = {
    "NFe": ("evento", "retEvento", "chNFe"),
    "NFCe": ("", "retEvento", "chNFe"),
    "CTe": ("eventoCTe", "retEventoCTe", "chCTe"),
    "MDFe": ("eventoMDFe", "retEventoMDFe", "chMDFe"),
    "BPe": ("eventoBPe", "retEventoBPe", "chBPe"),
    "NF3e": ("eventoNF3e", "retEventoNF3e", "chNF3e"),
    "NFCom": ("eventoNFCom", "retEventoNFCom", "chNFCom"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A document takes up to some tenths of a millisecond to write and parse: a task of this many takes a minute at most.
ORDERS_PER_TASK = 100_000


def document_tasks(orders: DataFrame) -> int:
    return max(orders.sparkSession.sparkContext.defaultParallelism, -(-orders.count() // ORDERS_PER_TASK))  # counted in the footers


def orders_for_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, spread over tasks whose number grows with the rows where the file has fewer splits: a short row becomes a long document."""
    orders = table(spark, sf_dir, "orders")
    tasks = document_tasks(orders)
    return orders if orders.rdd.getNumPartitions() >= tasks else orders.repartition(tasks, "o_orderkey")


def orders_with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, each joined with the ``status`` of its key; documents made of them have it beside their text, which no join needs to move."""
    orders = table(spark, sf_dir, "orders")
    status = orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    return orders.join(status, "o_orderkey").repartition(document_tasks(orders), "o_orderkey")


@dataclass(frozen=True)
class Detail:
    """A leaf that the documents of one group have; ``text`` holds ``{k}`` and ``{v}`` for the order's key and its number."""

    group: int
    groups: int
    text: str

    @property
    def present(self) -> Column:
        return F.col("o_orderkey") % self.groups == self.group


# What an element holds: a constant, a value, one of the details, children (if a condition holds), or several of these.
Content = str | Column | Detail | dict | tuple | list


def nested(fields: Mapping[str, Content]) -> dict[str, Content]:
    """Values under dotted paths as nested elements."""
    heads: dict[str, Content] = {}
    for path, value in fields.items():
        head, _, rest = path.partition(".")
        if rest:
            heads.setdefault(head, {})[rest] = value
        else:
            heads[head] = value
    return {name: nested(value) if isinstance(value, dict) else value for name, value in heads.items()}


def _parts(name: str, content: Content) -> list[str | Column | Detail]:
    """An element's text in parts, of which those that are NULL don't appear, as in ``to_xml``."""
    if isinstance(content, list):
        return [part for one in content for part in _parts(name, one)]
    if isinstance(content, tuple):
        condition, children = content
        return [F.when(condition, _joined(_parts(name, children)))]
    if isinstance(content, str):
        return [f"<{name}>{content}</{name}>"]
    if isinstance(content, Detail):
        return [replace(content, text=f"<{name}>{content.text}</{name}>")]
    if isinstance(content, Column):
        return [F.concat(F.lit(f"<{name}>"), content, F.lit(f"</{name}>"))]
    content = nested(content)
    head: list[str | Column | Detail] = [f"<{name}"]
    for attribute, value in content.items():
        if attribute.startswith("_"):
            plain = isinstance(value, str)
            head.append(f' {attribute[1:]}="{value}"' if plain else F.concat(F.lit(f' {attribute[1:]}="'), value, F.lit('"')))
    children = {child: value for child, value in content.items() if not child.startswith("_")}
    full = [*head, ">", *(part for child, value in children.items() for part in _parts(child, value)), f"</{name}>"]
    if not children:
        return [*head, "/>"]
    if not all(isinstance(value, Column | Detail) for value in children.values()):
        return full  # a child that is always there
    tests = {str(value.group) if isinstance(value, Detail) else child: value.present if isinstance(value, Detail) else value.isNotNull()
             for child, value in children.items()}
    return [F.when(reduce(Column.__or__, tests.values()), _joined(full)).otherwise(_joined([*head, "/>"]))]


def _joined(parts: list[str | Column | Detail]) -> Column:
    """One text; neighbours that are constant, or details of one group, are one part."""
    merged: list[str | Column | Detail] = []
    for part in parts:
        last = merged[-1] if merged else None
        if isinstance(part, str) and isinstance(last, str):
            merged[-1] = last + part
        elif isinstance(part, Detail) and isinstance(last, Detail) and part.group == last.group:
            merged[-1] = replace(last, text=last.text + part.text)
        else:
            merged.append(part)
    columns = []
    for part in merged:
        if isinstance(part, Detail):
            text = F.lit(part.text)
            for mark, value in (("{k}", F.col("o_orderkey")), ("{v}", F.col("o_orderkey") % 1000 + 0.5)):
                text = F.replace(text, F.lit(mark), value.cast("string")) if mark in part.text else text
            part = F.when(part.present, text)
        columns.append(F.lit(part) if isinstance(part, str) else part)
    return F.concat_ws("", *columns)


def escaped(value: Column) -> Column:
    """A text as it stands in an element; Spark's writer is asked only where there may be something to escape."""
    written = F.to_xml(F.struct(value.alias("t")), {"rowTag": "r", "indent": "", "declaration": ""})
    return F.when(value.rlike("[^0-9A-Za-z]"), F.regexp_extract(written, r"(?s)^<r><t>(.*)</t></r>\n$", 1)).otherwise(value)


def xml(fields: Mapping[str, Content], root: str) -> Column:
    """The document that ``to_xml`` gives for these fields, joined from texts: its writer, which looks at every field of every row, takes several times as long.

    Values are taken as they are; what may hold markup must be ``escaped``.
    """
    return _joined([*_parts(root, dict(fields)), "\n"])


def money(value: Column) -> Column:
    return F.format_string("%.2f", value)


def exact_sum(column: str) -> Column:
    """Sum of amounts in cents: the order of addition does not show in the result."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def access_key() -> Column:
    return F.concat(F.lit("53"), F.date_format("o_orderdate", "yyMM"), F.lpad(F.col("o_orderkey").cast("string"), 38, "0"))


def processed_at() -> Column:
    """Order dates have no time of day; spread them over it."""
    minutes = F.col("o_orderkey") % 24 * 60 + F.col("o_custkey") % 60
    return F.col("o_orderdate") + F.make_dt_interval(mins=minutes.cast("int"))


def item_count() -> Column:
    """0 to 4 items; every fifth document has none."""
    return (F.col("o_orderkey") % 5).cast("int")


def line_items() -> list[tuple[Column, dict[str, Content]]]:
    def item(number: int) -> dict[str, Content]:
        value = money(F.col("o_totalprice") * number)
        return {
            "_nItem": str(number),
            "prod.cProd": (F.col("o_custkey") + number).cast("string"),
            "prod.CFOP": "5102",
            "prod.qCom": str(number),
            "prod.vUnCom": money(F.col("o_totalprice")),
            "prod.vProd": value,
            "imposto.ICMS.ICMS00.CST": "00",
            "imposto.ICMS.ICMS00.vBC": value,
        }

    return [(item_count() >= number, item(number)) for number in range(1, 5)]


def body(name: str) -> dict[str, Content]:
    """The XML of one kind of document, as paths and values."""
    answer, key = ANSWER[name]
    at = BODY[name]
    fields = {
        f"{answer}.infProt.{key}": F.col("CHAVE"),
        f"{answer}.infProt.cStat": "100",
        f"{answer}.infProt.dhRecbto": F.col("DHPROC"),
        f"{at}._Id": F.concat(F.lit("Id"), "CHAVE"),
        f"{at}.ide.dhEmi": F.col("DHEMI"),
        f"{at}.ide.serie": escaped(F.col("o_orderstatus")),
        f"{at}.{VALUE[name]}": money(F.col("o_totalprice")),
    }
    if name in ("NFe", "NFCe"):
        fields |= {
            f"{at}.emit.CNPJ": F.col("EMITENTE"),
            f"{at}.dest.CNPJ": F.col("DESTINATARIO"),
            f"{at}.dest.enderDest.UF": F.col("UF_DESTINATARIO"),
            f"{at}.det": line_items(),
            f"{at}.pag.detPag": [{"tPag": "01", "vPag": money(F.col("o_totalprice"))}, {"tPag": "03", "vPag": "1.50"}],
        }
    return fields


def _base(orders: DataFrame) -> DataFrame:
    """Bronze columns without the XML, next to the order they come from."""
    stamp = F.date_format(processed_at(), SOURCE_FORMAT)
    customer = F.col("o_custkey")
    return orders.select(
        "*",
        access_key().alias("CHAVE"),
        F.lit(100).alias("CSTAT"),
        F.concat(F.lit("10.0.0."), (customer % 250).cast("string")).alias("IP_TRANSMISSOR"),
        F.date_format("o_orderdate", SOURCE_FORMAT).alias("DHEMI"),
        stamp.alias("DHRECBTO"),
        stamp.alias("DHPROC"),
        F.lpad((customer % 100).cast("string"), 14, "0").alias("EMITENTE"),
        F.lit("DF").alias("UF_EMITENTE"),
        F.lpad(customer.cast("string"), 14, "0").alias("DESTINATARIO"),
        F.element_at(F.array(*map(F.lit, ("DF", "GO", "SP"))), (customer % 3 + 1).cast("int")).alias("UF_DESTINATARIO"),
        F.element_at(F.array(*map(F.lit, (57, 67, 64))), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("MODELO"),
        F.lit(1).alias("TPEMIS"),
    )


def _text(family: str) -> Column:
    """A family's documents; families with several kinds mix them as their source does."""
    kinds = {name: xml(body(name), kind.root) for name, kind in DOCUMENTS.items() if kind.family == family}
    if family == "cte":
        simplified = F.col("o_orderkey") % 6 >= 3
        return (
            F.when(F.col("MODELO") == 67, kinds["CTeOS"])
            .when(F.col("MODELO") == 64, kinds["GVTe"])
            .when(simplified, kinds["CTeSimp"])
            .otherwise(kinds["CTe"])
        )
    if family == "bpe":
        return F.when(F.col("o_orderkey") % 4 == 3, kinds["BPeTA"]).otherwise(kinds["BPe"])
    return next(iter(kinds.values()))


def sequence_of(family: str) -> str:
    return next(kind.sequence for kind in DOCUMENTS.values() if kind.family == family)


def bronze(spark: SparkSession, sf_dir: str, family: str = "nfe", orders: DataFrame | None = None) -> DataFrame:
    """Bronze documents of one family, one per order of the table or of ``orders``."""
    base = _base(orders_for_documents(spark, sf_dir) if orders is None else orders)
    return base.select(
        F.col("o_orderkey").cast("decimal(38,0)").alias(sequence_of(family)),
        _text(family).alias(XML),
        *(name for name in base.columns if not name.startswith("o_")),
    )


def event_details(name: str) -> list[tuple[OutputColumn, int, int]]:
    """The plain columns below ``detEvento`` of a family's events, each with the number of its group and the number of groups: a
    document has one of them (a correction, a manifestation, a change of seat, ...)."""
    columns = [
        c for c in EVENTS[name].layout.columns()
        if "detEvento" in c.path[:-1] and not c.path[-1].startswith("_") and c.type.simpleString() in ("string", "double")
    ]
    groups = sorted({c.path[: c.path.index("detEvento") + 2] if len(c.path) > c.path.index("detEvento") + 2 else () for c in columns})
    own = [groups.index(c.path[: c.path.index("detEvento") + 2] if len(c.path) > c.path.index("detEvento") + 2 else ()) for c in columns]
    return [(c, g, len(groups)) for c, g in zip(columns, own, strict=True)]


def bronze_events(spark: SparkSession, sf_dir: str, family: str = "nfe", cancelled: bool = True, orders: DataFrame | None = None) -> DataFrame:
    """Bronze cancellations, or other events, one per order; those of pending orders (status P) have no reply yet."""
    name = next(name for name, kind in DOCUMENTS.items() if kind.family == family)
    request, answer, key = EVENT[name]
    at = f"{request}.infEvento" if request else "infEvento"
    answered = F.col("o_orderstatus") != "P"
    reply = (answered, {f"infEvento.{key}": F.col("CHAVE"), "infEvento.cStat": "135", "infEvento.nSeqEvento": "1"})
    code = "110111" if cancelled else "110110"
    fields = {
        f"{at}._Id": F.concat(F.lit(f"ID{code}"), "CHAVE"),
        f"{at}.{key}": F.col("CHAVE"),
        f"{at}.tpEvento": code,
        f"{at}.detEvento._{'versao' if family in ('nfe', 'nfce') else 'versaoEvento'}": "1.00",
        answer: reply,
    }
    for column, group, groups in () if cancelled else event_details(name):
        number = column.type.simpleString() == "double"
        fields[".".join(column.path)] = Detail(group, groups, "{v}" if number else f"{column.path[-1]}-{{k}}")
    base = _base(orders_for_documents(spark, sf_dir) if orders is None else orders)
    return base.select(
        F.col("o_orderkey").cast("decimal(38,0)").alias(sequence_of(family)),
        xml(fields, f"procEvento{'NFe' if family == 'nfce' else name}").alias(XML),
        *(name for name in base.columns if not name.startswith("o_")),
        F.col("DHPROC").alias("DHEVENTO"),
        F.lit(1).alias("SEQ_EVENTO"),
        F.lit(code).alias("TP_EVENTO"),
    )


# The same documents in SQL. Timestamps as strings, because that is what the source delivers.
ORDERS_SQL = """
orders_x AS (
  SELECT *,
         '53' || strftime(o_orderdate, '%y%m') || lpad(CAST(o_orderkey AS VARCHAR), 38, '0') AS chave,
         o_orderdate + to_minutes(CAST(o_orderkey % 24 * 60 + o_custkey % 60 AS BIGINT)) AS proc,
         strftime(o_orderdate, '%d/%m/%Y %H:%M:%S') AS dhemi,
         '10.0.0.' || CAST(o_custkey % 250 AS VARCHAR) AS ip,
         CASE o_orderkey % 3 WHEN 0 THEN 57 WHEN 1 THEN 67 ELSE 64 END AS modelo,
         CASE WHEN o_orderkey % 4 = 3 THEN 'BPeTA' ELSE 'BPe' END AS bpe_kind,
         CASE o_orderkey % 3 WHEN 1 THEN 'CTeOS' WHEN 2 THEN 'GVTe'
              ELSE CASE WHEN o_orderkey % 6 >= 3 THEN 'CTeSimp' ELSE 'CTe' END END AS cte_kind
  FROM orders)
"""
ITEMS_SQL = (
    ORDERS_SQL
    + """,
items_x AS (
  SELECT o.*, i.n AS nitem, round(o.o_totalprice * i.n, 2) AS vprod
  FROM orders_x o CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS n) i
  WHERE i.n <= o.o_orderkey % 5)
"""
)
