"""Parsing, routing, projection and the load of every document type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.dates import (
    day_parts,
    formatted_hour,
    hour_parts,
    timestamp,
    with_parsed_day,
    within_day,
    within_hour,
)
from fisclake.functions.keys import partition_key
from fisclake.functions.text import clean_xml
from fisclake.operators.parse import documents, items, parse, rejected, route, select_bronze, unrouted
from fisclake.registry import CANCELLATIONS, DOCUMENTS, EVENTS, ITEMS, SOURCE_SWITCH, XML
from workload.register import Register
from workload.documents import ANSWER, BODY, EVENT, ITEMS_SQL, ORDERS_SQL, VALUE, bronze, bronze_events, event_details, table

query = Register()
QUERIES, SQL = query.queries, query.sql


def value_column(name: str) -> str:
    """Output column of a document type that holds the value the generator wrote."""
    path = (*BODY[name].split("."), *VALUE[name].split("."))
    return next(column.name for column in DOCUMENTS[name].layout.columns() if column.path == path)


def _status_column(name: str) -> str:
    path = (ANSWER[name][0], "infProt", "cStat")
    return next(column.name for column in DOCUMENTS[name].layout.columns() if column.path == path)


def _document_load(name: str):
    kind = DOCUMENTS[name]

    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = documents(bronze(spark, sf_dir, kind.family), kind)
        return silver.select(
            F.col(kind.sequence).alias("nsu"),
            F.col("DHPROC_FORMATADO").alias("dhproc_formatado"),
            F.col("IP_TRANSMISSOR").alias("ip"),
            "chave",
            "chave_particao",
            F.col(_status_column(name)).alias("cstat"),
            F.round(value_column(name), 2).alias("valor"),
        )

    kind_filter = {"cte": f"WHERE cte_kind = '{name}'", "bpe": f"WHERE bpe_kind = '{name}'"}.get(kind.family, "")
    sql = f"""WITH {ORDERS_SQL}
        SELECT CAST(o_orderkey AS VARCHAR) AS nsu, strftime(proc, '%Y%m%d%H') AS dhproc_formatado, ip, chave,
               substr(chave, 3, 4) AS chave_particao, '100' AS cstat, round(o_totalprice, 2) AS valor
        FROM orders_x {kind_filter}"""
    QUERIES[f"document_load_{name}"] = load
    SQL[f"document_load_{name}"] = sql


def _event_load(name: str, cancelled: bool):
    prefix, kind = ("cancel_load", CANCELLATIONS[name]) if cancelled else ("event_load", EVENTS[name])
    answer = EVENT[name][1]
    details = [] if cancelled else event_details(name)

    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = documents(bronze_events(spark, sf_dir, kind.family, cancelled), kind)
        status = next(c.name for c in kind.layout.columns() if c.path == (answer, "infEvento", "cStat"))
        return silver.select(
            F.col(kind.sequence).alias("nsu"),
            F.col("DHPROC_FORMATADO").alias("dhproc_formatado"),
            "DHEVENTO",
            "chave",
            "chave_particao",
            F.col("infEvento_tpEvento").alias("tpevento"),
            F.col(status).alias("cstat"),
            *(F.col(column.name).alias(f"det_{n}") for n, (column, _, _) in enumerate(details)),
        )

    def detail(n: int) -> str:
        column, group, groups = details[n]
        value = "o_orderkey % 1000 + 0.5" if column.type.simpleString() == "double" else f"'{column.path[-1]}-' || o_orderkey"
        value = f"CAST({value} AS DOUBLE)" if column.type.simpleString() == "double" else value
        return f", CASE WHEN o_orderkey % {groups} = {group} THEN {value} END AS det_{n}"

    # The key comes from the reply, and pending orders have none; transport takes it from the request.
    key = "chave" if name == "CTe" else "CASE WHEN o_orderstatus <> 'P' THEN chave END"
    QUERIES[f"{prefix}_{kind.family}"] = load
    SQL[f"{prefix}_{kind.family}"] = f"""WITH {ORDERS_SQL}
        SELECT CAST(o_orderkey AS VARCHAR) AS nsu, strftime(proc, '%Y%m%d%H') AS dhproc_formatado,
               strftime(proc, '%d/%m/%Y %H:%M:%S') AS "DHEVENTO", {key} AS chave, substr({key}, 3, 4) AS chave_particao,
               '{"110111" if cancelled else "110110"}' AS tpevento, CASE WHEN o_orderstatus <> 'P' THEN '135' END AS cstat
               {"".join(map(detail, range(len(details))))}
        FROM orders_x"""


def _det_load(name: str):
    kind = ITEMS[name]

    def load(spark: SparkSession, sf_dir: str) -> DataFrame:
        silver = items(bronze(spark, sf_dir, kind.family), kind)
        return silver.select(
            F.col(kind.sequence).alias("nsu"),
            "chave",
            "chave_particao",
            F.col("nItem").cast("int").alias("nitem"),
            F.col("cProd").alias("cprod"),
            F.round("qCom", 4).alias("qcom"),
            F.round("vProd", 2).alias("vprod"),
            F.col("ICMS00_CST").alias("icms_cst"),
            F.round("ICMS00_vBC", 2).alias("icms_vbc"),
        )

    QUERIES[f"det_load_{kind.family}"] = load
    SQL[f"det_load_{kind.family}"] = f"""WITH {ITEMS_SQL}
        SELECT CAST(o_orderkey AS VARCHAR) AS nsu, chave, substr(chave, 3, 4) AS chave_particao, nitem,
               CAST(o_custkey + nitem AS VARCHAR) AS cprod, CAST(nitem AS DOUBLE) AS qcom, vprod, '00' AS icms_cst,
               vprod AS icms_vbc
        FROM items_x"""


for _name in DOCUMENTS:
    _document_load(_name)
for _name in EVENTS:
    _event_load(_name, cancelled=False)
for _name in CANCELLATIONS:
    _event_load(_name, cancelled=True)
for _name in ITEMS:
    _det_load(_name)


@query(
    f"""WITH {ITEMS_SQL}
    SELECT substr(chave, 3, 4) AS chave_particao, count(DISTINCT o_orderkey) AS documentos, count(*) AS itens,
           CAST(sum(CAST(vprod AS DECIMAL(18, 2))) AS DOUBLE) AS valor
    FROM items_x GROUP BY 1"""
)
def items_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: XML to items, parsed for just the columns needed, per year-month."""
    silver = items(bronze(spark, sf_dir, "nfe"), ITEMS["NFe"], columns=["nItem", "vProd"])
    per_document = silver.groupBy("chave_particao", "chave").agg(F.count("*").alias("n"), F.sum(F.col("vProd").cast("decimal(18,2)")).alias("v"))
    return per_document.groupBy("chave_particao").agg(
        F.count("*").alias("documentos"), F.sum("n").alias("itens"), F.sum("v").cast("double").alias("valor")
    )


@query(
    f"""WITH {ORDERS_SQL}
    SELECT chave, 'DF' AS uf_emitente, CAST(o_totalprice AS DOUBLE) AS vnf FROM orders_x"""
)
def xml_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = DOCUMENTS["NFe"]
    parsed = parse(select_bronze(bronze(spark, sf_dir, "nfe"), kind), kind.layout)
    return parsed.select(
        F.col("parsed.protNFe.infProt.chNFe").alias("chave"),
        F.lit("DF").alias("uf_emitente"),
        F.col("parsed.NFe.infNFe.total.ICMSTot.vNF").try_cast("double").alias("vnf"),
    )


@query(
    f"""WITH {ORDERS_SQL}
    SELECT chave, 'Id' || chave AS infnfe_id, dhemi AS ide_dhemi, o_orderstatus AS ide_serie,
           lpad(CAST(o_custkey % 100 AS VARCHAR), 14, '0') AS emit_cnpj, lpad(CAST(o_custkey AS VARCHAR), 14, '0') AS dest_cnpj,
           CASE o_custkey % 3 WHEN 0 THEN 'DF' WHEN 1 THEN 'GO' ELSE 'SP' END AS enderdest_uf,
           CAST(NULL AS VARCHAR) AS dest_cpf, o_totalprice AS icmstot_vnf
    FROM orders_x"""
)
def header_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = "chave infNFe_Id ide_dhEmi ide_serie emit_CNPJ dest_CNPJ enderDest_UF dest_CPF ICMSTot_vNF".split()
    return documents(bronze(spark, sf_dir, "nfe"), DOCUMENTS["NFe"], names).select(*(F.col(n).alias(n.lower()) for n in names))


@query(
    f"""WITH {ORDERS_SQL}
    SELECT chave, CAST(2 AS INTEGER) AS pagamentos, '01,03' AS formas, round(o_totalprice + 1.5, 2) AS pago FROM orders_x"""
)
def header_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = documents(bronze(spark, sf_dir, "nfe"), DOCUMENTS["NFe"], ["pag_detPag"])
    paid = F.aggregate("pag_detPag", F.lit(0.0), lambda total, p: total + p.vPag)
    return silver.select(
        "chave",
        F.size("pag_detPag").alias("pagamentos"),
        F.concat_ws(",", "pag_detPag.tPag").alias("formas"),
        F.round(paid, 2).alias("pago"),
    )


@query(
    f"""WITH {ORDERS_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS "NSUSVD", strftime(proc, '%Y%m%d%H') AS "DHPROC_FORMATADO", dhemi AS "DHEMI",
           ip AS "IP_TRANSMISSOR", CAST(modelo AS VARCHAR) AS "MODELO", '1' AS "TPEMIS" FROM orders_x"""
)
def bronze_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_bronze(bronze(spark, sf_dir, "cte"), DOCUMENTS["CTe"]).drop("xml")


@query(
    f"""WITH {ORDERS_SQL}
    SELECT chave, strftime(proc, '%Y%m%d%H') AS dhproc_formatado, strftime(proc, '%Y') AS ano FROM orders_x"""
)
def dhproc_formatado(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = bronze(spark, sf_dir, "nfe").select(F.col("CHAVE").alias("chave"), formatted_hour().alias("dhproc_formatado"))
    return stamped.withColumn("ano", F.substring("dhproc_formatado", 1, 4))


@query(f"""WITH {ORDERS_SQL} SELECT substr(chave, 3, 4) AS chave_particao, count(*) AS documentos FROM orders_x GROUP BY 1""", name="partition_key")
def partition_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = bronze(spark, sf_dir, "nfe").select(partition_key("CHAVE").alias("chave_particao"))
    return keyed.groupBy("chave_particao").agg(F.count("*").alias("documentos"))


@query(
    f"""WITH {ORDERS_SQL}
    SELECT strftime(proc, '%Y') AS year, strftime(proc, '%m') AS month, strftime(proc, '%d') AS day, count(*) AS documentos
    FROM orders_x GROUP BY 1, 2, 3"""
)
def dhproc_ymd_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = bronze(spark, sf_dir, "nfe").select(*(part.alias(name) for name, part in day_parts().items()))
    return dated.groupBy("year", "month", "day").agg(F.count("*").alias("documentos"))


@query(
    f"""WITH {ORDERS_SQL}
    SELECT strftime(proc, '%Y') AS year, strftime(proc, '%m') AS month, strftime(proc, '%d') AS day, count(*) AS documentos
    FROM orders_x WHERE o_orderstatus <> 'P' GROUP BY 1, 2, 3"""
)
def dhproc_ymd_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders get a time that does not parse; those rows are dropped."""
    stamps = bronze(spark, sf_dir, "nfe").join(
        table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("decimal(38,0)").alias("NSUDF"), "o_orderstatus"), "NSUDF"
    )
    stamps = stamps.select(F.when(F.col("o_orderstatus") == "P", "31/02/x").otherwise(F.col("DHPROC")).alias("DHPROC"))
    return with_parsed_day(stamps).groupBy("year", "month", "day").agg(F.count("*").alias("documentos"))


@query(
    """SELECT strftime(ts, '%Y') AS ano, strftime(ts, '%m') AS mes, strftime(ts, '%d') AS dia, strftime(ts, '%H') AS hora,
              count(*) AS documentos FROM events GROUP BY ALL"""
)
def hour_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = table(spark, sf_dir, "events").select(*(part.alias(name) for name, part in hour_parts("ts").items()))
    return hours.groupBy("ano", "mes", "dia", "hora").agg(F.count("*").alias("documentos"))


@query("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def window_extract_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(within_day("ts", "2024-01-10")).select("event_id", "value")


@query("SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10 07:00:00' AND ts < TIMESTAMP '2024-01-10 08:00:00'")
def window_extract_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(within_hour("ts", "2024-01-10 07:00:00")).select("event_id", "value")


@query(
    """SELECT page_id, replace(replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), chr(13), ' '), chr(10), ' ') AS cleaned
       FROM pages"""
)
def xml_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", clean_xml("html").alias("cleaned"))


@query(
    """WITH cleaned AS (
         SELECT page_id, replace(replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), chr(13), ' '), chr(10), ' ') AS h FROM pages)
       SELECT page_id, coalesce(nullif(regexp_extract(h, '<article[\\s>].*</article>', 0, 's'), ''),
                                nullif(regexp_extract(h, '<body[\\s>].*</body>', 0, 's'), '')) AS root
       FROM cleaned"""
)
def xml_first_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source tries several root elements in turn and keeps the first that is there."""
    return table(spark, sf_dir, "pages").select("page_id", clean_xml("html", ["article", "body"]).alias("root"))


def _routed(spark: SparkSession, sf_dir: str, family: str, names: list[str]) -> DataFrame:
    batch = bronze(spark, sf_dir, family)
    result = None
    for name in names:
        rows = route(batch, DOCUMENTS[name]).select(F.lit(name).alias("tipo"), F.col("CHAVE").alias("chave"))
        result = rows if result is None else result.unionByName(rows)
    return result


@query(f"""WITH {ORDERS_SQL} SELECT cte_kind AS tipo, chave FROM orders_x""")
def route_modelo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir, "cte", ["CTe", "CTeSimp", "CTeOS", "GVTe"])


@query(f"""WITH {ORDERS_SQL} SELECT bpe_kind AS tipo, chave FROM orders_x""")
def route_root_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir, "bpe", ["BPe", "BPeTA"])


@query(f"""WITH {ORDERS_SQL} SELECT bpe_kind AS tipo, chave FROM orders_x""")
def route_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The back-load's form: everything that holds one tag, and everything else that does not."""
    batch = bronze(spark, sf_dir, "bpe")
    air = F.col(XML).contains("<BPeTA")
    plain = F.col(XML).isNotNull() & F.col(XML).rlike(r"<BPe[\s>]") & ~F.col(XML).rlike(r"<BPeTA[\s>]")
    kinds = [("BPeTA", air), ("BPe", plain)]
    parts = [batch.filter(test).select(F.lit(name).alias("tipo"), F.col("CHAVE").alias("chave")) for name, test in kinds]
    return parts[0].unionByName(parts[1])


@query(f"""WITH {ORDERS_SQL} SELECT chave FROM orders_x WHERE modelo = 57 AND o_orderstatus = 'P'""")
def route_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending model-57 documents come with a root that no kind knows."""
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("decimal(38,0)").alias("NSUSVD"), "o_orderstatus")
    renamed = F.when(F.col("o_orderstatus") == "P", F.regexp_replace(XML, "<(/?)cte(Simp)?Proc", "<$1outroProc")).otherwise(F.col(XML))
    batch = bronze(spark, sf_dir, "cte").join(status, "NSUSVD").withColumn(XML, renamed)
    kinds = [kind for kind in DOCUMENTS.values() if kind.family == "cte"]
    return unrouted(batch, kinds).select(F.col("CHAVE").alias("chave"))


@query(
    """SELECT o_orderkey AS nsu, CASE WHEN o_orderkey * 200000 < 1000000000 THEN 'old' ELSE 'new' END AS fonte FROM orders"""
)
def route_nsu_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the switch; the number exactly at the switch belongs to the new source."""
    numbered = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") * 200000).alias("NSU"))
    old = numbered.filter(F.col("NSU") < SOURCE_SWITCH).select(F.col("o_orderkey").alias("nsu"), F.lit("old").alias("fonte"))
    new = numbered.filter(F.col("NSU") >= SOURCE_SWITCH).select(F.col("o_orderkey").alias("nsu"), F.lit("new").alias("fonte"))
    return old.unionByName(new)


@query(f"""WITH {ITEMS_SQL} SELECT chave, CAST(nitem AS VARCHAR) AS nitem, vprod FROM items_x""")
def det_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = items(bronze(spark, sf_dir, "nfe"), ITEMS["NFe"], ["nItem", "vProd"])
    return silver.select("chave", F.col("nItem").alias("nitem"), F.round("vProd", 2).alias("vprod"))


@query(
    f"""WITH {ORDERS_SQL}
    SELECT CAST(o_orderkey AS VARCHAR) AS nsu, CASE o_orderstatus WHEN 'P' THEN 'malformed' ELSE 'no key' END AS reason
    FROM orders_x WHERE o_orderstatus <> 'F'"""
)
def load_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken documents: those of pending orders are cut off, those of open ones lose their answer."""
    status = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("decimal(38,0)").alias("NSUDF"), "o_orderstatus")
    batch = bronze(spark, sf_dir, "nfe").join(status, "NSUDF")
    broken = (
        F.when(F.col("o_orderstatus") == "P", F.expr(f"left({XML}, 300)"))
        .when(F.col("o_orderstatus") == "O", F.regexp_replace(XML, r"(?s)<protNFe>.*</protNFe>", ""))
        .otherwise(F.col(XML))
    )
    found = rejected(batch.withColumn(XML, broken), DOCUMENTS["NFe"])
    return found.select(F.col("NSUDF").alias("nsu"), "reason")


@query(
    """SELECT o_orderkey,
              substr(o_orderpriority, 1, 1) || '-' || lower(o_orderstatus) AS juntado,
              o_orderpriority LIKE '%URGENT%' AS urgente,
              regexp_matches(o_orderpriority, '^[12]-') AS alta,
              strftime(o_orderdate, '%d/%m/%Y') AS dia,
              CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
              CAST(day(o_orderdate) AS INTEGER) AS dia_do_mes,
              round(o_totalprice, 0) AS arredondado, CAST(ceil(o_totalprice / 256) AS BIGINT) AS teto,
              o_custkey - o_orderkey AS diferenca,
              CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS preenchido,
              CAST(o_custkey AS VARCHAR) AS texto, 1 AS um
       FROM orders"""
)
def scalar_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar functions the jobs use, together."""
    orders = table(spark, sf_dir, "orders")
    stamp = F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss")
    filled = orders.withColumn("preenchido", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))).na.fill(0, ["preenchido"])
    time = timestamp(stamp)
    return filled.select(
        "o_orderkey",
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit("-"), F.lower("o_orderstatus")).alias("juntado"),
        F.col("o_orderpriority").contains("URGENT").alias("urgente"),
        F.col("o_orderpriority").rlike("^[12]-").alias("alta"),
        F.date_format(time, "dd/MM/yyyy").alias("dia"),
        F.year(time).alias("ano"),
        F.month(time).alias("mes"),
        F.dayofmonth(time).alias("dia_do_mes"),
        F.round("o_totalprice", 0).alias("arredondado"),
        F.ceil(F.col("o_totalprice") / 256).alias("teto"),
        (F.col("o_custkey") - F.col("o_orderkey")).alias("diferenca"),
        "preenchido",
        F.col("o_custkey").cast("string").alias("texto"),
        F.lit(1).alias("um"),
    )
