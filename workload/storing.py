"""Sinks, archives, tables, compaction and scans: every query writes below the shared folder and reads back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fisclake.functions.dates import SOURCE_FORMAT, with_parsed_day
from fisclake.operators import catalog, compaction
from fisclake.operators.audit import missing_rows
from fisclake.operators.mirror import compare_mirror, mirror, synchronise, verify_mirror
from fisclake.operators.parse import documents, parse, select_bronze
from fisclake.operators.sinks import (
    DAY,
    VerificationError,
    archive_new_days,
    hand_over,
    harmonise,
    new_items,
    require_same_rows,
    rewrite_deduplicated,
    rewrite_without,
    staged_swap,
    write_once as write_folder_once,
    write_partitioned,
)
from fisclake.plans.audits import log_metrics, section_metrics
from fisclake.plans.batches import Batch, load_batches
from fisclake.plans.load import Target, load, load_with_items
from fisclake.registry import CANCELLATIONS, DOCUMENTS, ITEMS, XML, DocumentType
from fisclake.session import shared_folder
from fisclake.sources import scans
from fisclake.sources.auditlog import measured, read_log
from fisclake.sources.storage import exists, files, move, partition_inventory
from workload.documents import ITEMS_SQL, ORDERS_SQL, access_key, bronze, bronze_events, exact_sum, table
from workload.register import Register

query = Register()
QUERIES, SQL = query.queries, query.sql

BY_MONTH = f"WITH {ORDERS_SQL} SELECT substr(chave, 3, 4) AS chave_particao, count(*) AS documentos FROM orders_x GROUP BY 1"


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow silver table: orders under their access key."""
    orders = table(spark, sf_dir, "orders").withColumn("chave", access_key())
    return orders.withColumn("chave_particao", F.substring("chave", 3, 4))


def stored_silver(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = shared_folder(spark, name)
    write_partitioned(silver_orders(spark, sf_dir), path)
    return path


def by_month(df: DataFrame) -> DataFrame:
    return df.groupBy("chave_particao").agg(F.count("*").alias("documentos"))


# --- loads and appends ------------------------------------------------------------------------------------------


@query(
    f"""WITH {ORDERS_SQL}
    SELECT substr(chave, 3, 4) AS chave_particao, count(*) AS documentos, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS valor FROM orders_x GROUP BY 1"""
)
def silver_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of parsed documents, then the table as it is stored."""
    path = shared_folder(spark, "silver")
    batch = bronze(spark, sf_dir, "nfcom")
    pending = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    pending = pending.select(F.col("o_orderkey").cast("decimal(38,0)").alias("NSU"))
    for part in (batch.join(pending, "NSU", "left_semi"), batch.join(pending, "NSU", "left_anti")):
        write_partitioned(documents(part, DOCUMENTS["NFCom"], ["chave", "total_vNF"]), path)
    return scans.read_table(spark, path).groupBy("chave_particao").agg(
        F.count("*").alias("documentos"), exact_sum("total_vNF").alias("valor")
    )


@query(BY_MONTH.replace("count(*) AS documentos", "count(*) AS documents"))
def document_load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch load: gate, route, parse, write, count."""
    folder = shared_folder(spark, "load")
    target = Target(f"{folder}/silver")
    counts = load(bronze(spark, sf_dir, "mdfe"), DOCUMENTS["MDFe"], target, where="NSU < 1000000000")
    return counts


@query(
    f"""WITH {ITEMS_SQL}
    SELECT (SELECT count(*) FROM orders_x) AS documentos, count(*) AS itens, CAST(sum(CAST(vprod AS DECIMAL(18, 2))) AS DOUBLE) AS valor FROM items_x"""
)
def document_load_with_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers and items of one batch."""
    folder = shared_folder(spark, "nfe")
    header, detail = Target(f"{folder}/infNFe"), Target(f"{folder}/det")
    load_with_items(bronze(spark, sf_dir, "nfe"), DOCUMENTS["NFe"], ITEMS["NFe"], header, detail)
    headers = spark.read.parquet(header.path).agg(F.count("*").alias("documentos"))
    lines = spark.read.parquet(detail.path).agg(F.count("*").alias("itens"), exact_sum("vProd").alias("valor"))
    return headers.join(lines)


GATED = f"""WITH {ORDERS_SQL} SELECT table_name, outcome, CASE outcome WHEN 'loaded' THEN (SELECT count(*) FROM orders_x) ELSE 0 END AS documentos
        FROM (SELECT unnest(['good', 'good', 'twice']) AS inbox, unnest(['{{0}}', '{{0}}', '{{0}}_twice']) AS table_name,
                     unnest(['loaded', 'loaded', 'failed']) AS outcome)"""


def _gated(spark: SparkSession, name: str, kind: DocumentType, good: DataFrame, twice: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Load one inbox twice and one that the gate of the type refuses, made of the stored rows of the first, and count what is in the tables."""
    folder = shared_folder(spark, f"gate-{name}")
    good.write.parquet(f"{folder}/good")
    twice(spark.read.parquet(f"{folder}/good")).write.parquet(f"{folder}/twice")
    loads = [("good", name), ("good", name), ("twice", f"{name}_twice")]
    batches = [Batch(kind, f"{folder}/{inbox}", Target(f"{folder}/{table_name}")) for inbox, table_name in loads]
    report = load_batches(spark, batches).collect()
    counts = {
        table_name: spark.read.parquet(f"{folder}/{table_name}").count() if exists(spark, f"{folder}/{table_name}") else 0 for _, table_name in loads
    }
    rows = [(table_name, row.outcome, counts[table_name]) for (_, table_name), row in zip(loads, report, strict=True)]
    return spark.createDataFrame(rows, "table_name string, outcome string, documentos long")


@query(GATED.format("sequence"))
def load_gate_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NF3-e, as most documents: a sequence number twice in a batch keeps all of it out."""
    half = F.floor(F.col("NSU") / 2).cast("decimal(38,0)")
    return _gated(spark, "sequence", DOCUMENTS["NF3e"], bronze(spark, sf_dir, "nf3e"), lambda good: good.withColumn("NSU", half))


@query(GATED.format("key"))
def load_gate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NFC-e: an access key twice in a batch keeps all of it out, though the sequence numbers differ."""
    later = (F.col("NSU") + 10**12).cast("decimal(38,0)")
    return _gated(spark, "key", DOCUMENTS["NFCe"], bronze(spark, sf_dir, "nfce"), lambda good: good.unionByName(good.withColumn("NSU", later)))


@query(GATED.format("row"))
def load_gate_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cancellations: only whole rows must not repeat; two of one document may well have the same number."""
    events = bronze_events(spark, sf_dir, "mdfe")
    same_number = events.withColumn("NSU", F.lit(1).cast("decimal(38,0)"))
    return _gated(spark, "row", CANCELLATIONS["MDFe"], same_number, lambda _: events.unionAll(events))


@query(
    f"""WITH {ITEMS_SQL} SELECT (SELECT count(*) FROM orders_x) AS documentos, count(*) AS itens,
          CAST(sum(CAST(vprod AS DECIMAL(18, 2))) AS DOUBLE) AS valor, CAST(0 AS BIGINT) AS recusados FROM items_x"""
)
def load_two_consumers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One inbox of texts as the source has them (comments, line breaks, something around the document), delivered in two parts, loaded for headers and
    for items, twice after each delivery: each document and item arrives once, the second delivery bringing items of the first again."""
    folder = shared_folder(spark, "consumers")
    raw = F.concat(F.lit("<!-- lote -->\n<envelope>"), F.replace(XML, F.lit("<ide>"), F.lit("<!-- <x> -->\r\n<ide>")), F.lit("</envelope>"))
    batch = bronze(spark, sf_dir, "nfe").withColumn(XML, raw)
    header, detail = Target(f"{folder}/infNFe"), Target(f"{folder}/det")
    consumers = [Batch(DOCUMENTS["NFe"], f"{folder}/inbox", header, clean=True), Batch(ITEMS["NFe"], f"{folder}/inbox", detail, clean=True)]
    again = Batch(ITEMS["NFe"], f"{folder}/again", detail, clean=True)
    for part in ("NSUDF % 2 = 0", "NSUDF % 2 = 1"):
        batch.filter(part).write.mode("append").parquet(f"{folder}/inbox")
        batch.filter(part).filter("NSUDF % 3 = 0").write.mode("append").parquet(f"{folder}/again")
        for _ in range(2):
            failed = load_batches(spark, [*consumers, again]).filter("outcome <> 'loaded'").collect()
            if failed:
                raise VerificationError(str(failed))
    headers = spark.read.parquet(header.path).agg(F.count("*").alias("documentos"))
    lines = spark.read.parquet(detail.path).agg(F.count("*").alias("itens"), exact_sum("vProd").alias("valor"))
    refused = spark.read.parquet(header.rejected).agg(F.count("*").alias("recusados"))
    return headers.join(lines).join(refused)


@query(
    """SELECT count(*) AS linhas, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS chaves,
              CAST(0 AS BIGINT) AS segunda_carga FROM lineitem"""
)
def idempotent_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch loaded twice: the second time nothing is new."""
    path = shared_folder(spark, "items")
    keys = ["l_orderkey", "l_linenumber"]
    batch = table(spark, sf_dir, "lineitem")
    new_items(batch, None, keys).write.parquet(path)
    stored = spark.read.parquet(path)
    again = new_items(batch, stored, keys).agg(F.count("*").alias("segunda_carga"))
    distinct = stored.select(*keys).distinct().agg(F.count("*").alias("chaves"))
    return stored.agg(F.count("*").alias("linhas")).join(distinct).join(again)


@query("SELECT count(*) AS documentos, CAST(1 AS INTEGER) AS gravacoes FROM events")
def write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write of a day finds it there and leaves it."""
    path = shared_folder(spark, "day")
    day = table(spark, sf_dir, "events")
    writes = sum(write_folder_once(part, path) for part in (day, day.limit(1)))
    return spark.read.parquet(path).agg(F.count("*").alias("documentos")).withColumn("gravacoes", F.lit(writes))


# --- day archive, month folders, hand-over ----------------------------------------------------------------------


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bronze rows: a sequence number and a processing time."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("decimal(38,0)").alias("NSUSVD"),
        F.date_format("ts", SOURCE_FORMAT).alias("DHPROC"),
        F.lit(57).alias("MODELO"),
        F.col("user_id").alias("TPEMIS"),
        "value",
    )


BY_DAY = """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS documentos
            FROM events GROUP BY 1, 2, 3"""


def by_day(df: DataFrame) -> DataFrame:
    padded = [F.lpad(F.col(name).cast("string"), width, "0").alias(name) for name, width in (("year", 4), ("month", 2), ("day", 2))]
    return df.groupBy(*padded).agg(F.count("*").alias("documentos"))


@query(BY_DAY, name="archive_new_days")
def archive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten days, then the whole month: only the days the archive lacks are added."""
    path = shared_folder(spark, "archive")
    source = event_documents(spark, sf_dir)
    archive_new_days(source.filter("substring(DHPROC, 1, 2) <= '10'"), path)
    archive_new_days(source, path)
    return by_day(spark.read.parquet(path))


@query(BY_DAY)
def archive_after_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that was cut off while it moved days into the archive; the next one brings the others, and each day is there once."""
    path = shared_folder(spark, "archive")
    source = event_documents(spark, sf_dir)
    archive_new_days(source.filter("substring(DHPROC, 1, 2) <= '04'"), path)
    later = source.filter("substring(DHPROC, 1, 2) > '04'")
    write_partitioned(with_parsed_day(later, "DHPROC"), f"{path}_staged", DAY)
    for day in ("05", "06", "07"):
        move(spark, f"{path}_staged/year=2024/month=01/day={day}", f"{path}/year=2024/month=01/day={day}")
    for _ in range(2):
        archive_new_days(source, path)
    return by_day(spark.read.parquet(path))


@query("SELECT strftime(ts, '%Y%m') AS mes, count(*) AS documentos, CAST(2 AS BIGINT) AS arquivos FROM events GROUP BY 1")
def month_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All day folders of a month into one folder with the least number of files."""
    folder = shared_folder(spark, "days")
    days = event_documents(spark, sf_dir).withColumn("day", F.concat(*(F.substring("DHPROC", a, n) for a, n in ((7, 4), (4, 2), (1, 2)))))
    write_partitioned(days, folder, ["day"])
    compaction.consolidate_month(spark, [f"{folder}/day=202401*"], f"{folder}_202401")
    written = files(spark, f"{folder}_202401").agg(F.count("*").alias("arquivos"))
    month = F.concat(F.substring("DHPROC", 7, 4), F.substring("DHPROC", 4, 2)).alias("mes")
    return spark.read.parquet(f"{folder}_202401").groupBy(month).agg(F.count("*").alias("documentos")).join(written)


@query(
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS documentos,
              count(DISTINCT event_id) AS nsus, max(CAST(event_id AS VARCHAR)) AS maior_nsu FROM events GROUP BY 1, 2, 3"""
)
def legacy_handover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys become text, days zero-padded folders. The largest key is the largest as text."""
    path = shared_folder(spark, "legacy")
    hand_over(event_documents(spark, sf_dir), path, "2024-01")
    schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in ("NSUSVD", "DHPROC", "MODELO", "TPEMIS", "year", "month", "day")]
    )
    stored = spark.read.schema(schema).parquet(path)
    return stored.groupBy("year", "month", "day").agg(
        F.count("*").alias("documentos"), F.count_distinct("NSUSVD").alias("nsus"), F.max("NSUSVD").alias("maior_nsu")
    )


@query(
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS documentos,
              count(DISTINCT event_id) AS nsus FROM events GROUP BY 1, 2, 3"""
)
def handover_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, each handed over twice: nothing is doubled."""
    path = shared_folder(spark, "handed")
    source = event_documents(spark, sf_dir)
    for _ in range(2):
        for name, part in (("first", source.filter("NSUSVD % 2 = 0")), ("second", source.filter("NSUSVD % 2 = 1"))):
            hand_over(part, path, name)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in ("NSUSVD", "year", "month", "day")])
    stored = spark.read.schema(schema).parquet(path)
    return stored.groupBy("year", "month", "day").agg(F.count("*").alias("documentos"), F.count_distinct("NSUSVD").alias("nsus"))


@query("SELECT typeof(CAST(1 AS VARCHAR)) = 'VARCHAR' AS texto, count(*) AS documentos, count(DISTINCT event_id) AS nsus FROM events")
def type_harmonise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders whose keys have different types become one table."""
    source = event_documents(spark, sf_dir)
    old = harmonise(source.filter("value < 20").withColumnRenamed("DHPROC", "day"), ["NSUSVD", "MODELO"], {"day": "DHPROC"})
    new = harmonise(source.filter("value >= 20").withColumn("NSUSVD", F.col("NSUSVD").cast("bigint")), ["NSUSVD", "MODELO"])
    both = scans.union_by_name(old, new)
    texts = F.lit(dict(both.dtypes)["NSUSVD"] == "string").alias("texto")
    return both.groupBy(texts).agg(F.count("*").alias("documentos"), F.count_distinct("NSUSVD").alias("nsus"))


@query(
    """SELECT strftime(ts, '%d') AS dia, count(*) AS documentos, count(CASE WHEN event_type = 'error' THEN 1 END) AS com_erro
       FROM events GROUP BY 1"""
)
def union_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that lack a column are united by name; the column is NULL there."""
    source = table(spark, sf_dir, "events").withColumn("dia", F.date_format("ts", "dd"))
    plain = source.filter("event_type <> 'error'").select("event_id", "dia")
    errors = source.filter("event_type = 'error'").select("dia", "event_id", "event_type")
    united = scans.union_by_name(plain, errors)
    return united.groupBy("dia").agg(F.count("*").alias("documentos"), F.count("event_type").alias("com_erro"))


# --- rewrites ---------------------------------------------------------------------------------------------------


@query("SELECT o_orderstatus, count(*) AS documentos FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1", name="staged_swap")
def staged_swap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is replaced by its corrected copy after the copy was checked."""
    path = shared_folder(spark, "swap")
    orders = table(spark, sf_dir, "orders")
    orders.unionByName(orders.filter("o_orderstatus = 'F'")).write.parquet(path)
    correct = orders.filter("o_orderstatus <> 'P'")
    expected = shared_folder(spark, "expected")
    correct.write.parquet(expected)
    staged_swap(spark, path, lambda copy: correct.write.parquet(copy), lambda copy: require_same_rows(spark, expected, copy))
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("documentos"))


@query(BY_MONTH.replace("GROUP BY 1", "GROUP BY 1").replace("count(*) AS documentos", "count(*) AS documentos, false AS tem_coluna"))
def drop_column_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_silver(spark, sf_dir, "column")
    rewrite_without(spark, path, "O_OrderPriority")
    stored = scans.read_table(spark, path)
    left = F.lit("o_orderpriority" in stored.columns).alias("tem_coluna")
    return stored.groupBy("chave_particao", left).agg(F.count("*").alias("documentos"))


@query(
    """SELECT strftime(l_shipdate, '%y%m') AS chave_particao, count(DISTINCT (l_orderkey, l_linenumber)) AS itens,
              CAST(0 AS BIGINT) AS ainda_repetidos FROM lineitem GROUP BY 1"""
)
def dedup_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item table with repeated keys, rewritten without them month by month."""
    path = shared_folder(spark, "repeated")
    keys = ["l_orderkey", "l_linenumber"]
    write_partitioned(table(spark, sf_dir, "lineitem").withColumn("chave_particao", F.date_format("l_shipdate", "yyMM")), path)
    rewrite_deduplicated(spark, path, keys)
    again = rewrite_deduplicated(spark, path, keys)
    stored = scans.read_table(spark, path).groupBy("chave_particao").agg(F.count("*").alias("itens"))
    return stored.withColumn("ainda_repetidos", F.lit(again.removed))


@query(BY_MONTH.replace("count(*) AS documentos", "count(*) AS source_rows, count(*) AS target_rows, true AS equal"))
def mirror_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = stored_silver(spark, sf_dir, "original")
    target = shared_folder(spark, "copy")
    mirror(spark, source, target)
    mirror(spark, source, target, since="2000-01-01 00:00:00")
    return verify_mirror(spark, source, target)


@query(
    f"""WITH {ORDERS_SQL}, m AS (SELECT substr(chave, 3, 4) AS chave_particao, count(*) AS n FROM orders_x GROUP BY 1)
        SELECT chave_particao, n AS source_rows, n AS target_rows, true AS equal,
               CASE WHEN chave_particao < '9700' AND chave_particao > '9600' THEN 'copied' END AS action FROM m
        UNION ALL SELECT '9999', 0, 0, true, 'removed'"""
)
def mirror_synchronised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mirror with changed values under equal counts in one year, and a month that the source has lost: only those are put right."""
    source, target = stored_silver(spark, sf_dir, "source"), shared_folder(spark, "mirror")
    orders = silver_orders(spark, sf_dir)
    year = F.col("chave_particao").between("9600", "9700")
    spoilt = orders.withColumn("o_totalprice", F.when(year, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    lost = orders.limit(7).withColumn("chave_particao", F.lit("9999"))
    write_partitioned(spoilt.unionByName(lost), target)
    done = synchronise(spark, source, target)
    if synchronise(spark, source, target).count():
        raise ValueError("a second run found differences")
    after = compare_mirror(spark, source, target).select("chave_particao", "source_rows", "target_rows", "equal")
    gone = after.join(done, "chave_particao", "full")
    return gone.na.fill(0, ["source_rows", "target_rows"]).na.fill(True, ["equal"])


@query(
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS documentos, CAST(1 AS BIGINT) AS files,
              CAST(1 AS BIGINT) AS times, day(ts) <= 10 AS first_run FROM events GROUP BY 1, 2, 3, 7"""
)
def day_rewrite_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of many files rewritten: ten in a run that then ends, the others by the next one, none by a third."""
    path = shared_folder(spark, "fragments")
    with_parsed_day(event_documents(spark, sf_dir), "DHPROC").repartition(4).write.partitionBy(*DAY).parquet(path)
    journal = f"{path}_journal"
    first = {tuple(r[k] for k in DAY) for r in compaction.rewrite_days(spark, path, journal, most=10).collect()}
    for _ in range(2):
        noted = compaction.rewrite_days(spark, path, journal)
    early = spark.createDataFrame(sorted(first), "year string, month string, day string").withColumn("first_run", F.lit(True))
    times = noted.groupBy(*DAY).agg(F.count("*").alias("times"))
    sizes = partition_inventory(spark, path, list(DAY)).select(*DAY, "files")
    found = by_day(scans.read_table(spark, path, list(DAY))).join(sizes, list(DAY)).join(times, list(DAY))
    return found.join(early, list(DAY), "left").na.fill(False, ["first_run"])


# --- inventory and compaction -----------------------------------------------------------------------------------


@query(BY_MONTH.replace("count(*) AS documentos", "true AS tem_arquivos, true AS tem_bytes"), name="partition_inventory")
def partition_inventory_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = partition_inventory(spark, stored_silver(spark, sf_dir, "inventory"), ["chave_particao"])
    return inventory.select("chave_particao", (F.col("files") > 0).alias("tem_arquivos"), (F.col("bytes") > 0).alias("tem_bytes"))


_INVENTORY_SQL = """
  inventory AS (SELECT strftime(l_shipdate, '%y%m') AS chave_particao, count(DISTINCT l_suppkey) AS files,
                       CAST(sum(CAST(l_quantity AS BIGINT)) * 500000 AS BIGINT) AS bytes FROM lineitem GROUP BY 1)"""


def _derived_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory as large as one wants: files and bytes per month computed from the items."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(F.date_format("l_shipdate", "yyMM").alias("chave_particao")).agg(
        F.count_distinct("l_suppkey").alias("files"), (F.sum(F.col("l_quantity").cast("bigint")) * 500000).alias("bytes")
    )


@query(
    f"""WITH {_INVENTORY_SQL},
    p AS (SELECT *, greatest(CAST(round(bytes / 1048576 / 160) AS INTEGER), CAST(round(bytes / 1048576 / 256) AS INTEGER), 1) AS ideal_files
          FROM inventory)
    SELECT *, files BETWEEN floor(ideal_files * 0.85) AND floor(ideal_files * 1.15) AS healthy FROM p"""
)
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compaction.plan(_derived_inventory(spark, sf_dir))


@query(f"WITH {_INVENTORY_SQL} SELECT * FROM inventory ORDER BY chave_particao DESC LIMIT 2")
def compaction_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two newest partitions; the weekly run takes all."""
    return compaction.newest_partitions(_derived_inventory(spark, sf_dir))


@query(
    """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS files,
              CAST(sum(user_id) * 100000 AS BIGINT) AS bytes,
              CAST(greatest(ceil(sum(user_id) * 100000 / 1048576 / 256), 1) AS INTEGER) AS target_files
       FROM events WHERE day(ts) > 7 GROUP BY 1, 2, 3"""
)
def day_rewrite_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the first week are finished."""
    days = table(spark, sf_dir, "events").select(
        *(F.date_format("ts", pattern).alias(name) for name, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))), "user_id"
    )
    inventory = days.groupBy("year", "month", "day").agg(
        F.count("*").alias("files"), (F.sum("user_id") * 100000).alias("bytes")
    )
    return compaction.day_rewrite_plan(inventory, inventory.filter("day <= '07'"))


@query(BY_MONTH.replace("count(*) AS documentos", "count(*) AS documentos, true AS healthy"))
def compaction_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written in far too many files, compacted; rows and health afterwards."""
    path = shared_folder(spark, "fragmented")
    silver_orders(spark, sf_dir).repartition(8).write.partitionBy("chave_particao").parquet(path)
    compaction.compact(spark, path)
    healthy = compaction.plan(partition_inventory(spark, path, ["chave_particao"])).select("chave_particao", "healthy")
    return by_month(scans.read_table(spark, path)).join(healthy, "chave_particao")


@query(
    f"""WITH {ORDERS_SQL} SELECT substr(chave, 3, 4) AS chave_particao, count(DISTINCT o_orderkey % 8) AS files, 1 AS ideal_files,
        count(DISTINCT o_orderkey % 8) <= 1 AS healthy, count(*) AS documentos FROM orders_x GROUP BY 1"""
)
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a compaction says it found, beside the rows of the table it left."""
    path = shared_folder(spark, "scattered")
    orders = silver_orders(spark, sf_dir)
    orders.repartitionById(8, F.pmod("o_orderkey", F.lit(8)).cast("int")).write.partitionBy("chave_particao").parquet(path)
    found = compaction.compact(spark, path).select("chave_particao", "files", "ideal_files", "healthy")
    return by_month(scans.read_table(spark, path)).join(found, "chave_particao")


@query(
    f"""WITH {ORDERS_SQL} SELECT substr(chave, 3, 4) AS chave_particao, count(DISTINCT o_orderkey % 3) AS files,
        CAST(sum(length(chave) + 1) AS BIGINT) AS bytes FROM orders_x GROUP BY 1"""
)
def inventory_known_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory of text files, whose number and bytes follow from their lines."""
    path = shared_folder(spark, "sized")
    orders = silver_orders(spark, sf_dir).select("chave", "chave_particao", F.pmod("o_orderkey", F.lit(3)).alias("third"))
    for third in range(3):
        orders.filter(F.col("third") == third).drop("third").repartition("chave_particao").write.mode("append").partitionBy("chave_particao").text(path)
    return partition_inventory(spark, path, ["chave_particao"], "*.txt").select("chave_particao", "files", "bytes")


# --- tables -----------------------------------------------------------------------------------------------------


@query(BY_MONTH)
def external_table_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table defined over a folder, defined anew, and queried by name."""
    name = f"silver_{uuid.uuid4().hex[:8]}"
    path = stored_silver(spark, sf_dir, "table")
    catalog.replace_table(spark, name, path)
    catalog.replace_table(spark, name, path)
    return spark.sql(f"SELECT chave_particao, count(*) AS documentos FROM {name} GROUP BY chave_particao")


@query(f"WITH {ORDERS_SQL} SELECT DISTINCT substr(chave, 3, 4) AS chave_particao FROM orders_x")
def partition_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions written past the table are found afterwards."""
    name = f"found_{uuid.uuid4().hex[:8]}"
    path = shared_folder(spark, "discovery")
    silver = silver_orders(spark, sf_dir)
    write_partitioned(silver.filter("chave_particao < '98'"), path)
    catalog.create_table(spark, name, path)
    write_partitioned(silver.filter("chave_particao >= '98'"), path)
    catalog.discover_partitions(spark, name)
    return catalog.partitions(spark, name)


# --- scans ------------------------------------------------------------------------------------------------------


@query("SELECT count(*) AS linhas, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS valor FROM lineitem")
def scan_file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scans.read_files(spark, [f"{sf_dir}/lineitem.parquet"])
    return lines.agg(F.count("*").alias("linhas"), exact_sum("l_extendedprice").alias("valor"))


@query("SELECT count(*) AS documentos FROM orders WHERE year(o_orderdate) = 1997")
def scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored_silver(spark, sf_dir, "glob")
    return scans.read_glob(spark, f"{path}/chave_particao=97*", base=path).agg(F.count("*").alias("documentos"))


@query(
    """SELECT strftime(o_orderdate, '%y%m') AS chave_particao, count(*) AS documentos FROM orders
       WHERE strftime(o_orderdate, '%y%m') IN ('9601', '9812', '0003') GROUP BY 1"""
)
def scan_multi_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several partition folders; `0003` stays text."""
    path = stored_silver(spark, sf_dir, "multi")
    return by_month(scans.read_table(spark, path, folders=[f"chave_particao={p}" for p in ("9601", "9812", "0003")]))


@query("SELECT count(*) AS documentos FROM events WHERE year(ts) = 2024 AND month(ts) = 1")
def scan_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old folders are called month=1, newer ones month=01; both are one month."""
    path = shared_folder(spark, "pruned")
    source = table(spark, sf_dir, "events").withColumn("year", F.date_format("ts", "yyyy"))
    month = F.when(F.dayofmonth("ts") < 15, F.date_format("ts", "M")).otherwise(F.date_format("ts", "MM"))
    dated = source.withColumn("month", month)
    write_partitioned(dated, path, ["year", "month"])
    return scans.in_month(scans.read_folder(spark, path, dated.schema), 2024, 1).agg(F.count("*").alias("documentos"))


@query(f"""WITH {ORDERS_SQL} SELECT chave, o_totalprice FROM orders_x WHERE o_custkey % 7 = 0""")
def extract_by_key_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the documents of a key list in a CSV file."""
    path = shared_folder(spark, "keys")
    silver = silver_orders(spark, sf_dir)
    silver.filter("o_custkey % 7 = 0").select("chave").write.option("header", True).csv(path)
    keys = scans.read_key_list(spark, path)
    return scans.listed(silver, keys, key="chave").select("chave", "o_totalprice")


@query(
    f"""WITH {ORDERS_SQL} SELECT chave FROM orders_x WHERE strftime(o_orderdate, '%Y') NOT IN ('1996', '1999')"""
)
def keys_except_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the origin that several month folders together lack."""
    path = stored_silver(spark, sf_dir, "except")
    found = scans.read_glob(spark, f"{path}/chave_particao=9[69]*", base=path)
    return missing_rows(silver_orders(spark, sf_dir).select("chave").distinct(), found, ["chave"])


@query(f"WITH {ITEMS_SQL} SELECT chave, CAST(nitem AS VARCHAR) AS nitem FROM items_x")
def xml_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in XML files, read by Spark's XML source with inferred columns, all text."""
    path = shared_folder(spark, "xml")
    kind = DOCUMENTS["NFe"]
    layout = ITEMS["NFe"].layout.select(["chave", "nItem", "cProd", "vProd"])
    parsed = parse(select_bronze(bronze(spark, sf_dir, "nfe"), kind), layout)
    parsed.select("parsed.protNFe", "parsed.NFe").write.format("xml").option("rootTag", "lote").option("rowTag", kind.root).save(path)
    found = scans.read_xml(spark, path, kind.root)
    return found.select(F.col("protNFe.infProt.chNFe").alias("chave"), F.explode("NFe.infNFe.det").alias("det")).select(
        "chave", F.col("det._nItem").alias("nitem")
    )


@query(BY_MONTH)
def replace_cut_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replacement that was cut off when the old table was gone and the new one had no name yet."""
    name = f"silver_{uuid.uuid4().hex[:8]}"
    path = stored_silver(spark, sf_dir, "table")
    catalog.create_table(spark, f"{name}_building", path)
    catalog.replace_table(spark, name, path)
    if spark.catalog.tableExists(f"{name}_building"):
        raise ValueError("the new definition is still there")
    return spark.sql(f"SELECT chave_particao, count(*) AS documentos FROM {name} GROUP BY chave_particao")


# --- audit log --------------------------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit log with one line per event: a phrase by type, a number by user."""
    path = shared_folder(spark, "log")
    number = F.col("user_id").cast("string")
    message = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("Total de NSUs não encontrados no prata: "), number))
        .when(F.col("event_type") == "click", F.concat(F.lit("Processando documento com NSU: "), number))
        .otherwise(F.concat(F.lit("Quantidade de arquivos: "), number))
    )
    line = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] "), message)
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    return read_log(spark, path)


@query(
    """SELECT strftime(ts, '%Y-%m-%d') AS dia, count(*) AS linhas, CAST(sum(user_id) AS BIGINT) AS ausentes
       FROM events WHERE event_type = 'error' GROUP BY 1"""
)
def audit_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = measured(_log(spark, sf_dir), r"não encontrados no prata: (\d+)", ["missing"])
    return lines.groupBy(F.date_format("at", "yyyy-MM-dd").alias("dia")).agg(
        F.count("*").alias("linhas"), F.sum(F.col("missing").cast("bigint")).alias("ausentes")
    )


@query(
    """SELECT count(*) FILTER (event_type = 'click') AS audited, CAST(0 AS BIGINT) AS errors,
              CAST(coalesce(sum(user_id) FILTER (event_type = 'error'), 0) AS BIGINT) AS missing, CAST(0 AS BIGINT) AS repeated,
              CAST(0 AS BIGINT) AS folders,
              CAST(coalesce(sum(user_id) FILTER (event_type NOT IN ('error', 'click')), 0) AS BIGINT) AS files,
              CASE WHEN sum(user_id) FILTER (event_type = 'error') > 0 THEN 'ATENÇÃO' ELSE 'SUCESSO' END AS status FROM events"""
)
def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_metrics(_log(spark, sf_dir))


@query(
    """WITH e AS (SELECT strftime(ts, '%d') AS dia, event_id, event_type, user_id, date_trunc('second', ts) AS instant,
                   CASE WHEN event_type = 'click' THEN 'T' || CAST(user_id % 7 AS VARCHAR) END AS named FROM events),
           s AS (SELECT *, coalesce(last_value(named IGNORE NULLS) OVER (PARTITION BY dia ORDER BY event_id ROWS UNBOUNDED PRECEDING), '') AS section FROM e)
       SELECT section, count(*) FILTER (event_type = 'click') AS audited, 2 * count(*) FILTER (event_type = 'purchase') AS errors,
              CAST(coalesce(sum(user_id) FILTER (event_type = 'error'), 0) AS BIGINT) AS missing, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS folders,
              CAST(coalesce(sum(user_id) FILTER (event_type = 'view'), 0) AS BIGINT) AS files, count(*) FILTER (event_type = 'signup') AS empty,
              strftime(min(instant), '%Y-%m-%d %H:%M:%S') AS begun, strftime(max(instant), '%Y-%m-%d %H:%M:%S') AS ended,
              CASE WHEN coalesce(sum(user_id) FILTER (event_type = 'error'), 0) + count(*) FILTER (event_type IN ('purchase', 'signup')) > 0
                   THEN 'ATENÇÃO' ELSE 'SUCESSO' END AS status
       FROM s GROUP BY section"""
)
def audit_log_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log file per day, in which tables follow each other and errors go over several lines: counts, times and outcome of each table."""
    path = shared_folder(spark, "log")
    number = F.col("user_id").cast("string")
    kinds = {
        "click": F.concat(F.lit("Processando documento com NSU: T"), (F.col("user_id") % 7).cast("string")),
        "error": F.concat(F.lit("Total de NSUs não encontrados no prata: "), number),
        "view": F.concat(F.lit("Quantidade de arquivos: "), number),
        "signup": F.lit("A última pasta está VAZIA"),
        "purchase": F.concat(F.lit("ERRO ao ler\n    em "), number, F.lit("\njava.io.IOException: [fim]")),
    }
    message = F.coalesce(*(F.when(F.col("event_type") == kind, text) for kind, text in kinds.items()))
    line = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] "), message)
    rows = table(spark, sf_dir, "events").select(F.date_format("ts", "dd").alias("dia"), "event_id", line.alias("value"))
    rows.repartition("dia").sortWithinPartitions("dia", "event_id").drop("event_id").write.partitionBy("dia").text(path)
    found = section_metrics(read_log(spark, path))
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("begun", "ended")})
