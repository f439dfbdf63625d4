"""Gates, comparisons between layers, duplicates, profiles and gaps."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.dates import timestamp
from fisclake.operators import audit
from fisclake.operators.gaps import folder_alerts, late_folders, missing_days, missing_hours, missing_recent_days, months_present
from fisclake.operators.gates import uniqueness
from fisclake.operators.keytables import KeyTable, add_keys, missing_keys
from fisclake.operators.parse import documents
from fisclake.operators.profile import empty_columns, mostly_null, null_profile
from fisclake.operators.repair import deduplicate, deduplication_report
from fisclake.plans.audits import audit_status, bronze_silver_audit, item_audit
from fisclake.registry import AUDITED, CANCELLATIONS, DOCUMENTS, EVENTS, DocumentType
from fisclake.session import shared_folder
from fisclake.sources.jdbc import range_bounds
from fisclake.sources.storage import mark, newest_folder
from workload.documents import ORDERS_SQL, access_key, bronze, bronze_events, orders_for_documents, sequence_of, table
from workload.register import Register

query = Register()
QUERIES, SQL = query.queries, query.sql


def order_key(column: str) -> Column:
    return F.concat(F.lit("53"), F.lpad(F.col(column).cast("string"), 42, "0"))


def _order_key_sql(column: str) -> str:
    return f"'53' || lpad(CAST({column} AS VARCHAR), 42, '0')"


O_KEY, L_KEY = _order_key_sql("o_orderkey"), _order_key_sql("l_orderkey")
ITEM_KEYS = ["l_orderkey", "l_linenumber"]


def header_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("*", order_key("o_orderkey").alias("chave"))


def item_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items as a silver table has them: key, item number, year-month."""
    return table(spark, sf_dir, "lineitem").select(
        "*",
        order_key("l_orderkey").alias("chave"),
        F.col("l_linenumber").alias("nItem"),
        F.date_format("l_shipdate", "yyMM").alias("chave_particao"),
    )


# --- gates ------------------------------------------------------------------------------------------------------


@query("SELECT count(*) AS total, count(DISTINCT o_orderkey) AS distinct_total, true AS is_unique FROM orders")
def gate_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole bronze rows, XML included."""
    return uniqueness(bronze(spark, sf_dir, "nfcom"))


@query("SELECT count(*) AS total, count(DISTINCT o_orderkey) AS distinct_total, true AS is_unique FROM orders")
def gate_nsu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return uniqueness(bronze(spark, sf_dir, "nfe"), [sequence_of("nfe")])


@query(
    """SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_total,
              false AS is_unique FROM lineitem"""
)
def gate_chave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that must be refused: item keys repeat."""
    return uniqueness(item_keys(spark, sf_dir), ["chave", "nItem"])


# --- counts -----------------------------------------------------------------------------------------------------


@query(f"WITH {ORDERS_SQL} SELECT substr(chave, 3, 4) AS chave_particao, count(*) AS count FROM orders_x GROUP BY 1 ORDER BY 1")
def count_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = documents(bronze(spark, sf_dir, "nf3e"), DOCUMENTS["NF3e"], ["chave"])
    return audit.count_by(silver, "chave_particao")


@query(f"WITH {ORDERS_SQL} SELECT strftime(proc, '%Y-%m-%d') AS dia, count(*) AS count FROM orders_x GROUP BY 1 ORDER BY 1")
def count_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = bronze(spark, sf_dir, "nfe").select(F.date_format(timestamp(), "yyyy-MM-dd").alias("dia"))
    return audit.count_by(days, "dia")


@query(
    """SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS total, count(DISTINCT l_orderkey) AS distinct_keys,
              count(*) - count(DISTINCT l_orderkey) AS repeated FROM lineitem GROUP BY 1"""
)
def daily_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return audit.daily_totals(lines, F.date_format("l_shipdate", "yyyy-MM-dd"), "l_orderkey")


@query(
    """SELECT event_type, count(*) AS total, CAST(grouping(event_type) = 1 AS BOOLEAN) AS is_total
       FROM events WHERE year(ts) = 2024 AND month(ts) = 1 GROUP BY ROLLUP (event_type)"""
)
def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    january = table(spark, sf_dir, "events").filter("ts >= TIMESTAMP_NTZ'2024-01-01' AND ts < TIMESTAMP_NTZ'2024-02-01'")
    return audit.totals_with_grand_total(january, "event_type")


@query(
    """WITH s AS (SELECT strftime(o_orderdate, '%Y') AS ano, count(*) AS source_total FROM orders GROUP BY 1),
            l AS (SELECT strftime(o_orderdate, '%Y') AS ano, count(*) AS lake_total FROM orders
                  WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
       SELECT ano, coalesce(source_total, 0) AS source_total, coalesce(lake_total, 0) AS lake_total,
              coalesce(source_total, 0) - coalesce(lake_total, 0) AS difference
       FROM s FULL JOIN l USING (ano) WHERE coalesce(source_total, 0) <> coalesce(lake_total, 0)"""
)
def source_lake_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per year at the source, against those that arrived with items."""
    orders = table(spark, sf_dir, "orders").withColumn("ano", F.date_format("o_orderdate", "yyyy"))
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    totals = (F.count("*").alias("total"),)
    source = orders.groupBy("ano").agg(*totals)
    lake = orders.join(keys, "o_orderkey", "left_semi").groupBy("ano").agg(*totals)
    return audit.compare_totals(source, lake, "ano")


# --- missing ----------------------------------------------------------------------------------------------------


@query(f"SELECT {O_KEY} AS chave, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_in_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing = audit.missing_in_silver(header_keys(spark, sf_dir), item_keys(spark, sf_dir), "chave", "chave")
    return missing.select("chave", "o_totalprice")


@query(
    """SELECT '53' || strftime(o_orderdate, '%y%m') || lpad(CAST(o_orderkey AS VARCHAR), 38, '0') AS chave, strftime(o_orderdate, '%y%m') AS chave_particao
       FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def stored_keys_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from key tables in buckets; the items arrive in two batches, of which the second repeats half of the first."""
    root, mark = shared_folder(spark, "keys"), uuid.uuid4().hex[:12]
    listed, filed = (KeyTable(f"{side}_{mark}", f"{root}/{side}", 4) for side in ("bronze_keys", "silver_keys"))
    orders = table(spark, sf_dir, "orders").withColumn("chave", access_key())
    lines = table(spark, sf_dir, "lineitem").join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "chave"), "l_orderkey")
    add_keys(orders, listed)
    add_keys(lines.filter("l_linenumber <= 2"), filed)
    add_keys(lines.filter("l_linenumber <> 2"), filed)
    return missing_keys(spark, listed, filed)


@query(
    """SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem a WHERE l_linestatus = 'O' AND NOT EXISTS (
         SELECT 1 FROM lineitem b WHERE b.l_linestatus = 'F' AND b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey)"""
)
def anti_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    left, right = lines.filter("l_linestatus = 'O'"), lines.filter("l_linestatus = 'F'")
    return audit.missing_rows(left, right, ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_partkey", "l_suppkey")


def _key_lists(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    expected = header_keys(spark, sf_dir).filter("o_orderstatus <> 'P'").select("chave")
    return expected, item_keys(spark, sf_dir).select("chave")


_LISTED = "(SELECT o_orderkey AS k FROM orders WHERE o_orderstatus <> 'P')"
_FOUND = "(SELECT DISTINCT l_orderkey AS k FROM lineitem)"


@query(f"SELECT {_order_key_sql('k')} AS chave FROM {_LISTED} WHERE k NOT IN (SELECT k FROM {_FOUND})")
def key_list_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.compare_key_lists(*_key_lists(spark, sf_dir)).filter("side = 'missing'").select("chave")


@query(f"SELECT {_order_key_sql('k')} AS chave FROM {_FOUND} WHERE k NOT IN (SELECT k FROM {_LISTED})")
def key_list_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.compare_key_lists(*_key_lists(spark, sf_dir)).filter("side = 'extra'").select("chave")


@query(
    f"""SELECT (SELECT count(*) FROM {_LISTED}) AS listed, (SELECT count(*) FROM {_FOUND}) AS found,
               (SELECT count(*) FROM {_LISTED} WHERE k NOT IN (SELECT k FROM {_FOUND})) AS missing,
               (SELECT count(*) FROM {_FOUND} WHERE k NOT IN (SELECT k FROM {_LISTED})) AS extra"""
)
def key_list_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.key_list_totals(*_key_lists(spark, sf_dir))


@query(f"SELECT {O_KEY} AS chave FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def inf_without_det(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distinct_keys_except(header_keys(spark, sf_dir), item_keys(spark, sf_dir), "chave", "chave")


_LOST = f"""{ORDERS_SQL},
  lost AS (SELECT 'cte/' || cte_kind AS "table", chave AS "key" FROM orders_x WHERE o_orderstatus = 'P'
           UNION ALL SELECT 'bpe/' || bpe_kind, chave FROM orders_x WHERE o_orderstatus = 'P'
           UNION ALL SELECT t, CAST(o_orderkey AS VARCHAR) FROM orders_x, (VALUES ('cte/evento'), ('mdfe/cancelamento')) v(t)
                     WHERE o_orderstatus = 'P')"""


@query(f"""WITH {_LOST} SELECT "table", "key" FROM lost""")
def audit_bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver lacks what belongs to pending orders; the audit must find each of them in its own table."""
    return bronze_silver_audit(_audit_pairs(spark, sf_dir))


_EVENTS = ("evento", "cancelamento")


def _lost_in(kind: DocumentType) -> str:
    """What a table lacks: pending orders, by access key, or by sequence number for events and cancellations."""
    of_kind = {"cte": f" AND cte_kind = '{kind.name}'", "bpe": f" AND bpe_kind = '{kind.name}'"}.get(kind.family, "")
    key, only = ("CAST(o_orderkey AS VARCHAR)", "") if kind.group in _EVENTS else ("chave", of_kind)
    return f"""SELECT '{kind.silver}' AS "table", {key} AS "key" FROM orders_x WHERE o_orderstatus = 'P'{only}"""


@query(f"""WITH {ORDERS_SQL} SELECT "table", count(*) AS missing, min("key") AS first_key, max("key") AS last_key
    FROM ({" UNION ALL ".join(map(_lost_in, AUDITED))}) GROUP BY 1""")
def audit_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit over every kind of document, cancellation and event."""
    found = bronze_silver_audit(_audit_pairs(spark, sf_dir, AUDITED))
    return found.groupBy("table").agg(F.count("*").alias("missing"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))


_SOME = (*(DOCUMENTS[name] for name in ("CTe", "CTeSimp", "CTeOS", "GVTe", "BPe", "BPeTA")), EVENTS["CTe"], CANCELLATIONS["MDFe"])


def _audit_pairs(spark: SparkSession, sf_dir: str, kinds: Sequence[DocumentType] = _SOME) -> list[tuple[DocumentType, DataFrame, DataFrame]]:
    orders = orders_for_documents(spark, sf_dir)
    loaded = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey").distinct()
    folder = shared_folder(spark, "audited")  # short rows, asked twice for each kind
    orders.join(loaded.withColumn("loaded", F.lit(True)), "o_orderkey", "left").write.parquet(folder)
    asked = spark.read.parquet(folder)
    kept = asked.drop("loaded")
    pairs = []
    for kind in kinds:
        cancelled = (kind.group == "cancelamento",) if kind.group in _EVENTS else ()
        source = bronze_events if kind.group in _EVENTS else bronze
        batch = source(spark, sf_dir, kind.family, *cancelled, orders=kept)
        silver = documents(source(spark, sf_dir, kind.family, *cancelled, orders=asked.filter("loaded").drop("loaded")), kind, ["chave"])
        pairs.append((kind, batch, silver))
    return pairs


@query(
    f"""WITH {_LOST},
    names AS (SELECT * FROM (VALUES ('cte/CTe'), ('cte/CTeSimp'), ('cte/CTeOS'), ('cte/GVTe'), ('bpe/BPe'), ('bpe/BPeTA'),
                                    ('cte/evento'), ('mdfe/cancelamento'), ('nfe/infNFe')) v("table"))
    SELECT "table", count("key") AS missing, CASE WHEN count("key") = 0 THEN 'SUCESSO' ELSE 'ATENÇÃO' END AS status
    FROM names LEFT JOIN lost USING ("table") GROUP BY 1"""
)
def audit_status_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _audit_pairs(spark, sf_dir)
    tables = [kind.silver for kind, *_ in pairs] + [DOCUMENTS["NFe"].silver]
    return audit_status(bronze_silver_audit(pairs), tables)


@query(
    f"""WITH {ORDERS_SQL}
    SELECT 'missing_keys' AS "check", count(*) AS found FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'headers_without_items', count(*) FROM orders
      WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'repeated_items', count(*) FROM (
      SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def det_audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = header_keys(spark, sf_dir)
    header = source.filter("o_orderstatus <> 'P'")
    return item_audit(source.withColumnRenamed("chave", "CHAVE"), header, item_keys(spark, sf_dir))


# --- partitions -------------------------------------------------------------------------------------------------

_RECONCILED = """
  a AS (SELECT strftime(l_shipdate, '%y%m') AS p, count(DISTINCT l_orderkey) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
  b AS (SELECT strftime(l_shipdate, '%y%m') AS p, count(DISTINCT l_orderkey) AS n FROM lineitem
        WHERE l_returnflag = 'R' AND year(l_shipdate) > 1995 GROUP BY 1),
  r AS (SELECT p AS chave_particao, coalesce(a.n, 0) AS left_documents, coalesce(b.n, 0) AS right_documents,
               coalesce(a.n, 0) - coalesce(b.n, 0) AS difference FROM a FULL JOIN b USING (p))"""


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = item_keys(spark, sf_dir)
    right = lines.filter("l_returnflag = 'R' AND l_shipdate >= TIMESTAMP_NTZ'1996-01-01'")
    return audit.reconcile_partitions(lines.filter("l_returnflag = 'A'"), right)


@query(f"WITH {_RECONCILED} SELECT * FROM r")
def partition_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir)


@query(f"WITH {_RECONCILED} SELECT * FROM r WHERE difference <> 0 ORDER BY difference DESC, chave_particao")
def partition_reconcile_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.differing_partitions(_reconciled(spark, sf_dir))


# --- duplicates -------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys(table(spark, sf_dir, "lineitem"), ITEM_KEYS)


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY 1, l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def duplicate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return audit.duplicate_records(lines, ITEM_KEYS).select(*ITEM_KEYS, "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    """WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
       SELECT strftime(l_shipdate, '%y%m') AS chave_particao, count(*) AS count
       FROM lineitem JOIN d USING (l_orderkey, l_linenumber) GROUP BY 1"""
)
def duplicates_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.count_by(audit.duplicate_records(item_keys(spark, sf_dir), ["l_orderkey", "nItem"]), "chave_particao")


@query("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 100")
def audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of an audit result, for the report."""
    return audit.duplicate_keys(table(spark, sf_dir, "lineitem"), ITEM_KEYS).orderBy(*ITEM_KEYS).limit(100)


_LINE_REST = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def _ranked(keys: str, order: str) -> str:
    return f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag FROM r WHERE rn = 1"""


_KEPT = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]


@query(
    _ranked(
        "l_orderkey",
        "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate",
    )
)
def dedup_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "lineitem"), ["l_orderkey"]).select(*_KEPT)


@query(_ranked("l_orderkey, l_linenumber", _LINE_REST))
def dedup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "lineitem"), ITEM_KEYS).select(*_KEPT)


@query(
    """WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       SELECT CAST(sum(n) AS BIGINT) AS before, count(*) AS after, CAST(sum(n - 1) AS BIGINT) AS removed,
              count(*) FILTER (n > 1) AS repeated_keys FROM g"""
)
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplication_report(table(spark, sf_dir, "lineitem"), ITEM_KEYS)


# --- profile ----------------------------------------------------------------------------------------------------

PROFILED = ["chave", "ide_dhEmi", "emit_CNPJ", "dest_CPF", "ICMSTot_vNF", "ICMSTot_vBC", "pag_detPag", "transp_vol"]
_FILLED = {"chave": 1, "ide_dhEmi": 1, "emit_CNPJ": 1, "dest_CPF": 0, "ICMSTot_vNF": 1, "ICMSTot_vBC": 0, "pag_detPag": 1, "transp_vol": 0}
_PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{name}' AS "column", count(*) AS total, count(*) * {filled} AS non_null, {100.0 * (1 - filled)} AS null_percent FROM orders"""
    for name, filled in _FILLED.items()
)


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(documents(bronze(spark, sf_dir, "nfe"), DOCUMENTS["NFe"], PROFILED), PROFILED)


@query(_PROFILE_SQL, name="null_profile")
def null_profile_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir)


@query(
    """WITH j AS (SELECT o.o_orderkey, l.l_partkey, CASE WHEN l.l_returnflag = 'R' THEN l.l_tax END AS tax
                  FROM orders o LEFT JOIN lineitem l ON l_orderkey = o_orderkey),
            c AS (SELECT 'o_orderkey' AS "column", count(*) AS total, count(o_orderkey) AS non_null FROM j
                  UNION ALL SELECT 'l_partkey', count(*), count(l_partkey) FROM j UNION ALL SELECT 'tax', count(*), count(tax) FROM j)
       SELECT *, round((total - non_null) * 100.0 / total, 4) AS null_percent FROM c"""
)
def null_profile_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    joined = table(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    joined = joined.select("o_orderkey", "l_partkey", F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("tax"))
    return null_profile(joined)


@query(f"""SELECT * FROM ({_PROFILE_SQL}) WHERE null_percent > 99 ORDER BY null_percent DESC, "column" """)
def null_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mostly_null(_profile(spark, sf_dir), 99.0)


@query(f"""SELECT "column", total FROM ({_PROFILE_SQL}) WHERE non_null = 0 ORDER BY 1""")
def null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return empty_columns(_profile(spark, sf_dir)).select("column", "total")


# --- gaps -------------------------------------------------------------------------------------------------------

_PRESENT = "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_discount = 0.1 AND l_tax = 0.08 AND l_returnflag = 'A')"


def _rare_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rare kind of item, so that some days lack it."""
    return table(spark, sf_dir, "lineitem").filter("l_discount = 0.1 AND l_tax = 0.08 AND l_returnflag = 'A'")


@query(
    f"""SELECT CAST(day AS DATE) AS day FROM (
          SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS day FROM {_PRESENT})
        WHERE CAST(day AS DATE) NOT IN (SELECT d FROM {_PRESENT})""",
    name="missing_days",
)
def missing_days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_days(_rare_lines(spark, sf_dir), F.col("l_shipdate"))


@query(
    f"""SELECT CAST(day AS DATE) AS day FROM (
          SELECT unnest(generate_series(DATE '1998-06-20', DATE '1998-06-29', INTERVAL 1 DAY)) AS day)
        WHERE CAST(day AS DATE) NOT IN (SELECT d FROM {_PRESENT})""",
    name="missing_recent_days",
)
def missing_days_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_recent_days(_rare_lines(spark, sf_dir), F.col("l_shipdate"), today="1998-06-30")


@query(
    """SELECT hour FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-11 23:00:00', INTERVAL 1 HOUR)) AS hour)
       WHERE hour NOT IN (SELECT date_trunc('hour', ts) FROM events WHERE event_type = 'error')""",
    name="missing_hours",
)
def missing_hours_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of two days in which no such event was loaded."""
    rare = table(spark, sf_dir, "events").filter("event_type = 'error'")
    return missing_hours(rare, F.col("ts"), "2024-01-10 00:00:00", "2024-01-12 00:00:00")


@query(
    """SELECT '2001' || lpad(CAST(m AS VARCHAR), 2, '0') AS month,
              EXISTS (SELECT 1 FROM orders WHERE year(o_orderdate) = 2001 AND month(o_orderdate) = m) AS present
       FROM (SELECT unnest(generate_series(1, 12)) AS m)""",
    name="months_present",
)
def months_of_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months_present(table(spark, sf_dir, "orders"), F.date_format("o_orderdate", "yyyyMM"), 2001)


@query(
    """SELECT '/bronze/' || event_type AS directory, max(strftime(ts, '%Y%m%d')) AS newest,
              max(strftime(ts, '%Y%m%d')) = '20240130' AS is_current FROM events WHERE event_type <> 'error' OR day(ts) < 20 GROUP BY 1"""
)
def folder_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest day folder per type, from a file listing in which one type stopped early."""
    listing = table(spark, sf_dir, "events").filter("event_type <> 'error' OR day(ts) < 20").select(
        F.concat(F.lit("/bronze/"), "event_type", F.lit("/"), F.date_format("ts", "yyyyMMdd"), F.lit("/part.parquet")).alias("path")
    )
    return late_folders(newest_folder(listing), datetime.date(2024, 1, 31))


@query(
    """WITH n AS (SELECT event_type, max(strftime(ts, '%Y%m%d')) AS newest FROM events WHERE event_type <> 'error' OR day(ts) < 20 GROUP BY 1)
       SELECT newest, count(*) AS count FROM n GROUP BY 1"""
)
def folder_freshness_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many directories end at which day."""
    return audit.count_by(folder_freshness(spark, sf_dir), "newest")


@query(
    """WITH n AS (SELECT event_type, max(strftime(ts, '%Y%m%d')) AS newest, count(DISTINCT strftime(ts, '%d')) AS days FROM events
                  WHERE (event_type <> 'error' OR day(ts) < 20) AND (event_type <> 'signup' OR day(ts) < 30) GROUP BY 1),
           m AS (SELECT event_type, CASE event_type WHEN 'view' THEN '20240131' WHEN 'signup' THEN '20240130' ELSE newest END AS newest FROM n)
       SELECT event_type AS directory, newest, newest <> '20240130' AS wrong_date, event_type IN ('view', 'signup') AS empty,
              event_type NOT IN ('view', 'signup') AS has_files FROM m
       UNION ALL SELECT 'absent', NULL, true, false, false"""
)
def folder_alerts_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real day folders per type: one type stopped early, one has an empty folder of today, one an empty one of yesterday, one directory is not there."""
    root = shared_folder(spark, "folders")
    events = table(spark, sf_dir, "events").filter("(event_type <> 'error' OR day(ts) < 20) AND (event_type <> 'signup' OR day(ts) < 30)")
    events.withColumn("day", F.date_format("ts", "yyyyMMdd")).repartition("day").write.partitionBy("event_type", "day").parquet(root)
    for kind, day in (("view", "20240131"), ("signup", "20240130")):
        mark(spark, f"{root}/event_type={kind}/day={day}")
    names = ["click", "error", "purchase", "signup", "view", "absent"]
    found = folder_alerts(spark, [f"{root}/event_type={name}" for name in names], datetime.date(2024, 1, 31))
    short = F.regexp_extract("directory", "event_type=(.*)$", 1)
    return found.select(short.alias("directory"), F.right("newest", F.lit(8)).alias("newest"), "wrong_date", "empty", (F.col("files") > 0).alias("has_files"))


@query(
    """SELECT CAST(min(o_orderkey) AS BIGINT) AS lower, CAST(max(o_orderkey) AS BIGINT) AS upper, CAST(20 AS BIGINT) AS partitions,
              CAST((max(o_orderkey) - min(o_orderkey)) // 20 AS BIGINT) AS stride FROM orders"""
)
def jdbc_range_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_bounds(bronze(spark, sf_dir, "nfe"), sequence_of("nfe"), 20)
