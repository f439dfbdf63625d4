"""Audits made of several comparisons, as result tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.functions.keys import PARTITION
from fisclake.operators.audit import distinct_keys_except, duplicate_keys, missing_in_silver
from fisclake.operators.parse import route
from fisclake.plans.load import Target, touched_folders
from fisclake.registry import AUDITED, DocumentType
from fisclake.sources.scans import in_month, read_table
from fisclake.sources.storage import child_folders


def item_audit(bronze: DataFrame, header: DataFrame, items: DataFrame, item_key: Sequence[str] = ("chave", "nItem")) -> DataFrame:
    """The three checks of an item table, one row each: keys missing, headers without items, repeated items."""
    checks = {
        "missing_keys": missing_in_silver(bronze, header),
        "headers_without_items": distinct_keys_except(header, items, "chave", "chave"),
        "repeated_items": duplicate_keys(items, item_key),
    }
    result = None
    for name, rows in checks.items():
        row = rows.agg(F.count("*").alias("found")).select(F.lit(name).alias("check"), "found")
        result = row if result is None else result.unionByName(row)
    return result


def bronze_silver_audit(pairs: Iterable[tuple[DocumentType, DataFrame, DataFrame]]) -> DataFrame:
    """Bronze keys that silver lacks, for each (type, bronze, silver): table, key.

    Documents are compared by access key, events and cancellations by sequence number, both as text.
    """
    result = None
    for kind, bronze, silver in pairs:
        missing = distinct_keys_except(route(bronze, kind), silver, *kind.audit_keys, name="key")
        rows = missing.select(F.lit(kind.silver).alias("table"), "key")
        result = rows if result is None else result.unionByName(rows)
    return result


def silver_of(bronze: DataFrame, kind: DocumentType, path: str) -> DataFrame:
    """The part of a silver table where the documents of ``bronze`` must be; all of it where sequence numbers are compared, which say
    nothing of the partition, or where the table has no partitions."""
    spark = bronze.sparkSession
    by_key = kind.audit_keys[0] != kind.sequence
    if not by_key or not any(name.startswith(f"{PARTITION}=") for name in child_folders(spark, path)):
        return spark.read.parquet(path)
    return read_table(spark, path, folders=touched_folders(bronze, Target(path)))


def full_audit(spark: SparkSession, bronze_root: str, silver_root: str, year: int, month: int,
               kinds: Sequence[DocumentType] = AUDITED) -> DataFrame:
    """The audit of one month over all tables, from the day archive and the silver folders.

    Of a table compared by access key only the partitions its month's keys belong to are read: a key says where its row lies.
    """
    pairs = []
    for kind in kinds:
        bronze = in_month(spark.read.parquet(f"{bronze_root}/{kind.bronze}"), year, month)
        pairs.append((kind, bronze, silver_of(route(bronze, kind), kind, f"{silver_root}/{kind.silver}")))
    return bronze_silver_audit(pairs)


# The two outcomes of an audit.
SUCCESS = "SUCESSO"
ATTENTION = "ATENÇÃO"


def outcome(problems: Column) -> Column:
    return F.when(problems == 0, SUCCESS).otherwise(ATTENTION)


def audit_status(audit: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Per table the number of missing keys and the outcome; tables without findings are listed too."""
    names = audit.sparkSession.createDataFrame([(name,) for name in tables], "table string")
    counted = names.join(audit.groupBy("table").agg(F.count("*").alias("missing")), "table", "left")
    return counted.na.fill(0, ["missing"]).withColumn("status", outcome(F.col("missing")))


# The phrases of the audit log and what they count.
MISSING_LINE = (
    r"(?:Total de (?:CHAVEs não encontradas|(?:NSU|NSUDF|NSUSVD)s não encontrados) no prata|"
    r"Quantidade de chaves faltantes encontradas): *(\d+)"
)
AUDITED_LINE = r"Processando documento(?: com (?:NSU|NSUDF|NSUSVD))?:"
REPEATED_LINE = r"Duplicidades? encontradas?"
ERROR_LINE = r"ERRO|Exception"
FOLDER_LINE = "Verificando diretório:"
FILES_LINE = r"Quantidade de arquivos: *(\d+)"


EMPTY_LINE = "A última pasta está VAZIA"


def _metrics() -> list[Column]:
    message = F.col("message")

    def number(pattern: str) -> Column:
        return F.coalesce(F.sum(F.regexp_extract(message, pattern, 1).try_cast("bigint")), F.lit(0).cast("bigint"))

    return [
        F.count_if(message.rlike(AUDITED_LINE)).alias("audited"),
        F.count_if(message.rlike(ERROR_LINE)).alias("errors"),
        number(MISSING_LINE).alias("missing"),
        F.count_if(message.rlike(REPEATED_LINE)).alias("repeated"),
        F.count_if(message.contains(FOLDER_LINE)).alias("folders"),
        number(FILES_LINE).alias("files"),
    ]


def log_metrics(log: DataFrame) -> DataFrame:
    """One row of counts over an audit log (``at``, ``message``) and its outcome."""
    return log.agg(*_metrics()).withColumn("status", outcome(F.col("missing") + F.col("repeated") + F.col("errors")))


def section_metrics(log: DataFrame) -> DataFrame:
    """The same for each section of a log (one per table or folder, whatever order its files and splits are read in), with its first and last time; what
    stands before any section has the name ``''``."""
    named = log.withColumn("section", F.coalesce("section", F.lit("")))
    empty = F.count_if(F.col("message").contains(EMPTY_LINE)).alias("empty")
    found = named.groupBy("section").agg(*_metrics(), empty, F.min("at").alias("begun"), F.max("at").alias("ended"))
    return found.withColumn("status", outcome(F.col("missing") + F.col("repeated") + F.col("errors") + F.col("empty")))
