"""Reads of stored data. Schemas are given where known, so nothing is inferred and `0512` stays text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader

from fisclake.functions.keys import PARTITION

KEY_LIST = T.StructType([T.StructField("chave", T.StringType())])


def _reader(spark: SparkSession, schema: T.StructType | None) -> DataFrameReader:
    return spark.read.schema(schema) if schema is not None else spark.read


def read_folder(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return _reader(spark, schema).parquet(path)


def read_table(spark: SparkSession, path: str, partitions: Sequence[str] = (PARTITION,), folders: Sequence[str] | None = None) -> DataFrame:
    """A partitioned table, or some of its partition folders, with the partition columns as text. No folders: no rows.

    Left to infer, Spark reads `0512` as the number 512, and a rewrite would then rename the partition.
    """
    if folders is not None and not folders:
        return read_table(spark, path, partitions).filter(F.lit(False))
    reader = spark.read.option("basePath", path)
    paths = [f"{path}/{folder}" for folder in folders] if folders else [path]
    if spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "false":
        return reader.parquet(*paths)
    text = {name.lower() for name in partitions}
    fields = [T.StructField(f.name, T.StringType()) if f.name.lower() in text else f for f in reader.parquet(*paths).schema.fields]
    return reader.schema(T.StructType(fields)).parquet(*paths)


def read_files(spark: SparkSession, files: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Exactly the listed files."""
    return _reader(spark, schema).parquet(*files)


def read_parquet_files_only(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The ``*.parquet`` files of a folder that also holds others."""
    return _reader(spark, schema).option("pathGlobFilter", "*.parquet").parquet(path)


def read_glob(spark: SparkSession, pattern: str, base: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """All folders that match; ``base`` keeps the partition columns below it."""
    reader = _reader(spark, schema)
    return (reader.option("basePath", base) if base else reader).parquet(pattern)


def in_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """Only the partitions of one month, whether they are called ``month=4`` or ``month=04``."""
    same_month = F.col("month").cast("string").isin(str(month), f"{month:02d}")
    return df.filter((F.col("year").cast("string") == str(year)) & same_month)


def read_key_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KEY_LIST).option("header", True).csv(path)


def listed(df: DataFrame, keys: DataFrame, key: str = "CHAVE", list_key: str = "chave") -> DataFrame:
    """Rows whose key is in the list. No hint: Spark broadcasts the list if it measures small enough."""
    return df.join(keys.select(F.col(list_key).alias(key)), key, "left_semi")


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | None = None) -> DataFrame:
    """XML files, one row per ``row_tag``. Without a schema the columns are inferred, all leaves as text."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("inferSchema", False)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Months whose columns differ; what a month lacks is NULL."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
