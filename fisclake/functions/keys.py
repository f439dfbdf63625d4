"""The 44-digit access key: digits 3 to 6 are year and month of issue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION = "chave_particao"


def partition_key(key: str | Column = "chave") -> Column:
    return F.substring(key, 3, 4)


def with_partition_key(df: DataFrame, key: str = "chave") -> DataFrame:
    return df.withColumn(PARTITION, partition_key(key))
