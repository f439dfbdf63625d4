"""External tables over silver folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fisclake.functions.keys import PARTITION


def data_columns(spark: SparkSession, path: str, partition: str = PARTITION) -> T.StructType:
    """Columns of the files without the partition column."""
    schema = spark.read.parquet(path).schema
    return T.StructType([f for f in schema.fields if f.name.lower() != partition.lower()])


def create_table(spark: SparkSession, name: str, path: str, partition: str = PARTITION) -> None:
    """External table over a folder; its partition column is text."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in data_columns(spark, path, partition).fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}, `{partition}` STRING) USING parquet PARTITIONED BY (`{partition}`) LOCATION '{path}'"
    )
    discover_partitions(spark, name)


def replace_table(spark: SparkSession, name: str, path: str, partition: str = PARTITION) -> None:
    """Define the table anew. The old one stays until the new definition has been built and its partitions found.

    A run that was cut off between dropping and renaming left only the new definition: it gets the name first, so that there is a table while
    the definition is built again.
    """
    building = f"{name}_building"
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(building):
        spark.sql(f"ALTER TABLE {building} RENAME TO {name}")
        discover_partitions(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {building}")
    try:
        create_table(spark, building, path, partition)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {building}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {building} RENAME TO {name}")


def discover_partitions(spark: SparkSession, name: str) -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


def partitions(spark: SparkSession, name: str, partition: str = PARTITION) -> DataFrame:
    """The partitions the catalog knows."""
    return spark.sql(f"SHOW PARTITIONS {name}").selectExpr(f"substring(partition, {len(partition) + 2}) AS {partition}")


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop external tables; their data stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
