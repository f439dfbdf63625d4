"""How empty the columns of a table are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: total, non_null, null_percent. One scan and one aggregate, however many columns."""
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.array(*(F.count(f"`{name}`") for name in columns)).alias("counts"))
    named = F.arrays_zip(F.array(*map(F.lit, columns)).alias("column"), F.col("counts").alias("non_null"))
    long = counts.select("total", F.inline(named)).select("column", "total", "non_null")
    share = F.when(F.col("total") > 0, (F.col("total") - F.col("non_null")) * 100.0 / F.col("total"))
    return long.withColumn("null_percent", F.round(share, 4))


def empty_columns(profile: DataFrame) -> DataFrame:
    return profile.filter("total > 0 AND non_null = 0").orderBy("column")


def mostly_null(profile: DataFrame, threshold: float) -> DataFrame:
    """Columns with more than ``threshold`` percent NULLs, worst first."""
    return profile.filter(F.col("null_percent") > threshold).orderBy(F.desc("null_percent"), "column")
