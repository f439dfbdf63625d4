"""Uniqueness gates: a batch with repeated rows or keys does not get in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateBatchError(ValueError):
    """The batch holds repeated rows or keys."""


def uniqueness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: total, distinct_total, is_unique; over ``columns`` or over whole rows.

    Whole rows are compared by a digest, so that the shuffle carries 64 characters and not the document. Equal keys are
    merged before the shuffle, and NULL counts as one value.
    """
    if columns is None:
        keyed = df.select(F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256).alias("__row"))
        columns = ["__row"]
    else:
        keyed = df.select(*columns)
    counted = keyed.groupBy(*columns).agg(F.count("*").alias("__rows"))
    totals = counted.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("total"), F.count("*").alias("distinct_total"))
    return totals.withColumn("is_unique", F.col("total") == F.col("distinct_total"))


def require_unique(df: DataFrame, columns: Sequence[str] | None = None) -> int:
    """Number of rows; raises :class:`DuplicateBatchError` if some repeat."""
    row = uniqueness(df, columns).first()
    if not row.is_unique:
        what = ", ".join(columns) if columns else "the whole row"
        raise DuplicateBatchError(f"{row.total} rows but {row.distinct_total} distinct by {what}")
    return row.total
