"""Deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by all other columns in their order, so reruns keep the same one. NULL is a key.

    Only the keys are shuffled to find the repeated ones. Rows of all other keys pass through untouched: with few repeats,
    which is the rule, the list of repeated keys measures small enough to be broadcast and no wide row moves. Of a repeated
    key each task keeps one row before the shuffle (the minimum of a struct), so one key may hold a third of all rows;
    ranking by a window would sort it in a single task.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    names = {name: f"__key_{i}" for i, name in enumerate(keys)}
    repeated = df.groupBy(*keys).agg(F.count("*").alias("__rows")).filter("__rows > 1").drop("__rows").withColumnsRenamed(names)
    same = reduce(and_, (df[name].eqNullSafe(repeated[renamed]) for name, renamed in names.items()))
    single = df.join(repeated, same, "left_anti")
    kept = df.join(repeated, same, "left_semi").groupBy(*keys).agg(F.min(F.struct(*others)).alias("__kept"))
    return single.unionByName(kept.select(*keys, "__kept.*").select(*df.columns))


def deduplication_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows before, rows after, rows removed, repeated keys."""
    counted = df.groupBy(*keys).agg(F.count("*").alias("__rows"))
    return counted.agg(
        F.sum("__rows").alias("before"),
        F.count("*").alias("after"),
        F.sum(F.col("__rows") - 1).alias("removed"),
        F.count_if(F.col("__rows") > 1).alias("repeated_keys"),
    )
