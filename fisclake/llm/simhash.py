"""SimHash near-duplicates: 64-bit fingerprints, compared exactly tile by tile."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fisclake.llm.components import components
from fisclake.llm.shared import NOT_SPACE, Texts, find_words, stored, text_chunks, unpacked, whole_row

#: Fingerprints per tile. Two tiles of the largest size take 2 MB to compare.
TILE = 512
#: The population count of a fingerprint is taken for each of so many equal parts of it.
PARTS = 4
_QUARTER = (1 << 16) - 1


def fingerprints_of(texts: Texts, shingle: int, seed: int = 42) -> np.ndarray:
    """Fingerprint of each text: a bit is set if it is set in over half of the hashes of its shingles, repeats included."""
    result = np.zeros(len(texts), np.uint64)
    lowered = texts.bytes.tobytes().lower()
    starts, ends, first = find_words(texts.bytes, texts.offsets, NOT_SPACE)
    digest = xxhash.xxh64_intdigest
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if a == b:
            continue
        n = b - a
        begin, end = int(texts.offsets[i]), int(texts.offsets[i + 1])
        joined = b" ".join(lowered[begin:end].split())
        # Where the words stand in the text with single spaces between them.
        lengths = ends[a:b] - starts[a:b]
        close = np.cumsum(lengths) + np.arange(n)
        opened = (close - lengths).tolist()
        size = min(shingle, n)
        close = close[size - 1 :].tolist()
        hashes = np.array([digest(joined[s:e], seed) for s, e in zip(opened, close, strict=False)], np.uint64)
        set_bits = np.zeros(64, np.int64)
        for part in range(0, len(hashes), 1 << 16):
            block = hashes[part : part + (1 << 16)]
            bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            set_bits += bits.sum(axis=0, dtype=np.int64)
        result[i] = np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0]
    return result


def fingerprints(documents: DataFrame, shingle: int = 3, id_column: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """``id``, ``fingerprint`` (the 64 bits as a long) and ``more`` long columns of every row."""
    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"), *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "text"):
            own = pa.array(fingerprints_of(texts, shingle).view(np.int64))
            yield pa.RecordBatch.from_arrays([part.column("id"), own, *map(part.column, more)], ["id", "fingerprint", *more])

    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in ("id", "fingerprint", *more)))


def tile_of(fingerprint: str = "fingerprint") -> Column:
    """Population counts of the four quarters, as one number in base 32."""
    counts = [F.bit_count(F.shiftrightunsigned(F.col(fingerprint), 16 * i).bitwiseAND(F.lit(_QUARTER))) for i in range(PARTS)]
    return sum((c.cast("long") * 32**i for i, c in enumerate(counts)), F.lit(0)).cast("int")


def neighbour_steps(radius: int) -> list[int]:
    """Differences of tile numbers whose counts differ by ``radius`` in sum at most; one of each pair of opposites."""
    steps = itertools.product(range(-radius, radius + 1), repeat=PARTS)
    return sorted({s for x in steps if sum(map(abs, x)) <= radius and (s := sum(v * 32**i for i, v in enumerate(x))) >= 0})


class Forest:
    """Spanning links of what a task has found connected."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.root(x), self.root(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def link_tiles(left: np.ndarray, right: np.ndarray, radius: int, forest: Forest) -> None:
    """Joins in ``forest`` whatever lies within ``radius`` bits: every left against every right fingerprint."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    rows, columns = np.nonzero(near)
    if len(rows) > 4 * TILE:
        # Dense: pass the smallest row number around until it stays, then join each to the row of that number.
        far, of_row = len(left), np.arange(len(left))
        while True:
            of_column = np.where(near, of_row[:, None], far).min(axis=0)
            reached = np.minimum(of_row, np.where(near, of_column[None, :], far).min(axis=1))
            if (reached == of_row).all():
                break
            of_row = reached
        linked = np.flatnonzero(of_column < far)
        pairs = zip(np.concatenate([left, right[linked]]).tolist(), left[np.concatenate([of_row, of_column[linked]])].tolist(), strict=True)
    else:
        pairs = zip(left[rows].tolist(), right[columns].tolist(), strict=True)
    for x, y in pairs:
        if x != y:
            forest.join(x, y)


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints within ``radius`` bits: every pair is joined directly or by others.

    Tiles hold fingerprints with the same population counts in each quarter, in parts of about ``TILE``. Two tiles are compared, by
    exclusive-or and bit counts, unless their counts differ by more than ``radius`` in sum: then so do any two fingerprints in them.
    A task passes on one link for each fingerprint that it connects, not the pairs.
    """
    distinct = prints.select("fingerprint").distinct().withColumn("tile", tile_of())
    sizes = distinct.groupBy("tile").agg(F.ceil(F.count("*") / TILE).alias("parts"))
    tiles = (
        distinct.join(F.broadcast(sizes), "tile")  # at most 17 ** PARTS rows, whatever the input
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")))
        .groupBy("tile", "part")
        .agg(F.collect_list("fingerprint").alias("members"))
    )
    tiles = stored(tiles, "simhash-tiles")
    left = tiles.select(F.explode(F.array(*map(F.lit, neighbour_steps(radius)))).alias("step"), "tile", F.col("part").alias("part_a"), F.col("members").alias("left"))
    left = left.select((F.col("tile") + F.col("step")).alias("tile"), "step", "part_a", "left")
    pairs = left.join(tiles, "tile").filter("step > 0 or part_a <= part").select("left", F.col("members").alias("right"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = Forest()
        for frame in frames:
            for a, b in zip(frame["left"], frame["right"], strict=True):
                link_tiles(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64), radius, forest)
        nodes = np.fromiter((x for x in forest.parent if forest.root(x) != x), np.uint64)
        roots = np.fromiter((forest.root(int(x)) for x in nodes), np.uint64, len(nodes))
        yield pd.DataFrame({"a": nodes.view(np.int64), "b": roots.view(np.int64)})

    return pairs.mapInPandas(run, "a long, b long")


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_column``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    Words are runs of anything but ASCII white space, A-Z lower-cased; shingles of ``shingle`` words count with repeats, and a text of
    fewer words is one shingle. Texts are linked if their fingerprints differ in ``radius`` bits at most; ``component_id`` is the
    smallest id that can be reached, the row's own included.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Rows with the same id are linked only by their
    fingerprints. A null id takes no part in the minimum; a component of null ids alone has a null ``component_id``. No rows: no rows.
    Other columns, whatever their names, are not looked at.
    """
    prints = stored(fingerprints(documents, shingle, id_column, text), "simhash")
    classes = prints.groupBy("fingerprint").agg(F.min("id").alias("least"))
    roots = components(links(prints, radius))
    together = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = together.groupBy("root").agg(F.min("least").alias("component_id"))
    named = together.select("fingerprint", "root").join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(documents: DataFrame, shingle: int = 3, radius: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``documents`` for each group of near-duplicates: that with the smallest id (of the same id, the smallest hash of the
    text). Rows without id stay only where no row of their group has one; of repeated rows one stays."""
    marked = documents.select(whole_row(documents), F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("kind"), F.col(text).alias("text"))
    keyed = marked.select(F.coalesce("id", F.lit(0)).alias("key"), F.col("id").isNull().alias("bare"), "kind", "kept")
    prints = stored(fingerprints(marked, shingle, "id", "text", "kind"), "simhash")
    roots = components(links(prints, radius)).withColumnRenamed("node", "fingerprint")
    first = F.min(F.struct(F.col("id").isNull().alias("bare"), F.coalesce("id", F.lit(0)).alias("key"), "kind")).alias("first")
    groups = prints.groupBy("fingerprint").agg(first).join(roots, "fingerprint", "left").groupBy(F.coalesce("root", "fingerprint")).agg(F.min("first").alias("first"))
    chosen = stored(groups.select("first.*"), "simhash-kept")
    same = ["key", "bare", "kind"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64("kept")))
    return unpacked(keyed.join(chosen, same, "left_semi").withColumn("nth", nth).filter("nth = 1"), documents)
