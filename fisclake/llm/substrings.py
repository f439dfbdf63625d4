"""Removal of repeated passages: windows repeated at one length are extended to twice that length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import BASES, NOT_SPACE, Texts, find_words, mixed, ragged, release, span_hashes, stored, text_chunks

_C1, _C2 = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
#: Bytes of text whose windows are held at a time.
BATCH_BYTES = 1_000_000
#: Rows without an id come after all others.
NO_ID = (1 << 63) - 1
#: What tells rows apart: the id, and 128 bits of hashes of the text, as ids may repeat.
KEY = ("id", "kind", "kind2")


def leftmost_minima(values: np.ndarray, size: int) -> np.ndarray:
    """Where the smallest of each ``size`` consecutive values stands, the first if there are several."""
    best, at, width = values, np.arange(len(values)), 1
    while width < size:
        shift = min(width, size - width)
        later = best[shift:] < best[:-shift]
        at = np.where(later, at[shift:], at[:-shift])
        best = np.where(later, best[shift:], best[:-shift])
        width += shift
    return at


def doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows twice as long as the given ones of ``size`` words."""
    return mixed(hashes[:-size] * _C1 + hashes[size:] * _C2)


class Windows:
    """The windows of some texts. Word numbers run through all the texts; ``first[i]`` is the first word of text ``i``."""

    def __init__(self, texts: Texts, window: int, base: int = BASES[0]) -> None:
        self.quarter, self.window = window // 4, window
        starts, ends, self.first = find_words(texts.bytes, texts.offsets, NOT_SPACE)
        words = span_hashes(texts.bytes, starts, ends, base)
        count = np.diff(self.first)
        #: Starts of the windows that lie within one text, and the text of each.
        self.starts = ragged(self.first[:-1], np.maximum(count - window + 1, 0))
        self.text = np.repeat(np.arange(len(texts)), np.maximum(count - window + 1, 0))
        if not len(self.starts):
            self.short = self.half = self.full = self.anchor = np.zeros(0, np.uint64)
            return
        n, q = len(words), self.quarter
        self.short = mixed(sum(words[k : n - q + 1 + k] * mixed(np.full(1, k + 1, np.uint64)) for k in range(q)))
        self.half = doubled(self.short, q)
        self.full = doubled(self.half, 2 * q)
        #: For each of ``starts``, where its anchor begins: the quarter-length window in it whose hash is smallest.
        self.anchor = leftmost_minima(self.short, window - q + 1)[self.starts]

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last (in ``starts``) of each run of windows that share a text and an anchor."""
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        new = np.flatnonzero(np.r_[True, np.diff(self.anchor) != 0])
        return new, np.r_[new[1:], len(self.starts)] - 1


def _rows(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    return documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64(text).alias("kind"),
        F.xxhash64(F.lit(1), text).alias("kind2"),  # the literal first: its hash is the seed of the text's
        F.coalesce(text, F.lit("")).alias("text"),
    )


def _arrow(names: str, *columns: np.ndarray | pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _anchors(rows: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "text", BATCH_BYTES):
            w = Windows(texts, window)
            first, _ = w.blocks()
            if len(first):
                of = w.text[first]
                keys = [np.asarray(part.column(c))[of] for c in KEY]
                at = w.anchor[first]
                yield _arrow("hash id kind kind2 at", w.short[at].view(np.int64), *keys, (at - w.first[of]).astype(np.int32))

    return rows.mapInArrow(run, "hash long, id long, kind long, kind2 long, at int")


def _repeated(df: DataFrame, *key: str) -> DataFrame:
    """The rows of ``df`` whose key another row has too: keys are counted before they move, then the rows are looked up.

    The keys are written first: adaptive execution splits a hot key only in a join of two plain exchanges."""
    several = stored(df.groupBy(*key).agg(F.count("*").alias("__n")).filter("__n > 1").select(*key), "repeated-keys")
    release(df.sparkSession)
    return df.join(several, list(key), "left_semi")


def _with_text(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The texts in which something was found, with the ascending places of it."""
    places = found.groupBy(*KEY).agg(F.array_sort(F.collect_set("at")).alias("places"))
    return rows.join(places, list(KEY))


def _places(part: pa.RecordBatch, w: Windows) -> np.ndarray:
    """Word numbers of the places of each text."""
    places = part.column("places")
    per_text = np.asarray(pc.list_value_length(places), np.int64)
    return np.asarray(pc.list_flatten(places), np.int64) + np.repeat(w.first[:-1], per_text)


def _blocks(candidates: DataFrame, window: int) -> DataFrame:
    """Windows around each surviving anchor, as one row: a hash of 128 bits over all of them, and the hashes of the two windows of twice
    the anchor's length that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "text", BATCH_BYTES):
            w, other = Windows(texts, window), Windows(texts, window, BASES[1])
            first, last = w.blocks()
            if not len(first):
                continue
            kept = np.isin(w.anchor[first], _places(part, w))
            first, last = first[kept], last[kept]
            if not len(first):
                continue
            of, at, size = w.text[first], w.anchor[first], last - first + 1
            inside = ragged(first, size)
            within = (inside - np.repeat(first, size)).astype(np.uint64)
            cuts = np.cumsum(size) - size
            codes = [np.add.reduceat(mixed(full[w.starts[inside]] + within * _C1), cuts) + size.astype(np.uint64) * _C2 + (at - w.starts[first]).astype(np.uint64) for full in (w.full, other.full)]
            # An anchor far to the right in a window is extended to the left.
            q = w.quarter
            near, far = at - w.starts[last] <= 2 * q, at - w.starts[first] > 2 * q
            ahead = pa.array(w.half[np.where(near, at, 0)].view(np.int64), mask=~near)
            back = pa.array(w.half[np.where(far, at - q, 0)].view(np.int64), mask=~far)
            keys = [np.asarray(part.column(c))[of] for c in KEY]
            base = w.first[of]
            yield _arrow(
                "code code2 id kind kind2 at first last ahead back", *(c.view(np.int64) for c in codes), *keys,
                *((x - base).astype(np.int32) for x in (at, w.starts[first], w.starts[last])), ahead, back,
            )

    return candidates.mapInArrow(run, "code long, code2 long, id long, kind long, kind2 long, at int, first int, last int, ahead long, back long")


def _windows(candidates: DataFrame, window: int) -> DataFrame:
    """A row for each window around the surviving anchors; ``places`` has twice the anchor, plus one for those extended to the left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_chunks(batches, "text", BATCH_BYTES):
            w, other = Windows(texts, window), Windows(texts, window, BASES[1])
            if not len(w.starts):
                continue
            base = w.first[w.text]
            mark = np.repeat(2 * w.first[:-1], np.asarray(pc.list_value_length(part.column("places")), np.int64))
            marks = np.asarray(pc.list_flatten(part.column("places")), np.int64) + mark
            kept = np.isin(2 * w.anchor + (w.anchor - w.starts > 2 * w.quarter), marks)
            starts, of = w.starts[kept], w.text[kept]
            keys = [np.asarray(part.column(c))[of] for c in KEY]
            yield _arrow(
                "code code2 id kind kind2 start", w.full[starts].view(np.int64), other.full[starts].view(np.int64), *keys, (starts - base[kept]).astype(np.int32)
            )

    return candidates.mapInArrow(run, "code long, code2 long, id long, kind long, kind2 long, start int")


def _marked(df: DataFrame, place: str, *columns: str) -> DataFrame:
    """``columns`` of ``df``, and ``later``: whether the row comes after the first with its codes. Written once, read for either kind."""
    first = df.groupBy("code", "code2").agg(F.count("*").alias("n"), F.min(F.struct("id", place)).alias("earliest")).filter("n > 1").drop("n")
    first = stored(first, "first")
    release(df.sparkSession)
    both = df.join(first, ["code", "code2"], "left")
    return stored(both.select(*columns, F.coalesce(F.struct("id", place) > F.col("earliest"), F.lit(False)).alias("later")), "marked")


def repeated_spans(documents: DataFrame, window: int = 20, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``kind`` and ``kind2`` (hashes of the text), ``first``, ``last``: starts of windows whose word sequence also starts earlier."""
    if window < 4 or window % 4:
        raise ValueError("window must be a multiple of four")
    spark = documents.sparkSession
    rows = _rows(documents, id_column, text)
    # Level one. Every window has an anchor chosen by what it holds: equal windows have equal anchors at equal places.
    anchors = stored(_repeated(_anchors(rows, window), "hash").select(*KEY, "at"), "anchors")
    release(spark)
    # Blocks of windows around one anchor that are alike from end to end need no look at their windows: all but the first block go.
    blocks = stored(_blocks(_with_text(rows, anchors), window), "blocks")
    release(spark)
    marked = _marked(blocks, "at", *KEY, "at", "first", "last", "ahead", "back")
    release(spark)
    whole, rest = marked.filter("later").select(*KEY, "first", "last"), marked.filter("not later")
    # Level two, among the blocks that are left.
    halves = rest.select(*KEY, (F.col("at") * 2).alias("at"), F.col("ahead").alias("hash")).union(
        rest.select(*KEY, (F.col("at") * 2 + 1).alias("at"), F.col("back").alias("hash"))
    )
    twice = stored(_repeated(halves.filter("hash is not null"), "hash").select(*KEY, "at"), "anchors-twice")
    release(spark)
    # Level three: the windows themselves.
    windows = stored(_windows(_with_text(rows, twice), window), "windows")
    release(spark)
    single = _marked(windows, "start", *KEY, "start").filter("later")
    release(spark)
    return whole.union(single.select(*KEY, F.col("start").alias("first"), F.col("start").alias("last")))


def remove_repeats(documents: DataFrame, window: int = 20, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_column``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by one space) of every row.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window`` consecutive words covers it whose word sequence
    starts earlier too: in a row with a smaller id, or further ahead in the same one. Windows are judged on the input.

    Levels: windows of a quarter of the length, of half, and of the whole. Only anchors (of each window, the quarter with the smallest
    hash) enter the first level. Full windows are compared by 128 bits of hashes.

    Null texts have no words, and texts shorter than a window lose none. Rows without id come last. Of rows with the same id none
    is earlier than the other: at the same start they don't remove each other's words, so that repeated rows all stay as they are
    (unless an earlier row has their words). No rows: no rows. Other columns, whatever their names, are not looked at.
    """
    spans = repeated_spans(documents, window, id_column, text)
    gone = spans.groupBy(*KEY).agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))
    joined = _rows(documents, id_column, text).join(gone, list(KEY), "left").select("id", "text", "first", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, total, removed = [], [], []
            for words, first, last in zip(batch.column("text"), batch.column("first"), batch.column("last"), strict=True):
                words = words.as_py().encode().split()
                total.append(len(words))
                if first.is_valid:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, np.asarray(first.values), 1)
                    np.subtract.at(change, np.asarray(last.values) + window, 1)
                    words = [x for x, covered in zip(words, (np.cumsum(change)[:-1] > 0).tolist(), strict=True) if not covered]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield _arrow("id n_words n_removed kept", batch.column("id"), np.array(total, np.int64), np.array(removed, np.int64), pa.array(kept, pa.string()))

    result = joined.mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    return result.select(F.nullif("id", F.lit(NO_ID)).alias(id_column), "n_words", "n_removed", "kept")


def kept_digest(result: DataFrame) -> DataFrame:
    """``kept`` as its SHA-256."""
    return result.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")

