"""Benchmark decontamination: each shard of the documents gets an FM-index, in which the test phrases are searched."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fisclake.llm.fmindex import FMIndex
from fisclake.llm.shared import ALPHANUMERIC, BASES, LOWER, Texts, find_words, ragged, span_hashes, stored, text_chunks, unpacked, whole_row

#: Words of test items searched at a time; more items are searched block by block.
BLOCK_WORDS = 500_000

#: Bytes of text in a shard, which has an index of its own.
SHARD_BYTES = 1_000_000

_SPANS = "array<struct<start:int,end:int>>"


class Phrases:
    """The distinct windows of some items as two hashes per word, and the items that hold each."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        texts = Texts(pa.array([t for _, t in items], pa.large_string()))
        data = LOWER[texts.bytes]
        starts, ends, first = find_words(data, texts.offsets, ALPHANUMERIC)
        hashes = [span_hashes(data, starts, ends, base) for base in BASES]
        found: dict[tuple[bytes, bytes], set[str]] = {}
        for (name, _), begin, end in zip(items, first[:-1].tolist(), first[1:].tolist(), strict=True):
            size = min(window, end - begin)
            for s in range(begin, end - size + 1) if size else ():
                found.setdefault(tuple(h[s : s + size].tobytes() for h in hashes), set()).add(name)
        self.names = [sorted(names) for names in found.values()]
        self.lengths = np.array([len(a) // 8 for a, _ in found], np.int64)
        self.words = [np.zeros((len(found), window), np.uint64) for _ in BASES]
        for i, key in enumerate(found):
            for table, own in zip(self.words, key, strict=True):
                table[i, : self.lengths[i]] = np.frombuffer(own, np.uint64)


def _blocks(benchmark: DataFrame, id_column: str, text: str, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """Items, never more at a time than ``block_words`` words (a longer item comes alone)."""
    block, words = [], 0
    items = benchmark.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"), F.col(text).alias("text"))
    for item in items.filter("text is not null").toLocalIterator():
        size = len(item["text"].split()) + item["text"].count("-")
        if block and words + size > block_words:
            yield block
            block, words = [], 0
        block.append((item["name"], item["text"]))
        words += size
    yield block


def hits(texts: Texts, phrases: Phrases, sample: int = 16) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of every word, first word of each text, and phrase and first word of each occurrence."""
    data = LOWER[texts.bytes]
    starts, ends, first = find_words(data, texts.offsets, ALPHANUMERIC)
    none = np.zeros(0, np.int64)
    if not len(starts) or not len(phrases.names):
        return starts, ends, first, none, none
    words = span_hashes(data, starts, ends, BASES[0])
    vocabulary, symbols = np.unique(words, return_inverse=True)
    # Symbol 1 ends a text; no phrase holds it.
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    place = np.arange(len(words)) + text_of
    sequence = np.ones(len(words) + len(texts), np.int64)
    sequence[place] = symbols + 2
    asked = np.searchsorted(vocabulary, phrases.words[0])
    known = vocabulary[np.minimum(asked, len(vocabulary) - 1)] == phrases.words[0]
    inside = np.arange(asked.shape[1])[None, :] < phrases.lengths[:, None]
    possible = np.flatnonzero((known | ~inside).all(axis=1))
    if not len(possible):
        return starts, ends, first, none, none
    index = FMIndex(sequence, len(vocabulary) + 1, sample)
    which, at = index.occurrences(asked[possible] + 2, phrases.lengths[possible])
    which = possible[which]
    word = np.searchsorted(place, at)
    if len(which):  # the same words by another hash too
        other = span_hashes(data, starts, ends, BASES[1])
        size = phrases.lengths[which]
        where, column = ragged(word, size), ragged(np.zeros(len(size), np.int64), size)
        same = other[where] == phrases.words[1][np.repeat(which, size), column]
        right = np.logical_and.reduceat(same, np.cumsum(size) - size)
        which, word = which[right], word[right]
    return starts, ends, first, which, word


def _search(documents: DataFrame, phrases: Phrases) -> DataFrame:
    """Adds what the phrases hit in ``text`` to ``covered`` (ranges of words, merged), ``spans`` and ``items``."""
    shared = documents.sparkSession.sparkContext.broadcast(phrases)  # of BLOCK_WORDS words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part, texts in text_chunks(batches, "text", SHARD_BYTES):
            starts, ends, first, which, word = hits(texts, own)
            of = np.searchsorted(first, word, side="right") - 1
            covered, items = part.column("covered").to_pylist(), part.column("items").to_pylist()
            spans = part.column("spans").to_pylist()
            if len(which):
                letters = np.r_[0, np.cumsum((texts.bytes & 0xC0) != 0x80)]  # code points up to each byte
                order = np.argsort(of, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
                    i = int(of[rows[0]])
                    mark = np.zeros(int(first[i + 1] - first[i]) + 1, np.int64)
                    begin = word[rows] - first[i]
                    np.add.at(mark, begin, 1)
                    np.subtract.at(mark, begin + own.lengths[which[rows]], 1)
                    for r in covered[i]:
                        mark[r["start"]] += 1
                        mark[r["end"]] -= 1
                    inside = np.r_[0, np.cumsum(mark) > 0, 0].astype(np.int8)
                    edges = np.diff(inside)
                    ranges = list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True))
                    covered[i] = [{"start": a, "end": b} for a, b in ranges]
                    zero = letters[texts.offsets[i]]
                    spans[i] = [{"start": int(letters[starts[first[i] + a]] - zero), "end": int(letters[ends[first[i] + b - 1]] - zero)} for a, b in ranges]
                    items[i] = sorted({*items[i], *(n for k in np.unique(which[rows]) for n in own.names[k])})
            pairs = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("kept"), part.column("text"), pa.array(np.diff(first)), pa.array(covered, pairs), pa.array(spans, pairs), pa.array(items, pa.list_(pa.string()))],
                ["kept", "text", "n_words", "covered", "spans", "items"],
            )

    kept = documents.schema["kept"].dataType.simpleString()
    return documents.mapInArrow(run, f"kept {kept}, text string, n_words long, covered {_SPANS}, spans {_SPANS}, items array<string>")


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = 13, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Row by row: ``id_column``, ``n_words``, ``n_hit`` (words in any occurrence), ``items`` (names of the items hit, as sorted strings),
    ``spans`` (code points ``start`` to ``end`` of the passages to remove, merged) and ``contaminated`` (5 % of the words hit, or more).

    A-Z are lower-cased; words are runs of digits, ASCII letters and anything beyond ASCII. A window is ``window`` consecutive words of
    an item, or a whole item that is shorter. Every window is searched in an FM-index over each shard of the documents, and each
    occurrence compared by a second hash of its words.

    Null and empty texts have no words and no hits; items without words are never hit; an item without id has the name ``''``, and
    items with the same id count as one. Repeated rows and ids: one result each. No rows: no rows. No items: no hits. Other columns,
    whatever their names, are not looked at.
    """
    found = _found(documents, F.col(id_column).cast("long").alias("kept"), benchmark, window, text, item_id, item_text, block_words)
    return found.select(F.col("kept").alias(id_column), "n_words", "n_hit", "items", "spans", "contaminated")


def _found(documents: DataFrame, kept: Column, benchmark: DataFrame, window: int, text: str, item_id: str, item_text: str, block_words: int) -> DataFrame:
    rows = documents.select(
        kept, F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("covered"), F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    for n, block in enumerate(_blocks(benchmark, item_id, item_text, block_words)):
        rows = _search(stored(rows, "decontamination") if n else rows, Phrases(block, window))
    n_hit = F.aggregate("covered", F.lit(0).cast("long"), lambda total, r: total + r["end"] - r["start"])
    return rows.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = 13, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``documents`` whose text isn't contaminated, each judged by itself."""
    found = _found(documents, whole_row(documents), benchmark, window, text, item_id, item_text, BLOCK_WORDS)
    return unpacked(found.filter("not contaminated"), documents)
