"""SentencePiece encoding and decoding of whole batches: pieces are found in a suffix array of the text, and the edges they make relaxed."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from fisclake.llm.shared import BASES, ragged, span_hashes, text_chunks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text whose segments are indexed together.
BATCH_BYTES = 750_000
#: Segments longer than this are relaxed one at a time, shorter ones side by side.
SHORT = 64
SPACE = "▁"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class Pieces:
    """Pieces of a model file: their characters numbered, and the pieces packed four characters to a number for searching."""

    def __init__(self, path: str) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        normal, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = {p.type for p in proto.pieces}
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("only models that leave texts as they are, but for marking spaces, are supported")
        if not trained.byte_fallback or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE} or trained.model_type not in (1, 2):
            raise ValueError("only BPE and unigram models with byte fallback and without symbols of the user's are supported")
        self.merging = trained.model_type == 2
        self.prefix = normal.add_dummy_prefix
        self.scores = np.array([p.score for p in proto.pieces])
        self.unknown = self.scores[[p.type == _NORMAL for p in proto.pieces]].min() - 10
        self.byte_ids = np.zeros(256, np.int32)
        own: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == _BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                own.append(bytes([int(p.piece[3:5], 16)]))
            else:
                own.append({_NORMAL: p.piece.replace(SPACE, " "), _UNKNOWN: " ⁇ ", _CONTROL: ""}[p.type].encode())
        self.data = np.frombuffer(b"".join(own), np.uint8)
        self.size = np.array([len(x) for x in own])
        self.start = np.cumsum(self.size) - self.size
        # What can be found in texts, as rows of character numbers (from 1; 0 fills up).
        self.ids = np.array([i for i, p in enumerate(proto.pieces) if p.type == _NORMAL])
        texts = [proto.pieces[i].piece for i in self.ids]
        self.length = np.array([len(t) for t in texts])
        self.longest = int(self.length.max())
        codes = [np.array([ord(c) for c in t], np.uint32) for t in texts]
        self.characters = np.unique(np.concatenate(codes))
        self.bits = int(len(self.characters)).bit_length()
        self.each = 60 // self.bits
        self.keys = -(-self.longest // self.each)
        table = np.zeros((len(texts), self.keys * self.each), np.int64)
        for row, c in zip(table, codes, strict=True):
            row[: len(c)] = np.searchsorted(self.characters, c) + 1
        filled = np.arange(table.shape[1])[None, :] < self.length[:, None]
        self.lowest = self.packed(table.T)
        self.highest = self.packed(np.where(filled, table, (1 << self.bits) - 1).T)
        # Segments begin at a space mark behind anything else, unless a piece runs over such a place; characters of no longer piece stand alone.
        together = np.zeros(len(self.characters) + 1, bool)
        together[np.unique(table[self.length > 1])] = True
        together[0] = False
        self.together = together
        self.cut_at_spaces = not any(SPACE in t[1:] and t.strip(SPACE) and t.lstrip(SPACE).find(SPACE) >= 0 for t in texts)

    def packed(self, columns: np.ndarray) -> list[np.ndarray]:
        """``columns[j]`` holds the j-th characters; ``each`` of them make one number of the list."""
        result = []
        for k in range(self.keys):
            value = np.zeros(columns.shape[1], np.int64)
            for j in range(self.each):
                value = value << self.bits | columns[k * self.each + j]
            result.append(value)
        return result

    def edges(self, text: np.ndarray) -> np.ndarray:
        """``[position, length - 1]``: the id of the piece that is there, or -1. ``text`` holds character numbers, 0 between segments."""
        n, depth = len(text), self.keys * self.each
        padded = np.r_[text, np.zeros(depth, np.int64)]
        first = np.zeros(n + depth, np.int64)
        for j in range(self.each):
            first[:n] = first[:n] << self.bits | padded[j : n + j]
        keys = [first[k * self.each : k * self.each + n] for k in range(self.keys)]
        # Suffixes in order of as many characters as the longest piece has: those of four, then of eight from the ranks by four, and so on.
        value, depth = keys[0], self.each
        while True:
            order = np.argsort(value)
            if depth >= self.longest:
                break
            ordered = value[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]])
            value = rank << 32
            value[: max(n - depth, 0)] |= rank[depth:]
            depth *= 2
        keys = [k[order] for k in keys]
        low, high = self._places(keys, self.lowest, False), self._places(keys, self.highest, True)
        count = high - low
        at = order[ragged(low, count)]
        # Put in place, the edges are sorted by position and length.
        table = np.full((n, self.longest), -1, np.int32)
        table[at, np.repeat(self.length - 1, count)] = np.repeat(self.ids, count)
        return table

    @staticmethod
    def _places(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
        """How many suffixes stand before each wanted one; with ``after``, before or at it. Binary search of all at once."""
        low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
        for _ in range(int(len(keys[0])).bit_length()):
            open_ = low < high
            middle = np.where(open_, (low + high) // 2, 0)
            less, same = np.zeros(len(low), bool), np.ones(len(low), bool)
            for own, asked in zip(keys, wanted, strict=True):
                value = own[middle]
                less |= same & (value < asked)
                same &= value == asked
            up = open_ & (less | same if after else less)
            low, high = np.where(up, middle + 1, low), np.where(open_ & ~up, middle, high)
        return low


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def merge_side_by_side(table: np.ndarray, starts: np.ndarray, ends: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Ends of the symbols left, by their first position (0 elsewhere): in every segment at once, the best of the neighbours that make a
    piece together are joined, the first of equal ones, until there are none."""
    following = np.zeros(len(table) + 1, np.int64)
    at = ragged(starts, ends - starts)
    following[at] = at + 1
    segment = np.repeat(np.arange(len(starts)), ends - starts)
    limit = ends
    while len(at):
        behind = following[at]
        joined = np.where(behind < limit[segment], following[np.minimum(behind, len(table) - 1)], 0)
        size = joined - at
        fits = (joined > 0) & (size <= table.shape[1])
        piece = np.where(fits, table[at, np.where(fits, size - 1, 0)], -1)
        score = np.where(piece >= 0, scores[piece], -np.inf)
        cuts = np.flatnonzero(np.r_[True, np.diff(segment) != 0])
        best = np.maximum.reduceat(score, cuts)
        per = np.diff(np.r_[cuts, len(at)])
        chosen = np.flatnonzero((score == np.repeat(best, per)) & (score > -np.inf))
        chosen = chosen[np.r_[True, np.diff(segment[chosen]) != 0]] if len(chosen) else chosen
        gone = following[at[chosen]]
        following[at[chosen]] = joined[chosen]
        following[gone] = 0
        alive = np.repeat(best > -np.inf, per) & (following[at] > 0)
        at, segment = at[alive], segment[alive]
    return following


def merge_one(table: np.ndarray, start: int, end: int, scores: np.ndarray, following: np.ndarray) -> None:
    """The same for a single long segment, best pairs from a heap."""
    after = list(range(1, end - start + 1))
    before = list(range(-1, end - start - 1))
    heap: list[tuple[float, int, int]] = []

    def offer(a: int) -> None:
        if a >= 0 and after[a] < end - start:
            z = after[after[a]]
            if z - a <= table.shape[1] and (p := table[start + a, z - a - 1]) >= 0:
                heapq.heappush(heap, (-scores[p], a, z))

    for a in range(end - start):
        offer(a)
    while heap:
        _, a, z = heapq.heappop(heap)
        if after[a] < 0 or after[a] >= end - start or after[after[a]] != z:
            continue
        gone = after[a]
        after[a], after[gone] = z, -1
        if z < end - start:
            before[z] = a
        offer(before[a])
        offer(a)
    following[start:end] = [start + a if a > 0 else 0 for a in after]


def best_paths(table: np.ndarray, starts: np.ndarray, ends: np.ndarray, scores: np.ndarray, unknown: float) -> np.ndarray:
    """Unigram models: ends of the symbols on the best path through each segment, relaxing the edges position by position."""
    following = np.zeros(len(table) + 1, np.int64)
    best = np.full(len(table) + len(starts) + 1, -np.inf)
    came = np.zeros(len(table) + len(starts) + 1, np.int64)
    base = starts + np.arange(len(starts))  # a segment of n characters has n + 1 places
    best[base] = 0
    for e in range(1, int((ends - starts).max(initial=0)) + 1):
        live = np.flatnonzero(ends - starts >= e)
        for size in range(min(e, table.shape[1]), 0, -1):
            at = starts[live] + e - size
            piece = table[at, size - 1]
            score = np.where(piece >= 0, scores[piece], unknown if size == 1 else -np.inf)
            total = best[base[live] + e - size] + score
            better = total > best[base[live] + e]
            place = base[live[better]] + e
            best[place], came[place] = total[better], size
    at, left = base.copy(), ends - starts
    while len(live := np.flatnonzero(left > 0)):
        size = came[base[live] + left[live]]
        following[starts[live] + left[live] - size] = starts[live] + left[live]
        left[live] -= size
    return following


def encode_segments(model: Pieces, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of some segments of ``codes`` one after another, and how many each has."""
    # Their characters in a row, with a gap behind each segment.
    size = ends - starts
    begin = np.cumsum(size + 1) - size - 1
    length = int((size + 1).sum())
    own = np.zeros(length, np.uint32)
    own[ragged(begin, size)] = codes[ragged(starts, size)]
    place = np.searchsorted(model.characters, own)
    text = np.where(model.characters[np.minimum(place, len(model.characters) - 1)] == own, place + 1, 0)
    text[begin + size] = 0
    table = model.edges(text)
    long = size > SHORT
    if model.merging:
        following = merge_side_by_side(table, begin[~long], begin[~long] + size[~long], model.scores)
        for s in np.flatnonzero(long):
            merge_one(table, int(begin[s]), int(begin[s] + size[s]), model.scores, following)
    else:
        following = best_paths(table, begin, begin + size, model.scores, model.unknown)
    at = np.flatnonzero(following)
    piece = table[at, following[at] - at - 1]
    # A character that is no piece is spelt in bytes.
    bare = np.flatnonzero(piece < 0)
    spelt = [chr(c).encode() for c in own[at[bare]].tolist()]
    counts = np.ones(len(at), np.int64)
    counts[bare] = [len(b) for b in spelt]
    ids = np.repeat(piece, counts)
    if len(bare):
        ids[ragged((np.cumsum(counts) - counts)[bare], counts[bare])] = model.byte_ids[np.frombuffer(b"".join(spelt), np.uint8)]
    return ids, np.bincount(np.searchsorted(begin, at, side="right") - 1, counts, len(starts)).astype(np.int64)


def encode_texts(model: Pieces, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, and how many each has. Equal segments are indexed and relaxed once."""
    marked = [((SPACE if model.prefix else "") + t).replace(" ", SPACE) if t else "" for t in texts]
    size = np.array([len(t) for t in marked], np.int64)
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    new = np.zeros(len(codes), bool)
    new[(np.cumsum(size) - size)[size > 0]] = True
    if model.cut_at_spaces:
        mark = codes == ord(SPACE)
        new[1:] |= mark[1:] & ~mark[:-1]
    place = np.searchsorted(model.characters, codes)
    known = model.characters[np.minimum(place, len(model.characters) - 1)] == codes
    alone = ~model.together[np.where(known, place + 1, 0)]
    new |= alone
    new[1:] |= alone[:-1]
    starts = np.flatnonzero(new)
    ends = np.r_[starts[1:], len(codes)]
    _, first, which = np.unique(span_hashes(codes, starts, ends), return_index=True, return_inverse=True)
    other = span_hashes(codes, starts, ends, BASES[1])
    if (other[first][which] != other).any():  # two segments with the same hash: tell them apart by both
        _, first, which = np.unique(np.stack([span_hashes(codes, starts, ends), other]), axis=1, return_index=True, return_inverse=True)
    ids, counts = encode_segments(model, codes, starts[first], ends[first])
    offset = np.cumsum(counts) - counts
    which = which.ravel()
    tokens = ids[ragged(offset[which], counts[which])]
    text_of = np.searchsorted(np.cumsum(size), starts, side="right")
    return tokens, np.bincount(text_of, counts[which], len(texts)).astype(np.int64)


def decode_ids(model: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of some rows of ids. Bytes that make no text become U+FFFD."""
    size = model.size[ids]
    data = model.data[ragged(model.start[ids], size)].tobytes()
    ends = np.r_[0, np.cumsum(size)][np.cumsum(counts)]
    result, begin = [], 0
    for end in ends.tolist():
        text = data[begin:end].decode(errors="replace")
        result.append(text[1:] if model.prefix and text.startswith(" ") else text)
        begin = end
    return result


def encode(documents: DataFrame, id_column: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """Row by row: ``id_column`` and ``ids``, the ids that SentencePiece gives for the text with the model file ``model``.

    The segments of a batch of texts are put in a row and its suffixes sorted. A binary search finds the run of suffixes that begin with
    each piece of the model; put in order of position, these occurrences are the edges from which BPE joins (or a unigram
    model takes the best path). Characters that no piece holds are spelt in bytes.

    Null and empty texts have no ids. Repeated rows and ids: one result each. No rows: no rows. Other columns, whatever their names,
    are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for part, _ in text_chunks(batches, "text", BATCH_BYTES):
            tokens, counts = encode_texts(own, part.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(tokens.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("id"), lists], ["id", "ids"])

    rows = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, id_column: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``encoded`` with its ids and ``text``, what they stand for. Null ids: an empty text. What was encoded comes back, but for the
    character U+2581, which is how the model writes a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                lists = part.column("ids")
                counts = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
                texts = decode_ids(own, np.asarray(lists.flatten(), np.int64), counts)
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, pa.array(texts, pa.string())], ["id", "ids", "text"])

    rows = encoded.select(F.col(id_column).cast("long").alias("id"), F.col(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "id long, ids array<int>, text string").withColumnRenamed("id", id_column)
