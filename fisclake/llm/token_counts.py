"""Token counts without tokens: byte pairs are merged on a heap and a linked list, and only how many symbols are left is kept."""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import cache, partial

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fisclake.llm.shared import give_back

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: How byte-level tokenizers cut texts (fixed value).
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Words whose counts a worker keeps, and the longest of them in characters.
WORDS, LONGEST = 300_000, 100
#: Bytes of words from which on the linked list is kept in flat arrays: slower, but a tenth of the memory.
SHORT = 10_000
#: Characters of a text whose words are held at a time.
AT_ONCE = 200_000


def byte_letters() -> dict[str, int]:
    """The letter by which a vocabulary file writes each byte: printable ones themselves, the others from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class Counter(dict):
    """Tokens of each word, counted when first asked for. Holds the merges of one vocabulary file."""

    def __init__(self, path: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model, cut = said["model"], said["pre_tokenizer"] or {}
        plain = not (said["normalizer"] or said["truncation"] or said["padding"] or model["dropout"] or model.get("ignore_merges"))
        if model["type"] != "BPE" or not plain or (cut.get("type"), cut.get("use_regex"), cut.get("add_prefix_space")) != ("ByteLevel", True, False):
            raise ValueError("only byte-level BPE that leaves texts as they are is supported")
        added = said["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take neighbours or want borders are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, names))) if names else None
        vocabulary = model["vocab"]
        letters = byte_letters()
        if not letters.keys() <= vocabulary.keys():
            raise ValueError("a byte is missing from the vocabulary")
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = vocabulary[letter]
        # Left and right symbol -> rank and merged symbol, packed into one number each.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocabulary[left] << 32 | vocabulary[right], rank << 32 | vocabulary[left + right])
        self.cutter = Tokenizer.from_file(path).pre_tokenizer
        self.alike: set[str] = set(map(chr, range(128)))
        self.unlike: set[str] = set()

    def merged(self, word: str) -> int:
        """Symbols of ``word`` minus its merges. The heap holds ``rank, place`` of adjacent pairs; a pair that has changed since is
        recognised by its rank and passed over."""
        symbols = [self.first[b] for b in word.encode()]
        count = n = len(symbols)
        if n < 2:
            return n
        find = self.merges.get
        bits = n.bit_length()
        mask = (1 << bits) - 1
        heap = [m >> 32 << bits | i for i in range(n - 1) if (m := find(symbols[i] << 32 | symbols[i + 1])) is not None]
        if not heap:
            return n
        heapq.heapify(heap)
        links = list if n < SHORT else partial(array, "q")
        after, before = links(range(1, n + 1)), links(range(-1, n - 1))
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            i = top & mask
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            m = find(symbols[i] << 32 | symbols[j])
            if m is None or m >> 32 != top >> bits:
                continue
            symbols[i], symbols[j] = m & 0xFFFFFFFF, -1
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := find(symbols[i] << 32 | symbols[k])) is not None:
                    push(heap, m >> 32 << bits | i)
            if (h := before[i]) >= 0 and (m := find(symbols[h] << 32 | symbols[i])) is not None:
                push(heap, m >> 32 << bits | h)
        return count

    def __missing__(self, word: str) -> int:
        count = self.merged(word)
        if len(word) <= LONGEST:
            if len(self) >= WORDS:
                self.clear()
            self[word] = count
        return count

    def cuts_alike(self, text: str) -> bool:
        """Whether the pattern sees the characters of ``text`` as the tokenizer's library does: their versions of Unicode differ."""
        if text.isascii():
            return True
        letters = {c for begin in range(0, len(text), AT_ONCE) for c in text[begin : begin + AT_ONCE]}
        for c in letters - self.alike - self.unlike:
            probe = f"a{c}1{c} {c}.{c}"
            same = [place for _, place in self.cutter.pre_tokenize_str(probe)] == [m.span() for m in PATTERN.finditer(probe)]
            (self.alike if same else self.unlike).add(c)
        return not letters & self.unlike

    def words(self, text: str) -> Iterable[str]:
        if not self.cuts_alike(text):
            return (text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text))
        return PATTERN.findall(text) if len(text) <= AT_ONCE else (m.group() for m in PATTERN.finditer(text))

    def count(self, text: str) -> int:
        """Tokens of ``text``; an added token that stands in it is one."""
        if self.added is None:
            return sum(map(self.__getitem__, self.words(text)))
        parts = self.added.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, self.words(p))) for p in parts if p)


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(documents: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = 1024) -> DataFrame:
    """Row by row: ``id_column``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    The count is that of the ``tokenizers`` library for the file ``vocabulary``, without tokens set around texts; strings of added tokens
    that occur in a text are one token each, as the library takes them by default. Nothing is truncated. A worker keeps the counts of at
    most ``WORDS`` words, each no longer than ``LONGEST`` characters; no row is moved.

    Null and empty texts: 0 bytes, 0 tokens. Repeated rows and ids: one result each. No rows: no rows. Other columns, whatever their
    names, are not looked at. A text has to fit into a task; of a long one the words are taken one after another.
    """
    rows = documents.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            counts = [count(t.as_py() or "") for t in batch.column("text")]
            sizes = [t.as_buffer().size if t.is_valid else 0 for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"])
            give_back()

    counted = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
