"""Toxicity by multiple-instance learning: labels of documents train a model of sentences, which finds the offending ones."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fisclake.llm.shared import ALPHANUMERIC, LOWER, Texts, find_words, ragged, span_hashes, stored, text_chunks, unpacked, whole_row

#: Features are hashed to so many places.
PLACES = 1 << 20
#: Bytes of the parts of words that are features beside whole words.
GRAMS = (4, 5, 6)
#: What ends a sentence.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n\r"]] = True


@dataclass
class Model:
    """Weights of a few thousand of the places, and the log-odds of a sentence that has none of them."""

    places: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = -12.0
    left_out: int = 0  # labelled texts that didn't fit into the sample

    def table(self) -> np.ndarray:
        dense = np.zeros(PLACES)
        dense[self.places] = self.weights
        return dense


class Sentences:
    """Sentences of some texts: runs without an end mark that hold a word. ``text`` and the span in bytes of each."""

    def __init__(self, texts: Texts) -> None:
        self.data = LOWER[texts.bytes]
        self.starts, self.ends, first = find_words(self.data, texts.offsets, ALPHANUMERIC)
        text_of = np.repeat(np.arange(len(texts)), np.diff(first))
        part = np.cumsum(ENDS[self.data])[self.starts] if len(self.starts) else self.starts
        new = np.r_[True, (np.diff(text_of) != 0) | (np.diff(part) != 0)] if len(self.starts) else np.zeros(0, bool)
        self.of_word = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        self.text = text_of[begin]
        self.first = self.starts[begin]
        self.last = self.ends[np.r_[begin[1:], len(new)] - 1] if len(begin) else self.ends

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of features, and the sentence of each: whole words, then parts of words."""
        shift = np.uint64(64 - PLACES.bit_length() + 1)
        yield (span_hashes(self.data, self.starts, self.ends) >> shift).astype(np.int64), self.of_word
        padded = np.r_[self.data, np.zeros(8, np.uint8)]
        eight = np.ndarray((len(self.data),), "<u8", padded, strides=(1,))
        for size in GRAMS:
            count = np.maximum(self.ends - self.starts - size + 1, 0)
            grams = eight[ragged(self.starts, count)] & np.uint64((1 << 8 * size) - 1)
            yield ((grams * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size)) * np.uint64(0xD6E8FEB86659FD93) >> shift).astype(np.int64), np.repeat(self.of_word, count)

    def logits(self, table: np.ndarray, bias: float) -> np.ndarray:
        known = [(places[some], of[some]) for places, of in self.features() for some in [np.flatnonzero(table[places])]]
        places, of = distinct(*(np.concatenate(x) for x in zip(*known, strict=True)))
        return bias + np.bincount(of, table[places], len(self.text))


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def odds(logit: np.ndarray) -> np.ndarray:
    """Probability of each logit."""
    return np.exp(-softplus(-logit))


def noisy_or(logits: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """1 - the product of (1 - probability) over the sentences of each text; 0 without sentences."""
    return -np.expm1(-np.bincount(text, softplus(logits), n))


def distinct(places: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A feature counts once in a sentence."""
    pairs = np.unique(of * PLACES + places)
    return pairs % PLACES, pairs // PLACES


def fit_model(texts: list[str | None], label: np.ndarray, most: int, rounds: int = 400, at_a_time: int = 200) -> Model:
    """Fits to the labels of whole texts. ``most`` features take part: those whose frequencies in the two kinds differ most surely."""
    n, kinds = len(label), np.bincount(label, minlength=2)
    if not kinds.all():
        return Model()

    def parts() -> Iterator[tuple[int, Sentences]]:
        for begin in range(0, n, at_a_time):
            yield begin, Sentences(Texts(pa.array(texts[begin : begin + at_a_time], pa.large_string())))

    counts = np.zeros((2, PLACES), np.int64)
    for begin, part in parts():
        for places, of in part.features():
            places, of = distinct(places, part.text[of])
            for k in (0, 1):
                counts[k] += np.bincount(places[label[begin + of] == k], minlength=PLACES)
    rate = counts.sum(0) / n
    z = (counts[1] / kinds[1] - counts[0] / kinds[0]) / np.sqrt(np.maximum(rate * (1 - rate), 1e-12) * (1 / kinds[0] + 1 / kinds[1]))
    z[(counts.sum(0) < 3) | (rate >= 1)] = 0
    order = np.argsort(-np.abs(z), kind="stable")[:most]
    chosen = order[np.abs(z[order]) >= 3]
    number = np.full(PLACES, -1)
    number[chosen] = np.arange(len(chosen))
    # Sentences without a chosen feature are alike; a text counts how many it has.
    plain, feature, of, text, before = np.zeros(n), [], [], [], 0
    for begin, part in parts():
        own = [(number[places[keep]], at[keep]) for places, at in part.features() for keep in [np.flatnonzero(number[places] >= 0)]]
        hit, at = distinct(*(np.concatenate(x) for x in zip(*own, strict=True)))
        some, at = np.unique(at, return_inverse=True)
        plain += np.bincount(begin + part.text, minlength=n) - np.bincount(begin + part.text[some], minlength=n)
        feature, of, text, before = [*feature, hit], [*of, before + at], [*text, begin + part.text[some]], before + len(some)
    feature, of, text = map(np.concatenate, (feature, of, text))
    weights, bias = np.zeros(len(chosen)), -4.0
    state = [np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)]
    for step in range(1, rounds + 1):
        logit = bias + np.bincount(of, weights[feature], before)
        total = np.bincount(text, softplus(logit), n) + plain * softplus(np.array(bias))
        slope = np.where(label == 1, -1 / np.expm1(np.clip(total, 1e-6, 500)), 1.0)
        by_sentence = slope[text] * odds(logit)
        gradient = np.r_[np.bincount(feature, by_sentence[of], len(chosen)) + 0.05 * weights, by_sentence.sum() + (slope * plain).sum() * odds(np.array(bias))] / n
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.99 * state[1] + 0.01 * gradient**2
        move = 0.1 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(chosen, weights, float(bias))


def held_out(id_column: str) -> Column:
    """Rows that training must not see; so are rows without an id."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _fitting(sizes: list[tuple[int, int]], most: int) -> list[int]:
    """Ids whose texts go into a sample of ``most`` bytes, taken in the given order of (id, bytes): one that doesn't fit is left out, the next one is tried."""
    chosen, total = [], 0
    for i, size in sizes:
        if total + size <= most:
            chosen.append(i)
            total += size
    return chosen


def train(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int = 10_000, most_bytes: int = 40_000_000, most_features: int = 4096) -> Model:
    """A model from a sample of the labelled documents that aren't held out.

    The sample: of the labelled ids that ``documents`` has, the ``most_rows`` smallest by a hash, and of their texts, in that order, all that
    fit into ``most_bytes`` of UTF-8; one that doesn't is left out and counted in ``left_out``. Both bounds are there because one task fits the model.
    Raises ValueError if there are labels of both kinds but texts of only one got into the sample. Several labels of an id: the largest counts. Several
    texts: the smallest. Null labels don't count, null texts are empty. Labels of one kind only, or none: a model that rejects nothing.
    """
    labelled = (
        labels.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .filter(~held_out("id"))
    )
    texts = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    present = stored(labelled.join(texts.select("id"), "id", "left_semi"), "labelled")
    kinds = {r["label"] for r in present.select("label").distinct().collect()}  # two at most
    if len(kinds) < 2:
        return Model()
    chosen = present.withColumn("order", F.xxhash64("id")).orderBy("order", "id").limit(most_rows)
    # One text of each id, chosen before anything is moved.
    each = texts.join(F.broadcast(chosen), "id").groupBy("order", "id", "label").agg(F.coalesce(F.min("text"), F.lit("")).alias("text"))
    each = stored(each, "labelled-texts")
    sizes = each.select("order", "id", F.octet_length("text").alias("bytes")).collect()  # most_rows at most
    ids = _fitting([(r["id"], r["bytes"]) for r in sorted(sizes)], most_bytes)
    fitting = documents.sparkSession.createDataFrame([(i,) for i in ids], "id long")
    sample = each.join(F.broadcast(fitting), "id").repartition(1).sortWithinPartitions("order", "id").select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        if parts:
            whole = pa.Table.from_batches(parts).combine_chunks()
            model = fit_model(whole.column("text").to_pylist(), np.asarray(whole.column("label")), most_features)
            both = len(set(whole.column("label").to_pylist())) == 2
            yield pa.RecordBatch.from_pydict({"places": [model.places.tolist()], "weights": [model.weights.tolist()], "bias": [model.bias], "both": [both]})

    row = sample.mapInArrow(run, "places array<long>, weights array<double>, bias double, both boolean").first()
    if row is None or not row["both"]:
        raise ValueError(f"the sample has texts of one kind only: {len(sizes) - len(ids)} of {len(sizes)} don't fit into {most_bytes} bytes")
    return Model(np.array(row["places"], np.int64), np.array(row["weights"]), row["bias"], len(sizes) - len(ids))


def _scored(rows: DataFrame, model: Model, threshold: float) -> DataFrame:
    """``rows`` (``kept`` and ``text``) with the score and the sentences found."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a few thousand weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = shared.value.table(), shared.value.bias
        for part, texts in text_chunks(batches, "text"):
            sentences = Sentences(texts)
            logits = sentences.logits(table, bias)
            score = noisy_or(logits, sentences.text, len(texts))
            found = np.flatnonzero(logits >= 0)
            spans: list[list[dict]] = [[] for _ in range(len(texts))]
            if len(found):
                letters = np.r_[0, np.cumsum((texts.bytes & 0xC0) != 0x80)]
                for s in found:
                    i = int(sentences.text[s])
                    zero = letters[texts.offsets[i]]
                    spans[i].append({"start": int(letters[sentences.first[s]] - zero), "end": int(letters[sentences.last[s]] - zero), "probability": float(odds(logits[s]))})
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("kept"), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(spans, kind)], ["kept", "score", "predicted", "offending"]
            )

    kept = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(run, f"kept {kept}, score double, predicted int, offending array<struct<start:int,end:int,probability:double>>")


def score_documents(documents: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Row by row: ``id_column``, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on) and ``offending``: the sentences more
    likely toxic than not, as code points ``start`` to ``end`` with their probability.

    Null, empty and blank texts have no sentence and the score 0. Repeated rows and ids: one result each. No rows: no rows. Other
    columns, whatever their names, are not looked at.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("kept"), F.col(text).alias("text"))
    return _scored(rows, model, threshold).withColumnRenamed("kept", id_column)


def drop_toxic(documents: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5, **sample: int) -> DataFrame:
    """The rows of ``documents`` that a model trained on ``labels`` doesn't reject, each judged by itself.

    Null, empty and blank texts stay. Repeated rows and ids are judged row by row and stay or go together. No documents: none. No labels, or of one
    kind only: all documents. All columns come back as they were, whatever their names.
    """
    model = train(documents, labels, id_column, text, **sample)
    scored = _scored(documents.select(whole_row(documents), F.col(text).alias("text")), model, threshold)
    return unpacked(scored.filter("predicted = 0"), documents)
