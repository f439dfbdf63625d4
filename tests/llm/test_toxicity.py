import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fisclake.llm.queries import QUERIES, table
from fisclake.llm.shared import Texts, span_hashes
from fisclake.llm.toxicity import Model, Sentences, _fitting, drop_toxic, fit_model, noisy_or, score_documents, train

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = QUERIES["op1_toxicity"](spark, SF_DIR).join(table(spark, SF_DIR, "labels"), "doc_id").filter("held_out").collect()
    right = [r["predicted"] == r["toxic"] for r in rows]
    assert np.mean(right) > 0.96
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    assert np.mean(toxic) > 0.7  # 2,600 labels to learn from
    assert np.mean([r["predicted"] for r in rows if not r["toxic"]]) < 0.01
    assert all((r["score"] >= 0.5) == bool(r["predicted"]) and 0 <= r["score"] <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark):
    """Labels of held-out rows may say anything."""
    documents, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = train(documents, labels), train(documents, turned)
    assert a.bias == b.bias and a.places.tolist() == b.places.tolist()


def test_finds_the_sentence_from_labels_of_texts(spark):
    rng = np.random.default_rng(0)
    words = [f"wort{i}" for i in range(200)]
    texts, labels, where = [], [], []
    for _ in range(600):
        sentences = [" ".join(rng.choice(words, 6)) for _ in range(rng.integers(1, 8))]
        bad = int(rng.integers(len(sentences))) if rng.random() < 0.3 else None
        if bad is not None:
            sentences[bad] += " grässlich"
        texts.append("Ä. " + ". ".join(sentences) + ".")
        labels.append(int(bad is not None))
        where.append(bad is not None and sentences[bad])
    model = fit_model(texts, np.array(labels), 100)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in score_documents(frame, model).collect():
        assert r["predicted"] == labels[r["doc_id"]]
        assert [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["offending"]] == ([where[r["doc_id"]]] if where[r["doc_id"]] else [])


def test_noisy_or():
    logits = np.array([0.0, 0.0, -800.0, 800.0])
    assert np.allclose(noisy_or(logits, np.array([0, 0, 2, 3]), 5), [0.75, 0, 0, 1, 0])


def test_a_feature_counts_once_in_a_sentence():
    texts = Texts(pa.array(["bad bad bad. bad", None]))
    table = np.ones(1 << 20)
    assert Sentences(texts).logits(table, 0.0).tolist() == [1.0, 1.0]


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(i, t, "x") for i, t in [(1, 0), (6, 1), (6, 0), (7, None), (9, 0), (None, 1), (12, 1), (3, 2)]], "doc_id long, toxic int, text string")
    model = train(odd_documents, labels)
    rows = score_documents(odd_documents, model).collect()
    assert len(rows) == 11
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0.0}
    assert score_documents(odd_documents.limit(0), model).collect() == []
    assert train(odd_documents, labels.limit(0)).places.tolist() == []
    assert train(odd_documents.limit(0), labels).bias == Model().bias
    kept = drop_toxic(odd_documents, labels.limit(0))
    assert kept.columns == odd_documents.columns and sorted(kept.collect(), key=str) == sorted(odd_documents.collect(), key=str)


def plain_score(text, model):
    """Sentence by sentence and word by word."""
    weight = dict(zip(model.places.tolist(), model.weights.tolist(), strict=True))
    lowered = re.sub(b"[A-Z]", lambda m: m.group().lower(), (text or "").encode())
    clean, offending = 1.0, 0
    for sentence in re.split(rb"[.!?\n\r]", lowered):
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", sentence)
        places = set()
        for word in words:
            data = np.frombuffer(word, np.uint8)
            places.add(int(span_hashes(data, np.array([0]), np.array([len(data)]))[0]) >> 44)
            for size in (4, 5, 6):
                for i in range(len(word) - size + 1):
                    gram = int.from_bytes(word[i : i + size], "little")
                    places.add((gram * 0x9E3779B97F4A7C15 + size) % 2**64 * 0xD6E8FEB86659FD93 % 2**64 >> 44)
        if words:
            logit = model.bias + sum(weight.get(p, 0.0) for p in places)
            clean *= 1 - 1 / (1 + np.exp(-logit))
            offending += logit >= 0
    return 1 - clean, offending


def test_scores_equal_a_plain_scorer(spark, odd_documents):
    documents, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    model = train(documents, labels)
    assert len(model.places) > 10
    for frame in (documents, odd_documents):
        texts = sorted((r["doc_id"] or -1, r["text"]) for r in frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect())
        found = sorted((r["doc_id"] or -1, r["score"], len(r["offending"])) for r in score_documents(frame, model).collect())
        assert [i for i, _, _ in found] == [i for i, _ in texts]
        for (_, text), (_, score, offending) in zip(texts, found, strict=True):
            expected = plain_score(text, model)
            assert abs(score - expected[0]) < 1e-9 and offending == expected[1]


def labelled_rows(spark, n=400):
    rows = [(i, f"wort{i % 50} wort{i % 7} " + ("grässlich." if i % 4 == 0 else "schön.")) for i in range(n)]
    return rows, spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")


def test_a_text_that_does_not_fit_is_left_out_and_the_others_are_taken(spark):
    rows, labels = labelled_rows(spark)
    whole = train(spark.createDataFrame(rows, "doc_id long, text string"), labels, most_bytes=200_000)
    order = spark.createDataFrame(rows, "doc_id long, text string").filter("crc32(cast(doc_id as string)) % 5 <> 0").orderBy(F.xxhash64("doc_id"))
    first = order.first()["doc_id"]
    long = [(i, "é" * 150_000 if i == first else t) for i, t in rows]
    model = train(spark.createDataFrame(long, "doc_id long, text string"), labels, most_bytes=200_000)
    assert whole.left_out == 0 and model.left_out == 1
    assert len(model.places) > 0.8 * len(whole.places) > 0
    assert drop_toxic(spark.createDataFrame(rows, "doc_id long, text string"), labels).filter("doc_id % 4 = 0").count() == 0
    assert _fitting([(1, 5), (2, 100), (3, 5), (4, 1)], 10) == [1, 3]


def test_a_sample_of_one_kind_is_an_error(spark):
    rows, labels = labelled_rows(spark)
    long = spark.createDataFrame([(i, "grässlich " * 1000 if i % 4 == 0 else t) for i, t in rows], "doc_id long, text string")
    with pytest.raises(ValueError, match="one kind"):
        train(long, labels, most_bytes=9_000)
    assert train(long, labels.filter("toxic = 0")).bias == Model().bias


def test_an_id_with_many_rows_is_one_text(spark):
    rows, labels = labelled_rows(spark)
    once = train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    often = train(spark.createDataFrame(rows + rows[:9] * 300, "doc_id long, text string"), labels)
    assert often.places.tolist() == once.places.tolist() and often.bias == once.bias
