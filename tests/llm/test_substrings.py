import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from fisclake.llm.queries import table
from fisclake.llm.substrings import leftmost_minima, remove_repeats


def plain(rows, window):
    """By row: number of words removed and what is left."""
    last = 1 << 63
    split = [((last if i is None else i), brute.words(t)) for i, t in rows]
    first = {}
    for i, words in split:
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            first[key] = min(first.get(key, (last, last)), (i, s))
    result = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] < (i, s):
                gone.update(range(s, s + window))
        result.append((None if i == last else i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(result, key=str)


def check(frame, window):
    expected = plain([(r["doc_id"], r["text"]) for r in frame.collect()], window)
    assert sorted(map(tuple, remove_repeats(frame, window).collect()), key=str) == expected
    return expected


@pytest.mark.parametrize("window", [4, 8, 20])
def test_equals_brute_force(spark, sf_dir, window):
    assert sum(r[2] for r in check(table(spark, sf_dir, "documents"), window))


def test_random_words(spark):
    """Few different words: chance repeats at every length, also within a text."""
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(rng.choice(["a", "b", "ç"], rng.integers(0, 60)))) for i in rng.permutation(80)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "a " * 200), (201, "b c " * 40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (4, 8, 12, 20):
        check(frame, window)


def test_odd_rows(spark, odd_documents):
    rows = {(r[0], r[1]): r for r in check(odd_documents, 20)}
    assert rows[(4, 30_000)][2] == 29_999 or rows[(4, 30_000)][2] == 30_000
    assert remove_repeats(odd_documents.limit(0)).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(odd_documents, 10)


def test_repeated_rows_stay(spark):
    text = " ".join(f"w{i}" for i in range(30))
    frame = spark.createDataFrame([(1, text), (1, text), (1, "x " + text), (2, text)], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in remove_repeats(frame).collect()) == [0, 0, 30, 30]
    check(frame, 20)


def test_rows_without_id_whose_texts_share_a_short_hash(spark):
    """Two texts with the same 32-bit hash and no id: only the one whose passage stands in an earlier row loses its words."""
    text = F.expr("array_join(transform(sequence(0, 29), j -> concat('w', id, '_', j)), ' ')")
    texts = spark.range(200_000).select(text.alias("text")).withColumn("h", F.hash("text"))
    alike = texts.groupBy("h").agg(F.sort_array(F.collect_list("text")).alias("t")).filter("size(t) > 1").orderBy("h").first()["t"]
    frame = spark.createDataFrame([(1, "x " + alike[0]), (None, alike[0]), (None, alike[1])], "doc_id long, text string")
    assert sorted(r[2] for r in check(frame, 20)) == [0, 0, 30]


def test_minima():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 9, 200).astype(np.uint64)
    for size in (1, 2, 3, 7, 16):
        assert leftmost_minima(values, size).tolist() == [i + int(np.argmin(values[i : i + size])) for i in range(200 - size + 1)]
