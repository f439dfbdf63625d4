import re

import numpy as np

import brute
from fisclake.llm.decontamination import drop_contaminated, find_contamination
from fisclake.llm.queries import table


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", brute.lowered(text))


def plain(documents, items, window=13):
    phrases = {}
    for name, text in items:
        w = words(text)
        size = min(window, len(w))
        for s in range(len(w) - size + 1) if size else ():
            phrases.setdefault(tuple(w[s : s + size]), set()).add(str(name) if name is not None else "")
    result = []
    for i, text in documents:
        w, hit, names = words(text), set(), set()
        for size in {len(p) for p in phrases}:
            for s in range(len(w) - size + 1):
                if found := phrases.get(tuple(w[s : s + size])):
                    names |= found
                    hit.update(range(s, s + size))
        result.append((i, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(result, key=str)


def check(documents, benchmark, **options):
    rows = find_contamination(documents, benchmark, **options).collect()
    found = sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows), key=str)
    expected = plain([(r["doc_id"], r["text"]) for r in documents.collect()], [(r["item_id"], r["text"]) for r in benchmark.collect()], options.get("window", 13))
    assert found == expected
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in rows:
        if len(rows) == len(texts):
            assert sum(len(words(texts[r["doc_id"]][s["start"] : s["end"]])) for s in r["spans"]) == r["n_hit"]
    return expected


def test_equals_brute_force(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    expected = check(documents, benchmark)
    assert any(r[4] for r in expected) and any(not r[4] for r in expected)
    kept = sorted(r["doc_id"] for r in drop_contaminated(documents, benchmark).collect())
    assert kept == sorted(r[0] for r in expected if not r[4])
    check(documents, benchmark, block_words=100)


def test_short_items_and_repeats(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["Ab", "b1", "ü", "c-d"], rng.integers(0, 50))) for _ in range(40)]
    documents = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(50, texts[1]), (51, None)], "doc_id long, text string")
    items = [(1, "ab ab"), (2, "!"), (3, None), (None, "ü"), (10, "c d c d b1"), (2, texts[3]), (4, texts[3] + " more"), (4, "ab B1")]
    check(documents, spark.createDataFrame(items, "item_id long, text string"))
    check(documents, spark.createDataFrame(items, "item_id long, text string"), window=3, block_words=5)
    check(documents, spark.createDataFrame([], "item_id long, text string"))


def test_odd_rows(spark, odd_documents):
    items = spark.createDataFrame([(7, "wort wort wort"), (8, "\U0001f600 END")], "item_id long, text string")
    check(odd_documents, items)
    assert find_contamination(odd_documents.limit(0), items).collect() == []
    kept = drop_contaminated(odd_documents, items)
    assert kept.columns == odd_documents.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "6", "6", "7", "9", "None"]
