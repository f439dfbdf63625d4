import numpy as np
import pytest

import brute
from fisclake.llm.queries import table
from fisclake.llm.simhash import TILE, Forest, keep_one_of_each, link_tiles, links, near_duplicates


def test_equals_brute_force(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    prints = {r["doc_id"]: brute.fingerprint(r["text"]) for r in documents.collect()}
    roots = brute.components(prints)
    found = near_duplicates(documents).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}
    assert any(r["doc_id"] != r["component_id"] for r in found)
    assert sorted(r["doc_id"] for r in keep_one_of_each(documents).collect()) == sorted(set(roots.values()))


@pytest.mark.parametrize("centres,flips", [(40, 5), (3, 2), (1, 4)])
def test_links_of_planted_groups(spark, centres, flips):
    """Chains and dense groups of fingerprints, more than a tile holds."""
    rng = np.random.default_rng(centres)
    base = rng.integers(0, 1 << 63, centres, dtype=np.uint64)
    prints = set()
    for _ in range(1500):
        x = int(rng.choice(base))
        for bit in rng.integers(0, 64, rng.integers(0, flips + 1)):
            x ^= 1 << int(bit)
        prints.add(x)
    prints = {i: p for i, p in enumerate(sorted(prints))}
    frame = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for i, p in prints.items()], "id long, fingerprint long")
    forest = Forest()
    for a, b in links(frame, 3).collect():
        forest.join(a & (1 << 64) - 1, b & (1 << 64) - 1)
    expected = brute.components(prints)
    groups = {}
    for i, p in prints.items():
        groups.setdefault(expected[i], set()).add(forest.root(p))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_dense_tiles_keep_components():
    rng = np.random.default_rng(5)
    for _ in range(5):
        values = np.unique(rng.integers(0, 1 << 12, TILE, dtype=np.uint64) | np.uint64(7 << 40))
        forest, single = Forest(), Forest()
        link_tiles(values, values, 2, forest)
        for x in values.tolist():
            for y in values.tolist():
                if (x ^ y).bit_count() <= 2 and x != y:
                    single.join(x, y)
        assert [forest.root(x) for x in values.tolist()] == [single.root(x) for x in values.tolist()]


def test_odd_rows(spark, odd_documents):
    found = near_duplicates(odd_documents).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert len(found) == 11
    assert {i: by_id[i]["component_id"] for i in (1, 2, 3, 4, 5, 6, 7)} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6}
    assert by_id[2]["fingerprint"] == "0" * 16
    assert by_id[None]["component_id"] is None
    kept = keep_one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "6", "8", "9", "None"]
    assert keep_one_of_each(odd_documents.limit(0)).collect() == []
    assert near_duplicates(odd_documents.limit(0)).collect() == []
