import numpy as np
import pytest

from fisclake.llm.fmindex import FMIndex, suffix_order


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (200, 1), (500, 2), (3000, 40)])
def test_finds_every_occurrence(n, top):
    rng = np.random.default_rng(n)
    text = rng.integers(1, top + 1, n)
    if n > 1000:
        text[1000:1900] = text[:900]
    assert suffix_order(text).tolist() == sorted(range(n), key=lambda i: text[i:].tolist())
    lengths = rng.integers(1, 5, 60)
    phrases = rng.integers(1, top + 1, (60, 4))
    which, starts = FMIndex(text, top, sample=4).occurrences(phrases, lengths)
    found = sorted(zip(which.tolist(), starts.tolist(), strict=True))
    words = text.tolist()
    assert found == sorted((p, s) for p in range(60) for s in range(n) if words[s : s + lengths[p]] == phrases[p, : lengths[p]].tolist() and s + lengths[p] <= n)
