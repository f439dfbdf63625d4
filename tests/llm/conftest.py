import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

LONG = "Wort " * 30_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, repeated rows and ids, and further columns whose names the operators use themselves."""
    rows = [
        (1, "", "a"), (2, None, None), (3, "  \t\n", "a"), (4, LONG, "a"), (5, LONG, "b"), (6, "one two", "b"), (6, "one two", "b"),
        (7, "ONE\ttwo", None), (8, "Ünïcode ſtraße 漢字 \U0001f600 end.", "c"), (9, "one two three four five six seven", "c"), (None, "no id", "c"),
    ]
    rows = [(i, t, "en", s, len(t or ""), 9, 9, "x", "y", 9, 9, 9, 9.5, "z") for i, t, s in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, key string, bin string, shard int, position int, score int, `a.b` double, tile string"
    return spark.createDataFrame(rows, names)
