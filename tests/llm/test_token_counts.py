import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fisclake.llm.queries import QUERIES, table
from fisclake.llm.token_counts import VOCABULARY, counter, count_tokens

LIBRARY = Tokenizer.from_file(VOCABULARY)


def expected(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(st.text() | st.lists(st.sampled_from(["<|endoftext|>", "<|endo", "text|>", " ", "\n", "'s", "don't", "1", "é", "\U0001f600", "aaaa", "the", "."]), max_size=12).map("".join))
def test_counts_equal_the_library(text):
    assert counter(VOCABULARY).count(text) == expected(text)


def test_every_character():
    """Also those that the versions of Unicode of library and pattern take for different things."""
    for first in range(0, 0x20000, 50):
        text = "".join(f"{chr(c)} a{chr(c)}1" for c in range(first, first + 50) if not 0xD800 <= c < 0xE000)
        assert counter(VOCABULARY).count(text) == expected(text), hex(first)


@pytest.mark.parametrize("text", ["ab" * 30_000, " " * 50_000, "é" * 20_000, "Wort " * 60_000, "x՘" * 100])
def test_long_words_and_texts(text):
    assert counter(VOCABULARY).count(text) == expected(text)


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    found = QUERIES["op12_token_counts"](spark, sf_dir).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in found} == {i: expected(t) for i, t in texts.items()}
    assert all(r["n_bytes"] == len(texts[r["doc_id"]].encode()) and r["over_limit"] == (r["n_tokens"] > 1024) for r in found)


def test_odd_rows(spark, odd_documents):
    rows = odd_documents.select("doc_id", "text").collect()
    found = count_tokens(odd_documents, limit=2)
    key = lambda r: (r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(((r["doc_id"], len((r["text"] or "").encode()), expected(r["text"]), expected(r["text"]) > 2) for r in rows), key=key)
    assert count_tokens(odd_documents.limit(0)).collect() == []
    assert count_tokens(odd_documents.selectExpr("cast(doc_id as string) as doc_id", "text")).schema["doc_id"].dataType.simpleString() == "string"


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        counter("/opt/tokenizers/word_bpe_49k.json")
