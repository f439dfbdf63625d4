import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

import brute
from fisclake.llm.pieces import MODEL, Pieces, decode, decode_ids, encode, encode_texts
from fisclake.llm.queries import QUERIES, table

ODD = [
    "", None, " ", "  a  b ", "a", "\n\n x\ty\r\n", "▁x ▁▁", "漢字 かな 한국어 ไทย", "\U0001f600\U0001f600 oḱ", "x" * 300, "ab" * 500, " " * 200, "lower UPPER 12345.678",
    "aaaaaaaaaaaabababababcabcabc " * 7, "\x00\x01 ﻿", "internationalization" * 20, "the cat sat. The cat, sat!", "<s></s><unk><0x41>",
]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return ODD + [r["text"] for r in table(spark, sf_dir, "documents").collect()]


def compare(path, texts, scores=None):
    """Ids, or with ``scores`` only their sum: paths may tie, and the library's rounding then depends on what stands before."""
    own, library = Pieces(path), sentencepiece.SentencePieceProcessor(model_file=path)
    tokens, counts = encode_texts(own, texts)
    found = [t.tolist() for t in np.split(tokens, np.cumsum(counts)[:-1])]
    for text, ids in zip(texts, found, strict=True):
        expected = library.encode(text or "")
        if scores is None or ids == expected:
            assert ids == expected, repr(text)[:200]
        else:
            assert abs(scores[ids].sum() - scores[expected].sum()) < 0.01, repr(text)[:200]
    for text, back in zip(texts, decode_ids(own, tokens, counts), strict=True):
        assert back == (text or "").replace("▁", " ")


def test_bpe_ids_are_the_library_s(texts):
    compare(MODEL, texts)


def test_unigram_ids_are_the_library_s(texts, tmp_path):
    """The same pieces as a unigram model, with scores that have no ties."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    rng = np.random.default_rng(0)
    for p in proto.pieces:
        if p.type == 1:
            p.score = float(-8 - 4 * rng.random())
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    compare(str(path), [t for t in texts if t is None or len(t) < 3000], np.array([p.score for p in proto.pieces]))


def test_random_strings_of_few_letters():
    rng = np.random.default_rng(1)
    compare(MODEL, ["".join(rng.choice(list("estaoin r▁é"), rng.integers(1, 150))) for _ in range(1500)])


def test_query_and_odd_rows(spark, sf_dir, odd_documents):
    rows = QUERIES["op7_sentencepiece"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["decoded_sha256"]) for r in rows} == {
        i: (len(ids := library.encode(t)), ids, brute.sha(t)) for i, t in texts.items()
    }
    encoded = encode(odd_documents)
    assert sorted(len(r["ids"]) for r in encoded.collect())[:2] == [0, 0]
    texts = sorted(r["text"] for r in decode(encoded).collect())
    assert texts == sorted(r["text"] or "" for r in odd_documents.collect())
    assert encode(odd_documents.limit(0)).collect() == []


def test_unsupported_models_are_refused(tmp_path):
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.byte_fallback = False
    (tmp_path / "x.model").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        Pieces(str(tmp_path / "x.model"))
