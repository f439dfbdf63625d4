"""Each stage on what the one before kept, against plain versions."""

import re

import sentencepiece

import brute
import corpus_pipeline
from fisclake.llm.pieces import MODEL
from fisclake.llm.pii import find_pii
from fisclake.llm.queries import table
from fisclake.llm.toxicity import score_documents, train
from test_decontamination import plain

SF_DIR = "/root/testdata/sf0.01"


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark):
    documents, stages = table(spark, SF_DIR, "documents"), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash_near_duplicates", "benchmark_decontamination", "personal_data", "sentencepiece"]
    kept, names = {}, ["documents"]
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        kept[names[-1]] = rows(docs)
        docs = spark.createDataFrame(list(kept[names[-1]].values()), documents.schema)
        docs = stage(spark, docs, SF_DIR)
        if name != "sentencepiece":
            assert docs.columns == documents.columns
        names.append(name)
    last = rows(docs)
    texts = {n: {i: r["text"] for i, r in own.items()} for n, own in kept.items()}

    model = train(documents, table(spark, SF_DIR, "labels"))
    assert texts["toxicity"].keys() == {r["doc_id"] for r in score_documents(documents, model).collect() if not r["predicted"]}
    roots = brute.components({i: brute.fingerprint(t) for i, t in texts["toxicity"].items()})
    assert texts["simhash_near_duplicates"].keys() == set(roots.values())
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    judged = plain(list(texts["simhash_near_duplicates"].items()), items)
    assert texts["benchmark_decontamination"].keys() == {r[0] for r in judged if not r[4]}
    assert len(documents.collect()) > len(texts["toxicity"]) > len(texts["simhash_near_duplicates"]) > len(texts["benchmark_decontamination"])

    before = spark.createDataFrame(list(kept["benchmark_decontamination"].values()), documents.schema)
    for r in find_pii(before).collect():
        text = texts["benchmark_decontamination"][r["id"]]
        spans = [(s["start"], s["end"], k) for k in ("email", "ip", "card", "phone") for s in r[k]] + [(s["start"], s["end"], s["kind"]) for s in r["added"]]
        assert set(brute.said(brute.personal(text)).split(",")) - {""} <= {f"{k}:{a}:{b}" for a, b, k in spans}
        at, parts = 0, []
        for a, b, k in sorted(spans):
            if a >= at:
                parts += [text[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        own = kept["personal_data"][r["id"]]
        assert own["text"] == "".join(parts) + text[at:] and own["n_chars"] == len(own["text"])
    assert any(re.search(r"\[(EMAIL|PHONE|IP|CARD)\]", t) for t in texts["personal_data"].values())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert {i: r["ids"] for i, r in last.items()} == {i: library.encode(t) for i, t in texts["personal_data"].items()}
    assert all(r["decoded_sha256"] == brute.sha(texts["personal_data"][i]) for i, r in last.items())


def test_run_gives_the_rows_of_the_last_stage(spark):
    found = rows(corpus_pipeline.run(spark, "/root/testdata/sf0.001"))
    assert found and all(r["n_tokens"] == len(r["ids"]) for r in found.values())
