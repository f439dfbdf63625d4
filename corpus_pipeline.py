"""The corpus pipeline: toxic documents go, one of each group of near-duplicates stays, contaminated documents go, personal data is
replaced, and the rest is encoded.

Of every stage: no documents give no rows; repeated rows and ids are judged row by row; further columns pass through unchanged, whatever their
names, up to the last stage; very long texts are judged whole. What null and empty texts give is said at each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fisclake.llm.decontamination import drop_contaminated
from fisclake.llm.pieces import decode, encode
from fisclake.llm.pii import redact
from fisclake.llm.queries import table
from fisclake.llm.shared import stored
from fisclake.llm.simhash import keep_one_of_each
from fisclake.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model trained on the labels doesn't reject; null and empty texts have no toxic sentence and stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id. Null, empty and blank texts all have fingerprint zero: one of them stays."""
    return keep_one_of_each(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than 5 % of the words lie in passages of the benchmark; null and empty texts have no words and stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text. Null texts stay null, with a null ``n_chars``."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document, and a digest of what they decode to: no ids, and the digest of nothing, for null and empty texts."""
    back = decode(encode(docs.select("doc_id", "text")))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("personal_data", personal_data),
    ("sentencepiece", pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, stored(docs, f"pipeline-{STAGES[n - 1][0]}") if n else docs, sf_dir)
    return docs


#: Fingerprints, trained models and tokens can't be expressed in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
