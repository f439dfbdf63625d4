from collections import Counter

from pyspark.sql import functions as F

from fisclake.llm.queries import table
from fisclake.llm.sharding import assign_shards, ranked, shuffle_key


def check(rows, n_rows, n_shards):
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == n_rows
    assert max(counts.values()) - min(counts[s] for s in range(n_shards)) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_equals_plain_ranking_and_mixes(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    rows = assign_shards(documents, 8, rows_per_bin=10).collect()
    check(rows, documents.count(), 8)
    keyed = documents.select(
        "doc_id", "source", shuffle_key(42, F.col("doc_id"), F.crc32(F.col("text").cast("binary")), F.octet_length("text").cast("long") + 1).alias("key")
    ).collect()
    by_source = {}
    for r in keyed:
        by_source.setdefault(r["source"], []).append((r["key"], r["doc_id"]))
    order = sorted(((n + 0.5) / len(own), "=" + source, key, i) for source, own in by_source.items() for n, (key, i) in enumerate(sorted(own)))
    total = len(order)
    expected = {i: g * 8 // total for g, (_, _, _, i) in enumerate(order)}
    assert {r["doc_id"]: r["shard"] for r in rows} == expected
    for source, own in by_source.items():
        shares = Counter(r["shard"] for r in rows if r["source"] == source)
        assert all(abs(shares[s] - len(own) / 8) <= 2 for s in range(8)), (source, shares)


def test_bins_change_nothing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    few, many = (sorted(assign_shards(documents, 3, rows_per_bin=n).collect()) for n in (1, 100_000))
    assert few == many


def test_odd_rows(spark, odd_documents):
    rows = assign_shards(odd_documents, 4).collect()
    check(rows, 11, 4)
    assert [(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 2] == [(1, 0)]
    assert assign_shards(odd_documents.limit(0), 4).collect() == []
    assert len(assign_shards(odd_documents.limit(2), 8).collect()) == 2


def test_rows_alike_and_sources_of_one_row(spark):
    """A third of the rows alike in all, and as many sources as rows: neither meets in one bin, and both are dealt out evenly."""
    alike = spark.range(400).selectExpr("7L AS doc_id", "'t' AS text", "'hot' AS source")
    single = spark.range(800).selectExpr("id + 100 AS doc_id", "concat('t', id) AS text", "concat('s', id) AS source")
    rows = assign_shards(alike.unionAll(single), 8, rows_per_bin=50).collect()
    check(rows, 1200, 8)
    shares = Counter(r["shard"] for r in rows if r["source"] == "hot")
    assert sum(shares.values()) == 400 and len({r["doc_id"] for r in rows}) == 801
    together = assign_shards(alike.unionAll(single), 8).collect()
    assert sorted(rows) == sorted(together)


def test_no_bin_holds_what_many_rows_share(spark):
    """Sources of one row all have fraction 0.5."""
    rows = spark.range(2000).selectExpr("'x' AS g", "0.5D AS fraction", "concat('s', id) AS stratum", "1L AS copies")
    placed = ranked(rows, ["g"], 20, ["fraction", "stratum"])
    assert sorted(r["position"] for r in placed.collect()) == list(range(2000))
    bins = rows.repartitionByRange(20, "g", "fraction", "stratum").groupBy(F.spark_partition_id()).count()
    assert bins.agg(F.max("count")).first()[0] < 400
