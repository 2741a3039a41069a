import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import clashing, documents, odd_documents

from imageset_spark.llm import sharding


def corpus(spark, n=3000):
    """A third of all rows in one source."""
    rows = [(i, f"text {i}", "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(n)]
    return documents(spark, rows)


def test_rows_law_slots_and_mixture(spark):
    out = sharding.shard_documents(corpus(spark)).collect()
    per_shard = Counter(r.shard for r in out)
    assert set(per_shard) == set(range(24)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    for shard, n in per_shard.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))
    sources = Counter(r.source for r in out)
    for shard, n in per_shard.items():
        own = Counter(r.source for r in out if r.shard == shard)
        for source, total in sources.items():
            assert abs(own[source] - total * n / len(out)) <= 2


def test_order_follows_fractional_ranks(spark):
    out = sharding.shard_documents(corpus(spark, 400), n_shards=1).orderBy("slot").collect()
    total, seen, last = Counter(r.source for r in out), Counter(), 0.0
    for r in out:
        rank = (2 * seen[r.source] + 1) / (2 * total[r.source])
        assert rank >= last
        last, seen[r.source] = rank, seen[r.source] + 1


def test_reruns_and_partitioning_agree(spark):
    docs = corpus(spark, 500)
    key = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.collect())
    first = key(sharding.shard_documents(docs))
    assert first == key(sharding.shard_documents(docs.repartition(7, "text")))
    assert first != key(sharding.shard_documents(docs, seed=1))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = sharding.shard_documents(docs.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")))), n_shards=4)
    rows = out.collect()
    assert len(rows) == docs.count() and set(docs.columns) <= set(out.columns)
    assert all(r.size == len((r.text or "").encode()) + 8 for r in rows)
    assert all(r.crc == zlib.crc32((r.text or "").encode()) for r in rows)
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(4) for k in range(4 if s in (0, 2) else 3)]
    assert sharding.shard_documents(clashing(documents(spark, []))).collect() == []
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, n_shards=0)


def test_written_shards_read_back(spark, tmp_path):
    out = sharding.shard_documents(corpus(spark, 100), n_shards=3)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r.doc_id, r.shard, r.slot) for r in back.collect()) == sorted(
        (r.doc_id, r.shard, r.slot) for r in out.collect())


def test_rows_without_id_spread_over_the_slices(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.col("id").cast("string").alias("text"),
                                      F.lit("s").alias("source"))
    ranked, _, (_, h, *_) = sharding.fractional_ranks(docs, 1024)
    per_slice = ranked.groupBy(F.pmod(h, F.lit(1024))).count().collect()
    assert len(per_slice) > 1000 and max(r["count"] for r in per_slice) < 60
