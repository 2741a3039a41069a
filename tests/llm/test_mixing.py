from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import clashing, documents, odd_documents, prose, words

from imageset_spark.llm import mixing


def greedy(votes, seats, limits):
    """Hand out seats one by one."""
    won = [0] * len(votes)
    for _ in range(seats):
        free = [i for i in range(len(votes)) if won[i] < limits[i] and votes[i] > 0]
        if not free:
            break
        won[max(free, key=lambda i: (votes[i] / (2 * won[i] + 1), -i))] += 1
    return won


VOTES = st.lists(st.integers(0, 400), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(VOTES, st.integers(0, 60), st.integers(0, 30))
def test_apportionment_is_the_highest_quotients(votes, seats, limit):
    votes = [Fraction(v) for v in votes]
    limits = [limit + i for i in range(len(votes))]
    assert mixing.apportion(votes, seats, limits) == greedy(votes, seats, limits)


@settings(max_examples=80, deadline=None)
@given(VOTES, st.integers(1, 7))
def test_shard_quotas_add_up_and_are_even(votes, shards):
    votes = [Fraction(v) for v in votes]
    limits = [10**6] * len(votes)
    quotas = mixing.shard_quotas(votes, 40, limits, shards)
    assert [sum(q) for q in zip(*quotas)] == mixing.apportion(votes, 40, limits)
    assert all(n >= 0 for q in quotas for n in q)
    if any(votes):
        assert max(map(sum, quotas)) - min(map(sum, quotas)) <= 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=9))
def test_targets_share_by_weight_below_the_caps(sizes):
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    out = mixing.targets(sizes, weights)
    assert sum(out) == Fraction(3, 2) * sum(sizes)
    assert all(0 <= t <= 2 * s for t, s in zip(out, sizes))
    free = [t / w for t, s, w in zip(out, sizes, weights) if t < 2 * s]
    assert len(set(free)) <= 1
    # A capped source would get more than its cap.
    assert all(t / w <= free[0] for t, s, w in zip(out, sizes, weights) if free and s and t == 2 * s)


def corpus(spark):
    rows = [(i, prose(20 + i % 90, i), "en", "hot" if i % 3 == 0 else f"s{i % 5}" if i % 7 else None) for i in range(600)]
    return documents(spark, rows)


def test_taken_words(spark):
    out = mixing.take_words(corpus(spark), block=64).collect()
    sources = {r.name: r for r in out}
    order = sorted(sources, key=lambda s: (s is None, s or ""))
    sizes = [sources[s].source_size for s in order]
    wanted = mixing.targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(order))])
    assert [sources[s].target for s in order] == [float(t) for t in wanted]
    for s, t in zip(order, wanted):
        own = [r for r in out if r.name == s]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - t) <= 2 * 64  # rounding, and a short last block
        assert all(0 <= r.taken <= 2 * r.size for r in own)


def test_reruns_agree_and_mixture_follows_the_plan(spark):
    docs = corpus(spark)
    key = lambda df: sorted((r.id, r.taken, r.copies) for r in df.collect())
    first = key(mixing.take_words(docs, block=64))
    assert first == key(mixing.take_words(docs.repartition(5, "text"), block=64))
    got = [r.doc_id for r in mixing.mix_documents(docs, block=64).collect()]
    assert {i: got.count(i) for i in set(got)} == {i: c for i, _, c in first if c}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = mixing.take_words(docs).collect()
    assert len(out) == docs.count()
    assert sorted(r.size for r in out) == sorted(len(words(r.text)) for r in docs.collect())
    assert all(r.taken == 0 for r in out if r.size == 0)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and all(words(r.text) for r in mixed.collect())
    empty = clashing(documents(spark, []))
    assert mixing.take_words(empty).collect() == [] and mixing.mix_documents(empty).collect() == []


def test_too_many_sources_are_refused(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="sources"):
        mixing.take_words(corpus(spark))


def test_rows_without_id_spread_over_the_slices(spark):
    docs = spark.range(20_000).select(F.lit(None).cast("bigint").alias("doc_id"), F.col("id").cast("string").alias("text"),
                                      F.lit("s").alias("source"))
    measured = mixing._measured(docs, mixing.SEED, "doc_id", "source", "text")
    per_slice = measured.groupBy(F.pmod("h", F.lit(mixing.LEAST_SLICES))).count().collect()
    assert len(per_slice) > 1000 and max(r["count"] for r in per_slice) < 60
