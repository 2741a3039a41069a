import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import LOWER, clashing, documents, odd_documents, prose

from imageset_spark.llm import resampling as R

TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, max_n=1):
    w = TOKEN.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)], len(w)


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def model(rows, target, max_n=1, buckets=10_000, least=20, share=(10, 100)):
    def counted(texts):
        total = [0] * buckets
        for text in texts:
            for f in features(text, max_n)[0]:
                total[bucket(f, buckets)] += 1
        return total

    s, t = counted(t for _, t in rows), counted(target)
    S, T = sum(s) + buckets, sum(t) + buckets
    gain = [math.floor(1000 * math.log((b + 1.0) * T_ / ((a + 1.0) * U_))) for a, b, T_, U_ in zip(s, t, [S] * buckets, [T] * buckets)]
    out = []
    for i, text in rows:
        found, n = features(text, max_n)
        weight = sum(gain[bucket(f, buckets)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, n >= least])
    drawn = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    number = share[0] * len(drawn) // share[1]
    place = {id(r): k + 1 for k, r in enumerate(drawn[:number])}
    return sorted(((r[0], r[1], r[2], r[3], place.get(id(r))) for r in out), key=str)


def result(frame, target, **options):
    out = R.resample(frame, target, **options)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def benchmark(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "text string")


TARGET = [prose(200, 900), "What is 12 plus 7? É ß", None, ""]


@pytest.mark.parametrize("max_n, buckets", [(1, 10_000), (2, 64), (3, 1000)])
def test_scores_and_draw_match_the_model(spark, max_n, buckets):
    rows = [(i, prose(5 + 3 * i, 900 + i % 40) + " Ünï-cödé 42x") for i in range(150)]
    options = {"max_n": max_n, "buckets": buckets}
    assert result(documents(spark, rows), benchmark(spark, TARGET), **options) == model(rows, TARGET, **options)


def test_ties_at_the_end_of_the_draw(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(R, "gumbel", lambda *_: F.lit(0).cast("bigint"))
    rows = [(i, "same " * 30) for i in random.Random(1).sample(range(1000), 95)] + [(None, "same " * 30)] * 5
    out = result(documents(spark, rows).repartition(5), benchmark(spark, TARGET))
    drawn = sorted((r[4], r[0]) for r in out if r[4])
    assert drawn == list(zip(range(1, 11), sorted(i for i, _ in rows if i is not None)[:10]))


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = model(rows, TARGET, share=(1, 2))
    assert result(docs, clashing(benchmark(spark, TARGET)), share=(1, 2)) == expected
    drawn = R.draw_documents(docs, benchmark(spark, TARGET), share=(1, 2))
    assert drawn.columns[0] == "doc_id" and {r.doc_id for r in drawn.collect()} == {r[0] for r in expected if r[4] and r[0]}


def test_empty_tables(spark):
    empty, some = clashing(documents(spark, [])), documents(spark, [(1, prose(30, 1))])
    assert result(empty, benchmark(spark, TARGET)) == [] and result(empty, benchmark(spark, [])) == []
    assert result(some, benchmark(spark, [])) == model([(1, prose(30, 1))], [])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=80), max_size=40))
def test_hashes_equal_the_library(items):
    data = np.frombuffer(b"".join(items) + b"\0", np.uint8)
    length = np.array([len(x) for x in items], np.int64)
    start = np.concatenate(([0], np.cumsum(length)))[:-1].astype(np.int64)
    assert R.xxhash64(data, start, length).tolist() == [xxhash.xxh64_intdigest(x) for x in items]


@pytest.mark.parametrize("hash_of", [R.xxhash64, lambda d, s, n: np.full(len(s), 5, np.uint64), lambda d, s, n: n.astype(np.uint64)])
def test_slots_belong_to_one_ngram(hash_of):
    """Also when all keys collide: bytes decide."""
    rng = random.Random(3)
    items = [rng.choice([b"a", b"b", b"ab", b"abc" * 20, b"abc" * 19 + b"abd", b"12345678", b"12345679"]) for _ in range(300)]
    data = np.frombuffer(b"".join(items), np.uint8)
    length = np.array([len(x) for x in items], np.int64)
    start = np.concatenate(([0], np.cumsum(length)))[:-1].astype(np.int64)
    table = R.Interned(data, start, length, 1000, hash_of)
    slots = {}
    for item, slot in zip(items, table.slot.tolist()):
        assert slots.setdefault(item, slot) == slot
    assert len(set(slots.values())) == len(slots)
    for item, slot in slots.items():
        assert table.bucket[slot] == zlib.crc32(item) % 1000 and table.count[slot] == items.count(item)


@pytest.mark.parametrize("max_n", [1, 3])
@pytest.mark.parametrize("limit", [7, 64, 1000])
def test_pieces_lose_no_ngram(max_n, limit):
    texts = ["", prose(60, 1), None, "x" * 300 + " y", "É" * 90 + "-a-" + prose(20, 2), "one", " . ", prose(300, 3)]
    got = [[] for _ in texts]
    words = [0] * len(texts)
    for data, start, length, row, counted, first in R.ngrams(pa.array(texts), max_n, limit):
        for a, n, r in zip(start.tolist(), length.tolist(), row.tolist()):
            got[first + r].append(data[a : a + n].tobytes().decode())
        for r, n in enumerate(counted.tolist()):
            words[first + r] += n
    expected = [features(t, max_n) for t in texts]
    assert [sorted(g) for g in got] == [sorted(f) for f, _ in expected]
    assert words == [n for _, n in expected]


def test_a_text_of_many_megabytes_in_bounded_memory():
    import tracemalloc

    text = pa.array([prose(2000, 4) * 2000])
    size = len(text[0].as_buffer())
    assert size > 20_000_000
    tracemalloc.start()
    total = sum(len(start) for _, start, *_ in R.ngrams(text, 1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total > 2_900_000 and peak < 4 * size
