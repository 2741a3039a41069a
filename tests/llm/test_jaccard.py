import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import clashing, documents, odd_documents, prose, shingles

from imageset_spark.llm import jaccard as J
from imageset_spark.llm.components import components


def model(rows):
    """Components by comparing all pairs of texts; texts of one id belong together."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return sorted(((i, len(s), find(i) if i is not None else None) for i, s in sets), key=str)


def check(spark, rows):
    out = J.jaccard_components(documents(spark, rows)).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str)
    assert got == model(rows)
    return got


def edited(text, n, seed):
    rng, w = random.Random(seed), text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = f"w{rng.randrange(1000)}"
    return " ".join(w)


def near_copies(n, groups, seed=0):
    """Copies with few to many edits, so that many pairs lie close to the limit."""
    rng = random.Random(seed)
    bases = [prose(40 + 30 * g, seed + g) for g in range(groups)]
    rows = [(i, edited(bases[i % groups], rng.randrange(0, 9), i)) for i in range(n)]
    rng.shuffle(rows)
    return rows


def test_components_match_all_pairs(spark):
    rows = near_copies(150, 5) + [(1000 + i, prose(30 + i, 700 + i)) for i in range(60)]
    rows += [(2000 + i, t) for i, t in enumerate(["A b c", "a B C", "a b c d", "", None, "a b c d e", "a b c d e f", " "])]
    got = check(spark, rows)
    assert len({c for *_, c in got}) < len(rows) - 60


@pytest.mark.parametrize("rounds", [(1, None), (2, 3, None), (None,)])
def test_one_large_group_needs_boxes_blocks_and_rounds(spark, monkeypatch, rounds):
    monkeypatch.setattr(J, "HOME", 20)
    monkeypatch.setattr(J, "OTHER", 40)
    monkeypatch.setattr(J, "LEAF", 8)
    monkeypatch.setattr(J, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(J, "ROUNDS", rounds)
    base = prose(90, 1)
    got = check(spark, [(i, edited(base, i % 10, i)) for i in range(250)])
    assert len({c for *_, c in got}) > 3


def test_a_pair_is_not_reported_in_every_subtree(spark):
    """Near copies share many subtrees, and are reported in few."""
    base = prose(150, 4)
    texts, _ = J._texts(documents(spark, [(i, edited(base, 3, i)) for i in range(60)]), "doc_id", "text")
    known = J.stage(J.points(texts, J.fine_ranks(texts)), "points")
    cells = known.select("id", F.explode("keys").alias("key"))
    alone = cells.select("key", "id", F.col("id").alias("label"))
    found = J.stage(J._candidates(alone, known, None), "found")
    pairs = found.select("a", "b").distinct()
    meetings = cells.alias("x").join(cells.alias("y"), "key").where("x.id < y.id").select("x.id", "y.id")
    possible = {(r.a, r.b) for r in pairs.collect()}
    n = sum((min(a, b), max(a, b)) in possible for a, b in meetings.collect())
    assert len(possible) > 100 and n > 10 * len(possible)
    assert found.count() < 1.5 * len(possible)
    # Of each pair of components a round takes the few that share most, and says that there are more.
    halves = alone.withColumn("label", F.pmod("id", F.lit(2)))
    few = J._candidates(halves, known, 2).collect()
    assert len(few) <= 2 * cells.select("key").distinct().count() and any(r.more for r in few)


def test_copies_of_one_set_stand_aside(spark):
    """Equal sets of texts that differ in case and space are one point of the search."""
    text = prose(80, 6)
    rows = [(i, (text.upper() if i % 2 else text) + " " * (i % 5)) for i in range(40)]
    rows += [(100 + i, edited(text, 5, i)) for i in range(30)]
    check(spark, rows)


def test_a_chain_and_a_common_passage(spark):
    text = prose(120, 2).split(" ")
    chain = [(i, " ".join(text[3 * i : 3 * i + 60])) for i in range(20)]
    passage = prose(40, 3)
    rows = chain + [(100 + i, prose(50, 800 + i) + " " + passage) for i in range(40)]
    got = check(spark, rows)
    assert {c for i, _, c in got if i < 20} == {0}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_bound_never_drops_a_link(seed):
    rng = random.Random(seed)
    base = prose(rng.randrange(5, 600), seed, 300)
    texts = pa.array([base, edited(base, rng.randrange(0, 12), seed)])
    vecs = np.zeros((2, J.DIMS), np.int64)
    (_, sizes, values, row), = J.shingle_sets(texts, np.arange(J.FINE_GROUPS, dtype=np.uint64))
    np.add.at(vecs, (row, ((values >> np.uint64(42)) & np.uint64(J.DIMS - 1)).astype(int)), 1)
    shared = len(np.intersect1d(values[row == 0], values[row == 1]))
    low = np.minimum(vecs, 2).astype(np.uint8)
    points = J.Points(sizes, (vecs - low).sum(1), low, np.arange(2))
    assert points.shared(np.array([0]), np.array([1]))[0] >= shared
    assert sizes.tolist() == [len(shingles(t)) for t in texts.to_pylist()]
    linked = 7 * shared >= 3 * sizes.sum()
    assert linked == (100 * shared >= 75 * (sizes.sum() - shared))
    left, *_ = points.possible(np.array([0]), np.array([1]))
    assert len(left) or not linked


def test_long_texts_overflow_the_counts(spark):
    base = prose(90_000, 5, 10**6)
    rows = [(1, base), (2, edited(base, 100, 1)), (3, prose(90_000, 6, 10**6)), (4, edited(base, 40_000, 2))]
    check(spark, rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = J.jaccard_components(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == model(rows)
    kept = J.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # 7 repeats 6, and of the two rows of 6, which are one document, one stays.
    expected = [str(i) for i, _ in rows if i != 7]
    expected.remove("6")
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(expected)
    empty = clashing(documents(spark, []))
    assert J.jaccard_components(empty).collect() == [] and J.drop_near_duplicates(empty).collect() == []


def test_rows_without_id_and_texts_of_one_id(spark):
    w = prose(120, 31).split(" ")
    part = lambda a: " ".join(w[a : a + 90])
    rows = [(1, part(0)), (None, part(8)), (2, part(16)), (None, part(8)), (3, prose(50, 32)), (3, prose(70, 33)),
            (4, prose(70, 33)), (None, prose(60, 34)), (None, prose(60, 34) + " end"), (None, ""), (None, ""), (5, prose(55, 35))]
    docs = documents(spark, rows)
    out = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(docs).collect()), key=str)
    shared = [1, 1, 1, 1, 3, 3, 3, None, None, None, None, 5]
    assert out == sorted(((i, len(shingles(t)), c) for (i, t), c in zip(rows, shared)), key=str)
    kept = [(r.doc_id, r.text) for r in J.drop_near_duplicates(docs).collect()]
    # One text of each component, the unique text of 3 too; blank texts are no copies.
    assert sorted(k for k in kept if k[0]) == [rows[0], *sorted(rows[4:6]), rows[11]]
    nameless = [t for i, t in kept if i is None]
    assert len(nameless) == 3 and nameless.count("") == 2


def test_repeated_rows_become_one(spark):
    rows = [(1, prose(40, 1))] * 3 + [(2, prose(40, 2))] * 2 + [(3, "")] * 2 + [(4, prose(40, 2))] * 2 + [(None, prose(40, 7))] * 3
    docs = clashing(documents(spark, rows))
    kept = sorted(((r.doc_id, r.text) for r in J.drop_near_duplicates(docs).collect()), key=str)
    assert kept == sorted([rows[0], rows[3], (3, ""), (3, ""), (None, prose(40, 7))], key=str)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components_of_graphs(spark, shape):
    rng = random.Random(shape)
    n = 200
    edges = {"path": [(rng.sample(range(n), n)[0], 0)], "star": [(n, i) for i in range(n)],
             "random": [(rng.randrange(n), rng.randrange(n)) for _ in range(150)]}[shape]
    if shape == "path":
        order = rng.sample(range(n), n)
        edges = list(zip(order, order[1:]))
    parent = list(range(n + 1))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    out = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in out} == {v: find(v) for e in edges if e[0] != e[1] for v in e}


def staged_rows(monkeypatch):
    """Rows of every table that is staged from here on, by name."""
    rows, stage = {}, J.stage

    def counted(df, name):
        out = stage(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(J, "stage", counted)
    return rows


def test_long_unlike_texts_are_refused_before_they_are_moved(spark, monkeypatch):
    """Any two texts of thousands of shingles fill the groups of the coarse vector alike."""
    rows = staged_rows(monkeypatch)
    passage = prose(12, 40, 10**6)
    texts = [(i, prose(8000 + 20 * i, 50 + i, 10**6) + " " + passage) for i in range(8)]
    base = prose(9000, 60, 10**6)
    check(spark, texts + [(20, base), (21, edited(base, 100, 1))])
    # Of all pairs, only the linked one is verified on its texts.
    assert sum(rows["dealt-pairs"]) == 1


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6))
def test_finer_bound_never_drops_a_link(seed):
    rng = random.Random(seed)
    size = rng.choice([2000, 4096, 8200, 9000])
    base = prose(size, seed, rng.choice([300, 10**6]))
    words = edited(base, rng.randrange(0, 200), seed).split(" ")
    texts = pa.array([base, " ".join(words[: rng.randrange(3 * size // 4, size)])])
    (_, sizes, values, row), = J.shingle_sets(texts, np.arange(J.FINE_GROUPS, dtype=np.uint64))
    a, b = values[row == 0], values[row == 1]
    (x, x_lost), (y, y_lost) = J.finer_vector(a), J.finer_vector(b)
    assert max(map(len, (x, y))) >= max(sizes) / J.DENSE
    bound = J.overlap_bound(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8), x_lost, y_lost)
    assert bound >= len(np.intersect1d(a, b))


def test_small_subtrees_move_vectors_once_for_each_pair(spark, monkeypatch):
    """Near copies share most of their keys; each pair meets its vectors in one row."""
    texts, _ = J._texts(documents(spark, [(i, edited(prose(150, 4), 3, i)) for i in range(8)]), "doc_id", "text")
    known = J.stage(J.points(texts, J.fine_ranks(texts)), "points")
    cells = known.select("id", F.explode("keys").alias("key"))
    rows = staged_rows(monkeypatch)
    found = J._candidates(cells.select("key", "id", F.col("id").alias("label")), known, None).collect()
    pairs = {(r.a, r.b) for r in found}
    assert 0 < len(found) == len(pairs) <= rows["meeting-pairs"][0] <= 28


def test_repeated_keys_are_found_within_and_across_batches(spark):
    rng = random.Random(5)
    lists = [sorted({rng.randrange(-(2**63), 2**63) for _ in range(20)}) for _ in range(60)]
    for i in range(0, 60, 3):
        lists[(i + 7) % 60][0] = lists[i][1]
    known = spark.createDataFrame([(k,) for k in lists], "keys array<bigint>").repartition(7)
    count = {}
    for keys in lists:
        for k in keys:
            count[k] = count.get(k, 0) + 1
    low = (1 << (J.SLICE_BITS + J.REST_BITS)) - 1
    expected = {k & low for k, n in count.items() if n > 1}
    assert expected and {r.print for r in J.repeated_keys(known).collect()} == expected
