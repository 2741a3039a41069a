import hashlib

import pytest
from pyspark.sql import functions as F
from samples import clashing, documents, odd_documents, prose

from imageset_spark.llm import merkle as M

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    values = [row[c] for c in COLUMNS]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """Root of a list of digests, and for each of them its siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            first = i - i % fanout
            paths[k].append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + fanout])))
        nodes = [sha("".join(nodes[i : i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], paths


def model(rows, fanout=8):
    """(id, leaf, subroot, root, siblings) of every row, by building whole trees in memory."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r["doc_id"]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        members = sorted(groups[name])
        trees.append((members, *climb([m[2] for m in members], fanout)))
    root, tops = climb([t[1] for t in trees], fanout)
    return sorted(
        ((m[3], m[2], top, root, tuple(path + tops[g]))
         for g, (members, top, paths) in enumerate(trees) for m, path in zip(members, paths)), key=str)


def proofs(manifest):
    out = M.proofs(manifest).collect()
    return sorted(((r.id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.siblings)) for r in out), key=str)


def sized(spark, sizes):
    """Groups of given sizes, all in one table."""
    rows, i = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            i += 1
            rows.append(((i * 7919) % 100_003, f"Text {i}", None if g == 0 else f"l{g}", f"s{i % 3}"))
    return documents(spark, rows)


@pytest.mark.parametrize("every", [1, 2, 3])
def test_proofs_match_whole_trees(spark, every):
    docs = sized(spark, [1, 2, 7, 8, 9, 63, 64, 65, 100, 513])
    rows = [r.asDict() for r in docs.collect()]
    assert proofs(M.build_manifest(docs, every=every)) == model(rows)


def test_other_fanout_and_many_groups(spark):
    docs = sized(spark, [3, 28, *[1] * 40])
    rows = [r.asDict() for r in docs.collect()]
    assert proofs(M.build_manifest(docs, fanout=3)) == model(rows, 3)


def test_only_some_levels_are_stored(spark):
    docs = sized(spark, [700, 30])
    manifest = M.build_manifest(docs)
    # 730 leaves in 12 subtrees of 64, whose tops form one subtree for each group.
    assert [t.count() for t in manifest.group_levels] == [12, 2]
    assert [t.count() for t in manifest.top_levels] == [1]
    assert M.root(manifest).first().root == model([r.asDict() for r in docs.collect()])[0][3]


def test_folding_finds_changed_rows(spark):
    docs = documents(spark, [(i, f"Text {i}" if i % 2 else f"text {i}", f"l{i % 3}", "s") for i in range(150)])
    changed = M.leaf_digest([*COLUMNS[:-1], F.lower("text")])
    found = M.proofs(M.build_manifest(docs, changed=changed))
    out = found.select(
        "id", (M.fold(F.col("leaf"), F.col("siblings")) == F.col("root")).alias("own"),
        (M.fold(F.col("changed"), F.col("siblings")) == F.col("root")).alias("other"),
        M.proof_digest(F.col("siblings")).alias("digest"),
    ).collect()
    assert all(r.own for r in out) and {r.id for r in out if not r.other} == set(range(1, 150, 2))
    expected = {m[0]: sha("".join(a + b for a, b in m[4])) for m in model([r.asDict() for r in docs.collect()])}
    assert {r.id: r.digest for r in out} == expected


def test_one_row_is_its_own_root(spark):
    docs = documents(spark, [(5, "alone")])
    (row,) = M.proofs(M.build_manifest(docs)).withColumn("digest", M.proof_digest(F.col("siblings"))).collect()
    assert row.leaf == row.subroot == row.root == leaf(docs.first().asDict())
    assert row.siblings == [] and row.digest == sha("")


def test_odd_rows_and_equal_rows(spark):
    docs = odd_documents(spark)
    rows = [r.asDict() for r in docs.collect()]
    assert proofs(M.build_manifest(docs)) == model(rows)
    same = documents(spark, [(None, "same", None, "s")] * 200 + [(1, prose(20, 1), "en", "s")])
    assert proofs(M.build_manifest(same.repartition(7))) == model([r.asDict() for r in same.collect()])


def test_empty_table(spark):
    manifest = M.build_manifest(clashing(documents(spark, [])))
    assert M.root(manifest).collect() == [] and M.proofs(manifest).collect() == []
