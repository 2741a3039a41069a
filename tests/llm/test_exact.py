import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from samples import LOWER, clashing, documents, odd_documents, prose

from imageset_spark.llm import exact as E
from imageset_spark.llm import rows as R


def norm(text):
    return (text or "").translate(LOWER)


def model(rows, largest=False):
    """Rows that stay and group sizes, by comparing whole texts."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = (max(named) if largest else min(named)) if named else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        marks = [i == keep for i in ids]
        first = marks.index(True)
        out += [(i, keep, len(ids), k == first, sha) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def report(frame, **options):
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    out = E.exact_duplicates(frame, **options)
    assert out.columns == names
    return sorted((tuple(r) for r in out.collect()), key=str)


ROWS = (
    [(i, prose(40, i % 7).upper() if i % 3 else prose(40, i % 7)) for i in range(60)]
    + [(100, "É"), (101, "é"), (102, "ABC"), (103, "abc"), (104, None), (105, ""), (106, " "), (106, " ")]
    + [(None, "abc"), (None, "Only here"), (None, "only HERE"), (None, None)]
)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups_match_whole_texts(spark, keep):
    assert report(documents(spark, ROWS), keep=keep) == model(ROWS, keep == "largest")


def short_hash(text):
    return F.unhex(F.substring(F.md5(F.substring(text, 1, 1)), 1, 4))


@pytest.mark.parametrize("digest", [short_hash, lambda text: F.unhex(F.lit("00"))])
def test_collisions_do_not_join_groups(spark, digest):
    assert report(documents(spark, ROWS), digest=digest) == model(ROWS)
    kept = E.drop_duplicates(documents(spark, ROWS), digest=digest).collect()
    assert sorted(norm(r.text) for r in kept) == sorted({norm(t) for _, t in ROWS})


def test_bitmap_keeps_every_group(spark, monkeypatch):
    monkeypatch.setattr(R, "BITMAP_BITS", 1 << 15)
    rows = spark.range(50_000).select(F.col("id"), F.unhex(F.md5(F.col("id").cast("string"))).alias("digest"))
    some = rows.where("id % 10 = 0").select("digest")
    found = {r.id for r in R.may_be_among(rows, some, "digest").collect()}
    assert found >= set(range(0, 50_000, 10)) and len(found) < 20_000


def test_copies_leave_the_table(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert report(docs) == model(rows)
    kept = E.drop_duplicates(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    # Both rows of 6 and row 7 hold one text; the rows without text are one group.
    assert sorted(norm(t) for _, t in got) == sorted({norm(t) for _, t in rows})
    assert {i for i, t in got if norm(t) == norm(rows[5][1])} == {6}
    assert [i for i, t in got if not t] == [1]


def test_a_third_of_rows_in_one_group(spark):
    rows = [(i, "Copy copy" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    out = report(documents(spark, rows).repartition(16))
    assert out == model(rows)


def test_empty_and_wrong_option(spark):
    empty = clashing(documents(spark, []))
    assert E.exact_duplicates(empty).collect() == [] and E.drop_duplicates(empty).collect() == []
    with pytest.raises(ValueError):
        E.exact_duplicates(empty, keep="any")


def test_text_ids(spark):
    rows = spark.createDataFrame([("b", "x"), ("a", "X"), (None, "x"), ("c", None)], "doc_id string, text string")
    assert report(rows, keep="largest") == [
        ("a", "b", 3, False, hashlib.sha256(b"x").hexdigest()),
        ("b", "b", 3, True, hashlib.sha256(b"x").hexdigest()),
        ("c", "c", 1, True, hashlib.sha256(b"").hexdigest()),
        (None, "b", 3, False, hashlib.sha256(b"x").hexdigest()),
    ]
