import random
import zlib

import numpy as np
import pyarrow as pa
from samples import clashing, documents, odd_documents, prose

from imageset_spark.llm import classifier as C


def walk(model, row):
    margin = model["prior"]
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"]):
        place = 0
        while place < len(feature):
            place = 2 * place + 1 + int(row[feature[place]] > cut[place])
        margin += leaf[place - len(feature)]
    return 1 / (1 + np.exp(-margin))


def test_flat_traversal_matches_a_walk_and_learns():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] > 0)).astype(float)
    model = C.fit(x[:1000], y[:1000])
    p = C.score(model, x)
    assert np.allclose(p[:40], [walk(model, row) for row in x[:40]])
    assert ((p[1000:] > 0.5) == y[1000:]).mean() > 0.93


def test_no_labels_or_one_class():
    assert C.score(C.fit(np.zeros((0, 3)), np.zeros(0)), np.zeros((2, 3))).tolist() == [0.5, 0.5]
    assert C.score(C.fit(np.zeros((4, 3)), np.ones(4)), np.zeros((1, 3)))[0] > 0.99


def test_features_of_odd_texts_are_finite():
    x = C.features(pa.array([None, "", " ", "a", "é" * 5000, prose(20_000, 1)]))
    assert x.shape == (6, len(C.FEATURES)) and np.isfinite(x).all() and not x[:2].any()


def corpus(spark, n=500):
    rng, rows, labels = random.Random(4), [], []
    for i in range(n):
        bad = rng.random() < 0.3
        text = prose(60 + i % 50, i)
        rows.append((i, " ".join(w + rng.choice(["###", "$$$", ""]) for w in text.split()) if bad else text))
        labels.append((i, int(not bad)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_held_out_rows_are_told_apart_and_never_learnt_from(spark):
    docs, labels = corpus(spark)
    out = {r.doc_id: r for r in C.score_documents(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [i for i in out if out[i].held_out]
    assert sum((out[i].score >= 0.5) == truth[i] for i in held) >= 0.95 * len(held)
    # Turning the held-out labels round changes nothing.
    flipped = spark.createDataFrame([(i, 1 - y if i in held else y) for i, y in truth.items()], labels.schema)
    again = {r.doc_id: r.score for r in C.score_documents(docs, flipped).collect()}
    assert again == {i: r.score for i, r in out.items()}


def test_odd_rows(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame(
        [(6, 1), (6, 0), (9, None), (None, 1), (99, 1), (7, 1), (11, 1)], "doc_id bigint, quality int")
    out = C.score_documents(docs, clashing(labels)).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    assert [r.held_out for r in out if r.doc_id is None] == [True, True]
    assert {r.score for r in C.score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert C.score_documents(clashing(documents(spark, [])), labels).collect() == []
