"""The pipeline against the operators' models, stage by stage, and the registered queries."""

from collections import Counter

import pytest
from samples import clashing, documents, odd_documents, prose
from test_jaccard import edited
from test_jaccard import model as components
from test_quality_rules import model as quality

import __spark_entry__ as entry
import corpus_pipeline
from imageset_spark.llm import mixing
from workload.compare import connect, differences

DATA = "/root/testdata/sf0.001"
LLM = [name for name in entry.queries() if name.startswith("op")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, prose(30 + i, 4000 + i)) for i in range(6)]
    rows = []
    for i in range(240):
        text = prose(60 + i % 70, i)
        if i % 6 == 1:
            text = edited(prose(60 + (i - 1) % 70, i - 1), 1, i)
        if i % 40 == 2:
            text += " " + items[i % 6][1]
        if i % 25 == 3:
            text = "word again " * 60
        rows.append((i, text, "en", "hot" if i % 3 == 0 else f"s{i % 4}"))
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_pipeline_matches_the_models(spark, folder):
    path, rows, items = folder
    kept = [r for r in rows if quality(r[1])[-1]]
    group = {i: c for i, _, c in components([(r[0], r[1]) for r in kept])}
    single = [r for r in kept if group[r[0]] == r[0]]
    clean = [r for r in single if not any(" ".join(t.split()) in " ".join(r[1].split()) for _, t in items)]
    assert len(rows) > len(kept) > len(single) > len(clean) > 100
    copies = {r.id: r.copies for r in mixing.take_words(documents(spark, clean)).collect()}
    out = corpus_pipeline.run(spark, path).collect()
    assert Counter(r.doc_id for r in out) == {i: c for i, c in copies.items() if c}
    assert {(r.doc_id, r.text, r.source) for r in out} <= {(r[0], r[1], r[3]) for r in clean}
    per_shard = Counter(r.shard for r in out)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    assert sorted((r.shard, r.slot) for r in out) == sorted((s, k) for s, n in per_shard.items() for k in range(n))


def test_stages_keep_columns_and_survive_odd_and_empty_tables(spark, folder):
    for docs in (odd_documents(spark), clashing(documents(spark, [])), odd_documents(spark, extra=False)):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, folder[0])
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            out.collect()


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", LLM)
def test_registered_query(spark, name):
    if name in entry.oracle_sql():
        from imageset_spark.llm import queries
        import workload.compare as compare

        both = dict(compare.QUERIES), dict(compare.ORACLES)
        try:
            compare.QUERIES.update(queries.QUERIES)
            compare.ORACLES.update(queries.ORACLES)
            assert differences(spark, connect(DATA), name, DATA) == ""
        finally:
            for kept, table in zip(both, (compare.QUERIES, compare.ORACLES)):
                table.clear()
                table.update(kept)
    else:
        table = "pages" if "url" in name else "documents"
        out = entry.queries()[name](spark, DATA)
        assert out.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()
