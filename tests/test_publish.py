import pytest
from conftest import rows
from pyspark.sql import functions as F

from imageset_spark import sources
from imageset_spark.operators import splits
from imageset_spark.plans import split as split_job
from imageset_spark.sources import versions as P


def table(spark, n, first=0):
    return spark.range(first, first + n).select(F.col("id").cast("string").alias("sample_id"), (F.col("id") % 2).cast("int").alias("label"))


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_readers_see_the_last_version(spark, tmp_path, format):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing was published"):
        P.read_published(spark, path, table(spark, 1).schema, format)
    for n in (5, 3, 4):
        P.publish(table(spark, n), path, format)
        assert P.read_published(spark, path, table(spark, 1).schema, format).count() == n
    assert P.last_commit(spark, path).seq == 3
    assert len({r.version for r in P._commits(spark, path).collect()}) == 3


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_a_refused_version_leaves_the_old_one(spark, tmp_path, monkeypatch, format):
    path, images = str(tmp_path / "splits"), table(spark, 200)
    split_job.split_manifest(images, path, format=format)
    schema = splits.create_splits(images).schema
    before = rows(P.read_published(spark, path, schema, format))
    assert len(before) == 200

    def lossy(images, *args):
        return splits.create_splits(images, *args).where("sample_id <> '7'")

    monkeypatch.setattr(split_job, "create_splits", lossy)
    with pytest.raises(RuntimeError, match="cover"):
        split_job.split_manifest(images, path, seed=7, format=format)
    assert rows(P.read_published(spark, path, schema, format)) == before
    assert P.last_commit(spark, path).seq == 1


def test_a_write_that_fails_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    P.publish(table(spark, 5), path)
    broken = table(spark, 5).withColumn("label", F.when(F.col("label") == 1, F.raise_error(F.lit("lost")).cast("int")).otherwise(0))
    with pytest.raises(Exception, match="lost"):
        P.publish(broken, path)
    assert P.read_published(spark, path, table(spark, 1).schema).count() == 5


def test_two_tables_are_committed_together(spark, tmp_path):
    drafts = [P.prepare(table(spark, n), str(tmp_path / str(n))) for n in (2, 3)]
    assert all(P.last_commit(spark, str(tmp_path / str(n))) is None for n in (2, 3))
    for draft in drafts:
        draft.commit(spark)
    assert [P.read_published(spark, str(tmp_path / str(n)), table(spark, 1).schema).count() for n in (2, 3)] == [2, 3]


def test_files_outside_the_list_are_not_read(spark, tmp_path):
    path = tmp_path / "t"
    P.publish(table(spark, 5).coalesce(1), str(path))
    (part,) = path.glob("_published/*/data/part-*.parquet")
    (part.parent / "part-stray.parquet").write_bytes(part.read_bytes())
    assert P.read_published(spark, str(path), table(spark, 1).schema).count() == 5
    found = {r.name: (r.expected is None, r.matches) for r in P.verify_published(spark, str(path)).collect()}
    assert found == {part.name: (False, True), "part-stray.parquet": (True, False)}


def test_changed_and_lost_files_are_found(spark, tmp_path):
    path = tmp_path / "t"
    P.publish(table(spark, 100).repartition(2), str(path), "csv")
    first, second = sorted(path.glob("_published/*/data/part-*.csv"))
    for part in (first, second):
        (part.parent / f".{part.name}.crc").unlink()
    first.write_text(first.read_text().replace("1", "2"))
    second.rename(second.with_name("_gone"))
    found = {r.name: (r.actual is None, r.matches) for r in P.verify_published(spark, str(path)).collect()}
    assert found == {first.name: (False, False), second.name: (True, False)}


def test_a_list_that_was_not_committed_is_refused(spark, tmp_path):
    path = tmp_path / "t"
    P.publish(table(spark, 4), str(path))
    (listed,) = path.glob("_published/*/files")
    extra = spark.createDataFrame([("x", 1, "00")], P.MANIFEST_SCHEMA)
    extra.write.mode("append").parquet(str(listed))
    with pytest.raises(ValueError, match="not the one that was committed"):
        P.read_published(spark, str(path), table(spark, 1).schema)


def test_an_empty_table_is_published(spark, tmp_path):
    for format in ("parquet", "csv"):
        path = str(tmp_path / format)
        sources.write_splits(splits.create_splits(table(spark, 200)).limit(0), path, format)
        schema = splits.create_splits(table(spark, 200)).schema
        empty = P.read_published(spark, path, schema, format)
        assert empty.collect() == [] and empty.columns == schema.names
