import os

import pytest

from imageset_spark.functions import clear_staged, stage, staging, staging_dir


def test_staged_tables_are_removed_on_request(spark, monkeypatch):
    monkeypatch.setattr(staging, "_STAGED", [])
    first, second = (stage(spark.range(n), f"clear-{n}") for n in (3, 4))
    assert first.count() + second.count() == 7
    paths = list(staging._STAGED)
    assert len(paths) == 2 and all(p.startswith(f"{staging_dir(spark)}/imageset/clear-") and os.path.isdir(p) for p in paths)
    # A path that was handed out and never written is no table.
    staging.staged_path(spark, "never")
    assert clear_staged(spark) == 2
    assert not any(os.path.exists(p) for p in paths) and clear_staged(spark) == 0
    with pytest.raises(Exception, match="(?i)not.exist|not_exist"):
        first.collect()
    assert stage(spark.range(5), "after").count() == 5


def test_shuffle_files_of_a_written_table_are_removed(spark, monkeypatch):
    seen = []
    write = type(spark.range(1).write).parquet
    monkeypatch.setattr(
        type(spark.range(1).write), "parquet",
        lambda self, path: (seen.append(spark.conf.get(staging._FREES_SHUFFLES, None)), write(self, path))[1])
    before = spark.conf.get(staging._FREES_SHUFFLES, None)
    assert stage(spark.range(9).groupBy("id").count(), "freed").count() == 9
    assert seen == ["true"] and spark.conf.get(staging._FREES_SHUFFLES, None) == before
