import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from imageset_spark.operators import splits
from imageset_spark.plans import split_manifest


def table(spark, per_label=100, labels=(0, 1)):
    data = [(f"scan{i:04d}{'np'[label] if label < 2 else label}", label, f"x{i}") for label in labels for i in range(per_label)]
    return spark.createDataFrame(data, "sample_id string, label int, note string")


def sizes(assigned):
    found = assigned.groupBy("split", "label").count().collect()
    return {(r.split, r.label): r["count"] for r in found}


def test_quotas_of_the_published_corpus():
    quotas = splits.split_quotas({0: 20672, 1: 6012}, 0.15, 0.15)
    assert quotas == {0: (14470, 3101, 3101), 1: (4208, 902, 902)}


def test_sizes_are_exact_and_columns_pass_through(spark):
    assigned = splits.create_splits(table(spark))
    assert sizes(assigned) == {
        ("train", 0): 70, ("train", 1): 70, ("validation", 0): 15, ("validation", 1): 15,
        ("test", 0): 15, ("test", 1): 15,
    }
    assert assigned.columns == ["sample_id", "label", "note", "split"]
    assert assigned.select("sample_id").distinct().count() == 200


@pytest.mark.parametrize("counts", [(40, 13), (7, 211), (333, 334)])
def test_uneven_labels_follow_the_quotas(spark, counts):
    data = [(f"{label}/{i}", label) for label, n in enumerate(counts) for i in range(n)]
    images = spark.createDataFrame(data, "sample_id string, label int")
    quotas = splits.split_quotas(dict(enumerate(counts)), 0.2, 0.1)
    found = sizes(splits.create_splits(images, 0.7, 0.2, 0.1))
    for label, parts in quotas.items():
        for name, n in zip(("train", "validation", "test"), parts):
            assert found.get((name, label), 0) == n


def test_same_split_for_any_partitioning_and_order(spark):
    images = table(spark)
    first = rows(splits.create_splits(images, seed=7), "sample_id", "split")
    for parts in (1, 7, 64):
        again = images.orderBy(F.rand(parts)).repartition(parts)
        assert rows(splits.create_splits(again, seed=7), "sample_id", "split") == first
    assert rows(splits.create_splits(images, seed=8), "sample_id", "split") != first


@pytest.mark.parametrize(
    "ratios",
    [
        (0.6, 0.4, 0.0), (1.0, 0.0, 0.0), (0.2, 1.2, -0.4), (float("inf"), 0.3, 0.3),
        (0.5, 0.25, float("nan")), (0.5, 0.3, 0.2 + 1e-8), (0.5, 0.3, 0.2 - 1e-8),
    ],
)
def test_bad_ratios(spark, ratios):
    with pytest.raises(ValueError, match="ratios"):
        splits.create_splits(table(spark), *ratios)


@pytest.mark.parametrize(
    "data, message",
    [
        ([], "empty"),
        ([(None, 0), ("b", 1)], "must not be missing"),
        ([(" \t", 0), ("b", 1)], "blank"),
        ([("a", 0), ("a", 1)], "unique"),
        ([("a", None), ("b", 1)], "label must not be missing"),
        ([("a", 2), ("b", 1)], "0 or 1"),
        ([("a", 1), ("b", 1)], "both labels"),
        ([(f"{label}{i}", label) for label in (0, 1) for i in range(3)], "too few"),
    ],
)
def test_bad_tables(spark, data, message):
    images = spark.createDataFrame(data, "sample_id string, label int")
    with pytest.raises(ValueError, match=message):
        splits.create_splits(images)


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="label"):
        splits.create_splits(spark.createDataFrame([("a",)], "sample_id string"))


def test_verification_finds_every_kind_of_damage(spark):
    images = table(spark, 20)
    good = splits.create_splits(images)
    splits.verify_splits(images, good)
    twice = good.limit(1).withColumn("split", F.lit("nowhere")).unionByName(good)
    assert splits.split_verification(images, twice).first().row_difference == 1
    lost = good.where("sample_id <> 'scan0003n'")
    with pytest.raises(RuntimeError, match="cover"):
        splits.verify_splits(images, lost)
    both = good.unionByName(good.withColumn("split", F.when(F.col("split") == "train", "test")
                                            .otherwise("train")))
    with pytest.raises(RuntimeError, match="overlap"):
        splits.verify_splits(images, both)


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_written_splits_and_report(spark, tmp_path, format):
    report = split_manifest(table(spark), str(tmp_path / "out"), format=format)
    found = {r.split: (r.n_rows, r.class_counts) for r in report.collect()}
    assert found == {
        "train": (140, {"0": 70, "1": 70}),
        "validation": (30, {"0": 15, "1": 15}),
        "test": (30, {"0": 15, "1": 15}),
    }
    assert {r.seed for r in report.collect()} == {42}


def test_ratios_within_the_tolerance(spark):
    assert splits.create_splits(table(spark), 0.5, 0.3, 0.2 + 1e-10).count() == 200


def test_report_as_json(spark):
    report = splits.split_report(splits.create_splits(table(spark)))
    found = json.loads(splits.split_report_json(report, 42).first().report)
    half = {"rows": 30, "class_counts": {"0": 15, "1": 15}}
    assert found == {
        "seed": 42,
        "splits": {"train": {"rows": 140, "class_counts": {"0": 70, "1": 70}},
                   "validation": half, "test": half},
    }


def test_subset_and_epoch_order(spark):
    images = table(spark, 10)
    assert [r[0] for r in splits.smoke_subset(images, 2).collect()] == ["scan0000n", "scan0000p"]
    first = [r[0] for r in splits.epoch_order(images, 1).collect()]
    assert first == [r[0] for r in splits.epoch_order(images.repartition(7), 1).collect()]
    assert first != [r[0] for r in splits.epoch_order(images, 2).collect()]
