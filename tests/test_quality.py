import pytest
from conftest import rows
from pyspark.sql import functions as F

from imageset_spark import schemas as S
from imageset_spark.operators import quality

BOX = (1.0, 2.0, 3.0, 4.0)
NONE = (None,) * 4


@pytest.fixture(scope="module")
def clean(spark):
    labels = spark.createDataFrame(
        [("a", *BOX, 1.0), ("a", *BOX, 1.0), ("b", *NONE, 0.0)], S.LABELS_SCHEMA
    )
    classes = spark.createDataFrame(
        [("a", "Lung Opacity"), ("a", "Lung Opacity"), ("b", "Normal")], S.CLASSES_SCHEMA
    )
    return labels, classes, spark.createDataFrame([("a",), ("b",)], "sample_id string")


def test_clean_tables_meet_all_expectations(clean):
    found = quality.expectations(*clean, strict=True).collect()
    assert len(found) == 14 and all(r.passed and r.violations == 0 for r in found)


def test_broken_tables_fail_by_name(spark, clean):
    labels = clean[0].unionByName(
        spark.createDataFrame(
            [("c", -1.0, 2.0, 3.0, 4.0, 1.0), ("d", None, 1.0, 1.0, 1.0, 1.0),
             ("e", *BOX, 0.0), ("e", *NONE, 2.0)],
            S.LABELS_SCHEMA,
        )
    )
    classes = clean[1].unionByName(
        spark.createDataFrame(
            [("b", "Lung Opacity"), ("c", "Odd"), ("d", "Normal"), ("f", "Normal")],
            S.CLASSES_SCHEMA,
        )
    )
    listing = spark.createDataFrame([("a",), ("x",)], "sample_id string")
    found = {r.check_name: r.violations for r in
             quality.expectations(labels, classes, listing).collect()}
    assert found == {
        "classes_supported": 1, "no_class_conflicts": 1, "classes_map_to_label": 1,
        "one_class_row_per_image": 1, "targets_are_binary": 1, "negatives_have_no_box": 1,
        "positives_have_full_box": 1, "no_target_conflicts": 1, "one_target_per_image": 1,
        "box_geometry_valid": 1, "images_in_both_sources": 2, "labels_agree": 2,
        "every_image_has_file": 5, "every_file_is_labelled": 1,
    }
    with pytest.raises(ValueError, match="targets_are_binary"):
        quality.expectations(labels, classes, listing, strict=True)


def test_reconciliation_marks_sides_and_disagreements(spark):
    targets = spark.createDataFrame(
        [("a", 1.0), ("b", 1.0), ("c", None), ("d", 0.0)], "patientId string, label double"
    )
    info = quality.class_info(
        spark.createDataFrame(
            [("a", "Lung Opacity"), ("b", "Normal"), ("c", "Normal"), ("e", "Normal")],
            S.CLASSES_SCHEMA,
        )
    )
    found = quality.reconcile_sources(targets, info)
    assert rows(found, "patientId", "source", "disagrees") == [
        ("a", "both", False), ("b", "both", True), ("c", "both", True),
        ("d", "left_only", False), ("e", "right_only", False),
    ]


def test_strict_reconciliation_needs_unique_patients(spark, clean):
    targets = quality.image_targets(clean[0])
    info = quality.class_info(clean[1])
    assert quality.reconcile_sources(targets, info, strict=True).count() == 2
    with pytest.raises(ValueError, match="a occurs 2 times"):
        quality.reconcile_sources(targets, info.unionByName(info.limit(1)).orderBy("patientId")
                                  .where("patientId = 'a'"), strict=True)


def test_crosstab_has_margins(spark):
    table = spark.createDataFrame(
        [("n", 0), ("n", 0), ("l", 1), (None, 1)], "raw_class string, label int"
    )
    found = quality.class_label_crosstab(table, "raw_class", "label")
    counts = {(r.raw_class, r.label): r.n_rows for r in found.collect()}
    assert counts == {("n", 0): 2, ("l", 1): 1, ("n", None): 2, ("l", None): 1,
                      (None, 0): 2, (None, 1): 1, (None, None): 3}


def test_counts_of_boxes_rows_and_values(spark, clean):
    labels, classes, _ = clean
    assert rows(quality.value_counts(classes, "class")) == [("Lung Opacity", 2), ("Normal", 1)]
    assert quality.repeated_rows(classes, ["patientId", "class"]).first()[0] == 2
    for approximate in (False, True):
        assert rows(quality.profile_counts({"l": labels}, approximate=approximate)) == [("l", 3, 2)]
    boxes = quality.positive_boxes(labels)
    assert rows(quality.boxes_per_image_hist(boxes)) == [(1, 1)]
    raw = quality.positive_boxes(labels, distinct=False)
    assert quality.max_boxes_per_image(raw).first()[0] == 2


def test_coverage_and_first_ids(spark):
    def ids(*names):
        return spark.createDataFrame([(n,) for n in names], "sample_id string")

    assert rows(quality.file_coverage(ids("a", "b", "b"), ids("b", "c"))) == [
        ("a", "missing"), ("c", "extra")
    ]
    images = spark.createDataFrame(
        [("b", "N"), ("a", "N"), ("c", "L"), ("0", None)], "sample_id string, raw_class string"
    )
    assert rows(quality.first_per_class(images), "raw_class", "sample_id") == [
        ("L", "c"), ("N", "a")
    ]


def test_reconciled_tables_keep_every_patient(spark):
    labels = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("b", 0.0), ("b", 1.0), ("c", None), ("d", 0.0), (None, 1.0), ("g", float("nan"))],
        "patientId string, Target double",
    )
    classes = spark.createDataFrame(
        [("a", "Normal"), ("b", "Normal"), ("c", "Lung Opacity"), ("e", "Normal"), ("f", None), ("f", "Normal"),
         ("h", "Normal"), ("h", "Lung Opacity"), (None, "Normal"), ("g", "Normal")],
        "patientId string, class string",
    )
    found = {r.patientId: tuple(r)[1:] for r in quality.reconcile_tables(labels, classes).collect()}
    assert found == {
        "a": (1.0, "Normal", 0, "both", True, False),
        "b": (None, "Normal", 0, "both", True, True),
        "c": (None, "Lung Opacity", 1, "both", True, False),
        "d": (0.0, None, None, "left_only", False, False),
        "e": (None, "Normal", 0, "right_only", False, False),
        "f": (None, "Normal", 0, "right_only", False, False),
        "g": (None, "Normal", 0, "both", True, False),
        "h": (None, None, None, "right_only", False, True),
    }


def test_expectations_read_every_table_once(spark, tmp_path, clean):
    names = ("labels", "classes", "files")
    for name, table in zip(names, clean):
        table.write.parquet(str(tmp_path / name))
    read = [spark.read.parquet(str(tmp_path / name)) for name in names]
    plan = quality.expectations(*read)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert len(scans) == 3


def test_rows_without_id_count_for_boxes_and_classes_only(spark, clean):
    labels = clean[0].unionByName(spark.createDataFrame(
        [(None, -1.0, 2.0, 3.0, 4.0, 1.0), (None, -1.0, 2.0, 3.0, 4.0, 1.0), (None, 1.0, 2.0, 3.0, 0.0, 1.0), (None, *NONE, 7.0)],
        S.LABELS_SCHEMA))
    classes = clean[1].unionByName(spark.createDataFrame([(None, "Odd"), (None, "Odd"), (None, "Even"), (None, None)], S.CLASSES_SCHEMA))
    found = {r.check_name: r.violations for r in quality.expectations(labels, classes, clean[2]).collect() if r.violations}
    assert found == {"box_geometry_valid": 2, "classes_supported": 2}


def test_sketches_of_batches_merge(spark):
    whole = spark.range(30_000).select(F.col("id").cast("string").alias("patientId"))
    parts = [quality.key_sketches({"t": whole.where(f"id % 3 >= {k}"), "u": whole.limit(k)}) for k in range(3)]
    merged = quality.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    found = {r.table_name: r for r in quality.sketched_counts(merged).collect()}
    assert found["t"].n_rows == 60_000 and abs(found["t"].unique_ids - 30_000) < 600
    assert (found["u"].n_rows, found["u"].unique_ids) == (3, 2)
    # A sketch does not grow with what it counts.
    sizes = {r.table_name: r.n for r in parts[0].selectExpr("table_name", "length(keys) AS n").collect()}
    assert sizes["t"] < 20_000
