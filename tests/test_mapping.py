import random

import pytest
from conftest import rows
from model import map_reasons

from imageset_spark import schemas as S
from imageset_spark.operators import mapping

BOX = (10.0, 20.0, 30.0, 40.0)
NO_BOX = (None,) * 4
CLASS_OF = {0: "Normal", 1: "Lung Opacity"}


def frames(spark, labels, classes, parts=1):
    left = spark.createDataFrame(labels, S.LABELS_SCHEMA).repartition(parts)
    return left, spark.createDataFrame(classes, S.CLASSES_SCHEMA).repartition(parts)


def reason(spark, label_rows, class_names, pid="p"):
    labels, classes = frames(
        spark, [(pid, *row) for row in label_rows], [(pid, name) for name in class_names]
    )
    found = mapping.mapping_verdict(labels, classes).collect()
    return [row.reason for row in found]


@pytest.mark.parametrize(
    "label_rows, class_names, expected",
    [
        ([(*NO_BOX, 0.0)], ["Normal"], None),
        ([(*BOX, 1.0)], ["Lung Opacity"], None),
        ([(*BOX, 1.0), (77.5, 31.0, 120.25, 88.0, 1.0)], ["Lung Opacity"] * 2, None),
        ([(*NO_BOX, 0.0), (*NO_BOX, None)], ["Normal"], None),
        ([(*NO_BOX, 0.0)], ["Normal", "Lung Opacity"], S.CONFLICTING_CLASSES),
        ([(*NO_BOX, 0.0)], ["One", "Two"], S.CONFLICTING_CLASSES),
        ([(*NO_BOX, 0.0)], [], S.MISSING_CLASS),
        ([(*NO_BOX, 0.0)], [None], S.MISSING_CLASS),
        ([(*BOX, None)], ["Lung Opacity"], S.MISSING_TARGET),
        ([(*BOX, float("nan"))], ["Lung Opacity"], S.MISSING_TARGET),
        ([(*BOX, 1.0), (*NO_BOX, 0.0)], ["Lung Opacity"], S.CONFLICTING_TARGETS),
        ([(*BOX, 2.0)], ["Lung Opacity"], S.INVALID_TARGET),
        ([(*BOX, 1.0)], ["Normal"], S.CLASS_TARGET_MISMATCH),
        ([(*NO_BOX, 0.0)], ["Something else"], S.CLASS_TARGET_MISMATCH),
        ([(None, 1.0, None, None, 0.0)], ["Normal"], S.UNEXPECTED_BOX_FOR_NEGATIVE),
        ([(*BOX, 1.0), (*NO_BOX, 1.0)], ["Lung Opacity"], S.MISSING_BOX_FOR_POSITIVE),
        ([(10.0, 20.0, None, 40.0, 1.0)], ["Lung Opacity"], S.INCOMPLETE_BOX),
        ([(10.0, 20.0, float("nan"), 40.0, 1.0)], ["Lung Opacity"], S.INCOMPLETE_BOX),
        ([(-1.0, 20.0, 0.0, 40.0, 1.0)], ["Lung Opacity"], S.INVALID_BOX_DIMENSIONS),
        ([(-1.0, 20.0, 30.0, 40.0, 1.0)], ["Lung Opacity"], S.INVALID_BOX_COORDINATES),
        ([(float("inf"), 20.0, 30.0, 40.0, 1.0)], ["Lung Opacity"], None),
    ],
)
def test_first_matching_rule(spark, label_rows, class_names, expected):
    assert reason(spark, label_rows, class_names) == [expected]


def test_missing_box_is_found_before_an_incomplete_one(spark):
    group = [(10.0, None, 30.0, 40.0, 1.0), (*NO_BOX, 1.0)]
    assert reason(spark, group, ["Lung Opacity"]) == [S.MISSING_BOX_FOR_POSITIVE]


def test_conflict_without_labels_is_listed_and_other_unlabelled_ids_are_not(spark):
    labels, classes = frames(
        spark,
        [("a", *NO_BOX, 0.0), (None, *NO_BOX, 0.0)],
        [("a", "Normal"), ("b", "Normal"), ("b", "Lung Opacity"), ("c", "Normal")],
    )
    verdict = mapping.mapping_verdict(labels, classes)
    assert rows(verdict, "sample_id", "reason") == [("a", None), ("b", S.CONFLICTING_CLASSES)]


def test_class_with_and_without_value_cannot_be_joined(spark):
    labels, classes = frames(spark, [("a", *NO_BOX, 0.0)], [("a", "Normal"), ("a", None)])
    with pytest.raises(Exception, match="not unique per patient"):
        mapping.mapping_verdict(labels, classes).collect()
    with pytest.raises(Exception, match="not unique per patient"):
        mapping.join_classes(labels, classes).collect()
    repeated = mapping.duplicate_join_keys(mapping.mergeable_classes(classes))
    assert rows(repeated) == [("a", 2)]


def test_canonical_records(spark):
    labels, classes = frames(
        spark,
        [("n", *NO_BOX, 0.0), ("p", *BOX, 1.0), ("p", *BOX, None), ("bad", *BOX, 0.0)],
        [("n", "No Lung Opacity / Not Normal"), ("p", "Lung Opacity"), ("bad", "Normal")],
    )
    result = mapping.map_records(labels, classes, "/images/")
    assert result.images.columns == S.IMAGE_SCHEMA.names
    assert rows(result.images) == [
        ("n", "/images/n.dcm", 0, S.SOURCE_DATASET, "No Lung Opacity / Not Normal"),
        ("p", "/images/p.dcm", 1, S.SOURCE_DATASET, "Lung Opacity"),
    ]
    assert rows(result.boxes) == [("p", *BOX), ("p", *BOX)]
    assert rows(result.rejections) == [(0, "bad", S.UNEXPECTED_BOX_FOR_NEGATIVE)]


def random_tables(seed, patients=150):
    pick = random.Random(seed)
    names = [*S.CLASS_LABELS, "Other"]
    labels, classes = [], []
    for i in range(patients):
        pid, target = f"p{i}", float(pick.random() < 0.6)
        for _ in range(pick.choice([1, 1, 2, 5])):
            box = list(BOX) if target else list(NO_BOX)
            if pick.random() < 0.15:
                box[pick.randrange(4)] = pick.choice(
                    [None, -1.0, 0.0, float("inf"), float("-inf"), float("nan")]
                )
            if pick.random() < 0.04:
                box = list(NO_BOX)
            labels.append((pid, *box, pick.choice([target] * 12 + [None, 1.0, 2.0])))
        if pick.random() < 0.95:
            own = [CLASS_OF[int(target)]] * 9 + names
            classes += [(pid, pick.choice(own))] * pick.choice([1, 2])
        if pick.random() < 0.05:
            classes.append((pid, pick.choice(names)))
    # One patient holds a third of all rows.
    labels += [("hot", *BOX[:3], float(i % 50 + 1), 1.0) for i in range(len(labels) // 2)]
    classes.append(("hot", "Lung Opacity"))
    pick.shuffle(labels)
    pick.shuffle(classes)
    return labels, classes


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 7), (3, 64)])
def test_random_tables_agree_with_the_row_model(spark, seed, parts):
    label_rows, class_rows = random_tables(seed)
    labels, classes = frames(spark, label_rows, class_rows, parts)
    expected = map_reasons(label_rows, class_rows)
    verdict = mapping.mapping_verdict(labels, classes).persist()
    assert {r.sample_id: r.reason for r in verdict.collect()} == expected
    accepted = {pid for pid, found in expected.items() if found is None}
    positive = {r[0] for r in label_rows if r[5] == 1.0} & accepted
    boxes = sorted((r[:5] for r in label_rows if r[0] in positive), key=str)
    for hot_rows in (3, 10**6):
        found = mapping.canonical_boxes(labels, verdict, hot_rows=hot_rows)
        assert sorted((tuple(r) for r in found.collect()), key=str) == boxes
    verdict.unpersist()


def test_joined_classes_keep_every_label_row(spark):
    label_rows, class_rows = random_tables(4)
    labels, classes = frames(spark, label_rows, class_rows, 5)
    names = {}
    for pid, name in class_rows:
        names.setdefault(pid, set()).add(name)
    joined = mapping.join_classes(labels, classes)
    assert joined.count() == len(label_rows)
    for row in joined.select("patientId", "class").distinct().collect():
        own = names.get(row["patientId"], set())
        assert row["class"] == (next(iter(own)) if len(own) == 1 else None)


def test_label_rows_without_a_patient_are_joined_with_no_class(spark):
    label_rows = [(None, *BOX, 1.0), (None, *BOX, 1.0), (None, *NO_BOX, None), ("a", *NO_BOX, 0.0), ("b", *BOX, 1.0)]
    class_rows = [("a", "Normal"), (None, "Lung Opacity"), (None, "Normal"), (None, None)]
    labels, classes = frames(spark, label_rows, class_rows, 3)
    joined = mapping.join_classes(labels, classes).select(*labels.columns, "class")
    expected = [(*row, "Normal" if row[0] == "a" else None) for row in label_rows]
    assert rows(joined) == sorted(expected, key=lambda r: tuple(map(str, r)))
