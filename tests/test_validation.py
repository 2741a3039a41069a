import random

import pytest
from conftest import rows
from model import validate

from imageset_spark import schemas as S
from imageset_spark.operators import validation

BOX_ROWS = "sample_id string, x double, y double, width double, height double, row_seq bigint"
OK = (True, 2, 100, 100)


def frames(spark, images, boxes, audit, parts=1):
    records = [(pid, f"/i/{pid}.dcm", label, "d", "c") for pid, label in images]
    return (
        spark.createDataFrame(records, S.IMAGE_SCHEMA).repartition(parts),
        spark.createDataFrame([(*b, i) for i, b in enumerate(boxes)], BOX_ROWS).repartition(parts),
        spark.createDataFrame([(pid, *a) for pid, a in audit.items()], S.AUDIT_SCHEMA),
    )


def run(spark, images, boxes, audit, parts=1, **more):
    return validation.validate_records(*frames(spark, images, boxes, audit, parts), "row_seq", **more)


def ledger(result):
    return sorted((r.sample_id, r.reason) for r in result.rejections.collect())


@pytest.mark.parametrize(
    "label, boxes, audit, expected",
    [
        (1, [("a", 10.0, 20.0, 30.0, 40.0)], OK, []),
        (1, [], OK, []),
        (1, [("a", 70.0, 60.0, 30.0, 40.0)], OK, []),
        (1, [], None, [S.IMAGE_FILE_NOT_FOUND]),
        (1, [], (False, None, None, None), [S.UNREADABLE_IMAGE]),
        (1, [], (True, 3, None, None), [S.INVALID_IMAGE_DIMENSIONS]),
        (1, [], (True, 2, 0, 10), [S.INVALID_IMAGE_DIMENSIONS]),
        (0, [("a", 1.0, 1.0, 1.0, 1.0)], OK, [S.UNEXPECTED_BOX_FOR_NEGATIVE]),
        (1, [("a", float("nan"), 1.0, 1.0, 1.0)], OK, [S.NON_FINITE_BOX]),
        (1, [("a", -1.0, 1.0, 0.0, 1.0)], OK, [S.INVALID_BOX_COORDINATES]),
        (1, [("a", 1.0, 1.0, 0.0, 1.0)], OK, [S.INVALID_BOX_DIMENSIONS]),
        (1, [("a", 71.0, 60.0, 30.0, 40.0)], OK, [S.BOX_OUTSIDE_IMAGE]),
        # The first faulty box decides, not the most severe fault.
        (1, [("a", 1.0, 1.0, 1.0, 1.0), ("a", 1.0, 1.0, 0.0, 1.0), ("a", -1.0, 1.0, 1.0, 1.0)],
         OK, [S.INVALID_BOX_DIMENSIONS]),
    ],
)
def test_single_image(spark, label, boxes, audit, expected):
    result = run(spark, [("a", label)], boxes, {"a": audit} if audit else {"other": OK})
    assert [reason for _, reason in ledger(result)] == expected
    assert rows(result.images, "sample_id") == ([] if expected else [("a",)])
    assert result.boxes.count() == (0 if expected else len(boxes))


def test_every_copy_of_an_image_is_refused_once(spark):
    result = run(spark, [("a", 1), ("a", 1), ("b", 0)], [], {"a": OK, "b": OK})
    assert ledger(result) == [("a", S.DUPLICATE_IMAGE_RECORD)]
    assert rows(result.images, "sample_id") == [("b",)]


def test_listed_duplicates_are_not_listed_again(spark):
    prior = spark.createDataFrame([(0, "a", S.DUPLICATE_IMAGE_RECORD)], S.REJECTION_SCHEMA)
    result = run(spark, [("a", 1), ("a", 1)], [], {"a": OK}, rejections=prior)
    assert ledger(result) == [("a", S.DUPLICATE_IMAGE_RECORD)]


def test_unknown_boxes_are_listed_per_distinct_box(spark):
    boxes = [("u", 1.0, 1.0, 1.0, 1.0)] * 2 + [("u", 2.0, 1.0, 1.0, 1.0)]
    result = run(spark, [("a", 1)], boxes, {"a": OK})
    assert ledger(result) == [("u", S.UNKNOWN_IMAGE_REFERENCE)] * 2
    assert result.duplicates.first()[0] == 1


def test_boxes_with_nan_are_never_copies(spark):
    nan = float("nan")
    boxes = [("a", nan, 1.0, 1.0, 1.0)] * 2 + [("a", 1.0, 1.0, 1.0, 1.0)] * 3
    _, frame, _ = frames(spark, [("a", 1)], boxes, {"a": OK})
    unique = validation.dedupe_boxes(frame, "row_seq")
    assert sorted(r.copies for r in unique.collect()) == [1, 1, 3]
    assert validation.removed_duplicates(unique).first()[0] == 2


def random_records(seed, n=80):
    pick = random.Random(seed)
    images, boxes, audit = [], [], {}
    for i in range(n):
        pid = f"i{i}"
        images += [(pid, int(pick.random() < 0.8))] * (2 if pick.random() < 0.05 else 1)
        if pick.random() < 0.93:
            audit[pid] = pick.choice([OK] * 12 + [(False, None, None, None), (True, 3, None, None)])
        for _ in range(pick.choice([0, 1, 2, 3])):
            box = [10.0, 20.0, 30.0, 40.0 + pick.randrange(3)]
            if pick.random() < 0.15:
                box[pick.randrange(4)] = pick.choice([-1.0, 0.0, 500.0, float("inf")])
            owner = pid if pick.random() < 0.95 else f"u{i}"
            boxes += [(owner, *box)] * pick.choice([1, 1, 2])
    # One image holds a third of all boxes, most of them copies of a few.
    images.append(("hot", 1))
    audit["hot"] = OK
    boxes += [("hot", 1.0, 1.0, 2.0, float(i % 40 + 1)) for i in range(len(boxes) // 2)]
    pick.shuffle(boxes)
    return images, boxes, audit


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 7), (3, 64)])
def test_random_records_agree_with_the_row_model(spark, seed, parts):
    images, boxes, audit = random_records(seed)
    valid, kept, expected, removed = validate(images, boxes, audit)
    result = run(spark, images, boxes, audit, parts)
    assert ledger(result) == sorted(expected)
    assert {r.sample_id for r in result.images.collect()} == valid
    found = result.boxes.select("sample_id", *S.COORDINATES)
    assert rows(found) == sorted(kept, key=lambda r: tuple(map(str, r)))
    assert result.duplicates.first()[0] == removed
    crowded = validation.valid_images(frames(spark, images, boxes, audit)[0], result.verdict, 1)
    assert {r.sample_id for r in crowded.collect()} == valid


def test_hot_images_are_salted_without_changing_the_result(spark):
    images, boxes, audit = random_records(9)
    image_rows, box_rows, audit_rows = frames(spark, images, boxes, audit, 4)
    state = validation.image_state(image_rows, box_rows, audit_rows)
    unique = validation.dedupe_boxes(box_rows, "row_seq")
    plain = validation.judge_boxes(unique, state)
    salted = validation.judge_boxes(unique, state, hot_rows=2)
    assert rows(plain, *sorted(plain.columns)) == rows(salted, *sorted(plain.columns))
    geometry = validation.geometry_verdict(plain, "row_seq")
    assert rows(validation.valid_boxes(plain, geometry)) == rows(
        validation.valid_boxes(salted, geometry, hot_rows=1)
    )


def test_missing_files(spark):
    image_rows, _, audit_rows = frames(spark, [("a", 1), ("b", 0)], [("a", 1.0, 1.0, 1.0, 1.0)],
                                       {"a": OK})
    assert rows(validation.missing_files(image_rows, audit_rows)) == [
        ("b", S.IMAGE_FILE_NOT_FOUND)
    ]


def test_records_without_an_id_reach_the_ledger(spark):
    result = run(
        spark, [("a", 1), (None, 1)],
        [("a", 1.0, 1.0, 5.0, 5.0), (None, 1.0, 1.0, 5.0, 5.0), (None, 1.0, 1.0, 5.0, 5.0), (None, 2.0, 1.0, 5.0, 5.0)],
        {"a": OK},
    )
    found = sorted((str(r.sample_id), r.reason) for r in result.rejections.collect())
    assert found == [
        ("None", S.IMAGE_FILE_NOT_FOUND), ("None", S.UNKNOWN_IMAGE_REFERENCE), ("None", S.UNKNOWN_IMAGE_REFERENCE),
    ]
    assert rows(result.images, "sample_id") == [("a",)] and result.boxes.count() == 1


@pytest.mark.parametrize("seed, parts", [(4, 1), (5, 23)])
def test_the_ordered_ledger_is_the_row_models(spark, seed, parts):
    images, boxes, audit = random_records(seed)
    images = sorted(images)
    prior = [(0, "m2", "missing_class"), (0, "m9", S.CONFLICTING_CLASSES), (0, "m1", "missing_target"), (0, "m3", S.CONFLICTING_CLASSES)]
    mapped = [("m3", S.CONFLICTING_CLASSES), ("m9", S.CONFLICTING_CLASSES), ("m1", "missing_target"), ("m2", "missing_class")]
    expected = mapped + validate(images, boxes, audit)[2]
    result = run(spark, images, boxes, audit, parts, rejections=spark.createDataFrame(prior, S.REJECTION_SCHEMA))
    found = sorted(tuple(r) for r in validation.ordered_ledger(result.ledger).collect())
    assert [(i, reason) for _, _, i, reason in found] == expected
    assert [place for place, *_ in found] == list(range(len(expected)))
    assert result.rejections.columns == ["stage", "sample_id", "reason"]
