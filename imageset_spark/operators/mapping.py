"""From two annotation tables to canonical images, boxes and rejections.

``labels`` holds one row per box (or one row without a box), ``classes`` one or
more rows per image. Both are folded into one row per patient by a single
grouped aggregate over their union: every row is pre-aggregated before the
shuffle, so a patient with very many rows costs no more than any other, and no
join between the two tables is needed.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import (
    HOT_ROWS,
    any_missing,
    any_present,
    class_label,
    is_number,
    name_of,
    nan_to_null,
    number_of,
    salted_join,
    stage,
)

_KNOWN_CLASSES = list(S.CLASS_LABELS)


class MappingResult(NamedTuple):
    images: DataFrame
    boxes: DataFrame
    rejections: DataFrame


def clean_labels(labels):
    """NaN to NULL in the numeric columns; other columns pass through."""
    numeric = [*S.COORDINATES, "Target"]
    return labels.withColumns({name: nan_to_null(name) for name in numeric})


def distinct_classes(classes):
    """Distinct (patientId, class) pairs; a missing class equals a missing class."""
    return classes.select("patientId", "class").distinct()


def _classes_per_patient(classes):
    pairs = distinct_classes(classes).where(F.col("patientId").isNotNull())
    return pairs.groupBy("patientId").agg(F.count("class").alias("n_classes"))


def conflicting_classes(classes):
    """Patients with more than one distinct class, whether or not they have labels."""
    return _classes_per_patient(classes).where("n_classes > 1")


def classes_per_patient(classes):
    """One row per patient: lowest and highest class, and whether a row has none.

    Classes conflict exactly when lowest and highest differ. Rows without a
    patient are kept apart by class, so that they conflict with nothing.
    """
    alone = F.when(F.col("patientId").isNull(), F.col("class"))
    return (
        classes.groupBy("patientId", alone.alias("_alone"))
        .agg(
            F.min("class").alias("lowest"), F.max("class").alias("highest"),
            F.bool_or(F.col("class").isNull()).alias("has_gap"),
        )
        .drop("_alone")
    )


def mergeable_classes(classes):
    """Distinct pairs without the patients whose classes conflict."""
    named = F.when(F.col("lowest").isNotNull(), F.array(F.col("lowest"))).otherwise(F.array().cast("array<string>"))
    gap = F.when(F.col("has_gap"), F.array(F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    return (
        classes_per_patient(classes)
        .where("lowest IS NULL OR lowest = highest")
        .select("patientId", F.explode(F.concat(named, gap)).alias("class"))
    )


def duplicate_join_keys(table, key="patientId"):
    """Keys that break a many-to-one join because they occur more than once."""
    return table.groupBy(key).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def require_unique(table, key="patientId"):
    """Raise ``ValueError`` if a key occurs more than once."""
    found = duplicate_join_keys(table, key).limit(1).collect()
    if found:
        raise ValueError(f"{key} is not unique: {found[0][key]} occurs {found[0].n_rows} times")


def join_classes(labels, classes):
    """Every label row with its class; patients with conflicting classes get none.

    Rows without a patient are kept; they have no class, whatever the class rows without one say.

    The join is many-to-one: a patient with a class and a row without one fails
    the job. The classes are written first, so that both sides of the join are
    plain scans and adaptive execution can split a patient with very many rows, or
    the rows without one.
    """
    known = classes_per_patient(classes.where(F.col("patientId").isNotNull()))
    problem = F.concat(F.lit("classes are not unique per patient: "), "patientId")
    known = stage(
        known.where("lowest IS NULL OR lowest = highest").select(
            "patientId",
            F.when(F.col("has_gap") & F.col("lowest").isNotNull(), F.raise_error(problem).cast("string"))
            .otherwise(F.col("lowest")).alias("class"),
        ),
        "patient-classes",
    )
    return labels.join(known, "patientId", "left")


def conflicting_targets(labels):
    """Patients with more than one distinct target.

    Lowest and highest target differ exactly when there are several; that needs
    no distinct count and therefore no second shuffle.
    """
    target = nan_to_null("Target")
    return (
        labels.where(F.col("patientId").isNotNull())
        .groupBy("patientId")
        .agg(F.min(target).alias("lowest"), F.max(target).alias("highest"))
        .where("lowest <> highest")
    )


def _row_flags():
    """Box properties of a single label row, NULL comparisons counting as false.

    NaN counts as missing; it is neither below nor equal to any number.
    """

    def known(condition):
        return F.coalesce(condition, F.lit(False))

    return {
        "has_box_value": any_present(S.COORDINATES),
        "has_empty_row": ~any_present(S.COORDINATES),
        "has_partial_row": any_missing(S.COORDINATES),
        "has_bad_size": known((F.col("width") <= 0) | (F.col("height") <= 0)),
        "has_bad_corner": known((F.col("x") < 0) | (F.col("y") < 0)),
    }


def box_flags(labels):
    """Per patient, whether any label row shows each box property."""
    flags = _row_flags()
    return (
        labels.where(F.col("patientId").isNotNull())
        .groupBy("patientId")
        .agg(*[F.bool_or(expr).alias(name) for name, expr in flags.items()])
    )


def patient_state(labels, classes, unnamed=False):
    """One row per patient with everything the mapping rules need.

    Keeps patients with label rows and patients with conflicting classes. Raises
    at run time if a patient has a class row and a row with no class, because
    such a table cannot be joined many-to-one. With ``unnamed`` the label rows without
    a patient are one more row, so that all label rows are counted in this pass.
    """
    flags = _row_flags()
    label_rows = (
        labels.where(F.col("patientId").isNotNull() | F.lit(unnamed))
        .select(
            "patientId",
            F.lit(1).alias("label_row"),
            nan_to_null("Target").alias("Target"),
            *[expr.alias(name) for name, expr in flags.items()],
            F.lit(0).alias("named_class"),
            F.lit(0).alias("unnamed_class"),
            F.lit(None).cast("int").alias("class_no"),
        )
    )
    class_rows = (
        distinct_classes(classes)
        .where(F.col("patientId").isNotNull())
        .select(
            "patientId",
            F.lit(0).alias("label_row"),
            F.lit(None).cast("double").alias("Target"),
            *[F.lit(None).cast("boolean").alias(name) for name in flags],
            F.col("class").isNotNull().cast("int").alias("named_class"),
            F.col("class").isNull().cast("int").alias("unnamed_class"),
            number_of("class", _KNOWN_CLASSES).alias("class_no"),
        )
    )
    state = (
        label_rows.unionByName(class_rows)
        .groupBy("patientId")
        .agg(
            F.sum("label_row").alias("n_rows"),
            F.min("Target").alias("lowest_target"),
            F.max("Target").alias("highest_target"),
            *[F.bool_or(name).alias(name) for name in flags],
            F.sum("named_class").alias("n_classes"),
            F.sum("unnamed_class").alias("n_unnamed"),
            F.min("class_no").alias("class_no"),
        )
    )
    not_unique = (F.col("n_classes") == 1) & (F.col("n_unnamed") > 0)
    wanted = (F.col("n_rows") > 0) | (F.col("n_classes") > 1)
    problem = F.concat(
        F.lit("classes are not unique per patient after removing conflicts: "), "patientId"
    )
    return state.where(
        F.when(not_unique, F.raise_error(problem).cast("boolean")).otherwise(wanted)
    ).drop("n_unnamed")


def mapping_reason():
    """First mapping rule that a patient breaks; NULL if it breaks none."""
    target = F.col("lowest_target")
    known_class = name_of("class_no", _KNOWN_CLASSES)
    agrees = F.coalesce(class_label(known_class) == target, F.lit(False))
    return (
        F.when(F.col("n_classes") > 1, S.CONFLICTING_CLASSES)
        .when(F.col("n_classes") == 0, S.MISSING_CLASS)
        .when(target.isNull(), S.MISSING_TARGET)
        .when(target != F.col("highest_target"), S.CONFLICTING_TARGETS)
        .when(~target.isin(0.0, 1.0), S.INVALID_TARGET)
        .when(~agrees, S.CLASS_TARGET_MISMATCH)
        .when((target == 0) & F.col("has_box_value"), S.UNEXPECTED_BOX_FOR_NEGATIVE)
        .when((target == 1) & F.col("has_empty_row"), S.MISSING_BOX_FOR_POSITIVE)
        .when((target == 1) & F.col("has_partial_row"), S.INCOMPLETE_BOX)
        .when((target == 1) & F.col("has_bad_size"), S.INVALID_BOX_DIMENSIONS)
        .when((target == 1) & F.col("has_bad_corner"), S.INVALID_BOX_COORDINATES)
    )


def mapping_verdict(labels, classes, unnamed=False):
    """One row per patient: ``reason`` (NULL = accepted), label, class and row count.

    ``unnamed`` as in :func:`patient_state`.
    """
    return patient_state(labels, classes, unnamed).select(
        F.col("patientId").alias("sample_id"),
        mapping_reason().alias("reason"),
        F.col("lowest_target").alias("target"),
        name_of("class_no", _KNOWN_CLASSES).alias("raw_class"),
        "n_rows",
    )


def canonical_images(verdict, image_directory, source_dataset=S.SOURCE_DATASET):
    """Accepted patients as canonical image records."""
    folder = image_directory.rstrip("/")
    return verdict.where("reason IS NULL").select(
        "sample_id",
        F.concat(F.lit(folder + "/"), "sample_id", F.lit(S.IMAGE_SUFFIX)).alias("image_path"),
        F.col("target").cast("int").alias("label"),
        F.lit(source_dataset).alias("source_dataset"),
        "raw_class",
    )


def canonical_boxes(labels, verdict, order_col=None, hot_rows=HOT_ROWS):
    """All label rows of accepted positives as box records.

    An accepted positive has only complete rows, so incomplete ones are dropped
    at the scan before anything is shuffled. ``order_col`` is kept; it also tells
    copies of one box apart, so that a patient with very many can be cut up.
    """
    positives = verdict.where("reason IS NULL AND target = 1").select("sample_id", "n_rows")
    order = [order_col] if order_col else []
    rows = labels.where(F.col("patientId").isNotNull())
    for name in S.COORDINATES:
        rows = rows.where(is_number(name))
    rows = (
        rows.where(F.coalesce(nan_to_null("Target") == 1, F.lit(True)))
        .select(F.col("patientId").alias("sample_id"), *S.COORDINATES, *order)
    )
    return salted_join(
        rows, positives, "sample_id", "left_semi", n="n_rows", hot_rows=hot_rows
    )


def mapping_rejections(verdict):
    return verdict.where("reason IS NOT NULL").select(
        F.lit(S.STAGE_MAPPING).alias("stage"), "sample_id", "reason"
    )


def map_records(labels, classes, image_directory, source_dataset=S.SOURCE_DATASET,
                order_col=None, verdict=None):
    """Canonical images, their boxes, and the rejected patients.

    Pass a staged ``verdict`` when more than one of the three results is used.
    """
    if verdict is None:
        verdict = mapping_verdict(labels, classes)
    return MappingResult(
        images=canonical_images(verdict, image_directory, source_dataset),
        boxes=canonical_boxes(labels, verdict, order_col),
        rejections=mapping_rejections(verdict),
    )
