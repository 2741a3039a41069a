"""Checks of canonical records against image files and box geometry.

Images, file audit and boxes are folded into one row per id by a single grouped
aggregate over their union (:func:`image_state`). Boxes meet that row once, in a
join that is salted for images with very many boxes (:func:`judge_boxes`).
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import HOT_ROWS, hot_keys, is_finite, name_of, row_positions, salted_join
from .quality import file_coverage

# Codes of box faults, so that the first fault is found over plain integers.
_FAULTS = [
    S.NON_FINITE_BOX,
    S.INVALID_BOX_COORDINATES,
    S.INVALID_BOX_DIMENSIONS,
    S.BOX_OUTSIDE_IMAGE,
]


class ValidationResult(NamedTuple):
    images: DataFrame
    boxes: DataFrame
    rejections: DataFrame
    duplicates: DataFrame
    verdict: DataFrame
    ledger: DataFrame


def image_state(images, boxes, audit):
    """One row per id seen in any input: copies, label, audit result, box rows.

    ``audit`` has one row per existing image file; no row means no file. Boxes
    may be deduplicated already, with their number of ``copies``. Image records
    without an id are counted like any other id, so that the ledger names them.
    """
    box_rows = F.col("copies") if "copies" in boxes.columns else F.lit(1)

    def part(df, **given):
        types = {
            "image": "int", "label": "int", "file": "int", "readable": "boolean",
            "ndim": "int", "width": "int", "height": "int", "box": "bigint",
        }
        columns = [
            given.get(name, F.lit(0 if name in ("image", "file", "box") else None))
            .cast(kind).alias(name)
            for name, kind in types.items()
        ]
        return df.select("sample_id", *columns)

    col = F.col
    rows = (
        part(images, image=F.lit(1), label=col("label"))
        .unionByName(
            part(audit, file=F.lit(1), readable=col("readable"), ndim=col("ndim"),
                 width=col("width"), height=col("height"))
        )
        .unionByName(part(boxes, box=box_rows))
    )
    return rows.groupBy("sample_id").agg(
        F.sum("image").alias("n_images"),
        F.max("label").alias("label"),
        F.sum("file").alias("n_files"),
        F.bool_or("readable").alias("readable"),
        F.max("ndim").alias("ndim"),
        F.max("width").alias("image_width"),
        F.max("height").alias("image_height"),
        F.sum("box").alias("n_boxes"),
    )


def image_audit(audit):
    """Audit rows with the reason for which the file is refused, if any."""
    return audit.withColumn("reason", _file_reason("width", "height"))


def _file_reason(width, height):
    usable = (F.col("ndim") == 2) & (F.col(width) > 0) & (F.col(height) > 0)
    return F.when(~F.coalesce("readable", F.lit(False)), S.UNREADABLE_IMAGE).when(
        ~F.coalesce(usable, F.lit(False)), S.INVALID_IMAGE_DIMENSIONS
    )


def image_reason():
    """First image-level rule broken by a row of :func:`image_state`."""
    return (
        F.when(F.col("n_images") > 1, S.DUPLICATE_IMAGE_RECORD)
        .when(F.col("n_files") == 0, S.IMAGE_FILE_NOT_FOUND)
        .otherwise(_file_reason("image_width", "image_height"))
    )


def missing_files(images, listing):
    """Ids of images without a file in the listing, once each."""
    return file_coverage(images, listing).where("side = 'missing'").select(
        "sample_id", F.lit(S.IMAGE_FILE_NOT_FOUND).alias("reason")
    )


def duplicate_images(images):
    """Ids with more than one image record, once each."""
    return (
        images.groupBy("sample_id")
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def dedupe_boxes(boxes, order_col=None):
    """Distinct boxes with their number of copies and their first position.

    With ``order_col`` a box holding NaN or NULL equals no other box.
    """
    keys = ["sample_id", *S.COORDINATES]
    if order_col is None:
        return boxes.groupBy(*keys).agg(F.count("*").alias("copies"))
    odd = F.lit(False)
    for name in S.COORDINATES:
        odd = odd | F.col(name).isNull() | F.coalesce(F.isnan(name), F.lit(False))
    return (
        boxes.withColumn("_alone", F.when(odd, F.col(order_col)))
        .groupBy(*keys, "_alone")
        .agg(F.count("*").alias("copies"), F.min(order_col).alias(order_col))
        .drop("_alone")
    )


def box_fault(width="image_width", height="image_height"):
    """Number of the first geometry rule that a box breaks, NULL if none."""
    x, y, w, h = (F.col(name) for name in S.COORDINATES)
    finite = is_finite(x) & is_finite(y) & is_finite(w) & is_finite(h)
    outside = (x + w > F.col(width)) | (y + h > F.col(height))
    return (
        F.when(~finite, F.lit(0))
        .when((x < 0) | (y < 0), F.lit(1))
        .when((w <= 0) | (h <= 0), F.lit(2))
        .when(outside, F.lit(3))
    )


def judge_boxes(unique_boxes, state, hot_rows=HOT_ROWS):
    """Distinct boxes with the fate of their image and their own fault.

    ``known`` is false for boxes of unknown images and for boxes without an id;
    ``candidate`` is true where the image passed every image-level check.
    """
    facts = state.where("n_boxes > 0").select(
        "sample_id",
        (F.col("n_images") > 0).alias("known"),
        ((F.col("n_images") > 0) & image_reason().isNull()).alias("candidate"),
        "label", "image_width", "image_height", "n_boxes",
    )
    judged = salted_join(
        unique_boxes, facts, "sample_id", "left", n="n_boxes", hot_rows=hot_rows,
        salt_cols=S.COORDINATES,
    ).withColumns({name: F.coalesce(name, F.lit(False)) for name in ("known", "candidate")})
    checked = F.col("candidate") & (F.col("label") != 0)
    return judged.withColumn("fault", F.when(checked, box_fault())).drop(
        "image_width", "image_height"
    )


def unknown_box_refs(judged, order_col=None):
    """One row per distinct box whose image is in no image record, with its place in the source if that is given."""
    return judged.where("NOT known").select("sample_id", *S.COORDINATES, *([order_col] if order_col else []))


def negative_with_boxes(state):
    """Images that passed the image checks, are negative and still have boxes."""
    return state.where(
        (F.col("n_images") > 0) & image_reason().isNull()
        & (F.col("label") == 0) & (F.col("n_boxes") > 0)
    ).select("sample_id", "n_boxes")


def geometry_verdict(judged, order_col):
    """Images refused for a box: the fault of their first faulty box decides."""
    return (
        judged.where("fault IS NOT NULL")
        .groupBy("sample_id")
        .agg(F.min_by("fault", order_col).alias("fault"), F.max("n_boxes").alias("n_boxes"))
        .select("sample_id", name_of("fault", _FAULTS).alias("reason"), "n_boxes")
    )


def image_verdict(state, geometry):
    """One row per known id: label, ledger stage and the reason of refusal, if any."""
    negative = (F.col("label") == 0) & (F.col("n_boxes") > 0)
    early = image_reason()
    late = F.when(negative, S.UNEXPECTED_BOX_FOR_NEGATIVE).otherwise(F.col("_fault"))
    faults = geometry.select("sample_id", F.col("reason").alias("_fault"))
    return (
        state.where("n_images > 0")
        .join(faults, "sample_id", "left")
        .select(
            "sample_id", "label", "n_images", "n_boxes",
            F.when(early.isNotNull(), S.STAGE_IMAGE).otherwise(S.STAGE_GEOMETRY).alias("stage"),
            F.coalesce(early, late).alias("reason"),
        )
    )


def valid_boxes(judged, geometry, hot_rows=HOT_ROWS):
    """Distinct boxes of the images that stay valid."""
    kept = judged.where("candidate AND label <> 0 AND fault IS NULL")
    return salted_join(
        kept, geometry, "sample_id", "left_anti", n="n_boxes", hot_rows=hot_rows,
        salt_cols=S.COORDINATES,
    ).drop("copies", "known", "candidate", "label", "n_boxes", "fault")


def rejection_ledger(verdict, judged, prior=None, order_col=None):
    """Every rejection of both stages; an id may occur more than once.

    With ``order_col`` the column ``seq`` holds the source place of a box whose image is
    unknown, which :func:`ordered_ledger` needs; it is NULL for all other rows.
    """
    found = verdict.where("reason IS NOT NULL").select("stage", "sample_id", "reason")
    if prior is not None:
        listed = prior.where(F.col("reason") == S.DUPLICATE_IMAGE_RECORD)
        found = found.join(
            listed.select("sample_id", "reason").distinct(), ["sample_id", "reason"], "left_anti"
        ).select("stage", "sample_id", "reason")
        found = prior.unionByName(found)
    refs = unknown_box_refs(judged, order_col)
    place = {}
    if order_col is not None:
        place = {"seq": F.col(order_col)}
        found = found.withColumn("seq", F.lit(None).cast(refs.schema[order_col].dataType))
    return found.unionByName(
        refs.select(
            F.lit(S.STAGE_REFERENCE).alias("stage"), "sample_id",
            F.lit(S.UNKNOWN_IMAGE_REFERENCE).alias("reason"), *[c.alias(n) for n, c in place.items()],
        )
    )


def ordered_ledger(ledger, out="place"):
    """The ledger with the place of every row, from 0, in the order in which the rejections are found.

    Mapping first (conflicting classes, then all others, each by id), then images by
    id, then boxes of unknown images in source order, then geometry by image id.
    ``ledger`` has the column ``seq`` of :func:`rejection_ledger`. Rows are placed by
    range partitioning, so no task sorts them all.
    """
    later = (F.col("stage") == S.STAGE_MAPPING) & (F.col("reason") != S.CONFLICTING_CLASSES)
    keyed = ledger.withColumn("_key", F.struct("stage", later.alias("later"), "seq", "sample_id", "reason"))
    return row_positions(keyed, "_key", out).select(out, "stage", "sample_id", "reason")


def valid_images(images, verdict, hot_rows=HOT_ROWS):
    """Image records that passed every check.

    An id with very many records is refused in any case; its records are left
    out before the shuffle, which they would only crowd.
    """
    crowded = hot_keys(verdict, "sample_id", "n_images", hot_rows).select("sample_id")
    passed = verdict.where("reason IS NULL").select("sample_id")
    return images.join(F.broadcast(crowded), "sample_id", "left_anti").join(
        passed, "sample_id", "left_semi"
    )


def removed_duplicates(unique_boxes):
    """One row: how many box rows were exact copies of another."""
    return unique_boxes.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_boxes_removed")
    )


def validate_records(images, boxes, audit, order_col, rejections=None,
                     keep=lambda df, name: df):
    """Run all checks. ``keep`` may stage the frames that several results share.

    ``boxes`` is read once: counts and geometry both work on the distinct boxes.
    """
    unique = keep(dedupe_boxes(boxes, order_col), "unique-boxes")
    state = keep(image_state(images, unique, audit), "image-state")
    judged = keep(judge_boxes(unique, state), "judged-boxes")
    verdict = keep(image_verdict(state, geometry_verdict(judged, order_col)), "image-verdict")
    # The images refused for a box, or for having any, as they stand in the verdict.
    refused = verdict.where((F.col("stage") == S.STAGE_GEOMETRY) & F.col("reason").isNotNull())
    ledger = rejection_ledger(verdict, judged, rejections, order_col)
    return ValidationResult(
        images=valid_images(images, verdict),
        boxes=valid_boxes(judged, refused.select("sample_id", "reason", "n_boxes")),
        rejections=ledger.drop("seq"),
        duplicates=removed_duplicates(judged),
        verdict=verdict,
        ledger=ledger,
    )
