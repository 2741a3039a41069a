"""Exploration and data-quality checks over the annotation tables."""

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import any_missing, any_present, class_label, nan_to_null
from .mapping import clean_labels, distinct_classes, require_unique


def profile_counts(tables, key="patientId", approximate=False):
    """Rows and distinct non-null keys per table; ``tables`` maps a name to a frame.

    Keys are counted per key first, so a single distinct key is one row and no
    table is expanded for a distinct count. ``approximate`` estimates the
    distinct keys without any shuffle of keys.
    """
    parts = []
    for name, table in tables.items():
        if approximate:
            estimate = F.approx_count_distinct(key).alias("unique_ids")
            rough = table.agg(F.count("*").alias("n_rows"), estimate)
            parts.append(rough.select(F.lit(name).alias("table_name"), "n_rows", "unique_ids"))
            continue
        per_key = table.groupBy(key).agg(F.count("*").alias("n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                F.count(key).alias("unique_ids"),
            ).select(F.lit(name).alias("table_name"), "n_rows", "unique_ids")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


#: Logarithm of the registers of a sketch: a standard error of 0.8%.
SKETCH_SIZE = 14


def key_sketches(tables, key="patientId"):
    """Per table, rows and a sketch of its distinct non-null keys; ``tables`` maps a name to a frame.

    A sketch has a fixed size whatever it counts, so those of all batches can be
    kept and merged, and no batch is read again.
    """
    out = None
    for name, table in tables.items():
        part = table.agg(
            F.count("*").alias("n_rows"), F.hll_sketch_agg(F.col(key).cast("string"), F.lit(SKETCH_SIZE)).alias("keys")
        ).select(F.lit(name).alias("table_name"), "n_rows", "keys")
        out = part if out is None else out.unionByName(part)
    return out


def merge_sketches(sketches):
    """One row per table from the sketches of its batches."""
    return sketches.groupBy("table_name").agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("keys").alias("keys")
    )


def sketched_counts(sketches):
    """Rows and estimated distinct keys per table."""
    return merge_sketches(sketches).select(
        "table_name", "n_rows", F.hll_sketch_estimate("keys").alias("unique_ids")
    )


def value_counts(table, column):
    """Rows per non-null value, most frequent first."""
    return (
        table.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("n_rows"), column)
    )


def repeated_rows(table, columns):
    """One row: how many rows take part in an exact duplicate over ``columns``."""
    return (
        table.groupBy(*columns)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("repeated_rows"))
    )


def unsupported_classes(classes):
    """Observed classes outside the known vocabulary."""
    return (
        classes.where(F.col("class").isNotNull() & ~F.col("class").isin(list(S.CLASS_LABELS)))
        .select("class")
        .distinct()
    )


def invalid_negative_rows(labels):
    """Rows with target 0 that hold any box value."""
    return clean_labels(labels.where((F.col("Target") == 0) & any_present(S.COORDINATES)))


def invalid_positive_rows(labels):
    """Rows with target 1 that lack any box value."""
    return clean_labels(labels.where((F.col("Target") == 1) & any_missing(S.COORDINATES)))


def image_targets(labels):
    """Distinct (patientId, label) pairs."""
    return labels.select("patientId", nan_to_null("Target").alias("label")).distinct()


def positive_boxes(labels, distinct=True):
    """Boxes of rows with target 1, as they stand in the source."""
    boxes = clean_labels(labels.where(F.col("Target") == 1)).select("patientId", *S.COORDINATES)
    return boxes.distinct() if distinct else boxes


def _bad_geometry():
    return (
        (F.col("x") < 0) | (F.col("y") < 0) | (F.col("width") <= 0) | (F.col("height") <= 0)
    )


def invalid_geometry_rows(labels):
    """Distinct boxes with a negative corner or a size that is not positive."""
    boxes = positive_boxes(labels, distinct=False)
    return boxes.where(_bad_geometry()).distinct()


def boxes_per_image(boxes, key="patientId"):
    return boxes.groupBy(key).agg(F.count("*").alias("n_boxes"))


def boxes_per_image_hist(boxes, key="patientId"):
    """How many images have 1, 2, 3 ... boxes, and the largest number of all."""
    return (
        boxes_per_image(boxes.where(F.col(key).isNotNull()), key)
        .groupBy("n_boxes")
        .agg(F.count("*").alias("image_count"))
        .orderBy("n_boxes")
    )


def max_boxes_per_image(boxes, key="patientId"):
    counts = boxes_per_image(boxes.where(F.col(key).isNotNull()), key)
    return counts.agg(F.max("n_boxes").alias("max_boxes"))


def class_info(classes):
    """Distinct classes per patient with the binary label of each."""
    return distinct_classes(classes).select(
        "patientId", F.col("class").alias("raw_class"), class_label("class").alias("class_label")
    )


def reconcile_sources(targets, classes, strict=False):
    """Full outer join of one-row-per-patient targets and classes with provenance.

    ``disagrees`` marks patients of both sources whose labels differ; a missing
    label differs from everything. ``strict`` first checks that patients are
    unique on both sides.
    """
    if strict:
        require_unique(targets)
        require_unique(classes)
    left = targets.withColumn("_left", F.lit(True))
    right = classes.withColumn("_right", F.lit(True))
    joined = left.join(right, "patientId", "full_outer")
    both = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    return joined.withColumns(
        {
            "source": F.when(both, "both")
            .when(F.col("_left").isNotNull(), "left_only")
            .otherwise("right_only"),
            "disagrees": both
            & F.coalesce(F.col("label") != F.col("class_label"), F.lit(True)),
        }
    ).drop("_left", "_right")


def reconcile_tables(labels, classes):
    """One row per patient of either annotation table: provenance, labels, conflicts.

    One aggregate over the union of both tables. Nothing is filtered before: a
    patient whose targets or classes differ keeps its row, with a NULL label and
    ``conflict`` set; ``disagrees`` marks patients of both tables whose labels
    differ or are missing.
    """
    none = F.lit(None)
    rows = labels.where(F.col("patientId").isNotNull()).select(
        "patientId", F.lit(True).alias("l"), none.cast("boolean").alias("r"),
        nan_to_null("Target").alias("Target"), none.cast("string").alias("class"),
    ).unionByName(
        classes.where(F.col("patientId").isNotNull()).select(
            "patientId", none.cast("boolean").alias("l"), F.lit(True).alias("r"),
            none.cast("double").alias("Target"), "class",
        )
    )
    seen = rows.groupBy("patientId").agg(
        F.bool_or("l").alias("l"), F.bool_or("r").alias("r"),
        F.min("Target").alias("t0"), F.max("Target").alias("t1"),
        F.min("class").alias("c0"), F.max("class").alias("c1"),
    )
    both = F.coalesce(F.col("l") & F.col("r"), F.lit(False))
    differ = F.coalesce(F.col("t0") != F.col("t1"), F.lit(False)) | F.coalesce(F.col("c0") != F.col("c1"), F.lit(False))
    return (
        seen.withColumn("label", F.when(F.col("t0") == F.col("t1"), F.col("t0")))
        .withColumn("raw_class", F.when(F.col("c0") == F.col("c1"), F.col("c0")))
        .withColumn("class_label", class_label("raw_class"))
        .select(
            "patientId", "label", "raw_class", "class_label",
            F.when(both, "both").when(F.col("l"), "left_only").otherwise("right_only").alias("source"),
            (both & F.coalesce(F.col("label") != F.col("class_label"), F.lit(True))).alias("disagrees"),
            differ.alias("conflict"),
        )
    )


def class_label_crosstab(table, row_key, column_key):
    """Counts per pair of values with margins; NULL marks a margin.

    Counting the pairs first leaves only a handful of rows for the cube.
    """
    pairs = (
        table.where(F.col(row_key).isNotNull() & F.col(column_key).isNotNull())
        .groupBy(row_key, column_key)
        .agg(F.count("*").alias("n"))
    )
    return pairs.cube(row_key, column_key).agg(
        F.sum("n").alias("n_rows"),
        F.grouping(row_key).cast("int").alias("row_margin"),
        F.grouping(column_key).cast("int").alias("column_margin"),
    )


def file_coverage(expected, available):
    """Ids that only one side has: ``missing`` files and ``extra`` files.

    One aggregate over the union of both id lists answers both questions.
    """
    sides = expected.select("sample_id", F.lit(1).alias("want"), F.lit(0).alias("have"))
    sides = sides.unionByName(
        available.select("sample_id", F.lit(0).alias("want"), F.lit(1).alias("have"))
    )
    seen = sides.groupBy("sample_id").agg(F.max("want").alias("want"), F.max("have").alias("have"))
    return seen.where("want <> have").select(
        "sample_id", F.when(F.col("want") == 1, "missing").otherwise("extra").alias("side")
    )


def first_per_class(images, class_col="raw_class", id_col="sample_id"):
    """Smallest id of each class; an aggregate, so a large class needs no large task."""
    return (
        images.where(F.col(class_col).isNotNull())
        .groupBy(class_col)
        .agg(F.min(id_col).alias(id_col))
    )


def _check_groups(labels, classes, listing):
    """Every table read once, grouped by what the checks count.

    A group is an id, an invalid box of an id, or an unsupported class (``kind``
    tells the latter apart). Rows are combined before the shuffle, so that little
    more than one row per id is moved.
    """
    none = F.lit(None)
    target = nan_to_null("Target")
    numbers = {name: nan_to_null(name) for name in S.COORDINATES}
    bad_box = F.coalesce(
        (target == 1) & ((numbers["x"] < 0) | (numbers["y"] < 0) | (numbers["width"] <= 0) | (numbers["height"] <= 0)),
        F.lit(False),
    )
    columns = {
        "kind": "int", "id": "string", **{name: "double" for name in S.COORDINATES}, "bad_box": "int", "in_labels": "int",
        "in_classes": "int", "in_files": "int", "target": "double", "no_target": "boolean", "odd_target": "int",
        "bad_negative": "int", "bad_positive": "int", "class": "string",
    }

    def part(df, **given):
        zero = {"kind", "bad_box", "in_labels", "in_classes", "in_files", "odd_target", "bad_negative", "bad_positive"}
        return df.select(*[
            given.get(n, F.lit(0) if n in zero else none).cast(kind).alias(n) for n, kind in columns.items()
        ])

    lab = part(
        labels, id=F.col("patientId"), in_labels=F.lit(1), target=target, no_target=target.isNull(),
        odd_target=F.coalesce(~target.isin(0.0, 1.0), F.lit(False)),
        bad_negative=F.coalesce((target == 0) & any_present(S.COORDINATES), F.lit(False)),
        bad_positive=F.coalesce((target == 1) & any_missing(S.COORDINATES), F.lit(False)),
        bad_box=bad_box, **{n: F.when(bad_box, c) for n, c in numbers.items()},
    )
    # A class without a label is looked at for itself as well.
    odd = F.col("class").isNotNull() & class_label("class").isNull()
    both = classes.select("patientId", "class", F.explode(F.when(odd, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("kind"))
    of_class = F.col("kind") == 1
    cls = part(
        both, kind=F.col("kind"), id=F.when(of_class, F.col("class")).otherwise(F.col("patientId")),
        in_classes=F.when(of_class, 0).otherwise(1), **{"class": F.when(~of_class, F.col("class"))},
    )
    files = part(listing, id=F.col("sample_id"), in_files=F.lit(1))
    # Rows without an id are in no group of ids; their invalid boxes still count as boxes.
    keep = F.col("id").isNotNull() | (F.col("bad_box") == 1)
    return lab.unionByName(cls).unionByName(files).where(keep).groupBy(
        "kind", "id", "bad_box", *S.COORDINATES, "class"
    ).agg(
        *[F.max(n).alias(n) for n in ("in_labels", "in_classes", "in_files")],
        F.min("target").alias("low"), F.max("target").alias("high"), F.bool_or("no_target").alias("no_target"),
        *[F.sum(n).alias(n) for n in ("odd_target", "bad_negative", "bad_positive")],
    )


def _facts(labels, classes, listing):
    """One row per id, and one per unsupported class, for :func:`expectations`."""
    in_class = F.col("in_classes") == 1
    return _check_groups(labels, classes, listing).groupBy("kind", "id").agg(
        *[F.max(n).alias(n) for n in ("in_labels", "in_classes", "in_files")],
        F.min("low").alias("low"), F.max("high").alias("high"), F.bool_or("no_target").alias("no_target"),
        *[F.sum(n).alias(n) for n in ("odd_target", "bad_negative", "bad_positive", "bad_box")],
        # Groups hold distinct classes of an id.
        F.count_if(in_class & F.col("class").isNotNull()).alias("named"),
        F.count_if(in_class & F.col("class").isNull()).alias("unnamed"),
        F.count_if(in_class & class_label("class").isNotNull()).alias("n_mapped"),
        F.max(F.when(in_class, class_label("class"))).alias("mapped"),
    )


def expectations(labels, classes, listing, strict=False):
    """Fourteen data checks as rows of (check_name, violations, passed).

    All checks come out of one fold over labels, classes and files, each read once.
    ``strict`` raises if any check fails.
    """
    facts = _facts(labels, classes, listing)
    col = F.col
    image = (col("kind") == 0) & col("id").isNotNull()
    several_targets = (col("low") != col("high")) | (col("low").isNotNull() & col("no_target"))
    one_target = col("low").isNotNull() & ~several_targets
    one_class = col("named") + col("unnamed") == 1
    labelled = (col("in_labels") == 1) | (col("in_classes") == 1)

    def count(condition):
        return F.count_if(image & condition)

    def total(number):
        number = col(number) if isinstance(number, str) else number
        return F.sum(F.when(image, number))

    per_id = {
        "no_class_conflicts": count(col("named") > 1),
        "classes_map_to_label": total(col("named") + col("unnamed") - col("n_mapped")),
        "one_class_row_per_image": count(col("named") + col("unnamed") > 1),
        "targets_are_binary": total("odd_target"),
        "negatives_have_no_box": total("bad_negative"),
        "positives_have_full_box": total("bad_positive"),
        "no_target_conflicts": count(col("low") != col("high")),
        "one_target_per_image": count(several_targets),
        "images_in_both_sources": count(
            labelled & (col("in_labels") != col("in_classes"))
        ),
        "labels_agree": count(
            one_target & one_class & (col("in_labels") == 1)
            & F.coalesce(col("low") != col("mapped"), F.lit(True))
        ),
        "every_image_has_file": count(labelled & (col("in_files") == 0)),
        "every_file_is_labelled": count(~labelled & (col("in_files") == 1)),
    }
    whole = {
        "classes_supported": F.count_if(col("kind") == 1),
        "box_geometry_valid": F.sum("bad_box"),
        **per_id,
    }
    counts = facts.agg(
        *[F.coalesce(expr, F.lit(0)).cast("bigint").alias(name) for name, expr in whole.items()]
    )
    rows = counts.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(n).alias("check_name"), col(n).alias("violations"))
                  for n in whole]
            )
        ).alias("c")
    ).select("c.check_name", "c.violations")
    out = rows.withColumn("passed", col("violations") == 0)
    if strict:
        failed = [f"{r.check_name}: {r.violations}" for r in out.where("NOT passed").collect()]
        if failed:
            raise ValueError("data expectations failed: " + "; ".join(sorted(failed)))
    return out
