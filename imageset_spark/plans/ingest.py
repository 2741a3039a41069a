"""The ingestion job: annotation tables and files to canonical tables and a report."""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import stage
from ..operators import mapping, validation
from ..sources import (
    audit_paths,
    canonical,
    open_path,
    prepare,
    read_classes,
    read_labels,
)


class IngestResult(NamedTuple):
    images: DataFrame
    boxes: DataFrame
    rejections: DataFrame
    report: DataFrame
    ledger: DataFrame


def rejection_histogram(rejections):
    return rejections.groupBy("reason").agg(F.count("*").alias("n_rows"))


def ingestion_report(patients, verdict, boxes, rejections, duplicates):
    """One row of totals; ``source_rows`` counts label rows, also those without an id.

    ``patients`` holds the label rows of each patient (``n_rows``), one row for those
    without an id among them, so that the labels are not read again to be counted.

    Accepted images are counted on the image verdict, where each is one row.
    """

    def figures(df, **values):
        one = df.agg(*[expr.alias(name) for name, expr in values.items()])
        return one.select(
            F.explode(
                F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("bigint").alias("n"))
                          for n in values])
            ).alias("f")
        ).select("f.name", "f.n", F.lit(None).cast("string").alias("reason"))

    facts = (
        figures(patients, source_rows=F.sum("n_rows"))
        .unionByName(
            figures(
                verdict.where("reason IS NULL"),
                accepted_images=F.count("*"),
                positive_images=F.count_if(F.col("label") == 1),
                negative_images=F.count_if(F.col("label") == 0),
            )
        )
        .unionByName(figures(boxes, bounding_boxes=F.count("*")))
        .unionByName(figures(duplicates, duplicate_boxes_removed=F.max("duplicate_boxes_removed")))
        .unionByName(
            rejection_histogram(rejections).select(
                F.lit("rejected_records").alias("name"), F.col("n_rows").alias("n"), "reason"
            )
        )
    )
    names = ["source_rows", "accepted_images", "positive_images", "negative_images",
             "bounding_boxes", "duplicate_boxes_removed", "rejected_records"]
    # At most one entry per reason of the fixed vocabulary.
    entries = F.collect_list(
        F.when(F.col("reason").isNotNull(), F.struct(F.col("reason"), F.col("n")))
    )
    return facts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("name") == name, F.col("n"))), F.lit(0)).alias(name)
            for name in names
        ],
        F.map_from_entries(F.sort_array(entries)).alias("rejection_reasons"),
    )


def ingest(labels, classes, audit, image_directory, order_col="row_seq",
           source_dataset=S.SOURCE_DATASET):
    """Map and validate; ``audit`` has one row per image file, or makes it from the mapped images.

    The frames that several results read are written once to the staging folder,
    so labels are scanned twice in all, classes once, and a lost executor never
    sends the job back to them.
    """
    patients = stage(mapping.mapping_verdict(labels, classes, unnamed=True), "mapping-verdict")
    verdict = patients.where("sample_id IS NOT NULL")
    mapped = mapping.map_records(
        labels, classes, image_directory, source_dataset, order_col, verdict=verdict
    )
    images = mapped.images
    if callable(audit):
        images = stage(images, "mapped-images")
        audit = stage(audit(images), "image-audit")
    checked = validation.validate_records(
        images, mapped.boxes, audit, order_col, mapped.rejections, keep=stage
    )
    return IngestResult(
        images=checked.images,
        boxes=checked.boxes,
        rejections=checked.rejections,
        ledger=checked.ledger,
        report=ingestion_report(
            patients, checked.verdict, checked.boxes, checked.rejections, checked.duplicates
        ),
    )


def ingest_files(spark, labels_path, classes_path, image_directory, images_output,
                 boxes_output, decoder, format="csv", opener=open_path):
    """The whole job over files. Returns the one-row report.

    Only the images that pass the mapping rules are opened, each once, in the
    task that decodes it: file contents never go through a shuffle, and the image
    folder is never listed.
    """
    # Parsed once; the later passes read columns, and row numbers are fixed.
    labels = stage(read_labels(spark, labels_path), "labels")
    classes = read_classes(spark, classes_path)

    def audit(images):
        return audit_paths(images, decoder, opener)

    result = ingest(labels, classes, audit, image_directory)
    images, boxes = stage(result.images, "images"), stage(result.boxes, "boxes")
    # Both tables are written and checked before readers see either.
    drafts = [
        prepare(canonical(rows, schema, order), output, format, check=_same_rows(rows))
        for rows, schema, order, output in (
            (images, S.IMAGE_SCHEMA, "sample_id", images_output),
            (boxes, S.BOX_SCHEMA, ["sample_id", "row_seq"], boxes_output),
        )
    ]
    for draft in drafts:
        draft.commit(spark)
    return result.report


def _same_rows(source):
    """A check that as many rows were written as there are."""

    def check(written):
        found, wanted = written.count(), source.count()
        if found != wanted:
            raise RuntimeError(f"{found} rows were written instead of {wanted}")

    return check
