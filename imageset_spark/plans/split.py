"""The splitting job: a manifest to three split manifests and a report."""

from pyspark.sql import functions as F

from ..functions import stage
from ..operators.splits import create_splits, split_report, verify_splits
from ..sources import read_published, write_splits


def split_manifest(images, path, train=0.70, validation=0.15, test=0.15, seed=42,
                   format="parquet"):
    """Write the splits, verify what was written, publish it, and return the report frame, which names the seed.

    Splits that fail the verification are never seen by readers, who keep the
    version that they had.
    """
    images = stage(images, "split-source")
    assigned = create_splits(images, train, validation, test, seed)
    write_splits(assigned, path, format, check=lambda written: verify_splits(images, written))
    written = read_published(images.sparkSession, path, assigned.schema, format)
    return split_report(written).withColumn("seed", F.lit(seed))
