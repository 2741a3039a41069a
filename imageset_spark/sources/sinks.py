"""Writers for canonical tables, split manifests, reports and files."""

from uuid import uuid4

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .folders import file_system
from .versions import publish


def canonical(df, schema, sort_by=None):
    """Exactly the columns of ``schema``; with ``sort_by`` in that order."""
    out = df.orderBy(sort_by) if sort_by else df
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_canonical(df, path, schema, format="csv", sort_by=None, check=None):
    """Publish exactly the columns of ``schema``, with a header even when empty.

    With ``sort_by`` the part files follow each other in that order. ``check`` is
    given the rows as written and raises to refuse them; readers then keep the
    version that they had. See ``versions.py``.
    """
    publish(canonical(df, schema, sort_by), path, format, check=check)


def write_splits(assigned, path, format="parquet", check=None):
    """Publish a frame with a ``split`` column, one folder per split, in id order.

    Sorting by split first also means that a task writes one split, not all three.
    """
    publish(assigned.orderBy("split", "sample_id"), path, format, ["split"], check)


def report_json(report, pretty=False):
    """A one-row report as JSON text with its fields in alphabetical order."""
    options = {"pretty": "true"} if pretty else {}
    return report.select(
        F.to_json(F.struct(*sorted(report.columns)), options).alias("report")
    )


def write_report(report, path, mode="overwrite"):
    """Write a report frame as JSON lines."""
    report.coalesce(1).write.mode(mode).json(path)


def write_planes(planes, table, path, buckets):
    """Store preprocessed planes bucketed by id, as a table.

    A later join on ``sample_id`` then leaves the wide planes where they are and
    moves only the narrow side.
    """
    (
        planes.write.mode("overwrite")
        .bucketBy(buckets, "sample_id")
        .sortBy("sample_id")
        .option("path", path)
        .saveAsTable(table)
    )
    return planes.sparkSession.table(table)


BATCH = "batch"


def append_batch(rows, path, batch):
    """Add the rows of one batch to the table at ``path``; a batch sent again replaces itself.

    The batch is a partition of the table, and only the partition written is
    replaced, so a job that is run again never adds its rows twice.
    """
    if BATCH in (name.lower() for name in rows.columns):
        raise ValueError(f"the rows have a column {BATCH} of their own")
    if not str(batch).strip():
        raise ValueError("a batch needs a name")
    (
        rows.withColumn(BATCH, F.lit(str(batch))).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
    )


def read_batches(spark, path, schema, batch=None):
    """The rows of all batches, or of one; a batch's scan reads its own files only."""
    batched = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    rows = spark.read.schema(batched).parquet(path)
    return (rows if batch is None else rows.where(F.col(BATCH) == str(batch))).drop(BATCH)


def append_history(rows, path, batch):
    """Append the finished epochs of a batch to the training history table, once however often it is sent."""
    append_batch(rows, path, batch)


def write_files(files, path_col="path", content_col="content"):
    """Write the content of every row to its path, creating folders; returns path and length of what was written.

    Each file appears under its name only when it is whole, so a retried task
    leaves the same files. The result is lazy: writing happens when it is read.
    """

    def run(batches):
        for batch in batches:
            lengths = []
            for path, content in zip(batch[path_col], batch[content_col]):
                system, inner = file_system(path)
                folder, name = inner.rsplit("/", 1)
                system.create_dir(folder, recursive=True)
                part = f"{folder}/._{name}.{uuid4().hex}"
                with system.open_output_stream(part) as handle:
                    handle.write(bytes(content))
                system.move(part, inner)
                lengths.append(len(content))
            yield pd.DataFrame({"path": batch[path_col], "length": lengths})

    return files.select(path_col, content_col).mapInPandas(run, "path string, length bigint")
