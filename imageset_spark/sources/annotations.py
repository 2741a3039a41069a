"""CSV scans with the missing-value rules of the annotation tables.

Columns are read by header name as text. Texts that stand for a missing value
become NULL; numbers are parsed afterwards, so that ``inf`` stays infinite
instead of turning into NULL.
"""

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import nan_to_null, row_positions
from .versions import published_paths, read_published

# Room for the byte offset of a split and for the row within a partition.
_ROW_DIGITS = 10
_BLOCK_DIGITS = 15


def _scan(spark, path, required):
    """All columns as text. A file whose header differs from the first one's fails the job."""
    options = {"header": True, "nullValue": "", "emptyValue": "", "enforceSchema": False}
    columns = spark.read.options(**options).csv(path).schema
    rows = spark.read.options(**options).schema(columns).csv(path)
    absent = [name for name in required if name not in rows.columns]
    if absent:
        raise ValueError(f"{path} lacks the columns {', '.join(sorted(absent))}")
    return rows


def _text(name):
    cell = F.col(f"`{name}`")
    return F.when(~cell.isin(S.MISSING_TEXTS), cell)


def _texts(rows, names, *kept):
    """Named columns with missing texts as NULL, a step of its own so that each
    cell is looked up once however often it is used afterwards."""
    return rows.select(*[_text(name).alias(name) for name in names], *kept)


def _number(name, strict):
    cell = F.col(name)
    parsed = cell.try_cast("double")
    if strict:
        problem = F.concat(F.lit(f"not a number in column {name}: "), cell)
        parsed = F.when(
            cell.isNotNull() & parsed.isNull(), F.raise_error(problem).cast("double")
        ).otherwise(parsed)
    return nan_to_null(parsed)


def _source_order(spark, path, rows):
    """Add ``row_seq``, which grows in the order of the source text.

    A number made of the file's place in the sorted file list, the byte offset
    of the split within the file, and the row's place in its partition. Numbers
    keep later aggregates in hash form. Files are numbered in Spark; the list,
    of which no content is read, never reaches the driver.
    """
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("_file"))
    numbers = row_positions(files, "_file", "_no")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        place.alias("_place"),
    ).join(numbers, "_file", "left")
    lost = F.concat(F.lit("input file missing from the file list: "), "_file")
    key = _number_of_row(F.coalesce("_no", F.raise_error(lost).cast("bigint")))
    return parts.withColumn("row_seq", key).drop("_file", "_block", "_place", "_no")


def _number_of_row(file_number):
    wide = "decimal(38,0)"

    def shifted(column, digits):
        return column.cast(wide) * F.lit(str(10**digits)).cast(wide)

    return (
        shifted(file_number, _BLOCK_DIGITS + _ROW_DIGITS)
        + shifted(F.col("_block"), _ROW_DIGITS)
        + F.col("_place").cast(wide)
    ).cast(wide)


def read_labels(spark, path, strict=False):
    """Label rows: patientId, x, y, width, height, Target and ``row_seq``.

    ``strict`` fails the job on a cell that is neither missing nor a number;
    otherwise such a cell counts as missing.
    """
    names = S.LABELS_SCHEMA.names
    rows = _source_order(spark, path, _scan(spark, path, names))
    rows = _texts(rows, names, "row_seq")
    numbers = [_number(name, strict).alias(name) for name in names[1:]]
    return rows.select("patientId", *numbers, "row_seq")


def unparsed_cells(spark, path):
    """Per numeric column, how many cells are neither missing nor a number."""
    names = S.LABELS_SCHEMA.names[1:]
    rows = _texts(_scan(spark, path, names), names)
    return rows.agg(
        *[
            F.count_if(F.col(n).isNotNull() & F.col(n).try_cast("double").isNull()).alias(n)
            for n in names
        ]
    )


def read_classes(spark, path):
    names = S.CLASSES_SCHEMA.names
    return _texts(_scan(spark, path, names), names)


def read_manifest(spark, path, schema=S.IMAGE_SCHEMA, format="csv"):
    """A canonical or split manifest, columns found by name and typed by ``schema``.

    Where a table was published, the files of its last version are read.
    """
    files = published_paths(spark, path)
    if format != "csv":
        if files is not None:
            return read_published(spark, path, schema, format)
        return spark.read.schema(schema).format(format).load(path)
    rows = _texts(_scan(spark, path if files is None else files, schema.names), schema.names)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
