"""Table schemas and the fixed vocabulary shared by all operators."""

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Source classes and the binary label each one stands for.
CLASS_LABELS = {
    "Lung Opacity": 1,
    "Normal": 0,
    "No Lung Opacity / Not Normal": 0,
}
SOURCE_DATASET = "rsna_pneumonia_2018"
IMAGE_SUFFIX = ".dcm"

# Decisions of the released model.
POSITIVE_DECISION = "pneumonia"
NEGATIVE_DECISION = "normal"

# Rejection reasons of the mapping stage, in order of precedence.
CONFLICTING_CLASSES = "conflicting_classes"
MISSING_CLASS = "missing_class"
MISSING_TARGET = "missing_target"
CONFLICTING_TARGETS = "conflicting_targets"
INVALID_TARGET = "invalid_target"
CLASS_TARGET_MISMATCH = "class_target_mismatch"
UNEXPECTED_BOX_FOR_NEGATIVE = "unexpected_box_for_negative"
MISSING_BOX_FOR_POSITIVE = "missing_box_for_positive"
INCOMPLETE_BOX = "incomplete_box"
INVALID_BOX_DIMENSIONS = "invalid_box_dimensions"
INVALID_BOX_COORDINATES = "invalid_box_coordinates"

# Further reasons that only the validation stage gives.
DUPLICATE_IMAGE_RECORD = "duplicate_image_record"
IMAGE_FILE_NOT_FOUND = "image_file_not_found"
UNREADABLE_IMAGE = "unreadable_dicom"
INVALID_IMAGE_DIMENSIONS = "invalid_image_dimensions"
UNKNOWN_IMAGE_REFERENCE = "unknown_image_reference"
NON_FINITE_BOX = "non_finite_box"
BOX_OUTSIDE_IMAGE = "box_outside_image"

# Cell texts that a CSV reader takes as missing (the public pandas default list).
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# ----------------------------------------------------------------------------

COORDINATES = ["x", "y", "width", "height"]
SPLIT_NAMES = ["train", "validation", "test"]

LABELS_SCHEMA = T.StructType(
    [T.StructField("patientId", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in COORDINATES]
    + [T.StructField("Target", T.DoubleType())]
)
CLASSES_SCHEMA = T.StructType(
    [
        T.StructField("patientId", T.StringType()),
        T.StructField("class", T.StringType()),
    ]
)
IMAGE_SCHEMA = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("image_path", T.StringType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("source_dataset", T.StringType()),
        T.StructField("raw_class", T.StringType()),
    ]
)
BOX_SCHEMA = T.StructType(
    [T.StructField("sample_id", T.StringType())]
    + [T.StructField(name, T.DoubleType()) for name in COORDINATES]
)
REJECTION_SCHEMA = T.StructType(
    [
        T.StructField("stage", T.IntegerType()),
        T.StructField("sample_id", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("sample_id", T.StringType()),
        T.StructField("readable", T.BooleanType()),
        T.StructField("ndim", T.IntegerType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
    ]
)

# Stages of the rejection ledger, in the order in which its rows were found.
STAGE_MAPPING = 0
STAGE_IMAGE = 1
STAGE_REFERENCE = 2
STAGE_GEOMETRY = 3
