"""Every registered query: an operator of the package on the derived tables."""

from pyspark.sql import functions as F

from imageset_spark import schemas as S
from imageset_spark import sources
from imageset_spark.functions import decision, replace_text, stage
from imageset_spark.functions import remap_prefix as rewrite_prefix
from imageset_spark.functions.staging import staged_path
from imageset_spark.operators import evaluation, history, images, mapping, quality, splits
from imageset_spark.operators import validation
from imageset_spark.plans import ingest, score_files, split_manifest
from imageset_spark.plans.ingest import rejection_histogram as histogram

from . import tables

IMAGE_FOLDER = "/data/train/images/"
THRESHOLD = 0.30780404806137085
BOX = ["sample_id", *S.COORDINATES]
LABEL_ROW = ["patientId", *S.COORDINATES, "Target"]

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _verdict(spark, sf_dir):
    return mapping.mapping_verdict(tables.labels(spark, sf_dir), tables.classes(spark, sf_dir))


def _images(spark, sf_dir):
    return mapping.canonical_images(_verdict(spark, sf_dir), IMAGE_FOLDER)


def _staged_verdict(spark, sf_dir):
    """The mapping verdict, written once for queries that read it more than once."""
    return stage(_verdict(spark, sf_dir), "mapping-verdict")


def _state(spark, sf_dir):
    return validation.image_state(
        tables.direct_images(spark, sf_dir), tables.direct_boxes(spark, sf_dir),
        tables.headers(spark, sf_dir),
    )


def _judged(spark, sf_dir, state=None):
    """Judged boxes of the records that skip the mapping stage."""
    unique = stage(validation.dedupe_boxes(tables.direct_boxes(spark, sf_dir), "row_seq"), "unique-boxes")
    if state is None:
        images, headers = tables.direct_images(spark, sf_dir), tables.headers(spark, sf_dir)
        state = stage(validation.image_state(images, unique, headers), "image-state")
    return validation.judge_boxes(unique, state)


def _checked(spark, sf_dir):
    return validation.validate_records(
        tables.direct_images(spark, sf_dir), tables.direct_boxes(spark, sf_dir),
        tables.headers(spark, sf_dir), "row_seq", keep=stage,
    )


def _ingested(spark, sf_dir):
    return ingest(
        tables.labels(spark, sf_dir), tables.classes(spark, sf_dir),
        tables.headers(spark, sf_dir), IMAGE_FOLDER,
    )


def _scored(spark, sf_dir):
    return evaluation.add_score(tables.predictions(spark, sf_dir))


def _points(df, column, name="value"):
    """One row per array element, so that results compare as plain numbers."""
    return df.select("sample_id", F.posexplode_outer(column).alias("place", name))


# --- sources and sinks ------------------------------------------------------


@query
def scan_labels(spark, sf_dir):
    path = staged_path(spark, "labels-csv")
    rows = tables.labels(spark, sf_dir).drop("row_seq")
    rows.write.option("header", True).csv(path)
    return sources.read_labels(spark, path, strict=True).drop("row_seq")


@query
def unparsed_cells(spark, sf_dir):
    """Cells of a label file that are neither missing nor numbers, by column."""
    path = staged_path(spark, "labels-csv")
    rows = tables.labels(spark, sf_dir).drop("row_seq")
    line = F.col("patientId").cast("bigint")
    odd = {"x": (7, "1,5"), "width": (11, "n.d."), "Target": (13, "yes")}
    rows = rows.withColumns({
        name: F.when(line % n == 0, F.lit(text)).otherwise(F.col(name).cast("string")) for name, (n, text) in odd.items()
    })
    rows.write.option("header", True).csv(path)
    return sources.unparsed_cells(spark, path)


@query
def scan_manifest(spark, sf_dir):
    path = staged_path(spark, "manifest-csv")
    sources.write_canonical(_images(spark, sf_dir), path, S.IMAGE_SCHEMA)
    return sources.read_manifest(spark, path)


@query
def image_listing(spark, sf_dir):
    pages = tables.read(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return sources.listed_paths(pages, suffix=".html")


@query
def missing_files(spark, sf_dir):
    return validation.missing_files(_images(spark, sf_dir), tables.headers(spark, sf_dir))


@query
def image_audit(spark, sf_dir):
    return validation.image_audit(tables.headers(spark, sf_dir))


@query
def image_audit_decoded(spark, sf_dir):
    """Audit of bytes that a worker decodes: JSON grids, some broken, some 3-D."""
    import json

    import numpy as np

    key = F.col("sample_id").cast("bigint")
    grid = F.to_json(F.struct(F.col("pixels").alias("codes"), (key % 23).alias("form")))
    content = F.when(key % 29 == 0, F.lit("no image")).otherwise(grid)
    files = tables.pixels(spark, sf_dir).select(
        "sample_id", F.encode(content, "UTF-8").alias("content")
    )

    def decode(content):
        parsed = json.loads(content)
        codes = np.asarray(parsed["codes"])
        return codes.reshape((2, 4, 8) if parsed["form"] == 0 else (8, 8))

    return validation.image_audit(sources.audit_images(files, decode))


@query
def write_canonical(spark, sf_dir):
    path = staged_path(spark, "boxes-csv")
    verdict = _staged_verdict(spark, sf_dir)
    boxes = mapping.canonical_boxes(tables.labels(spark, sf_dir), verdict, "row_seq")
    sources.write_canonical(boxes, path, S.BOX_SCHEMA)
    return sources.read_manifest(spark, path, S.BOX_SCHEMA)


@query
def write_splits(spark, sf_dir):
    path = staged_path(spark, "splits")
    assigned = splits.create_splits(tables.split_input(spark, sf_dir))
    sources.write_splits(assigned, path)
    return sources.read_published(spark, path, assigned.schema)


@query
def published_files(spark, sf_dir):
    """The files of published splits against their list: rows by split, and whether every digest matches."""
    path = staged_path(spark, "splits")
    assigned = splits.create_splits(tables.split_input(spark, sf_dir))
    # Published twice: readers see the second version only.
    for rows in (assigned.where("label = 1"), assigned):
        sources.write_splits(rows, path)
    sizes = sources.read_published(spark, path, assigned.schema).groupBy("split").agg(F.count("*").alias("n_rows"))
    digests = sources.verify_published(spark, path).groupBy(F.regexp_extract("name", "^split=([a-z]+)/", 1).alias("split"))
    return sizes.join(digests.agg(F.bool_and("matches").alias("all_match")), "split")


@query
def smoke_subset(spark, sf_dir):
    return splits.smoke_subset(_images(spark, sf_dir), 64)


@query
def checksum_manifest(spark, sf_dir):
    artifacts = tables.read(spark, sf_dir, "pages").select(
        F.concat(F.lit("/exports/page-"), F.col("page_id").cast("string"), F.lit(".html"))
        .alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    return sources.checksum_lines(sources.checksum_files(artifacts))


@query
def checksum_verification(spark, sf_dir):
    artifacts = tables.read(spark, sf_dir, "pages").select(
        F.concat(F.lit("/exports/page-"), F.col("page_id").cast("string")).alias("path"),
        F.encode("html", "UTF-8").alias("content"),
    )
    stored = tables.read(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("name"),
        F.sha2(F.when(F.col("page_id") % 10 == 0, F.col("url")).otherwise(F.col("html")), 256)
        .alias("sha256"),
    )
    return sources.verify_checksums(sources.checksum_files(artifacts, root="/exports"), stored)


# --- image files ------------------------------------------------------------


def _grids(spark, sf_dir):
    folder = staged_path(spark, "grids")
    return folder, tables.grid_files(spark, sf_dir, folder)


def _codes(content):
    return tables.decode_grid(content)[0]


@query
def listed_files(spark, sf_dir):
    """Image files below a folder and its subfolders; their bytes are not read."""
    folder, _ = _grids(spark, sf_dir)
    listing = sources.list_images(spark, folder, ".grid", recursive=True, slices=2)
    below = F.substr("path", F.lit(len(folder) + 1)).alias("path")
    return listing.select("sample_id", below, "length")


@query
def audited_files(spark, sf_dir):
    """Every image file below a folder, decoded where it is read."""
    folder, _ = _grids(spark, sf_dir)
    files = sources.read_images(spark, folder, ".grid", recursive=True)
    return validation.image_audit(sources.audit_images(files, _codes))


@query
def audited_paths(spark, sf_dir):
    """Every image record with the reason for which its file is refused, if any."""
    _, records = _grids(spark, sf_dir)
    audit = sources.audit_paths(records, _codes)
    no_boxes = spark.createDataFrame([], S.BOX_SCHEMA)
    state = validation.image_state(records, no_boxes, audit)
    return state.select("sample_id", validation.image_reason().alias("reason"), "image_width", "image_height")


@query
def preprocessed_paths(spark, sf_dir):
    """Planes of all image records; a file that cannot be used gives none."""
    _, records = _grids(spark, sf_dir)
    spec = images.ImageSpec(height=5, width=5)
    planes = images.preprocess_paths(records, tables.decode_grid, spec, errors="keep")
    return _points(planes, "plane").withColumn("value", F.col("value").cast("double"))


@query
def scored_files(spark, sf_dir):
    """From image files to scores, for the records whose files pass the audit."""
    _, records = _grids(spark, sf_dir)
    audit = validation.image_audit(sources.audit_paths(records, _codes))
    good = records.join(audit.where("reason IS NULL").select("sample_id"), "sample_id", "left_semi")
    scored = score_files(good, tables.decode_grid, images.ImageSpec(height=5, width=5), _pixel_predictor)
    return scored.select("sample_id", F.round("logit", 4).alias("logit"))


# --- projections and filters ------------------------------------------------


@query
def canonical_images(spark, sf_dir):
    return _images(spark, sf_dir)


@query
def canonical_boxes(spark, sf_dir):
    labels = tables.labels(spark, sf_dir)
    verdict = _staged_verdict(spark, sf_dir)
    return mapping.canonical_boxes(labels, verdict, "row_seq").select(*BOX)


@query
def class_label(spark, sf_dir):
    from imageset_spark.functions import class_label as label

    return tables.classes(spark, sf_dir).withColumn("class_label", label("class"))


@query
def remap_paths(spark, sf_dir):
    return tables.paths(spark, sf_dir).withColumn(
        "image_path", replace_text("image_path", "/mnt/c/", "C:/")
    )


@query
def remap_prefix(spark, sf_dir):
    return tables.paths(spark, sf_dir).withColumn(
        "image_path", rewrite_prefix("image_path", "/mnt/c/", "C:/")
    )


@query
def invalid_negative_rows(spark, sf_dir):
    return quality.invalid_negative_rows(tables.labels(spark, sf_dir)).select(*LABEL_ROW)


@query
def invalid_positive_rows(spark, sf_dir):
    return quality.invalid_positive_rows(tables.labels(spark, sf_dir)).select(*LABEL_ROW)


@query
def invalid_geometry_rows(spark, sf_dir):
    return quality.invalid_geometry_rows(tables.labels(spark, sf_dir))


# --- joins ------------------------------------------------------------------


@query
def label_class_join(spark, sf_dir):
    labels = tables.labels(spark, sf_dir)
    joined = mapping.join_classes(labels, tables.classes(spark, sf_dir))
    return joined.select(*LABEL_ROW, "class")


@query
def reconcile_sources(spark, sf_dir):
    return quality.reconcile_tables(tables.labels(spark, sf_dir), tables.classes(spark, sf_dir))


@query
def mergeable_classes(spark, sf_dir):
    return mapping.mergeable_classes(tables.classes(spark, sf_dir))


@query
def unknown_box_refs(spark, sf_dir):
    return validation.unknown_box_refs(_judged(spark, sf_dir))


@query
def valid_boxes(spark, sf_dir):
    judged = stage(_judged(spark, sf_dir), "judged-boxes")
    geometry = stage(validation.geometry_verdict(judged, "row_seq"), "geometry")
    return validation.valid_boxes(judged, geometry).select(*BOX)


@query
def valid_images(spark, sf_dir):
    return _checked(spark, sf_dir).images


@query
def file_coverage(spark, sf_dir):
    available = tables.headers(spark, sf_dir).select("sample_id")
    return quality.file_coverage(_images(spark, sf_dir), available)


@query
def dup_join_keys(spark, sf_dir):
    return mapping.duplicate_join_keys(mapping.distinct_classes(tables.classes(spark, sf_dir)))


@query
def training_examples(spark, sf_dir):
    spec = images.ImageSpec(height=5, width=5)
    planes = images.preprocess_images(tables.pixels(spark, sf_dir), spec)
    examples = images.training_examples(tables.split_input(spark, sf_dir), planes, spec, missing="keep")
    tensor = F.posexplode_outer("tensor").alias("place", "value")
    return examples.select("sample_id", F.col("label").cast("double").alias("label"), tensor) \
        .withColumn("value", F.col("value").cast("double"))


@query
def stored_examples(spark, sf_dir):
    """Training examples from planes that were stored in buckets: only the manifest is moved to meet them."""
    spec = images.ImageSpec(height=5, width=5)
    path = staged_path(spark, "planes")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    planes = sources.write_planes(images.preprocess_images(tables.pixels(spark, sf_dir), spec), name, path, 8)
    examples = images.training_examples(tables.split_input(spark, sf_dir), planes, spec, missing="keep")
    return examples.select(
        "sample_id", F.col("label").cast("double").alias("label"), F.posexplode_outer("tensor").alias("place", "value")
    ).withColumn("value", F.col("value").cast("double"))


# --- aggregations -----------------------------------------------------------


@query
def distinct_classes(spark, sf_dir):
    return mapping.distinct_classes(tables.classes(spark, sf_dir))


@query
def conflicting_classes(spark, sf_dir):
    return mapping.conflicting_classes(tables.classes(spark, sf_dir))


@query
def conflicting_targets(spark, sf_dir):
    return mapping.conflicting_targets(tables.labels(spark, sf_dir))


@query
def box_flags(spark, sf_dir):
    return mapping.box_flags(tables.labels(spark, sf_dir))


@query
def mapping_verdict(spark, sf_dir):
    return _verdict(spark, sf_dir).select("sample_id", "reason", "target", "n_rows")


@query
def duplicate_images(spark, sf_dir):
    return validation.duplicate_images(tables.direct_images(spark, sf_dir))


@query
def dedupe_boxes(spark, sf_dir):
    unique = validation.dedupe_boxes(tables.direct_boxes(spark, sf_dir), "row_seq")
    return unique.select(*BOX, "copies")


@query
def geometry_verdict(spark, sf_dir):
    judged = _judged(spark, sf_dir)
    return validation.geometry_verdict(judged, "row_seq").select("sample_id", "reason")


@query
def negative_with_boxes(spark, sf_dir):
    return validation.negative_with_boxes(_state(spark, sf_dir))


@query
def rejection_histogram(spark, sf_dir):
    return histogram(mapping.mapping_rejections(_verdict(spark, sf_dir)))


@query
def rejection_ledger(spark, sf_dir):
    return _ingested(spark, sf_dir).rejections


@query
def direct_ledger(spark, sf_dir):
    return _checked(spark, sf_dir).rejections


@query
def ordered_ledger(spark, sf_dir):
    """The ledger of direct records in the order in which its rows are found."""
    return validation.ordered_ledger(_checked(spark, sf_dir).ledger)


@query
def ordered_rejections(spark, sf_dir):
    """The ledger of the ingest job, mapping included, in that order."""
    return validation.ordered_ledger(_ingested(spark, sf_dir).ledger)


@query
def ingest_report(spark, sf_dir):
    report = _ingested(spark, sf_dir).report
    return report.withColumn("rejection_reasons", F.to_json("rejection_reasons"))


@query
def class_distribution(spark, sf_dir):
    return quality.value_counts(tables.classes(spark, sf_dir), "class")


@query
def repeated_rows(spark, sf_dir):
    classes = quality.repeated_rows(tables.classes(spark, sf_dir), ["patientId", "class"])
    boxes = quality.positive_boxes(tables.labels(spark, sf_dir), distinct=False)
    found = quality.repeated_rows(boxes, ["patientId", *S.COORDINATES])
    return classes.select(F.lit("classes").alias("table_name"), "repeated_rows").unionByName(
        found.select(F.lit("boxes").alias("table_name"), "repeated_rows")
    )


@query
def profile_counts(spark, sf_dir):
    return quality.profile_counts(
        {"labels": tables.labels(spark, sf_dir), "classes": tables.classes(spark, sf_dir)}
    )


@query
def sketched_counts(spark, sf_dir):
    """Distinct ids from the kept sketches of eight slices, and whether each lies within 3% of the exact count."""
    found = {"labels": tables.labels(spark, sf_dir), "classes": tables.classes(spark, sf_dir)}
    path = staged_path(spark, "sketches")
    slice_of = F.pmod(F.crc32("patientId"), F.lit(8))
    for number in range(8):
        part = {name: table.where(slice_of == number) for name, table in found.items()}
        sources.append_batch(quality.key_sketches(part), path, number)
    schema = quality.key_sketches(found).schema
    rough = quality.sketched_counts(sources.read_batches(spark, path, schema)).withColumnRenamed("unique_ids", "estimate")
    exact = quality.profile_counts(found).select("table_name", "unique_ids")
    near = F.abs(F.col("estimate") - F.col("unique_ids")) <= 0.03 * F.col("unique_ids")
    return rough.join(exact, "table_name").select("table_name", "n_rows", "unique_ids", near.alias("is_near"))


@query
def boxes_per_image_hist(spark, sf_dir):
    return quality.boxes_per_image_hist(quality.positive_boxes(tables.labels(spark, sf_dir)))


@query
def max_boxes_per_image(spark, sf_dir):
    return quality.max_boxes_per_image(quality.positive_boxes(tables.labels(spark, sf_dir)))


@query
def class_label_crosstab(spark, sf_dir):
    orders = tables.read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("raw_class"), F.col("o_orderstatus").alias("label")
    )
    return quality.class_label_crosstab(orders, "raw_class", "label")


@query
def image_targets(spark, sf_dir):
    return quality.image_targets(tables.labels(spark, sf_dir))


@query
def expectations(spark, sf_dir):
    return quality.expectations(
        tables.labels(spark, sf_dir), tables.classes(spark, sf_dir), tables.headers(spark, sf_dir)
    )


@query
def unsupported_classes(spark, sf_dir):
    return quality.unsupported_classes(tables.classes(spark, sf_dir))


# --- splits -----------------------------------------------------------------


@query
def split_input_checks(spark, sf_dir):
    return splits.split_input_checks(tables.split_input(spark, sf_dir))


@query
def stratified_split(spark, sf_dir):
    accepted = stage(_images(spark, sf_dir), "images")
    return splits.create_splits(accepted).select("sample_id", "label", "split")


@query
def split_report(spark, sf_dir):
    report = split_manifest(tables.split_input(spark, sf_dir), staged_path(spark, "splits"))
    return report.withColumn("class_counts", F.to_json("class_counts"))


@query
def split_verification(spark, sf_dir):
    source = tables.split_input(spark, sf_dir)
    return splits.split_verification(source, splits.create_splits(source))


@query
def epoch_order(spark, sf_dir):
    return splits.epoch_order(tables.split_input(spark, sf_dir), epoch=1)


@query
def epoch_places(spark, sf_dir):
    """Place and batch of every example in two epochs; the examples are numbered once."""
    numbered = splits.number_examples(tables.split_input(spark, sf_dir))
    n = numbered.count()
    found = [splits.epoch_places(numbered, epoch, n=n).withColumn("epoch", F.lit(epoch)) for epoch in (1, 2)]
    return found[0].unionByName(found[1]).select("epoch", "sample_id", "label", "place", "batch_no")


# --- order and windows ------------------------------------------------------


@query
def first_per_class(spark, sf_dir):
    return quality.first_per_class(_images(spark, sf_dir))


@query
def checkpoint_saves(spark, sf_dir):
    return history.checkpoint_saves(tables.history(spark, sf_dir)).select(
        "run", "epoch", "val_loss", "best_before", "saved"
    )


@query
def run_summary(spark, sf_dir):
    return history.run_summary(tables.history(spark, sf_dir))


@query
def append_history(spark, sf_dir):
    """The history as it grows: odd and even epochs are two batches, each sent twice."""
    path = staged_path(spark, "history")
    rows = tables.history(spark, sf_dir)
    for half in (1, 0, 0, 1):
        sources.append_history(rows.where(F.col("epoch") % 2 == half), path, f"half-{half}")
    return sources.read_batches(spark, path, rows.schema)


def _history_steps(spark, sf_dir):
    """The history in three batches of later and later epochs: the saves of each, and the last summary."""
    path = staged_path(spark, "history")
    rows = tables.history(spark, sf_dir)
    last = rows.agg(F.max("epoch")).scalar()
    third = F.least(F.floor(F.col("epoch") * 3 / (last + 1)), F.lit(2))
    state, saves = None, []
    for number in range(3):
        sources.append_history(rows.where(third == number), path, number)
        batch = sources.read_batches(spark, path, rows.schema, number)
        step = history.extend_history(batch, state)
        saves.append(step.saves)
        state = stage(step.state, "run-state")
    return saves, state


@query
def checkpoint_saves_by_batch(spark, sf_dir):
    """Saved epochs of a history that arrives in three batches."""
    (first, second, third), _ = _history_steps(spark, sf_dir)
    return first.unionByName(second).unionByName(third).select("run", "epoch", "val_loss", "best_before", "saved")


@query
def run_summary_by_batch(spark, sf_dir):
    """Run summaries carried through three batches; only the last batch and one row per run are read."""
    return _history_steps(spark, sf_dir)[1]


@query
def batches(spark, sf_dir):
    return evaluation.batches(tables.split_input(spark, sf_dir), 32)


# --- evaluation -------------------------------------------------------------


def _linear_predictor():
    import numpy as np

    weights = ((np.arange(64) * 7) % 13 - 6) / 10.0
    return lambda inputs: np.asarray(inputs, dtype="float64") @ weights


@query
def batch_score(spark, sf_dir):
    examples = tables.read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("sample_id"),
        F.col("embedding").cast("array<double>").alias("tensor"),
    )
    scored = evaluation.batch_score(examples, _linear_predictor, input_shape=(64,))
    return scored.select(
        "sample_id", F.round("logit", 6).alias("logit"), F.round("score", 6).alias("score")
    )


def _pixel_predictor():
    import numpy as np

    weights = np.array([((i * 5) % 11 - 5) / 100.0 for i in range(75)])
    return lambda tensors: tensors.reshape(len(tensors), -1).astype("float64") @ weights


@query
def score_images(spark, sf_dir):
    """From pixels to score in one pass of Python."""
    spec = images.ImageSpec(height=5, width=5)
    pixels = tables.pixels(spark, sf_dir)
    inputs = ["rows", "cols", "code_max", "photometric", "pixels"]
    table = pixels.select("sample_id", *inputs)
    scored = evaluation.score_planes(
        table, lambda batch: images.table_planes(batch, spec), spec, _pixel_predictor, drop=inputs
    )
    return scored.select("sample_id", F.round("logit", 4).alias("logit"))


@query
def score(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "sample_id", "label", "logit", F.round("score", 12).alias("score")
    )


@query
def decide(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "sample_id", decision("score", THRESHOLD).alias("decision")
    )


@query
def loss_accuracy(spark, sf_dir):
    found = evaluation.loss_accuracy(tables.predictions(spark, sf_dir))
    return found.select(*[F.round(name, 6).alias(name) for name in found.columns])


@query
def roc_points(spark, sf_dir):
    return evaluation.roc_points(_scored(spark, sf_dir)).withColumn(
        "threshold", F.round("threshold", 12)
    )


@query
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(_scored(spark, sf_dir))


@query
def youden_threshold(spark, sf_dir):
    return evaluation.youden_threshold(_scored(spark, sf_dir)).withColumn(
        "threshold", F.round("threshold", 12)
    )


@query
def confusion(spark, sf_dir):
    return evaluation.confusion(_scored(spark, sf_dir), THRESHOLD)


@query
def binary_metrics(spark, sf_dir):
    return evaluation.binary_metrics(evaluation.confusion(_scored(spark, sf_dir), THRESHOLD))


@query
def eval_report(spark, sf_dir):
    placed = splits.create_splits(tables.split_input(spark, sf_dir))
    scored = stage(
        _scored(spark, sf_dir).join(placed.select("sample_id", "split"), "sample_id"),
        "predictions",
    )
    report = evaluation.eval_report(
        scored.where("split = 'validation'"), scored.where("split = 'test'"), model="chars"
    )
    return report.select("*", "confusion_matrix.*").drop("confusion_matrix").withColumn(
        "threshold", F.round("threshold", 12)
    )


# --- images -----------------------------------------------------------------


@query
def invert_mono1(spark, sf_dir):
    return _points(images.invert_mono1(tables.pixels(spark, sf_dir)), "pixels")


@query
def min_max_scale(spark, sf_dir):
    return _points(images.min_max_scale(tables.pixels(spark, sf_dir)), "plane")


@query
def resize_bilinear(spark, sf_dir):
    planes = images.min_max_scale(tables.pixels(spark, sf_dir))
    return _points(images.resize_bilinear(planes, 5, 5), "plane")


@query
def replicate_channels(spark, sf_dir):
    planes = images.min_max_scale(tables.pixels(spark, sf_dir))
    return _points(planes, images.replicate_channels(F.col("plane")))


@query
def normalize_channels(spark, sf_dir):
    planes = images.min_max_scale(tables.pixels(spark, sf_dir))
    return _points(planes, images.normalize_channels(F.col("plane")))


@query
def preprocess_images(spark, sf_dir):
    spec = images.ImageSpec(height=5, width=5)
    planes = images.preprocess_images(tables.pixels(spark, sf_dir), spec)
    out = _points(images.to_tensor(planes, spec), "tensor")
    return out.withColumn("value", F.col("value").cast("double"))


@query
def preprocess_large(spark, sf_dir):
    """Whole images at the size of the released model, as the mean and two corners of every plane."""
    planes = images.preprocess_images(tables.pixels(spark, sf_dir), images.ImageSpec())
    total = F.aggregate("plane", F.lit(0.0), lambda s, v: s + v.cast("double"))
    return planes.select(
        "sample_id", F.size("plane").alias("n_pixels"), F.round(total / F.size("plane"), 4).alias("mean"),
        F.get("plane", F.lit(0)).cast("double").alias("first"), F.element_at("plane", -1).cast("double").alias("last"),
    )
