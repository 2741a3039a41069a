"""Deterministic stratified train / validation / test split.

An image's place depends on a hash of the seed and its id alone. The split
needs, per label, the images with the smallest hashes up to a quota. Instead of
ranking all images, the hash space is cut in 65,536 slices per label: counting
per slice tells in which slice a quota ends, and only the images of those few
slices are ranked. Every image is then placed by comparing its hash with the
resulting cut, without moving it.
"""

from math import ceil, floor, isfinite

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import is_blank, number_of, row_positions, shuffled_place, stage
from ..schemas import SPLIT_NAMES

_SLICE_DIGITS = 4


def split_hash(seed, id_col="sample_id"):
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def split_input_checks(images):
    """One row of counts that decide whether a table can be split.

    Rows are counted per id first, which finds duplicate ids in the same pass.
    """
    label = F.col("label")
    per_id = images.groupBy("sample_id").agg(
        F.count("*").alias("n"),
        F.count_if(label == 0).alias("n0"),
        F.count_if(label == 1).alias("n1"),
        F.count_if(label.isNull()).alias("no_label"),
    )
    key = F.col("sample_id").cast("string")
    sums = {
        "n_rows": F.sum("n"),
        "missing_ids": F.sum(F.when(key.isNull(), F.col("n"))),
        "blank_ids": F.sum(F.when(is_blank(key), F.col("n"))),
        "duplicate_ids": F.count_if((F.col("n") > 1) & key.isNotNull()),
        "missing_labels": F.sum("no_label"),
        "other_labels": F.sum(F.col("n") - F.col("n0") - F.col("n1") - F.col("no_label")),
        "label_0": F.sum("n0"),
        "label_1": F.sum("n1"),
    }
    return per_id.agg(
        *[F.coalesce(expr, F.lit(0)).cast("bigint").alias(name) for name, expr in sums.items()]
    )


def check_ratios(train, validation, test):
    ratios = (train, validation, test)
    if any(not isfinite(r) or r <= 0 or r >= 1 for r in ratios):
        raise ValueError(f"split ratios must be finite and between 0 and 1, got {ratios}")
    if abs(sum(ratios) - 1.0) > 1e-9:
        raise ValueError(f"split ratios must add up to 1, got {ratios}")


def _require_columns(images):
    absent = sorted({"sample_id", "label"} - set(images.columns))
    if absent:
        raise ValueError(f"missing required columns: {', '.join(absent)}")


def check_split_input(images, train, validation, test):
    """Raise ``ValueError`` on a table or ratios that cannot be split; return label counts."""
    _require_columns(images)
    found = split_input_checks(images).first()
    problems = [
        (found.n_rows == 0, "cannot split an empty table"),
        (found.missing_ids > 0, "sample_id must not be missing"),
        (found.blank_ids > 0, "sample_id must not be blank"),
        (found.duplicate_ids > 0, "sample_id must be unique"),
        (found.missing_labels > 0, "label must not be missing"),
        (found.other_labels > 0, "label must be 0 or 1"),
        (0 in (found.label_0, found.label_1), "both labels are needed to stratify"),
    ]
    for bad, message in problems:
        if bad:
            raise ValueError(message)
    check_ratios(train, validation, test)
    counts = {0: found.label_0, 1: found.label_1}
    for label, count in counts.items():
        if round(count * (validation + test)) < 2:
            raise ValueError(f"label {label} has too few images for validation and test")
    return counts


def _shares(counts, draws):
    """Split ``draws`` over the labels in proportion, by largest remainder.

    Equal remainders go to the lower label.
    """
    total = sum(counts.values())
    exact = {label: count / total * draws for label, count in sorted(counts.items())}
    whole = {label: floor(value) for label, value in exact.items()}
    spare = draws - sum(whole.values())
    by_remainder = sorted(exact, key=lambda label: (whole[label] - exact[label], label))
    for label in by_remainder[:spare]:
        whole[label] += 1
    return whole


def split_quotas(counts, validation, test):
    """Images per label and split: ``{label: (train, validation, test)}``."""
    total = sum(counts.values())
    held_out = ceil((validation + test) * total)
    train = _shares(counts, total - held_out)
    rest = {label: counts[label] - train[label] for label in counts}
    tested = ceil(test / (validation + test) * held_out)
    if min(total - held_out, held_out - tested, tested) < len(counts):
        raise ValueError("every split needs room for at least one image of each label")
    chosen = _shares(rest, held_out - tested)
    return {
        label: (train[label], chosen[label], rest[label] - chosen[label]) for label in counts
    }


def split_keys(images, seed):
    """What a split is decided by: id, label and hash of every image, written once."""
    return stage(images.select("sample_id", "label", split_hash(seed).alias("_hash")), "split-keys")


def split_cuts(keys, quotas):
    """Per label, the last hash that belongs to train and to validation; ``keys`` from :func:`split_keys`."""
    keyed = keys.select(
        F.col("label").cast("int").alias("label"), "_hash"
    ).withColumn("_slice", F.substring("_hash", 1, _SLICE_DIGITS))
    sizes = keyed.groupBy("label", "_slice").agg(F.count("*").alias("n"))
    so_far = W.partitionBy("label").orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)
    ends = F.lit(None).cast("array<struct<cut:string,quota:bigint>>")
    for label, (train, validation, _) in quotas.items():
        ends = F.when(
            F.col("label") == label,
            F.array(
                F.struct(F.lit("train").alias("cut"), F.lit(train).cast("bigint").alias("quota")),
                F.struct(
                    F.lit("validation").alias("cut"),
                    F.lit(train + validation).cast("bigint").alias("quota"),
                ),
            ),
        ).otherwise(ends)
    # At most one slice per label and cut: four rows.
    last_slices = (
        sizes.withColumn("_upto", F.sum("n").over(so_far))
        .withColumn("_end", F.explode(ends))
        .where(
            (F.col("_end.quota") > F.col("_upto") - F.col("n"))
            & (F.col("_end.quota") <= F.col("_upto"))
        )
        .select(
            "label", "_slice", F.col("_end.cut").alias("cut"),
            (F.col("_end.quota") - F.col("_upto") + F.col("n")).alias("_need"),
        )
    )
    order = W.partitionBy("label", "_slice", "cut").orderBy("_hash")
    ranked = keyed.join(F.broadcast(last_slices), ["label", "_slice"]).withColumn(
        "_rank", F.row_number().over(order)
    )
    return (
        ranked.where("_rank = _need")
        .groupBy("label")
        .agg(
            F.max(F.when(F.col("cut") == "train", F.col("_hash"))).alias("_train_end"),
            F.max(F.when(F.col("cut") == "validation", F.col("_hash"))).alias("_validation_end"),
        )
    )


def assign_splits(images, quotas, seed, keys=None):
    """Add the ``split`` column; all other columns pass through unchanged."""
    keys = split_keys(images, seed) if keys is None else keys
    cuts = split_cuts(keys, quotas).withColumnRenamed("label", "_label")
    # One row per label.
    placed = images.join(
        F.broadcast(cuts), F.col("label").cast("int") == F.col("_label"), "left"
    )
    own = split_hash(seed)
    return placed.withColumn(
        "split",
        F.when(own <= F.col("_train_end"), SPLIT_NAMES[0])
        .when(own <= F.col("_validation_end"), SPLIT_NAMES[1])
        .otherwise(SPLIT_NAMES[2]),
    ).drop("_label", "_train_end", "_validation_end")


def create_splits(images, train=0.70, validation=0.15, test=0.15, seed=42):
    """Checked, stratified, deterministic split with exact sizes per label.

    ``images`` are read twice: once for their narrow keys, which checks, counts and
    cuts work on, and once to be placed.
    """
    _require_columns(images)
    keys = split_keys(images, seed)
    counts = check_split_input(keys, train, validation, test)
    return assign_splits(images, split_quotas(counts, validation, test), seed, keys)


def split_verification(source, assigned):
    """One row of violation counts: all zero for a proper split of ``source``.

    One aggregate over the union of both tables finds overlaps, gaps and extra
    ids together.
    """
    rows = source.select(
        "sample_id", F.lit(1).alias("src"), F.lit(0).alias("out"),
        F.lit(None).cast("int").alias("no"),
    )
    rows = rows.unionByName(
        assigned.select("sample_id", F.lit(0).alias("src"), F.lit(1).alias("out"),
                        number_of("split", SPLIT_NAMES).alias("no"))
    )
    per_id = rows.groupBy("sample_id").agg(
        F.sum("src").alias("src"), F.sum("out").alias("out"),
        F.min("no").alias("low"), F.max("no").alias("high"),
    )
    return per_id.agg(
        F.count_if(F.col("low") != F.col("high")).alias("overlapping_ids"),
        F.count_if((F.col("src") > 0) & (F.col("out") == 0)).alias("uncovered_ids"),
        F.count_if((F.col("src") == 0) & (F.col("out") > 0)).alias("unknown_ids"),
        (F.coalesce(F.sum("out"), F.lit(0)) - F.coalesce(F.sum("src"), F.lit(0))).alias(
            "row_difference"
        ),
    )


def verify_splits(source, assigned):
    """Raise ``RuntimeError`` unless the splits are disjoint and cover ``source``."""
    found = split_verification(source, assigned).first()
    if found.overlapping_ids:
        raise RuntimeError("splits overlap")
    if found.uncovered_ids or found.unknown_ids:
        raise RuntimeError("splits do not cover the source")
    if found.row_difference:
        raise RuntimeError("splits changed the number of rows")


def split_report(assigned):
    """Rows and class counts of every split; ``class_counts`` is a map keyed by label text."""
    counts = assigned.groupBy("split", "label").agg(F.count("*").alias("n"))
    entry = F.struct(F.col("label").cast("string").alias("key"), F.col("n").alias("value"))
    return counts.groupBy("split").agg(
        F.sum("n").alias("n_rows"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("class_counts"),
    )


def split_report_json(report, seed):
    """The split report as one JSON text: the seed, and rows and class counts per split."""
    # Three rows. Maps have no order, so they are sorted as lists of entries.
    entries = F.sort_array(
        F.collect_list(F.struct("split", "n_rows", F.map_entries("class_counts").alias("counts")))
    )
    per_split = F.transform(
        entries,
        lambda e: F.struct(
            e["split"],
            F.struct(
                e["n_rows"].alias("rows"), F.map_from_entries(e["counts"]).alias("class_counts")
            ),
        ),
    )
    whole = F.struct(F.lit(seed).alias("seed"), F.map_from_entries(per_split).alias("splits"))
    return report.agg(F.to_json(whole).alias("report"))


def smoke_subset(manifest, n, order_col="sample_id"):
    """The first ``n`` rows of a manifest in id order."""
    return manifest.orderBy(order_col).limit(n)


def epoch_order(examples, epoch, seed=42, id_col="sample_id"):
    """Examples in the shuffled order of one epoch, the same for every partitioning.

    Sorts all rows; :func:`epoch_places` gives every row its place without a sort.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), F.col(id_col)))
    return examples.withColumn("shuffle_key", key).orderBy("shuffle_key")


def number_examples(examples, id_col="sample_id", out="number"):
    """Examples with their number in id order, written once for all epochs."""
    return stage(row_positions(examples, id_col, out), "numbered-examples")


def epoch_places(numbered, epoch, seed=42, batch_size=32, n=None, number_col="number"):
    """Place and batch of every numbered example in one epoch.

    Each row's place follows from its number alone (``functions/shuffles.py``): a new
    epoch sorts and moves nothing, and a worker that wants one batch filters for it.
    ``n`` is the number of rows, counted if not given.
    """
    n = numbered.count() if n is None else n
    place = shuffled_place(number_col, max(n, 1), f"{seed}:{epoch}")
    placed = numbered.withColumn("place", place)
    return placed.withColumn("batch_no", F.expr(f"place div {int(batch_size)}"))
