"""Batch scoring and exact binary-classification metrics.

Counts are summed as integers over distinct scores, so ROC points and AUC do
not depend on partitioning and need no binning.
"""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import range_buckets, row_positions, running_total, sigmoid, stage

_WIDE = "decimal(38,0)"


def batch_score(examples, make_predictor, input_col="tensor", batch_size=32,
                input_shape=None):
    """Add the model's ``logit`` and its ``score``.

    ``make_predictor()`` runs once per Python worker and returns a function from
    a batch of inputs (numpy, one row per example) to one logit per row.
    """

    def make_predict_fn():
        predictor = make_predictor()

        def predict(inputs):
            return np.asarray(predictor(inputs), dtype="float64").reshape(-1)

        return predict

    shapes = [list(input_shape)] if input_shape else None
    predict = predict_batch_udf(
        make_predict_fn, return_type=T.DoubleType(), batch_size=batch_size,
        input_tensor_shapes=shapes,
    )
    return add_score(examples.withColumn("logit", predict(F.col(input_col))))


def score_planes(table, planes_of, spec, make_predictor, batch_size=32, drop=()):
    """Add the ``logit`` of every row in one pass of Python from image to model.

    ``planes_of(batch)`` makes the resized planes of an Arrow batch, one per row;
    channels and normalisation follow in numpy, so no tensor ever leaves the worker.
    ``make_predictor()`` runs once per task. Columns in ``drop`` go in, but not out.
    """
    fields = [f for f in table.schema.fields if f.name not in drop]
    names = [f.name for f in fields]
    mean, std = (np.array(v, "float64").reshape(-1, 1, 1) for v in (spec.mean, spec.std))

    def run(batches):
        predictor = make_predictor()
        for batch in batches:
            for begin in range(0, len(batch), batch_size):
                part = batch.slice(begin, batch_size)
                grey = np.asarray(planes_of(part), "float64").reshape(-1, 1, spec.height, spec.width)
                tensors = ((grey - mean) / std).astype("float32")
                logits = np.asarray(predictor(tensors), dtype="float64").reshape(-1)
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(logits)], [*names, "logit"])

    return add_score(table.mapInArrow(run, T.StructType([*fields, T.StructField("logit", T.DoubleType())])))


def add_score(predictions):
    return predictions.withColumn("score", sigmoid("logit"))


def batches(examples, batch_size=32, order_col="sample_id"):
    """Number of the batch each row falls in when rows are cut in id order."""
    placed = row_positions(examples, order_col, "_position")
    return placed.withColumn(
        "batch_no", F.floor(F.col("_position") / F.lit(batch_size)).cast("bigint")
    ).drop("_position")


def row_loss(logit="logit", label="label"):
    """Binary cross entropy of one row, in the form that cannot overflow."""
    z, y = F.col(logit), F.col(label)
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def loss_accuracy(predictions, batch_size=32, order_col="sample_id"):
    """Mean over batches of the mean batch loss, plain mean loss, and accuracy.

    All batches but the last are full, so the mean over batches needs only the
    total loss and the loss of the rows in the last, shorter batch. Those are
    the fewer than ``batch_size`` rows at the end of the order.
    """
    rows = predictions.withColumn("_loss", row_loss())
    correct = F.count_if((F.col("logit") > 0) == (F.col("label") == 1))
    totals = rows.agg(
        F.count("*").alias("n"), F.sum("_loss").alias("loss"), correct.alias("correct")
    )
    tail = rows.orderBy(F.desc(order_col)).limit(batch_size - 1)
    # Fewer than batch_size rows, last of the order first.
    losses = tail.agg(
        F.reverse(
            F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("k"), "_loss")))
        ).alias("last")
    )
    short = F.col("n") % F.lit(batch_size)
    last_rows = F.slice("last", F.lit(1), short.cast("int"))
    last_loss = F.aggregate(last_rows, F.lit(0.0), lambda total, row: total + row["_loss"])
    whole = (F.col("loss") - F.col("last_loss")) / F.lit(float(batch_size))
    partial = F.when(F.col("short") > 0, F.col("last_loss") / F.col("short")).otherwise(0.0)
    n_batches = F.ceil(F.col("n") / F.lit(float(batch_size)))
    return (
        totals.select("*", losses.scalar().alias("last"))
        .select("n", "loss", "correct", short.alias("short"), last_loss.alias("last_loss"))
        .where("n > 0")
        .select(
            ((whole + partial) / n_batches).alias("batch_mean_loss"),
            (F.col("loss") / F.col("n")).alias("row_mean_loss"),
            (F.col("correct") / F.col("n")).alias("accuracy"),
        )
    )


def checked(predictions):
    """Predictions whose score is a number and whose label is 0 or 1; any other row fails the job."""
    score, label = F.col("score"), F.col("label")
    good = score.isNotNull() & ~F.isnan(score) & label.isNotNull() & label.isin(0, 1)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in ("score", "label")]
    name = F.col("sample_id").cast("string") if "sample_id" in predictions.columns else F.lit("")
    problem = F.concat(
        F.lit("score must be a number and label 0 or 1: "), F.coalesce(name, F.lit("")), F.lit(" score "),
        shown[0], F.lit(", label "), shown[1],
    )
    return predictions.withColumn(
        "score", F.when(F.coalesce(good, F.lit(False)), score).otherwise(F.raise_error(problem).cast("double"))
    )


def score_counts(predictions):
    """Positives and negatives per distinct score, written once.

    The one pass over the predictions: all curve operators read this table, and
    a score shared by very many rows is a single row of it.
    """
    positive = (F.col("label") == 1).cast("bigint")
    rows = checked(predictions).select("score", positive.alias("pos"), (1 - positive).alias("neg"))
    counts = rows.groupBy("score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return stage(counts, "score-counts")


def _running_counts(counts, n_buckets=None):
    """Distinct scores with own and cumulative counts, summed from the highest score."""
    ranges = range_buckets(counts, "score", n_buckets)
    return running_total(ranges, "score", ["pos", "neg"], descending=True)


def _roc_points(counts, n_buckets):
    totals = counts.agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    curve = _running_counts(counts, n_buckets).select(
        F.col("score").alias("threshold"), F.col("run_pos").alias("tp"), F.col("run_neg").alias("fp")
    )
    none = F.lit(0).cast("bigint")
    anchor = counts.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), none.alias("tp"), none.alias("fp")
    )

    def rate(count, total):
        return F.try_divide(F.col(count).cast("double"), totals.select(total).scalar())

    return curve.unionByName(anchor).select(
        "threshold", "tp", "fp", rate("tp", "n_pos").alias("tpr"), rate("fp", "n_neg").alias("fpr")
    )


def roc_points(predictions, n_buckets=None):
    """Every distinct threshold with counts and rates, plus the (inf, 0, 0) anchor."""
    return _roc_points(score_counts(predictions), n_buckets)


def roc_auc(predictions, n_buckets=None):
    """Exact area under the ROC curve; tied scores count half. NULL with one class only."""
    curve = _running_counts(score_counts(predictions), n_buckets)
    twice = 2 * F.col("run_pos").cast(_WIDE) - F.col("pos").cast(_WIDE)
    sums = curve.agg(
        F.sum((F.col("neg").cast(_WIDE) * twice).cast(_WIDE)).alias("area"),
        F.sum("pos").cast(_WIDE).alias("n_pos"),
        F.sum("neg").cast(_WIDE).alias("n_neg"),
    )
    cells = (2 * F.col("n_pos") * F.col("n_neg")).cast("double")
    return sums.select(F.try_divide(F.col("area").cast("double"), cells).alias("auc"))


def youden_threshold(predictions, n_buckets=None):
    """Highest threshold at which tpr - fpr is largest; infinite if none beats zero."""
    points = roc_points(predictions, n_buckets).withColumn("j", F.col("tpr") - F.col("fpr"))
    best = points.agg(F.max(F.struct("j", "threshold")).alias("best"))
    return best.select(F.col("best.threshold").alias("threshold"), F.col("best.j").alias("j"))


def confusion(predictions, threshold):
    """One row: tp, tn, fp, fn of the inclusive rule ``score >= threshold``."""
    limit = F.lit(float(threshold)) if isinstance(threshold, (int, float)) else threshold
    flagged, sick = F.col("score") >= limit, F.col("label") == 1
    return checked(predictions).agg(
        F.count_if(flagged & sick).alias("tp"),
        F.count_if(~flagged & ~sick).alias("tn"),
        F.count_if(flagged & ~sick).alias("fp"),
        F.count_if(~flagged & sick).alias("fn"),
    )


def binary_metrics(matrix):
    """Rates of a confusion matrix. Zero denominators give 0, for specificity NULL."""

    def share(top, bottom, empty):
        bottom = bottom.cast("double")
        return F.coalesce(F.try_divide(top.cast("double"), bottom), empty)

    zero, null = F.lit(0.0), F.lit(None).cast("double")
    tp, tn, fp, fn = (F.col(name) for name in ("tp", "tn", "fp", "fn"))
    recall = share(tp, tp + fn, zero)
    return matrix.select(
        "tp", "tn", "fp", "fn",
        share(tp, tp + fn, null).alias("sensitivity"),
        share(tn, tn + fp, null).alias("specificity"),
        share(tp, tp + fp, zero).alias("precision"),
        recall.alias("recall"),
        share(2 * tp, 2 * tp + fp + fn, zero).alias("f1"),
    )


def eval_report(validation, test, n_buckets=None, **facts):
    """Threshold from ``validation``, metrics from ``test``, in one row.

    ``facts`` (model name, checkpoint path ...) become leading text columns.
    """
    threshold = youden_threshold(validation, n_buckets).select("threshold").scalar()
    metrics = binary_metrics(confusion(test, threshold))
    auc = roc_auc(test, n_buckets).scalar()
    return metrics.select(
        *[F.lit(value).alias(name) for name, value in facts.items()],
        threshold.alias("threshold"),
        auc.alias("test_auc"),
        "sensitivity", "specificity", "precision", "recall", "f1",
        F.struct("tp", "tn", "fp", "fn").alias("confusion_matrix"),
    )
