"""Training history: which epochs were saved and how each run ended.

A history that grows by batches of later epochs is followed by one summary row
per run (:func:`run_state`). A new batch is judged against that row, and its own rows
are folded into it (:func:`extend_history`); earlier batches are not read again.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import range_buckets, running_total

STATE_SCHEMA = "run string, best_val_loss double, best_epoch bigint, last_epoch bigint, final_val_acc double"


class HistoryStep(NamedTuple):
    saves: DataFrame
    state: DataFrame


def _saved(history, n_buckets):
    ranges = range_buckets(history, "epoch", n_buckets)
    return running_total(
        ranges, "epoch", ["val_loss"], group=["run"], how="min", include_current=False
    )


def _marked(best):
    return best.withColumn(
        "saved", F.coalesce(F.col("val_loss") < F.col("run_val_loss"), F.lit(True))
    ).withColumnRenamed("run_val_loss", "best_before")


def checkpoint_saves(history, n_buckets=None):
    """Mark the epochs whose validation loss is strictly below all earlier ones of the run."""
    return _marked(_saved(history, n_buckets))


def run_summary(history):
    """Per run: lowest validation loss, its first epoch, and the last epoch's accuracy.

    Grouping by loss value first keeps every aggregate on plain numbers.
    """
    per_loss = history.groupBy("run", "val_loss").agg(
        F.min("epoch").alias("first_epoch"),
        F.max("epoch").alias("last_epoch"),
        F.max_by("val_acc", "epoch").alias("val_acc"),
    )
    return per_loss.groupBy("run").agg(
        F.min("val_loss").alias("best_val_loss"),
        F.min_by("first_epoch", "val_loss").alias("best_epoch"),
        F.max("last_epoch").alias("last_epoch"),
        F.max_by("val_acc", "last_epoch").alias("final_val_acc"),
    )


def merge_states(*states):
    """One summary of all epochs from summaries of parts of them, in any order and grouping.

    Of equal losses the earlier epoch is the best one.
    """
    rows = states[0]
    for state in states[1:]:
        rows = rows.unionByName(state)
    per_loss = rows.groupBy("run", "best_val_loss").agg(
        F.min("best_epoch").alias("best_epoch"), F.max("last_epoch").alias("last_epoch"),
        F.max_by("final_val_acc", "last_epoch").alias("final_val_acc"),
    )
    return per_loss.groupBy("run").agg(
        F.min("best_val_loss").alias("lowest"), F.min_by("best_epoch", "best_val_loss").alias("best_epoch"),
        F.max_by("final_val_acc", "last_epoch").alias("final_val_acc"), F.max("last_epoch").alias("last_epoch"),
    ).select("run", F.col("lowest").alias("best_val_loss"), "best_epoch", "last_epoch", "final_val_acc")


def extend_history(batch, state=None, n_buckets=None):
    """The saves of a batch of epochs, and the summary after it.

    ``state`` is the summary before the batch (none at the start). Within a run,
    a batch follows all epochs that the summary covers; one that does not fails the
    job.
    """
    if state is None:
        return HistoryStep(checkpoint_saves(batch, n_buckets), run_summary(batch))
    before = state.select("run", F.col("best_val_loss").alias("_best"), F.col("last_epoch").alias("_last"))
    best = _saved(batch, n_buckets).join(before, "run", "left")
    problem = F.concat(F.lit("epoch already covered by the summary: "), "run", F.lit(" "), F.col("epoch").cast("string"))
    covered = F.coalesce(F.col("epoch") <= F.col("_last"), F.lit(False))
    carried = F.least("run_val_loss", F.when(covered, F.raise_error(problem).cast("double")).otherwise(F.col("_best")))
    saves = _marked(best.withColumn("run_val_loss", carried).drop("_best", "_last"))
    return HistoryStep(saves, merge_states(state, run_summary(batch)))
