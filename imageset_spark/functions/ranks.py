"""Running totals over a whole table without a one-partition window.

Rows are range partitioned into value ranges of ``ROWS_PER_RANGE`` rows or so and
written once, which fixes the range of every row however often it is read. Totals
per range are few, so carrying them forward is cheap; inside a range an ordinary
window adds up the rest. Cut points never reach the driver.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .staging import stage

BUCKET = "_range"
ROWS_PER_RANGE = 200_000


def range_buckets(df, order_col, n_buckets=None, out=BUCKET):
    """Add the number of the value range that ``order_col`` falls in.

    The number of ranges follows the number of rows unless ``n_buckets`` gives
    it. Equal values share a range.
    """
    if n_buckets is None:
        n_buckets = -(-df.count() // ROWS_PER_RANGE)
    placed = df.repartitionByRange(max(1, n_buckets), order_col)
    return stage(placed.withColumn(out, F.spark_partition_id()), "ranges")


def running_total(bucketed, order_col, measures, group=(), how="sum", descending=False,
                  include_current=True):
    """Running ``sum`` or ``min`` of each measure, named ``run_<measure>``.

    ``bucketed`` comes from :func:`range_buckets` and holds unique values of
    ``order_col`` within ``group``.
    """
    group = list(group)
    fold = {"sum": F.sum, "min": F.min}[how]
    direction = F.desc if descending else F.asc
    totals = bucketed.groupBy(*group, BUCKET).agg(
        *[fold(m).alias(f"_t_{m}") for m in measures]
    )
    ranges = W.partitionBy(*group).orderBy(direction(BUCKET))
    before = ranges.rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group, BUCKET, *[fold(f"_t_{m}").over(before).alias(f"_o_{m}") for m in measures]
    )
    inside = W.partitionBy(*group, BUCKET).orderBy(direction(order_col)).rowsBetween(
        W.unboundedPreceding, 0 if include_current else -1
    )
    joined = bucketed.join(offsets if group else F.broadcast(offsets), [*group, BUCKET])

    def combined(measure):
        within, offset = fold(measure).over(inside), F.col(f"_o_{measure}")
        if how == "sum":
            return F.coalesce(within, F.lit(0)) + F.coalesce(offset, F.lit(0))
        return F.least(within, offset)

    return joined.withColumns({f"run_{m}": combined(m) for m in measures}).drop(
        *[f"_o_{m}" for m in measures], BUCKET
    )


def row_positions(df, order_col, out="position"):
    """Zero-based position of every row in the order of a unique, sortable column.

    Works for text keys too, where no numeric cut points exist: rows are range
    partitioned and written once, which fixes their partition number for good.
    """
    # The place within a sorted partition is known while writing, so that no
    # second shuffle is needed.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = df.repartitionByRange(order_col).sortWithinPartitions(order_col)
    written = stage(placed.withColumns({BUCKET: F.spark_partition_id(), "_within": within}), "positions")
    sizes = written.groupBy(BUCKET).agg(F.count("*").alias("_n"))
    before = W.orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        written.join(F.broadcast(offsets), BUCKET)
        .withColumn(out, F.col("_offset") + F.col("_within"))
        .drop(BUCKET, "_offset", "_within")
    )
