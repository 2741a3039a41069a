"""Places of rows in a total order, without one task that sees all of them.

Rows are range partitioned in the order and written once, which fixes for good
the partition of every row and its place there. Totals of the partitions carry
the places forward, separately for each group.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from imageset_spark.functions import stage

_PLACE_BITS = (1 << 33) - 1


def in_order(rows, order, group=None, out="place"):
    """Add ``out``: the place of every row, from 0 without gaps, by ``order`` within ``group``.

    ``rows`` must be the scan of a written table: rows equal in all sort columns are
    told apart by their place there, so a third of all rows may be equal and
    still spread over many tasks. ``group`` is a column without nulls.
    """
    keys = [*([F.col(group)] if group else []), *order]
    sorted_rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    sorted_rows = sorted_rows.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    written = stage(
        sorted_rows.withColumns({
            "_part": F.spark_partition_id(),
            "_within": F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)),
        }),
        "ordered-rows",
    )
    per = [group] if group else []
    # One row for each partition and group that meet; groups are contiguous in the order.
    met = written.groupBy("_part", *per).agg(F.min("_within").alias("_first"), F.count("*").alias("_n"))
    before = W.partitionBy(*per).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shifts = met.select(
        "_part", *per, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    return (
        written.join(shifts, ["_part", *per])
        .withColumn(out, F.col("_within") + F.col("_shift"))
        .drop("_part", "_within", "_shift")
    )
