"""Proportional stratified interleaving: shards that all hold the mixture of the sources.

Rows are shuffled within their source by a seeded hash of id and text, so that rows
without id, or of one id, spread like others, and ranked;
row ``r`` of a source with ``n`` rows gets the fractional rank ``(2r+1)/(2n)``.
Sorting all rows by fractional rank interleaves the sources in proportion, so
any stretch of that order holds the corpus mixture, and equal cuts of it are
the shards. Row counts of shards differ by one at most (law ``rows``).

No step sorts a whole source or the whole table in one task: rows are ranked
within hash slices of a source and within cells of the unit interval, and the
counts of slices and cells, which are few, carry the ranks forward.

Defined results: a null source is a source of its own; null text has size 8
and checksum 0; an empty table gives an empty result; rows that agree in id,
source and text are interchangeable; input columns named like an output column
are replaced.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .rows import fresh, group_key, text_key, text_of

N_SHARDS = 24
SEED = 20240
#: Rows that one ranking task is meant to sort.
ROWS_PER_SLICE = 100_000
LEAST_SLICES = 1024
OVERHEAD_BYTES = 8


def _before(order):
    return order.rowsBetween(W.unboundedPreceding, -1)


def fractional_ranks(docs, slices, seed=SEED, id_col="doc_id", source_col="source", text_col="text"):
    """Add source key, rank within source, source size and the order columns of the shuffle."""
    src, h, t, cut, rank, n = fresh(docs, "_src", "_h", "_t", "_slice", "_rank", "_n")
    keyed = (
        docs.withColumns({src: group_key(source_col), t: text_key(text_col)})
        .withColumn(h, F.xxhash64(F.lit(seed), F.col(id_col), F.col(t)))
        .withColumn(cut, F.pmod(F.col(h), F.lit(slices)))
    )
    counts = keyed.groupBy(src, cut).agg(F.count("*").alias("_c"))
    whole = W.partitionBy(src)
    offsets = counts.select(
        src, cut,
        F.coalesce(F.sum("_c").over(_before(whole.orderBy(cut))), F.lit(0)).alias("_o"),
        F.sum("_c").over(whole).alias(n),
    )
    inside = W.partitionBy(src, cut).orderBy(h, F.col(id_col), t)
    ranked = (
        keyed.join(offsets, [src, cut])
        .withColumn(rank, F.col("_o") + F.row_number().over(inside) - 1)
        .drop("_o", cut)
    )
    return ranked, counts.groupBy(src).agg(F.sum("_c").alias(n)), (src, h, t, rank, n)


def shard_documents(docs, n_shards=N_SHARDS, seed=SEED, id_col="doc_id", source_col="source",
                    text_col="text"):
    """All rows of ``docs`` with ``size``, ``shard`` and ``slot`` (place within the shard)."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    # The size is taken first: a caller who drops the text then shuffles none of it.
    size = F.octet_length(text_of(text_col)).cast("bigint") + OVERHEAD_BYTES
    docs = docs.drop("shard", "slot").withColumn("size", size)
    total = docs.count()
    slices = max(LEAST_SLICES, -(-total // ROWS_PER_SLICE))
    ranked, sources, (src, h, t, rank, n) = fractional_ranks(
        docs, slices, seed, id_col, source_col, text_col
    )
    cell, place = fresh(ranked, "_cell", "_place")
    odd = 2 * F.col(rank) + 1
    placed = ranked.withColumn(cell, F.expr(f"((2 * {rank} + 1) * {slices}L) div (2 * {n})"))
    # A source puts (2nk + S - 1) div 2S of its rows before cell k of S, so the
    # cells need no counting of rows.
    offsets = (
        sources.withColumn(cell, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))))
        .groupBy(cell)
        .agg(F.sum(F.expr(f"(2 * {n} * {cell} + {slices - 1}L) div {2 * slices}L")).alias("_o"))
    )
    order = W.partitionBy(cell).orderBy(odd / (2 * F.col(n)), src, h, F.col(id_col), t)
    k, rows = F.lit(n_shards).cast("bigint"), max(total, 1)
    return (
        placed.join(offsets, cell)
        .withColumn(place, F.col("_o") + F.row_number().over(order) - 1)
        .withColumn("shard", F.expr(f"({place} * {n_shards}L) div {rows}L").cast("int"))
        .withColumn("slot", F.col(place) - F.expr(f"(shard * {rows}L + {n_shards - 1}L) div {n_shards}L"))
        .drop("_o", src, h, t, rank, n, cell, place)
    )


def write_shards(sharded, path):
    """Write one folder per shard, rows in slot order within each file."""
    (
        sharded.repartition("shard", F.expr(f"slot div {ROWS_PER_SLICE}L"))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )
