"""Mixing sources to target weights by Sainte-Laguë apportionment.

A mixture takes ``share`` times the words of the corpus. Targets follow the
weights of the sources, stop at ``most`` times a source's size, and what is cut
off is shared again by weight until no source is above. The words to take are
cut in blocks of ``block`` words, and blocks go to sources by the highest
quotients target/(2k+1). The order in which blocks are handed out would also give
every shard its integer quota of each source (:func:`shard_quotas`); the mixture
does not use them, it takes one quota of each source for the whole corpus.

Documents of a source lie on a line in seeded order of id and text, which is cut in
the same blocks. A source that gets ``q`` of its ``m`` blocks takes the whole line
``q div m`` times and the first ``q mod m`` blocks once more; as the line is
shuffled, those are a seeded choice of blocks. How many words of a document
are taken follows from where it lies on the line, so nothing is collected,
and a long document costs no more than a short one. No document is taken more
than ``most`` times.

Weights, sizes and quotas are one row per source and are worked out on the
driver; a mixture of more than ``MAX_SOURCES`` sources is refused.

Defined results: null text has size 0 and is never taken; a null source is the
last source; an empty table gives an empty result; repeated rows lie side by
side on the line and are taken like any others; input columns named like an
output column are replaced.
"""

from fractions import Fraction
from heapq import heapify, heapreplace

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .rows import fresh, group_key, left_join, text_key, text_of

WEIGHTS = (3, 1, 2)
SHARE = Fraction(3, 2)
MOST = 2
#: Words of a block; a source misses its target by two blocks at most.
BLOCK = 64
SEED = 77
MAX_SOURCES = 100_000
LEAST_SLICES = 1024
WORDS_PER_SLICE = 50_000_000
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes, weights, share=SHARE, most=MOST):
    """Exact words to take of each source: weighted shares, none above ``most`` times its size."""
    total = share * sum(sizes)
    if sizes and share > most:
        raise ValueError("share must not exceed most")
    out = [Fraction(0)] * len(sizes)
    free = [i for i, size in enumerate(sizes) if size and weights[i]]
    rest = total
    while free:
        unit = rest / sum(weights[i] for i in free)
        full = [i for i in free if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
            rest -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def apportion(votes, seats, limits):
    """Seats of each party by the highest quotients votes/(2k+1), none above its limit.

    Starts from the largest seat numbers that all quotients above a common
    divisor give, so that few seats are handed out one by one.
    """
    free = [i for i, v in enumerate(votes) if v > 0 and limits[i] > 0]
    won = [0] * len(votes)
    seats = min(seats, sum(limits[i] for i in free))
    if seats <= 0:
        return won

    def at(divisor):
        # seat k (from 0) is won while votes/(2k+1) > divisor
        return [min(limits[i], max(0, -(-(votes[i] / divisor - 1) // 2))) for i in free]

    low, high = Fraction(0), Fraction(max(votes[i] for i in free) + 1)
    for _ in range(64):
        middle = (low + high) / 2
        if sum(at(middle)) > seats:
            low = middle
        else:
            high = middle
    for i, k in zip(free, at(high)):
        won[i] = int(k)
    left = seats - sum(won)
    queue = [(-(votes[i] / (2 * won[i] + 1)), i) for i in free if won[i] < limits[i]]
    heapify(queue)
    while left > 0 and queue:
        _, i = queue[0]
        won[i] += 1
        left -= 1
        following = -(votes[i] / (2 * won[i] + 1)) if won[i] < limits[i] else Fraction(1)
        heapreplace(queue, (following, i))
    return won


def shard_quotas(votes, seats, limits, n_shards):
    """Blocks of each source in each shard: the shard's share of the order of quotients."""
    before, out = [0] * len(votes), []
    for shard in range(1, n_shards + 1):
        now = apportion(votes, seats * shard // n_shards, limits)
        out.append([b - a for a, b in zip(before, now)])
        before = now
    return out


def _measured(docs, seed, id_col, source_col, text_col):
    """One narrow row per document: key columns, size and place in the seeded order."""
    return docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("name"), group_key(source_col).alias("src"),
        text_key(text_col).alias("t"), F.xxhash64(F.lit(seed), F.col(id_col), text_key(text_col)).alias("h"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("bigint").alias("size"),
    )


def source_plan(measured, weights=WEIGHTS, share=SHARE, most=MOST, block=BLOCK):
    """Per source, in code point order with null last: key, name, size, target and block quota."""
    found = (
        measured.groupBy("src").agg(F.first("name").alias("name"), F.sum("size").alias("size"))
        .limit(MAX_SOURCES + 1).collect()
    )
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources; group them first")
    found.sort(key=lambda r: (r.name is None, r.name or ""))
    sizes = [int(r["size"]) for r in found]
    weight = [weights[i % len(weights)] for i in range(len(found))]
    wanted = targets(sizes, weight, share, most)
    blocks = [-(-size // block) for size in sizes]
    seats = int(sum(wanted) / block + Fraction(1, 2))
    quotas = apportion(wanted, seats, [most * m for m in blocks])
    return [
        {"src": r["src"], "name": r.name, "source_size": size, "target": float(t), "exact": t, "blocks": m,
         "quota": q, "rounds": q // m if m else 0, "extra": (q % m if m else 0) * block}
        for r, size, t, m, q in zip(found, sizes, wanted, blocks, quotas)
    ]


def take_words(docs, weights=WEIGHTS, share=SHARE, most=MOST, block=BLOCK, seed=SEED,
               id_col="doc_id", source_col="source", text_col="text"):
    """For each row: id, text key, size, source_size, target, taken words and whole ``copies``.

    ``copies`` rounds the taken words to whole documents: the document at the
    edge of a source's last block counts if half of it or more is taken.
    """
    spark = docs.sparkSession
    measured = stage(_measured(docs, seed, id_col, source_col, text_col), "mix-sizes")
    plan = source_plan(measured, weights, share, most, block)
    rows = [(p["src"], p["source_size"], p["target"], p["rounds"], p["extra"]) for p in plan]
    sources = spark.createDataFrame(
        rows, "src string, source_size bigint, target double, rounds bigint, extra bigint"
    )
    words = sum(p["source_size"] for p in plan)
    slices = max(LEAST_SLICES, -(-words // WORDS_PER_SLICE))
    cut = measured.withColumn("slice", F.pmod("h", F.lit(slices)))
    earlier = W.partitionBy("src").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = cut.groupBy("src", "slice").agg(F.sum("size").alias("s")).select(
        "src", "slice", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before")
    )
    inside = (
        W.partitionBy("src", "slice").orderBy("h", "id", "t", "size")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    ends = F.col("before") + F.sum("size").over(inside)
    placed = cut.join(offsets, ["src", "slice"]).withColumn("end", ends).join(sources, "src")
    begin = F.col("end") - F.col("size")
    again = F.greatest(F.lit(0), F.least("end", "extra") - begin)
    return placed.select(
        "id", "t", "name", "size", "source_size", "target",
        (F.col("rounds") * F.col("size") + again).alias("taken"),
        F.when(F.col("size") == 0, F.lit(0))
        .otherwise(F.col("rounds") + (2 * again >= F.col("size")).cast("bigint")).alias("copies"),
    )


def mix_documents(docs, **options):
    """The mixture itself: the rows of ``docs``, each as often as the mixture takes it."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    source_col = options.get("source_col", "source")
    key, copies = fresh(docs, "_key", "_copies")
    taken = take_words(docs, **options)
    # Rows equal in id, source and text lie side by side; each gets the rounded mean.
    per_key = taken.groupBy("id", "t", "name").agg(F.avg("copies").alias(copies)).select(
        F.col("id").alias(id_col), F.col("t").alias(key), F.col("name").alias(source_col), copies
    )
    joined = left_join(docs.withColumn(key, text_key(text_col)), per_key, [id_col, key, source_col])
    return (
        joined.withColumn(copies, F.round(copies).cast("bigint")).where(F.col(copies) > 0)
        .withColumn(copies, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies))))
        .select(*docs.columns)
    )
