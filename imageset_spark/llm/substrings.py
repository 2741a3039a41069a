"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: each byte's random value, shifted by
its distance, summed over the last 16 bytes. A chunk ends where the top
bits of the hash are zero, so its end depends on nearby bytes only, and chunks
behind an insertion are the same as before it. Two ends closer than ``LEAST``
bytes keep the first one, again a rule on neighbours only. Stretches of over
``MOST`` bytes without an end, as in text that repeats a word, are cut where the
hash is the lowest nearby.

Chunks are deduplicated by 64-bit digest. Consecutive chunks that some other
document has too form a run. A run of ``LEAST_RUN`` words or more is a
repeated passage if, with the chunks around it, which the passage may reach
into, it can be longer than ``PASSAGE`` words. One chance collision of digests
cannot make a run. The first holder of a chunk is the document of lowest id, and of
lowest text key among texts of one id; ``later`` passages are those that begin in another document.

Defined results: null and empty texts have no chunks; each row without id is a
document of its own; rows of one id and text are one document, rows of one id
and different texts are different documents; ids that are no whole numbers are in
the order of their hashes; empty tables give empty results; only the columns
below are returned.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from imageset_spark.functions import stage

from .rows import bound_batches, fresh, left_join, text_key
from .text import Chunk, chunks, series

GEAR = (series(256, 21) & np.uint64(0xFFFF)).astype(np.uint16)
#: A chunk ends where the gear hash is below this: one byte in sixteen.
BELOW = np.uint16(1 << 12)
REACH, LEAST, MOST, NEARBY = 16, 8, 96, 24
LEAST_RUN, PASSAGE = 20, 50
NO_ID = -(1 << 63)

CHUNK_COLUMNS = "digest bigint, start int, stop int, words int, around int"


def gear(data):
    """Rolling hash over the last 16 bytes at every byte, by doubling the reach."""
    out = GEAR[data]
    for step in (1, 2, 4, 8):
        out[step:] = out[step:] + (out[:-step] << np.uint16(step))
    return out


def _lowest(rolled, begin, stop):
    """Ends inside a stretch without one: where the hash is the lowest of its surroundings, ties included.

    Such ends depend on nearby bytes only, too, so text that repeats a short
    pattern is cut alike wherever it stands.
    """
    around = np.concatenate((np.full(NEARBY, 0xFFFF, np.uint16), rolled[begin:stop], np.full(NEARBY, 0xFFFF, np.uint16)))
    least = np.lib.stride_tricks.sliding_window_view(around, 2 * NEARBY + 1).min(1)
    return begin + 1 + np.flatnonzero(rolled[begin:stop] == least)


def boundaries(data, offsets):
    """Start and end byte and text of all chunks."""
    n = len(data)
    follows = np.zeros(n + 1, bool)
    follows[:-1] = (data & 0xC0) == 0x80
    rolled = gear(data)
    ends = np.flatnonzero((rolled < BELOW) & ~follows[1:]) + 1
    row = np.searchsorted(offsets, ends - 1, "right") - 1
    ends, row = ends[ends - offsets[row] >= REACH], row[ends - offsets[row] >= REACH]
    near = np.zeros(len(ends), bool)
    near[1:] = (ends[1:] - ends[:-1] < LEAST) & (row[1:] == row[:-1])
    cuts = np.union1d(ends[~near], offsets)
    wide = np.flatnonzero(np.diff(cuts) > MOST)
    if len(wide):
        more = np.concatenate([_lowest(rolled, cuts[i] + REACH, cuts[i + 1]) for i in wide])
        cuts = np.union1d(cuts, more[~follows[more]])
        # What is still too long is cut by length.
        gaps = np.diff(cuts)
        wide = np.flatnonzero(gaps > MOST)
        times = (gaps[wide] - 1) // MOST
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
        extra = np.repeat(cuts[wide], times) + step * MOST
        for _ in range(3):  # to the end of a character
            extra = extra + follows[extra]
        cuts = np.union1d(cuts, extra)
    start, stop = cuts[:-1], cuts[1:]
    return start, stop, np.searchsorted(offsets, start, "right") - 1


def cut(texts):
    """Chunks of all texts: (text, digest, start and stop in code points, words, words around)."""
    for begin, data, offsets in chunks(texts):
        if not len(data):
            continue
        start, stop, row = boundaries(data, offsets)
        chunk = Chunk(data, offsets)
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
        opened = np.zeros(len(data) + 1, np.int64)
        opened[chunk.start + 1] = 1
        opened = np.cumsum(opened)
        words = opened[stop] - opened[start]
        around = np.zeros(len(words), np.int64)
        same = row[1:] == row[:-1]
        around[1:] += np.where(same, words[:-1], 0) << 16
        around[:-1] += np.where(same, words[1:], 0)
        base = points[offsets[row]]
        yield row + begin, chunk.spans(start, stop), points[start] - base, points[stop] - base, words, around


def keyed_documents(docs, id_col, text_col, key, t):
    """``docs`` with the document key: ``key`` (id, ``NO_ID`` if there is none) and ``t`` (text key, else the row).

    An id that is no whole number is told apart by its 64-bit hash, together with the text
    key. Rows without id are written, so that their row numbers stay.
    """
    own = F.col(id_col)
    whole = isinstance(docs.schema[id_col].dataType, IntegralType)
    number = own.cast("bigint") if whole else F.when(own.isNotNull(), F.xxhash64(own))
    nameless = stage(docs.where(number.isNull()).withColumn(t, F.monotonically_increasing_id()), "rows-without-id")
    named = docs.where(number.isNotNull()).withColumns({key: number, t: text_key(text_col)})
    return named.unionByName(nameless.withColumn(key, F.lit(NO_ID)))


def chunk_table(keyed):
    """One row per chunk of texts ``id``, ``t``, ``text``: document key, digest, span, words.

    ``around`` packs the words of the chunks before and behind.
    """
    bound_batches(keyed.sparkSession)
    rows = keyed.select("id", "t", "text")

    def run(batches):
        for batch in batches:
            for row, digest, start, stop, words, around in cut(batch.column(2)):
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(digest.view(np.int64)),
                     *[pa.array(c.astype(np.int32)) for c in (start, stop, words, around)]],
                    ["id", "t", "digest", "start", "stop", "words", "around"],
                )

    return rows.mapInArrow(run, f"id bigint, t bigint, {CHUNK_COLUMNS}")


def repeated_passages(keyed, least_run=LEAST_RUN, passage=PASSAGE):
    """One row per repeated passage of texts ``id``, ``t``, ``text``: id, ``t``, start, stop (code points), words, ``later``."""
    table = chunk_table(keyed)
    holder = F.struct("id", "t")
    shared = stage(
        table.groupBy("digest").agg(F.min(holder).alias("first"), F.max(holder).alias("last"))
        .where("first <> last").select("digest", "first"),
        "shared-chunks",
    )
    found = table.join(shared, "digest").select("id", "t", "start", "stop", "words", "around", "first")
    line = W.partitionBy("id", "t").orderBy("start")
    # Repeated rows bring the same chunk again; a run goes on across them.
    new = F.coalesce((F.lag("stop").over(line) != F.col("start")) & (F.lag("start").over(line) != F.col("start")),
                     F.lit(True))
    run = F.sum(F.col("new").cast("int")).over(line.rowsBetween(W.unboundedPreceding, 0))
    runs = (
        found.withColumn("new", new).withColumn("run", run)
        .groupBy("id", "t", "run", "start", "stop").agg(
            F.max("words").alias("words"), F.max("around").alias("around"), F.max("first").alias("first"))
        .groupBy("id", "t", "run").agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("words").alias("words"),
            F.min_by("around", "start").alias("head"), F.max_by("around", "start").alias("tail"),
            F.max(F.col("first") != F.struct("id", "t")).alias("later"),
        )
    )
    reach = F.col("words") + F.shiftright("head", 16) + F.col("tail").bitwiseAND(0xFFFF)
    return runs.where((F.col("words") >= least_run) & (reach > passage)).select(
        "id", "t", "start", "stop", "words", "later"
    )


def passage_report(docs, id_col="doc_id", text_col="text", **options):
    """One row per document: its repeated passages, and those first seen in another document."""
    span = F.concat_ws(":", "start", "stop")
    entry = F.struct("start", span.alias("span"))

    def joined(entries):
        return F.array_join(F.transform(F.sort_array(entries), lambda e: e["span"]), ",")

    keyed = keyed_documents(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")), "_id", "text", "id", "t"
    )
    found = repeated_passages(keyed, **options).groupBy("id", "t").agg(
        F.count("*").alias("n_passages"), F.sum("words").alias("repeated_words"),
        joined(F.collect_list(entry)).alias("passages"),
        joined(F.collect_list(F.when(F.col("later"), entry))).alias("later_passages"),
    )
    zero, none = F.lit(0).cast("bigint"), F.lit("")
    return left_join(keyed.select("_id", "id", "t"), stage(found, "passages"), ["id", "t"]).select(
        F.col("_id").alias(id_col), F.coalesce("n_passages", zero).alias("n_passages"),
        F.coalesce("repeated_words", zero).alias("repeated_words"), F.coalesce("passages", none).alias("passages"),
        F.coalesce("later_passages", none).alias("later_passages"),
    )


def drop_repeats(docs, id_col="doc_id", text_col="text", **options):
    """The documents without their later passages, with the columns they came with."""
    key, t, spans, marks = fresh(docs, "_key", "_t", "_spans", "_marks")
    keyed = keyed_documents(docs, id_col, text_col, key, t)
    texts = keyed.select(F.col(key).alias("id"), F.col(t).alias("t"), F.col(text_col).alias("text"))
    found = repeated_passages(texts, **options).where("later").groupBy("id", "t").agg(
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(spans)
    ).select(F.col("id").alias(key), F.col("t").alias(t), spans)
    # Where a kept piece starts and the next later passage begins, by turns.
    edges = F.concat(
        F.array(F.lit(0)), F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["stop"]))),
        F.array(F.length(text_col)),
    )
    joined = left_join(keyed, stage(found, "later-passages"), [key, t]).withColumn(marks, edges)
    pieces = F.transform(
        F.sequence(F.lit(1), F.size(marks) - 1, F.lit(2)),
        lambda i: F.substring(text_col, F.element_at(marks, i) + 1, F.element_at(marks, i + 1) - F.element_at(marks, i)),
    )
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(F.array_join(pieces, ""))
    return joined.withColumn(text_col, text).select(*docs.columns)
