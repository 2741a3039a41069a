"""Target-distribution importance resampling by hashed n-gram buckets.

Words are runs of digits, letters and non-ASCII characters, A-Z read as a-z;
features are all runs of 1 to ``max_n`` words, joined by one space. A feature's
bucket is its CRC-32 modulo ``buckets``. Counting buckets over the corpus and over
the target texts gives every bucket a gain, the log ratio of its smoothed shares; a
document's weight is the mean gain of its features. Adding Gumbel noise, seeded
by the document's id, and taking the highest scores draws documents without
replacement in proportion to their weights.

In the tasks, an open-addressed NumPy table interns the n-grams of each piece
of a batch: the slot follows from a 64-bit xxHash, bytes are compared before two
n-grams share a slot, and each slot holds the bucket and the count of its n-gram. So
a CRC is taken once for each different n-gram, counts add up by slot, and gains are
gathered by the slot of each occurrence. Texts are read in pieces of bounded size that
end between words, whatever their length.

What reaches the driver is bounded by arithmetic: two counts for each bucket, and one count
for each score in thousandths. The latter gives the score at which the draw ends, so
only documents at or above it are ordered, by range partitioning (``ordering.py``).

Defined results: null and wordless texts have no features and weight 0; a document
without id has the noise of the empty id and comes after all others of its score;
rows of one id share their noise and follow their number of features, rows equal in these
are interchangeable; empty tables count nothing; an empty corpus gives an empty result; input
columns other than id and text are left out.
"""

import zlib
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .ordering import in_order
from .text import chunks

BUCKETS = 10_000
MAX_N = 1
LEAST_WORDS = 20
SHARE = (10, 100)
SEED = "2024"
#: Bytes of text that are interned at once.
PIECE_BYTES = 1 << 19

_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True

# The primes of the 64-bit xxHash.
_P1, _P2, _P3, _P4, _P5 = (_U(p) for p in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Longer n-grams are hashed one by one.
_SHORT = 31


def _turned(x, bits):
    return (x << _U(bits)) | (x >> _U(64 - bits))


def xxhash64(data, start, length):
    """64-bit xxHash (seed 0) of byte ranges, as an array of uint64.

    Ranges of up to 31 bytes are hashed together, one array operation for each
    step of the hash; the few longer ones by the library.
    """
    out = np.empty(len(start), _U)
    short = np.flatnonzero(length <= _SHORT)
    at, left = start[short], length[short].copy()
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    # Every place of the buffer as the little-endian number that begins there.
    wide = np.lib.stride_tricks.sliding_window_view(padded, 8)
    h = _P5 + left.astype(_U)
    while (some := np.flatnonzero(left >= 8)).size:
        lane = wide[at[some]].view("<u8").ravel()
        h[some] = _turned(h[some] ^ (_turned(lane * _P2, 31) * _P1), 27) * _P1 + _P4
        at[some] += 8
        left[some] -= 8
    some = np.flatnonzero(left >= 4)
    lane = np.ascontiguousarray(wide[at[some], :4]).view("<u4").ravel().astype(_U)
    h[some] = _turned(h[some] ^ (lane * _P1), 23) * _P2 + _P3
    at[some] += 4
    left[some] -= 4
    while (some := np.flatnonzero(left > 0)).size:
        h[some] = _turned(h[some] ^ (padded[at[some]].astype(_U) * _P5), 11) * _P1
        at[some] += 1
        left[some] -= 1
    h = (h ^ (h >> _U(33))) * _P2
    h = (h ^ (h >> _U(29))) * _P3
    out[short] = h ^ (h >> _U(32))
    for i in np.flatnonzero(length > _SHORT).tolist():
        out[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + length[i]].tobytes())
    return out


def same_bytes(data, a, b, length):
    """Whether the ranges of one ``length`` that begin at ``a`` and ``b`` hold the same bytes."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    wide = np.lib.stride_tricks.sliding_window_view(padded, 8)
    same = np.ones(len(a), bool)
    places = np.arange(8)
    for step in range(0, _SHORT + 1, 8):
        some = np.flatnonzero(same & (length > step) & (length <= _SHORT))
        if not some.size:
            break
        unlike = wide[a[some] + step] != wide[b[some] + step]
        same[some] = ~(unlike & (places < (length[some] - step)[:, None])).any(1)
    for i in np.flatnonzero(length > _SHORT).tolist():
        n = length[i]
        same[i] = np.array_equal(data[a[i] : a[i] + n], data[b[i] : b[i] + n])
    return same


class Interned:
    """Open-addressed table of the n-grams in ``data``: ``slot`` of each occurrence, ``bucket`` and ``count`` of each slot."""

    def __init__(self, data, start, length, buckets, hash_of=xxhash64):
        n = len(start)
        size = 1 << max(4, (2 * n - 1).bit_length())
        key = hash_of(data, start, length)
        #: The occurrence that a slot belongs to, -1 if it is free.
        owner = np.full(size, -1, np.int64)
        self.slot = (key & _U(size - 1)).astype(np.int64)
        open_ = np.arange(n)
        while open_.size:
            at = self.slot[open_]
            free = owner[at] < 0
            # Of several that want a free slot one gets it; the others look at it again below.
            owner[at[free]] = open_[free]
            held = owner[at]
            same = (key[held] == key[open_]) & (length[held] == length[open_])
            alike = np.flatnonzero(same)
            same[alike] = same_bytes(data, start[held[alike]], start[open_[alike]], length[open_[alike]])
            open_ = open_[~same]
            self.slot[open_] = (self.slot[open_] + 1) & (size - 1)
        self.bucket = np.zeros(size, np.int64)
        taken = np.flatnonzero(owner >= 0)
        view = memoryview(data)
        first = start[owner[taken]].tolist()
        last = (start[owner[taken]] + length[owner[taken]]).tolist()
        self.bucket[taken] = [zlib.crc32(view[a:b]) % buckets for a, b in zip(first, last)]
        self.count = np.bincount(self.slot, minlength=size)


def _pieces(texts, limit):
    """Folded bytes of the texts in pieces: (first row, bytes, offsets, whether the first row goes on).

    A long text is cut where a word ends; a word is never cut.
    """
    for first, data, offsets in chunks(texts, limit):
        data = _FOLD[data]
        if len(data) <= limit:
            yield first, data, offsets, False
            continue
        # One long text.
        begin, goes_on = 0, False
        while begin < len(data) or not goes_on:
            end = min(begin + limit, len(data))
            while end < len(data):
                outside = np.flatnonzero(~_IN_WORD[data[end : end + limit]])
                if outside.size:
                    end += int(outside[0])
                    break
                end = min(end + limit, len(data))
            yield first, data[begin:end], np.array([0, end - begin]), goes_on
            begin, goes_on = end, True


def ngrams(texts, max_n=MAX_N, limit=None):
    """All n-grams of the texts, piece by piece: (bytes, start, length, row, words of each row from the first on, first row).

    Words are copied one after another with a space between, so that an n-gram is one range of bytes.
    """
    tail = np.empty(0, np.uint8)
    for first, data, offsets, goes_on in _pieces(texts, limit or PIECE_BYTES):
        lead = 0
        if goes_on and len(tail):
            lead = int((tail == 32).sum())
            data = np.concatenate((tail, data))
            offsets = np.array([0, len(data)])
        inside = _IN_WORD[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | cut[1:-1]
        start = np.flatnonzero(opens)
        row = np.searchsorted(offsets, start, "right") - 1
        word_of = np.cumsum(opens[inside]) - 1
        size = np.bincount(word_of, minlength=len(start))
        begin = np.concatenate(([0], np.cumsum(size + 1)))[:-1].astype(np.int64)
        packed = np.full(int((size + 1).sum()), 32, np.uint8)
        packed[np.arange(len(word_of)) + word_of] = data[inside]
        starts, lengths, rows = [], [], []
        n_words = len(start)
        for n in range(1, min(max_n, n_words) + 1):
            last = np.arange(n - 1, n_words)
            last = last[(row[last] == row[last - n + 1]) & (last >= lead)]
            starts.append(begin[last - n + 1])
            lengths.append(begin[last] + size[last] - begin[last - n + 1])
            rows.append(row[last])
        none = np.empty(0, np.int64)
        counted = np.bincount(row[lead:], minlength=len(offsets) - 1)
        yield (packed, np.concatenate([none, *starts]), np.concatenate([none, *lengths]), np.concatenate([none, *rows]),
               counted, first)
        keep = min(max_n - 1, n_words)
        tail = packed[begin[n_words - keep] :] if keep else packed[:0]


def bucket_counts(texts, max_n=MAX_N, buckets=BUCKETS):
    """Features of all rows of the one-column frame ``texts`` in each bucket, as an array."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data, start, length, *_ in ngrams(batch.column(0), max_n):
                table = Interned(data, start, length, buckets)
                np.add.at(total, table.bucket, table.count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    found = texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return total


def bucket_gains(corpus, target):
    """Gain of each bucket in thousandths, rounded down, from the counts of corpus and target texts."""
    s, t, buckets = corpus.astype(float), target.astype(float), len(corpus)
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.array([int(np.floor(1000 * log(r))) for r in ratio.tolist()], np.int64)


def weighted(texts, gains, max_n=MAX_N):
    """``id``, ``n_words``, ``n_features`` and the floored mean gain ``weight`` of each row of ``texts`` (id, text)."""
    buckets = len(gains)

    def run(batches):
        for batch in batches:
            words, features, total = np.zeros((3, len(batch)), np.int64)
            for data, start, length, row, counted, first in ngrams(batch.column(1), max_n):
                table = Interned(data, start, length, buckets)
                gathered = gains[table.bucket][table.slot]
                np.add.at(total, first + row, gathered)
                np.add.at(features, first + row, 1)
                words[first : first + len(counted)] += counted
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (words, features, weight))], ["id", "n_words", "n_features", "weight"]
            )

    kind = texts.schema[0].dataType.simpleString()
    return texts.mapInArrow(run, f"id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(id_col, seed=SEED):
    """Noise of an id in thousandths, rounded down."""
    named = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), named), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform)))


def drawn(scored, number):
    """Add ``rank``, 1 for the best, to the ``number`` rows of highest score that may be drawn; null to all others."""
    counts = scored.where("eligible").groupBy("score").agg(F.count("*").alias("n")).toArrow()
    score, n = counts["score"].to_numpy(), counts["n"].to_numpy()
    best = np.argsort(-score)
    reached = np.flatnonzero(np.cumsum(n[best]) >= number)
    none = F.lit(None).cast("bigint")
    if number <= 0 or not reached.size:
        return scored.withColumn("rank", none)
    near = F.col("eligible") & (F.col("score") >= int(score[best[reached[0]]]))
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")]
    placed = in_order(stage(scored.where(near), "draw"), order)
    rank = F.when(F.col("place") < number, F.col("place") + 1)
    return placed.withColumn("rank", rank).drop("place").unionByName(
        scored.where(~near).withColumn("rank", none)
    )


def resample(docs, target, max_n=MAX_N, buckets=BUCKETS, least_words=LEAST_WORDS, share=SHARE, seed=SEED,
             id_col="doc_id", text_col="text"):
    """One row for each row of ``docs``: id, ``n_features``, ``weight``, ``score`` and ``rank`` in the draw (null: not drawn).

    ``target`` holds the texts (column ``text_col``) whose distribution is wanted. Of the
    documents of ``least_words`` words or more the part ``share`` (numerator,
    denominator) is drawn, rounded down.
    """
    gains = bucket_gains(
        bucket_counts(docs.select(text_col), max_n, buckets), bucket_counts(target.select(text_col), max_n, buckets)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = stage(weighted(texts, gains, max_n).select(
        "id", "n_features", "weight", (F.col("weight") + gumbel("id", seed)).alias("score"),
        (F.col("n_words") >= least_words).alias("eligible"),
    ), "scored")
    number = scored.where("eligible").count() * share[0] // share[1]
    return drawn(scored, number).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


def draw_documents(docs, target, id_col="doc_id", text_col="text", **options):
    """The drawn rows of ``docs`` by id, with their ``rank``; rows without id are not told apart and stay out."""
    ranks = resample(docs, target, id_col=id_col, text_col=text_col, **options).where("rank is not null")
    best = ranks.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min("rank").alias("rank"))
    return docs.drop("rank").join(best, id_col)
