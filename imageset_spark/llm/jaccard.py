"""N-gram Jaccard join by count vectors in R-trees.

A document is its set of distinct five-word shingles. Shingles are hashed into
``DIMS`` groups; the number of shingles in each group is the document's point.
Two sets cannot share more than the sum of the coordinate minima of their
points, and a link needs an overlap of 3/7 of the summed sizes (the same as a
Jaccard similarity of 3/4), so points whose minima sum to less are never
compared. Survivors are verified on their texts.

One tree over all points does not scale: prose fills the groups evenly, so
boxes of unlike documents of one length overlap, and the number of box pairs
grows with the square of the corpus. The first level of the forest is therefore
split by fine coordinates, one per shingle. Fine coordinates have a corpus-wide
order, rarest first as counted over all documents in ``FINE_GROUPS`` groups, and
a point is filed under the first quarter of its own. Two linked sets share their
first common shingle there, so no link is lost, and each pair meets only in
subtrees of shingles they share.

Subtrees of copies would hold all pairs of the group. Equal sets are linked by their
digests, and one of them stands for all. Then each member of a subtree is tried with
one hub, which links groups of near copies in linear work. Components are formed, and
subtrees whose other points lie in one component are done. Of the rest, small ones (``FEW``
points) list their pairs by sizes and places of the shared shingle alone, and vectors are
moved for each pair once, not for each subtree of a point. In large ones an R-tree is packed
over the points outside the subtree's largest component (sorted by size and
coordinates, boxes of ``LEAF`` points), and all points of other components are looked up
in it. Large subtrees are cut on both sides, so that a task holds ``HOME`` points of one
side and ``OTHER`` of the other.

``DIMS`` groups say little about texts of thousands of shingles, of which any two fill
them alike. A long text also has a finer vector, of at most ``DENSE`` shingles a group,
and pairs of long texts have to pass the bound on these before their texts are moved.

Two documents with the same component need no link between them, so pairs are taken in
rounds: first the few of each pair of components that share most by the bound. Most
components meet there; only pairs of components that have not met and had more
candidates are looked at again, and the last round takes all that are left. A pair
is reported in one subtree, not in each of those that its points share: where both
points hold a common key among the few before the subtree's own, it was met there.

The join runs on nodes: a 64-bit hash of id and text, so rows without id take part
and texts of one id are told apart. A component is named by its smallest id.

Defined results: null, empty and blank texts have an empty set and link with
nothing; a component of rows without id only is null; rows of one id and text are
one document, also those without id; empty tables give empty results; only the
columns below are returned.
"""

import itertools

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .components import components
from .rows import bound_batches, fresh, left_join, may_be_among, text_key, text_of
from .text import Chunk, chunks, mix, series

SHINGLE = 5
DIMS = 256
#: Mean shingles in a group of a finer vector; texts with more than this in ``DIMS`` groups have one.
DENSE = 8
FINE_GROUPS = 1 << 16
LEAF, HOME, OTHER = 32, 1024, 4096
#: Points of a subtree whose pairs are listed without vectors; the pairs of larger ones would grow with the square.
FEW = 8
#: Candidates of each pair of components that a round takes from a subtree; the last takes all.
ROUNDS = (4, 64, None)
#: Keys of a point before a subtree's own that tell whether a pair was met before.
EARLIER = 4
#: Shingles on one side of a block of pairs that are verified together, and its pairs.
BLOCK, BLOCK_PAIRS = 1 << 20, 1 << 13
ID_BITS = 1 << 23
#: Hash bits of a key that tell whether it may be another point's too: those that name a slice, and the rest.
SLICE_BITS, REST_BITS = 12, 32
WORD = r"[^\x20\x09-\x0D]"
_U = np.uint64
_TAG = series(1, 31)[0]


def needed(a, b):
    """Least overlap of linked sets of these sizes."""
    return -(-3 * (a + b) // 7)


def shingle_sets(texts, ranks=None):
    """Distinct shingles of each text: yields (first row, sizes, values sorted within each text).

    With ``ranks`` a shingle is written as its fine group's rank and its other
    bits, which keeps it apart from all others and sorts it by rank.
    """
    for begin, data, offsets in chunks(texts):
        chunk = Chunk(data, offsets)
        values, row = chunk.shingles(chunk.word_hashes(fold=True), SHINGLE)
        if ranks is not None:
            values = (ranks[(values & _U(FINE_GROUPS - 1)).astype(np.int64)] << _U(48)) | (values >> _U(16))
        order = np.argsort(row, kind="stable")
        values = values[order]
        count = np.bincount(row, minlength=chunk.rows)
        edge = np.concatenate(([0], np.cumsum(count)))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            values[a:b].sort()
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[edge[:-1][count > 0]] = True
        row = np.repeat(np.arange(chunk.rows), count)[new]
        yield begin, np.bincount(row, minlength=chunk.rows), values[new], row


def _node(id_col, text_col):
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), text_key(text_col))


def _texts(docs, id_col, text_col):
    """Node as ``id``, text and document id ``doc`` of all rows, and whether any node repeats."""
    texts = docs.select(_node(id_col, text_col).alias("id"), F.col(text_col).alias("text"), F.col(id_col).alias("doc"))
    return texts, not texts.groupBy("id").count().where("count > 1").isEmpty()


def fine_ranks(texts):
    """Order of the fine groups, rarest first, from counts over all documents."""

    def count(batches):
        total = np.zeros(FINE_GROUPS, np.int64)
        for batch in batches:
            for _, _, values, _ in shingle_sets(batch.column(0)):
                total += np.bincount((values & _U(FINE_GROUPS - 1)).astype(np.int64), minlength=FINE_GROUPS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["g", "n"])

    rows = texts.select("text").mapInArrow(count, "g int, n bigint").groupBy("g").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(FINE_GROUPS, np.int64)
    total[rows["g"].to_numpy()] = rows["n"].to_numpy()
    ranks = np.empty(FINE_GROUPS, _U)
    ranks[np.argsort(total, kind="stable")] = np.arange(FINE_GROUPS, dtype=_U)
    return ranks


def finer_vector(values):
    """Count vector of a long set, each group of the coarse one halved until ``DENSE`` shingles fill one, and what counts above 255 hold back."""
    halvings = max(0, (-(-len(values) // (DENSE * DIMS)) - 1).bit_length())
    group = (values >> _U(42 - halvings)) & _U((DIMS << halvings) - 1)
    exact = np.bincount(group.astype(np.int64), minlength=DIMS << halvings)
    vec = np.minimum(exact, 255).astype(np.uint8)
    return vec.tobytes(), int((exact - vec).sum())


def points(texts, ranks):
    """One row per text: ``id``, ``doc``, size ``n``, ``digest`` of the set, count vector ``vec``, fine coordinates ``keys``.

    ``lost`` is what counts above 255 hold back; long sets have a finer vector ``fine`` and its ``fine_lost``, others null.
    """

    def run(batches):
        for batch in batches:
            for begin, sizes, values, row in shingle_sets(batch.column(1), ranks):
                n = len(sizes)
                group = row * DIMS + ((values >> _U(42)) & _U(DIMS - 1)).astype(np.int64)
                exact = np.bincount(group, minlength=n * DIMS)
                vec = np.minimum(exact, 255).astype(np.uint8)
                lost = (exact - vec).reshape(n, DIMS).sum(1)
                edge = np.concatenate(([0], np.cumsum(sizes)))
                total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(values ^ _TAG))))
                digest = (total[edge[1:]] - total[edge[:-1]]).view(np.int64)
                taken = np.where(sizes > 0, sizes - (3 * sizes + 3) // 4 + 1, 0)
                place = np.arange(len(values)) - np.repeat(edge[:-1], sizes)
                first = place < np.repeat(taken, sizes)
                starts = np.concatenate(([0], np.cumsum(taken))).astype(np.int32)
                finer = [
                    finer_vector(values[a:b]) if b - a > DENSE * DIMS else (None, None)
                    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, n), batch.column(2).slice(begin, n), pa.array(sizes.astype(np.int64)), pa.array(digest),
                     pa.array(lost),
                     pa.Array.from_buffers(pa.binary(), n, [
                         None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(DIMS)), pa.py_buffer(vec)]),
                     pa.ListArray.from_arrays(pa.array(starts), pa.array(values[first].view(np.int64))),
                     pa.array([f for f, _ in finer], pa.binary()), pa.array([x for _, x in finer], pa.int64())],
                    ["id", "doc", "n", "digest", "lost", "vec", "keys", "fine", "fine_lost"],
                )

    return texts.mapInArrow(
        run, f"id bigint, doc {dict(texts.dtypes)['doc']}, n bigint, digest bigint, lost bigint, vec binary, keys array<bigint>, "
        "fine binary, fine_lost bigint"
    )


def matrix(column):
    """Count vectors of a binary Arrow column, one row each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, DIMS), np.uint8)
    first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    return data[first : first + len(column) * DIMS].reshape(-1, DIMS)


class Points:
    """Sizes and count vectors; counts above 255 are held back in ``lost``.

    Of what is held back, two sets share at most the smaller sum.
    """

    def __init__(self, n, lost, vec, label):
        self.n, self.lost, self.vec, self.label = n, lost, vec, label

    def part(self, a, b):
        return Points(self.n[a:b], self.lost[a:b], self.vec[a:b], self.label[a:b])

    def shared(self, left, right):
        """Upper bounds of the overlap of index pairs."""
        least = np.minimum(self.vec[left], self.vec[right]).sum(1, dtype=np.int64)
        return least + np.minimum(self.lost[left], self.lost[right])

    def possible(self, left, right):
        """Of the index pairs, those of different labels that may be linked, and by how much they pass the bound."""
        n, label = self.n, self.label
        keep = (label[left] != label[right]) & (4 * np.minimum(n[left], n[right]) >= 3 * np.maximum(n[left], n[right]))
        left, right = left[keep], right[keep]
        parts = [[np.empty(0, np.int64)] * 3]
        for i in range(0, len(left), 1 << 14):
            a, b = left[i : i + (1 << 14)], right[i : i + (1 << 14)]
            spare = self.shared(a, b) - needed(n[a], n[b])
            some = spare >= 0
            parts.append([a[some], b[some], spare[some]])
        return [np.concatenate(p) for p in zip(*parts)]


def overlap_bound(x, y, x_lost, y_lost):
    """Upper bound of the overlap of two sets by their count vectors; the longer one is folded to the groups of the shorter."""
    if len(x) == len(y):
        return int(np.minimum(x, y).sum(dtype=np.int64)) + min(x_lost, y_lost)
    if len(x) < len(y):
        x, y = y, x
    return int(np.minimum(x.reshape(len(y), -1).sum(1, dtype=np.int64), y).sum()) + x_lost + y_lost


def bounded(pairs, columns):
    """``columns`` of the pairs (sizes ``na``, ``nb``, vectors and ``lost`` of :func:`_beside`) that pass the bound, and ``spare``, by how much."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            vectors = zip(*([np.frombuffer(v.as_buffer(), np.uint8) for v in table[f"{x}_vec"]] for x in "ab"))
            lost = zip(*(table[f"{x}_lost"].to_pylist() for x in "ab"))
            most = [overlap_bound(*v, *x) for v, x in zip(vectors, lost)]
            spare = np.array(most, np.int64) - needed(table["na"].to_numpy(), table["nb"].to_numpy())
            kept = table.select(columns).append_column("spare", pa.array(spare)).filter(pa.array(spare >= 0))
            yield from kept.to_batches()

    types = dict(pairs.dtypes)
    return pairs.mapInArrow(run, ", ".join(f"{c} {types[c]}" for c in columns) + ", spare bigint")


def _beside(pairs, side, table, columns):
    """``pairs`` with columns of ``table`` for the document of column ``side``."""
    return pairs.join(table.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)


def _with_vectors(pairs, known, vec="vec", lost="lost"):
    """``pairs`` with the count vectors of both sides, for :func:`bounded`."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    vectors = may_be_among(known.select("id", F.col(vec).alias("vec"), F.col(lost).alias("lost")), ends, "id")
    return _beside(_beside(pairs, "a", vectors, ["vec", "lost"]), "b", vectors, ["vec", "lost"])


def _close(pairs, known):
    """The pairs (staged, as for :func:`verified`) less those of two long texts that the finer vectors refuse."""
    both = F.least("na", "nb") > DENSE * DIMS
    columns = ["tree", "a", "b", "na", "nb"]
    passed = bounded(_with_vectors(pairs.where(both), known.where("fine is not null"), "fine", "fine_lost"), columns)
    return stage(pairs.where(~both).select(*columns).union(passed.select(*columns)), "close-pairs")


def _picked(texts, repeats, ids):
    """Packed texts that may be among ``ids``, one of each: a bitmap of a fixed size keeps most others out of the shuffles."""
    bit = F.pmod(F.xxhash64("id"), F.lit(ID_BITS))
    words = ids.groupBy(F.shiftright(bit, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(pmod(xxhash64(id), {ID_BITS}) & 63))")).alias("b")
    ).collect()
    bits = np.zeros(ID_BITS // 64, np.int64)
    for r in words:
        bits[r.w] = r.b
    bits = bits.view(_U)

    def pick(batches):
        for batch in batches:
            at = batch.column(2).to_numpy()
            some = pa.array((bits[at >> 6] >> (at & 63).astype(_U)) & _U(1) > 0)
            packer = zstandard.ZstdCompressor(level=3)
            packed = [packer.compress(t.as_buffer()) if t.is_valid else None for t in batch.column(1).filter(some)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(some), pa.array(packed, pa.binary())], ["id", "text"])

    picked = texts.select("id", "text", bit.alias("bit")).mapInArrow(pick, "id bigint, text binary")
    return stage(picked.dropDuplicates(["id"]), "picked-texts") if repeats else picked


def _compare(batches):
    """Verify pairs block by block: the texts of a block come first, then its pairs."""
    block, sets = None, {}
    for batch in batches:
        blocks, ids, others = (batch.column(i).to_pylist() for i in (0, 2, 3))
        pair = np.asarray(batch.column(1)) == 1
        opener = zstandard.ZstdDecompressor()
        raw = [opener.decompress(t.as_buffer()).decode() if t.is_valid else None for t in batch.column(4)]
        values = iter(
            v for _, sizes, values, _ in shingle_sets(pa.array(raw, pa.large_string()))
            for v in np.split(values, np.cumsum(sizes)[:-1])
        )
        left, right = [], []
        for g, i, j, is_pair in zip(blocks, ids, others, pair.tolist()):
            own = next(values)
            if g != block:
                block, sets = g, {}
            if not is_pair:
                sets.setdefault(i, []).append(own)
            elif any(
                len(x) and 7 * len(np.intersect1d(x, y, assume_unique=True)) >= 3 * (len(x) + len(y))
                for x in sets.get(i, ()) for y in sets.get(j, ())
            ):
                left.append(i)
                right.append(j)
        yield pa.RecordBatch.from_arrays(
            [pa.array(left, batch.schema.field(2).type), pa.array(right, batch.schema.field(2).type)], ["a", "b"]
        )


def verified(texts, repeats, pairs, known):
    """The staged pairs (``tree``, ``a``, ``b``, sizes ``na``, ``nb``) whose texts are linked, as ``a``, ``b``.

    Pairs of one ``tree`` are verified together, so that a text is moved once for
    each block, whose sides hold about ``BLOCK`` shingles and which has about
    ``BLOCK_PAIRS`` pairs, and not once for each pair.
    """
    pairs = _close(pairs, known)
    ids = pairs.select("tree", F.col("a").alias("id"), F.col("na").alias("n")).union(pairs.select("tree", "b", "nb"))
    shingles = ids.distinct().groupBy("tree").agg(F.ceil(F.sum("n") / BLOCK).alias("wide"))
    counts = pairs.groupBy("tree").agg(F.ceil(F.sqrt(F.count("*") / BLOCK_PAIRS)).alias("many"))
    sides = shingles.join(counts, "tree").select("tree", F.greatest("wide", "many").alias("sides"))
    dealt = stage(pairs.join(sides, "tree").select(
        F.xxhash64("tree", F.pmod(F.xxhash64("a"), "sides"), F.pmod(F.xxhash64("b"), "sides")).alias("block"), "a", "b"
    ), "dealt-pairs")
    members = dealt.select("block", F.col("a").alias("id")).union(dealt.select("block", "b")).distinct()
    none = F.lit(None)
    rows = members.join(_picked(texts, repeats, members), "id").select(
        "block", F.lit(0).alias("part"), "id", none.cast("bigint").alias("other"), "text"
    ).union(dealt.select("block", F.lit(1), "a", "b", none.cast("binary")))
    placed = rows.repartition("block").sortWithinPartitions("block", "part", "id")
    return placed.mapInArrow(_compare, "a bigint, b bigint")


def tree_pairs(points, home, other):
    """Pairs (home point, other point) of one subtree that the bound lets through, and by how much.

    The home points are packed in boxes; a point meets those boxes only whose
    upper corner, by summed minima, could hold a partner.
    """
    inside, every = np.flatnonzero(home), np.flatnonzero(other)
    n, vec = points.n, points.vec
    order = inside[np.lexsort((vec[inside, 1], vec[inside, 0], n[inside]))]
    found = [[np.empty(0, np.int64)] * 3]
    for i in range(0, len(order), LEAF):
        box = order[i : i + LEAF]
        high, least, most = vec[box].max(0), n[box].min(), n[box].max()
        reach = every[(4 * n[every] >= 3 * least) & (4 * most >= 3 * n[every])]
        shared = np.minimum(vec[reach], high).sum(1, dtype=np.int64)
        shared += np.minimum(points.lost[reach], points.lost[box].max())
        reach = reach[shared >= needed(n[reach], least)]
        found.append(points.possible(np.repeat(box, len(reach)), np.tile(reach, len(box))))
    return [np.concatenate(p) for p in zip(*found)]


def met_before(earlier, left, right):
    """Whether the points of index pairs share one of the keys ``earlier`` (0: none), in pieces."""
    out = np.zeros(len(left), bool)
    for i in range(0, len(left), 1 << 16):
        a, b = earlier[left[i : i + (1 << 16)]], earlier[right[i : i + (1 << 16)]]
        for j in range(EARLIER):
            own = a[:, j : j + 1]
            out[i : i + (1 << 16)] |= ((own == b) & (own != 0)).any(1)
    return out


def _best(tree, low, high, spare, limit):
    """Places of the ``limit`` pairs of most spare for each tree and pair of labels, and whether there are more."""
    order = np.lexsort((-spare, high, low, tree))
    t, x, y = tree[order], low[order], high[order]
    new = np.ones(len(order), bool)
    new[1:] = (t[1:] != t[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.concatenate((first, [len(order)])))
    rank = np.arange(len(order)) - np.repeat(first, size)
    kept = rank < limit
    return order[kept], np.repeat(size > limit, size)[kept]


_HOME, _OTHER, _MOBILE = 1, 2, 4
_PAIRS = "key bigint, a bigint, b bigint, na bigint, nb bigint, la bigint, lb bigint, more boolean"


def _searched(table, limit):
    """Candidates of all subtrees of a table sorted by subtree."""
    tree = np.stack([table["key"].to_numpy(), table["part"].to_numpy().astype(np.int64)], 1)
    role = table["role"].to_numpy()
    ids, n = table["id"].to_numpy(), table["n"].to_numpy()
    points = Points(n, table["lost"].to_numpy(), matrix(table["vec"]), table["label"].to_numpy())
    earlier = np.stack([table[f"e{j}"].to_numpy() for j in range(EARLIER)], 1)
    edge = np.concatenate(([0], np.flatnonzero((tree[1:] != tree[:-1]).any(1)) + 1, [len(tree)]))
    size = np.diff(edge)
    found = [[np.empty(0, np.int64)] * 3]
    # Subtrees of one box: all their pairs at once, by distance within the subtree.
    small = (size <= LEAF) & (tree[edge[:-1], 1] < 0)
    rest = np.repeat(edge[1:], size) - np.arange(len(tree))
    single = np.repeat(small, size)
    for step in range(1, min(LEAF, int(size.max()))):
        left = np.flatnonzero(single & (rest > step))
        found.append(points.possible(left, left + step))
    for a, b in zip(edge[:-1][~small].tolist(), edge[1:][~small].tolist()):
        left, right, spare = tree_pairs(points.part(a, b), role[a:b] & _HOME > 0, role[a:b] & _OTHER > 0)
        left, right = left + a, right + a
        # Two mobile points meet in either order.
        once = (role[right] & _MOBILE == 0) | (ids[left] < ids[right])
        found.append([left[once], right[once], spare[once]])
    left, right, spare = (np.concatenate(p) for p in zip(*found))
    new = ~met_before(earlier, left, right)
    left, right, spare = left[new], right[new], spare[new]
    label = points.label
    low, high = np.minimum(label[left], label[right]), np.maximum(label[left], label[right])
    more = np.zeros(len(left), bool)
    if limit is not None:
        number = np.repeat(np.arange(len(size)), size)
        kept, more = _best(number[left], low, high, spare, limit)
        left, right = left[kept], right[kept]
    turned = ids[left] > ids[right]
    left, right = np.where(turned, right, left), np.where(turned, left, right)
    columns = [tree[left, 0], ids[left], ids[right], n[left], n[right], label[left], label[right], more]
    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "a", "b", "na", "nb", "la", "lb", "more"])


def _search(limit):
    """Search every subtree of a partition sorted by subtree; one subtree may span batches."""

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            key, part = table["key"].to_numpy(), table["part"].to_numpy()
            of_last = (key == key[-1]) & (part == part[-1]) if len(key) else np.zeros(0, bool)
            last = int(np.flatnonzero(~of_last)[-1]) + 1 if not of_last.all() else 0
            if last:
                yield from _searched(table.slice(0, last), limit)
            held = table.slice(last)
        if held is not None and len(held):
            yield from _searched(held, limit)

    return run


def _meeting(batches):
    """Pairs of different labels in small subtrees of a partition sorted by subtree and id, by sizes and places alone."""
    held = None
    for batch in itertools.chain(batches, [None]):
        if batch is None:
            table, last = held, len(held) if held is not None else 0
        else:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            key = table["key"].to_numpy()
            last = int(np.searchsorted(key, key[-1])) if len(key) else 0
            held = table.slice(last)
        if not last:
            continue
        key, ids, n, reach, label = (table[c].to_numpy()[:last] for c in ("key", "id", "n", "reach", "label"))
        edge = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [last]))
        size = np.diff(edge)
        rest = np.repeat(edge[1:], size) - np.arange(last)
        for step in range(1, int(size.max())):
            left = np.flatnonzero(rest > step)
            right = left + step
            both = (label[left] != label[right]) & (n[left] <= reach[right]) & (n[right] <= reach[left])
            left, right = left[both], right[both]
            columns = [key[left], ids[left], ids[right], n[left], n[right], label[left], label[right]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["key", "a", "b", "na", "nb", "la", "lb"])


def _filed(known, met, *columns):
    """Cells (``key``, ``id``, ``n``) that may be among ``met``, with columns worked out from ``place``, the key's place in ``keys``."""
    filed = may_be_among(known.select("id", "n", "keys"), met, "id")
    filed = filed.select("id", "n", "keys", F.posexplode("keys").alias("place", "key")).select("key", "id", "n", *columns)
    return may_be_among(filed, met, "key")


def _small_candidates(met, known, limit):
    """Candidates of the cells ``met`` (key, id, label) of small subtrees.

    The sets of a pair share nothing before the first key that they share, so there the rest of
    either has to hold the needed overlap: ``reach`` is the largest other set for which it does.
    """
    cells = _filed(known, met, F.expr("(7 * (n - place)) div 3 - n").alias("reach")).join(met.select("key", "id", "label"), ["key", "id"])
    placed = cells.repartition("key").sortWithinPartitions("key", "id")
    pairs = placed.mapInArrow(_meeting, "key bigint, a bigint, b bigint, na bigint, nb bigint, la bigint, lb bigint")
    # A pair that meets in several subtrees counts in the first.
    pairs = pairs.groupBy("a", "b").agg(F.min("key").alias("key"), *[F.min(c).alias(c) for c in ("na", "nb", "la", "lb")])
    columns = ["key", "a", "b", "na", "nb", "la", "lb"]
    found = bounded(_with_vectors(stage(pairs, "meeting-pairs"), known), columns)
    if limit is None:
        return found.select(*columns, F.lit(False).alias("more"))
    of_labels = Window.partitionBy("key", F.least("la", "lb"), F.greatest("la", "lb"))
    found = found.withColumns({
        "rank": F.row_number().over(of_labels.orderBy(F.desc("spare"), "a", "b")), "size": F.count("*").over(of_labels)})
    return found.where(F.col("rank") <= limit).select(*columns, (F.col("size") > limit).alias("more"))


def _candidates(labelled, known, limit):
    """Pairs of different components that meet in a subtree of ``labelled`` (key, id, label) and pass the bound."""
    per_label = labelled.groupBy("key", "label").agg(F.count("*").alias("size"))
    mixed = stage(
        per_label.groupBy("key").agg(
            F.count("*").alias("labels"), F.sum("size").alias("all"), F.max("size").alias("most"),
            F.max_by("label", "size").alias("largest"),
        ).where("labels > 1").select(
            "key", "largest", "all", F.ceil((F.col("all") - F.col("most")) / HOME).cast("int").alias("homes"),
            F.when(F.col("all") <= HOME, 1).otherwise(F.ceil(F.col("all") / OTHER)).cast("int").alias("others"),
        ),
        "mixed-subtrees",
    )
    met = stage(labelled.join(mixed, "key"), "mixed-cells")
    small, met = met.where(F.col("all") <= FEW), met.where(F.col("all") > FEW)
    earlier = [
        F.when(F.col("place") > j, F.element_at("keys", F.greatest(F.col("place") - j, F.lit(1)))).otherwise(F.lit(0)).alias(f"e{j}")
        for j in range(EARLIER)
    ]
    vectors = may_be_among(known.select("id", "lost", "vec"), met, "id")
    rows = _filed(known, met, *earlier).join(met, ["key", "id"]).join(vectors, "id")
    # A subtree of several parts has one for each block of mobile points (those outside the largest
    # component) and block of all points.
    rows = rows.select(
        "key", "id", "n", "lost", "vec", "label", "homes", "others", (F.col("label") != F.col("largest")).alias("mobile"),
        F.expr("int(pmod(xxhash64(id), homes))").alias("home"), F.expr("int(pmod(xxhash64(id, 1), others))").alias("other"),
        *[f"e{j}" for j in range(EARLIER)],
    )
    parts = F.expr("""if(homes = 1 and others = 1, array(-1), array_union(
        transform(sequence(0, homes - 1), i -> i * others + other),
        if(mobile, transform(sequence(0, others - 1), j -> home * others + j), array())))""")
    role = F.expr(f"""if(mobile and (part < 0 or int(part div others) = home), {_HOME}, 0)
        + if(part < 0 or part % others = other, {_OTHER}, 0) + if(mobile, {_MOBILE}, 0)""")
    filed = rows.withColumn("part", F.explode(parts)).select(
        "key", "part", "id", "n", "lost", "vec", "label", role.alias("role"), *[f"e{j}" for j in range(EARLIER)]
    )
    large = filed.repartition("key", "part").sortWithinPartitions("key", "part", "id").mapInArrow(_search(limit), _PAIRS)
    return large.union(_small_candidates(small, known, limit))


def cross_links(texts, repeats, cells, place, known):
    """Links between components that meet in a subtree, enough to join all that are linked.

    ``cells`` (key, id) leaves out hubs, with which all pairs have been tried, and
    all but one of equal sets. ``place`` holds the components so far.
    """
    links, tried = [], None
    for limit in ROUNDS:
        labelled = stage(left_join(cells, place.withColumnRenamed("node", "id"), ["id"]).select(
            "key", "id", F.coalesce("component", "id").alias("label")
        ), "labelled-cells")
        found = stage(_candidates(labelled, known, limit), "cross-pairs")
        # Components that meet often share their least neighbour; verified under it, their texts move about once.
        both = found.select("la", "lb").union(found.select("lb", "la"))
        least = stage(both.groupBy("la").agg(F.least(F.min("lb"), F.first("la")).alias("tree")), "least-neighbours")
        pairs = found.select("a", "b", "na", "nb", "la", "lb").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        for side in ("la", "lb"):
            pairs = pairs.join(least.select(F.col("la").alias(side), F.col("tree").alias(f"t_{side}")), side)
        pairs = stage(pairs.select("a", "b", "na", "nb", F.least("t_la", "t_lb").alias("tree")), "open-pairs")
        links.append(stage(verified(texts, repeats, pairs, known).distinct(), "cross-links"))
        cut = found.where("more").select("key", "la", "lb").distinct()
        if limit is None or cut.isEmpty():
            break
        tried = pairs.select("a", "b") if tried is None else tried.union(pairs.select("a", "b"))
        place = components(place.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links[-1]))
        for side in ("la", "lb"):
            to = place.select(F.col("node").alias(side), F.col("component").alias(f"{side}_now"))
            cut = cut.join(to, side, "left").withColumn(f"{side}_now", F.coalesce(f"{side}_now", side))
        apart = stage(cut.where("la_now <> lb_now").select("key").distinct(), "open-subtrees")
        cells = labelled.join(apart, "key").select("key", "id")
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out


def _print(keys):
    """Bits by which keys are told apart in :func:`repeated_keys`."""
    return keys.bitwiseAND((1 << (SLICE_BITS + REST_BITS)) - 1)


def repeated_keys(known):
    """``print`` of all keys that more than one point holds, and of few others.

    Most keys are held by one point only. They are moved as packed numbers, one row for
    each slice of a batch, which takes a fraction of a row for each key.
    """

    def pack(batches):
        for batch in batches:
            keys = batch.column(0).flatten().to_numpy().view(_U)
            keys, count = np.unique(keys & _U((1 << (SLICE_BITS + REST_BITS)) - 1), return_counts=True)
            # A key of two points of a batch is written twice.
            keys = np.repeat(keys, np.minimum(count, 2))
            part = (keys >> _U(REST_BITS)).astype(np.int32)
            rest = keys.astype(np.uint32)
            first = np.flatnonzero(np.diff(part, prepend=-1))
            edge = np.concatenate((first, [len(part)])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(part[first]),
                pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(edge * np.int32(4)), pa.py_buffer(rest)]),
            ], ["slice", "rest"])

    def twice(batches):
        for batch in batches:
            for part, rests in zip(batch.column(0).to_pylist(), batch.column(1)):
                rest, count = np.unique(np.frombuffer(b"".join(rests.as_py()), np.uint32), return_counts=True)
                found = (part << REST_BITS) + rest[count > 1].astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["print"])

    packed = known.select("keys").mapInArrow(pack, "slice int, rest binary")
    return packed.groupBy("slice").agg(F.collect_list("rest").alias("rests")).mapInArrow(twice, "print bigint")


def jaccard_links(docs, id_col="doc_id", text_col="text"):
    """(sizes, links): one row per text with ``id`` (its node), ``doc`` and ``n``, and links ``a``, ``b`` of nodes that span all components."""
    bound_batches(docs.sparkSession)
    texts, repeats = _texts(docs, id_col, text_col)
    table = stage(points(texts, fine_ranks(texts)), "points")
    single = stage(table.dropDuplicates(["id"]), "single-points") if repeats else table
    known = single.drop("doc")
    # Equal sets: the least node stands for all of them.
    sets = known.where("n > 0").groupBy("n", "digest").agg(F.min("id").alias("a"), F.count("*").alias("copies"))
    sets = stage(sets.where("copies > 1").select("n", "digest", "a"), "equal-sets")
    equal = known.select("id", "n", "digest").join(sets, ["n", "digest"]).where("id <> a")
    equal = stage(equal.select("a", F.col("id").alias("b")), "equal-links")
    filed = single.select("id", F.explode("keys").alias("key"))
    repeated = stage(repeated_keys(known), "repeated-keys")
    shared = may_be_among(filed.withColumn("print", _print(F.col("key"))), repeated, "print")
    hubs = stage(
        shared.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("size"))
        .where("size > 1"),
        "hubs",
    )
    cells = stage(may_be_among(filed, hubs, "key").join(hubs, "key"), "cells")
    stars = cells.where("hub <> id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    tried = stage(_beside(_beside(stars, "a", known, ["digest", "n"]), "b", known, ["digest", "n"]), "star-pairs")
    same = F.expr("a_n = b_n and a_digest = b_digest")
    near = F.expr("4 * a_n >= 3 * b_n and 4 * b_n >= 3 * a_n")
    # A copy need not be tried: the set that stands for it has the same hubs.
    open_pairs = tried.where(~same & near).select("a", "b", F.col("a_n").alias("na"), F.col("b_n").alias("nb"))
    open_pairs = _with_vectors(open_pairs.join(equal.select("b"), "b", "left_anti"), known)
    open_pairs = bounded(open_pairs, ["a", "b", "na", "nb"]).drop("spare").withColumn("tree", F.xxhash64("a"))
    open_pairs = stage(open_pairs, "open-pairs")
    first = stage(equal.union(verified(texts, repeats, open_pairs, known)).distinct(), "star-links")
    place = components(first)
    others = cells.where("size > 2 and hub <> id").select("key", "id").join(
        equal.select(F.col("b").alias("id")), "id", "left_anti")
    # The components found so far stand for the first links.
    links = place.select(F.col("node").alias("a"), F.col("component").alias("b")).union(
        cross_links(texts, repeats, others, place, known))
    return table.select("id", "doc", "n"), stage(links, "jaccard-links")


def _placed(sizes, links):
    """(``id``, ``component``, ``least``, ``kept``) of all linked nodes: the component's smallest document id, and its node that stays."""
    place = components(links).select(F.col("node").alias("id"), "component")
    named = place.join(sizes.select("id", "doc"), "id").groupBy("component").agg(
        # Null is greater than all ids here.
        F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "id")).alias("first")
    )
    named = stage(named, "named-components")
    return stage(place.join(named, "component").select(
        "id", "component", F.col("first.doc").alias("least"), F.col("first.id").alias("kept")), "placed")


def jaccard_components(docs, id_col="doc_id", text_col="text"):
    """One row per document: id, ``n_shingles`` and ``component_id`` (the smallest id it reaches)."""
    sizes, links = jaccard_links(docs, id_col, text_col)
    return left_join(sizes, _placed(sizes, links), ["id"]).select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "doc").alias("component_id")
    )


def drop_near_duplicates(docs, id_col="doc_id", text_col="text"):
    """One document of each component stays, the one of the smallest id.

    Rows that repeat id and text (or, without id, the text) are one document, of which one row stays;
    texts without words are nobody's copies.
    """
    node, stays, rows = fresh(docs, "_node", "_stays", "_rows")
    sizes, links = jaccard_links(docs, id_col, text_col)
    placed = _placed(sizes, links).select(F.col("id").alias(node), (F.col("id") == F.col("kept")).alias(stays))
    repeated = sizes.where("n > 0").groupBy(F.col("id").alias(node)).agg(F.count("*").alias(rows)).where(f"{rows} > 1")
    # Nodes that go, and nodes of several rows: all other rows stay as they are.
    verdict = placed.where(~F.col(stays)).join(repeated, node, "full_outer")
    verdict = stage(verdict.withColumn(stays, F.coalesce(stays, F.lit(True))), "near-copies")
    keyed = docs.withColumn(node, _node(id_col, text_col))
    joined = left_join(keyed, verdict, [node]).where(F.coalesce(stays, F.lit(True)))
    alone = joined.where(F.col(rows).isNull())
    return alone.select(*docs.columns).union(
        joined.where(F.col(rows).isNotNull()).dropDuplicates([node]).select(*docs.columns)
    )
