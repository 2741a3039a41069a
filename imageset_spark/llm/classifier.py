"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

``features`` turns every whole text into a row of numbers; neither labels nor
language, source or id are among them. ``fit`` learns from at most
``FIT_ROWS`` labelled rows (those of the lowest seeded hash of the id), a fixed
bound, so the driver's share of the work does not grow with the corpus. Trees
are complete binary trees kept in flat arrays; scoring walks all rows down one
level at a time with numpy. Features are written once, so texts are read once.

Defined results: null and empty texts have all-zero features and get a score
like any other; an id with several labels takes the lowest; null labels and
labels of unknown ids are ignored; without any labels, or with one class only,
the score is the share of label 1 (0.5 without labels); a null id counts as
held out; empty tables give empty results.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .rows import bound_batches, text_key
from .text import Chunk, chunks

FIT_ROWS = 20_000
SEED = 5
TREES, DEPTH, RATE, BINS, SHRINK, LEAST_WEIGHT = 60, 4, 0.15, 64, 1.0, 1.0
THRESHOLD = 0.3

_CLASSES = {
    "marks": b"#*$%&<>", "bars": b"|", "shouts": b"!", "stops": b".?", "commas": b",;:", "quotes": b"\"'()[]{}",
    "digits": b"0123456789", "uppers": bytes(range(65, 91)), "lowers": bytes(range(97, 123)), "lines": b"\n",
    "others": b"@/\\_=+~^`-",
}
_MASKS = np.zeros((len(_CLASSES), 256), bool)
for _i, _members in enumerate(_CLASSES.values()):
    _MASKS[_i, list(_members)] = True
FEATURES = (
    "log_words", "log_points", "word_length", "wide_share", *_CLASSES, "repeat_share", "distinct_share",
    "most_share", "dup_line_share", "line_words",
)


def features(texts):
    """Matrix of statistics, one row per text."""
    out = []
    for _, data, offsets in chunks(texts):
        chunk = Chunk(data, offsets)
        hashes = chunk.word_hashes(fold=True)
        words = chunk.words.astype(float)
        per_word = np.maximum(words, 1)
        points = chunk.sums((data & 0xC0) != 0x80)
        inner = chunk.sums(chunk.inside & ((data & 0xC0) != 0x80))
        filled, dup = chunk.repeated_lines()
        distinct, most = chunk.distinct_words(hashes)
        out.append(np.column_stack([
            np.log1p(words), np.log1p(points), inner / per_word, chunk.sums(data >= 0xC0) / np.maximum(points, 1),
            *[chunk.sums(mask[data]) / per_word for mask in _MASKS],
            chunk.repeated_words(hashes) / per_word, distinct / per_word, most / per_word,
            dup / np.maximum(filled, 1), words / np.maximum(filled, 1),
        ]))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def _best_splits(grad, hess, codes, node, n_nodes, n_bins):
    """Best (gain, feature, bin) of each node from histograms of gradients."""
    n_features = codes.shape[1]
    at = (node[:, None] * n_features + np.arange(n_features)) * n_bins + codes
    size = n_nodes * n_features * n_bins
    shape = (n_nodes, n_features, n_bins)
    g = np.bincount(at.ravel(), np.repeat(grad, n_features), size).reshape(shape).cumsum(2)
    h = np.bincount(at.ravel(), np.repeat(hess, n_features), size).reshape(shape).cumsum(2)
    all_g, all_h = g[:, :, -1:], h[:, :, -1:]
    gain = g**2 / (h + SHRINK) + (all_g - g) ** 2 / (all_h - h + SHRINK) - all_g**2 / (all_h + SHRINK)
    gain[(h < LEAST_WEIGHT) | (all_h - h < LEAST_WEIGHT)] = 0
    flat = gain.reshape(n_nodes, -1)
    best = flat.argmax(1)
    return flat[np.arange(n_nodes), best], best // n_bins, best % n_bins


def fit(x, y):
    """A model: prior log-odds and flat arrays of all trees."""
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    model = {"prior": float(np.log(share / (1 - share))), "feature": np.zeros((0, 2**DEPTH - 1), int),
             "cut": np.zeros((0, 2**DEPTH - 1)), "leaf": np.zeros((0, 2**DEPTH))}
    if len(y) < 2 or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    codes = np.column_stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T)])
    margin = np.full(len(y), model["prior"])
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, cut = np.zeros(2**DEPTH - 1, int), np.full(2**DEPTH - 1, np.inf)
        node = np.zeros(len(y), int)
        for level in range(DEPTH):
            gain, f, b = _best_splits(grad, hess, codes, node, 2**level, BINS)
            value = np.array([edges[i][j] if j < len(edges[i]) else np.inf for i, j in zip(f, b)])
            value[gain <= 1e-9] = np.inf
            base = 2**level - 1
            feature[base : base + 2**level], cut[base : base + 2**level] = f, value
            node = 2 * node + (x[np.arange(len(y)), f[node]] > value[node])
        g, h = np.bincount(node, grad, 2**DEPTH), np.bincount(node, hess, 2**DEPTH)
        leaf = -RATE * g / (h + SHRINK)
        margin += leaf[node]
        trees.append((feature, cut, leaf))
    model["feature"], model["cut"], model["leaf"] = (np.array(part) for part in zip(*trees))
    return model


def score(model, x):
    """Probability of label 1 of each row, all trees walked level by level."""
    margin = np.full(len(x), model["prior"])
    rows = np.arange(len(x))
    for feature, cut, leaf in zip(model["feature"], model["cut"], model["leaf"]):
        place = np.zeros(len(x), int)
        for _ in range(DEPTH):
            place = 2 * place + 1 + (x[rows, feature[place]] > cut[place])
        margin += leaf[place - (2**DEPTH - 1)]
    return 1 / (1 + np.exp(-margin))


def feature_table(docs, id_col="doc_id", text_col="text"):
    """One row per document: ``id``, ``t`` (text key) and ``x`` (the features)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            x = features(batch.column(2))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "t", "x"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"id {kind}, t bigint, x array<double>")


def held_out(col):
    """Whether a row is kept from learning: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % 5 == 0


def learn(table, labels, id_col="doc_id", label_col="quality", fit_rows=FIT_ROWS):
    """Fit on labelled rows that are not held out."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"))
    )
    rows = (
        table.join(known, "id").orderBy(F.xxhash64(F.lit(SEED), "id"), "id", "t").limit(fit_rows)
        .select("x", F.col("y").cast("double")).toArrow()
    )
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    return fit(x, rows["y"].to_numpy())


def score_documents(docs, labels, id_col="doc_id", text_col="text", label_col="quality", fit_rows=FIT_ROWS,
                    threshold=THRESHOLD):
    """One row per document: id, ``held_out``, ``score`` and ``predicted``."""
    table = stage(feature_table(docs, id_col, text_col), "features")
    model = learn(table, labels, id_col, label_col, fit_rows)

    def run(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(model, x))], ["id", "score"])

    kind = dict(table.dtypes)["id"]
    scored = table.select("id", "x").mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
