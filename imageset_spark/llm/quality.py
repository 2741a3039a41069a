"""Quality rules: word rules, then compression bands.

A text that compresses very well repeats itself; one that hardly compresses is
noise. The zstandard ratio (compressed bytes / bytes) of the whole text must lie
inside a band that depends on its length, because short texts compress worse than
long ones of the same kind. The same holds for fixed chunks: a text is cut at
every size of ``CHUNK_BANDS`` that it reaches, each size with a band of its own.
Small chunks show noise between prose, large ones blocks that repeat. Bytes behind
the last full chunk are judged as the text's last chunk of that size, so no byte
is left out. Of all chunks one in ``CHUNKS_PER_BAD`` may lie outside, which is none
in a text of up to 5 KB or so.

The bands are the range of running prose in several languages, widened by 0.03 to
0.06 on either side. Texts of too few words, and texts most of whose words lie in
repeated windows, fail before.

Defined results: null and empty texts have no words and are not kept; repeated
rows are judged alike; an empty table gives an empty result; input columns
named like an output column are replaced.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

from .rows import bound_batches
from .text import Chunk, chunks

LEAST_WORDS = 50
#: Reject if more than this share of the words lies in repeated 3-word windows.
MOST_REPEATED = (50, 100)
LEVEL = 3
#: (bytes below this, lowest ratio, highest ratio) of whole texts.
BANDS = (
    (256, 0.50, 0.90), (512, 0.49, 0.80), (1024, 0.42, 0.75), (2048, 0.38, 0.64), (4096, 0.35, 0.57),
    (8192, 0.34, 0.53), (32768, 0.31, 0.51), (float("inf"), 0.25, 0.48),
)
#: (bytes of a chunk, lowest ratio, highest ratio).
CHUNK_BANDS = ((512, 0.45, 0.76), (1024, 0.39, 0.66), (4096, 0.33, 0.54))
#: One in so many chunks may lie outside its band.
CHUNKS_PER_BAD = 20
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "ratio double, n_chunks bigint, n_bad_chunks bigint"
)
COLUMNS = [m.split()[0] for m in MEASURES.split(", ")]


def chunk_starts(n_bytes, size):
    """Where the chunks of a size begin; the last one ends with the text."""
    if n_bytes < size:
        return []
    last = n_bytes - size
    return [*range(0, last, size), last]


def ratios(data, offsets):
    """Whole-text ratio, number of chunks, and how many lie outside their band."""
    packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    raw = memoryview(np.ascontiguousarray(data))
    whole, count, bad = [], [], []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        whole.append(len(packer.compress(raw[a:b])) / (b - a) if b > a else 0.0)
        fits = [
            low <= len(packer.compress(raw[a + i : a + i + size])) / size <= high
            for size, low, high in CHUNK_BANDS
            for i in chunk_starts(b - a, size)
        ]
        count.append(len(fits))
        bad.append(len(fits) - sum(fits))
    return whole, count, bad


def measure(texts):
    """The measures of each text, as a frame."""
    out = []
    for _, data, offsets in chunks(texts):
        chunk = Chunk(data, offsets)
        hashes = chunk.word_hashes()
        # Code points of a word: its bytes that do not continue a character.
        points = chunk.sums(chunk.inside & ((data & 0xC0) != 0x80))
        _, dup = chunk.repeated_lines()
        whole, n_chunks, bad = ratios(data, offsets)
        out.append(pd.DataFrame(dict(zip(COLUMNS, (
            chunk.words, points, chunk.sums(SYMBOLS[data]), dup, chunk.repeated_words(hashes), whole, n_chunks, bad,
        )))))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in COLUMNS})


def judge(m):
    """(base_failed, kept) of a frame of measures and ``_bytes``."""
    few, per = MOST_REPEATED
    failed = (m.n_words < LEAST_WORDS) | (per * m.n_repeat_words > few * m.n_words)
    size = m["_bytes"].to_numpy()
    band = np.searchsorted([b for b, _, _ in BANDS[:-1]], size, "right")
    low, high = np.array([b[1] for b in BANDS])[band], np.array([b[2] for b in BANDS])[band]
    fits = (m.ratio >= low) & (m.ratio <= high) & (m.n_bad_chunks * CHUNKS_PER_BAD <= m.n_chunks)
    return failed, ~failed & fits


def judge_documents(docs, text_col="text"):
    """All rows of ``docs`` with the measures, ``base_failed`` and ``kept``."""
    bound_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in [*COLUMNS, "base_failed", "kept"] if c != text_col])
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
        + [MEASURES, "base_failed boolean, kept boolean"]
    )

    def judged(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            m = measure(texts)
            m["_bytes"] = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            failed, kept = judge(m)
            columns = [pa.array(m[c].to_numpy(), pa.float64() if c == "ratio" else pa.int64()) for c in COLUMNS]
            columns += [pa.array(failed.to_numpy(bool)), pa.array(kept.to_numpy(bool))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], [*batch.schema.names, *COLUMNS, "base_failed", "kept"]
            )

    return docs.mapInArrow(judged, schema)


def keep_documents(docs, text_col="text"):
    """The rows that pass, with the columns they came with."""
    judged = judge_documents(docs.select("*"), text_col)
    return judged.where("kept").select(*docs.columns)
