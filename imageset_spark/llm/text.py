"""Vectorised work on the bytes of many texts at once (numpy only).

Texts arrive as Arrow string arrays. Their UTF-8 bytes lie one after another
in one buffer, so words, lines and hashes come from a handful of array
operations over a few megabytes, whatever the number of texts. Memory is
about 100 bytes per byte of a chunk; a chunk holds ``CHUNK_BYTES``, or one text
if that is longer.
"""

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
SHINGLE = 5

_U = np.uint64


def mix(x):
    """Finaliser of the splitmix64 generator: spreads the bits of an array of uint64."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def series(n, seed):
    """``n`` pseudo-random uint64 values of a seed."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed) * _U(0x1000)) * _U(0x9E3779B97F4A7C15))


BYTE_VALUES = series(256, 1)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = int(series(1, 2)[0]) | 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Odd multipliers of the words of a window.
PLACES = series(16, 3) | _U(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = {}


def powers(n):
    """Powers of the base and of its inverse, modulo 2**64."""
    if _POWERS.get("n", 0) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        _POWERS["n"] = size
    return _POWERS["up"][:n], _POWERS["down"][:n]


def chunks(texts, limit=None):
    """Cut an Arrow string array in chunks: yields (first row, byte array, row offsets)."""
    limit = limit or CHUNK_BYTES
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def windows(hashes, row, k):
    """Hashes of all windows of ``k`` words within a text, and the first word of each."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, _U), np.empty(0, np.int64)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    out = np.full(len(at), _U(k * int(PLACES[15]) & ((1 << 64) - 1)), _U)
    for j in range(k):
        out += hashes[at + j] * PLACES[j]
    return mix(out), at


class Chunk:
    """Words of the texts in one chunk.

    ``start``/``end`` are byte positions, ``row`` the text of each word,
    ``words`` the number of words of each text.
    """

    def __init__(self, data, offsets):
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        inside = ~IS_SPACE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:-1]
        last[:-1] &= ~inside[1:] | cut[1:-1]
        self.inside = inside
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row = np.searchsorted(offsets, self.start, "right") - 1
        self.words = np.bincount(self.row, minlength=self.rows)

    def sums(self, mask):
        """Number of marked bytes of each text."""
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def spans(self, start, end, fold=False):
        """Hashes of the byte ranges; ``fold`` reads A-Z as a-z."""
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, _U)
        np.cumsum((FOLDED_VALUES if fold else BYTE_VALUES)[self.data] * up[:-1], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))

    def word_hashes(self, fold=False):
        return self.spans(self.start, self.end, fold)

    def windows(self, hashes, k):
        return windows(hashes, self.row, k)

    def shingles(self, hashes, k=SHINGLE):
        """Hashes and texts of all shingles; a text of fewer words has one of all its words."""
        full, at = self.windows(hashes, k)
        row = self.row[at]
        short = np.flatnonzero((self.words > 0) & (self.words < k))
        if len(short):
            first = np.concatenate(([0], np.cumsum(self.words)))[short]
            count = self.words[short]
            out = count.astype(_U) * PLACES[15]
            for j in range(k - 1):
                has = count > j
                out[has] += hashes[first[has] + j] * PLACES[j]
            full, row = np.concatenate((full, mix(out))), np.concatenate((row, short))
        return full, row

    def repeated_words(self, hashes, k=3):
        """Words of each text that lie in a window of ``k`` words found twice or more in it."""
        window, at = self.windows(hashes, k)
        row = self.row[at]
        keys = mix(window + row.astype(_U) * PLACES[14])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        marked = np.zeros(len(hashes), bool)
        hit = at[order[twice]]
        for j in range(k):
            marked[hit + j] = True
        return np.bincount(self.row[marked], minlength=self.rows)

    def distinct_words(self, hashes):
        """Number of different words of each text, and the most frequent word's count."""
        keys = mix(hashes + self.row.astype(_U) * PLACES[13])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        at = np.flatnonzero(new)
        runs = np.diff(np.concatenate((at, [len(ranked)])))
        rows = self.row[order[at]]
        most = np.zeros(self.rows, np.int64)
        np.maximum.at(most, rows, runs)
        return np.bincount(rows, minlength=self.rows), most

    def lines(self):
        """Start and end bytes, and the text, of all lines (split at newlines)."""
        breaks = np.flatnonzero(self.data == 10)
        start = np.concatenate((self.offsets[:-1], breaks + 1))
        row = np.concatenate((np.arange(self.rows), np.searchsorted(self.offsets, breaks, "right") - 1))
        order = np.argsort(start + row, kind="stable")
        start, row = start[order], row[order]
        end = np.empty_like(start)
        same = row[1:] == row[:-1]
        end[:-1] = np.where(same, start[1:] - 1, self.offsets[row[:-1] + 1])
        end[-1] = self.offsets[-1]
        return start, end, row

    def repeated_lines(self):
        """Lines with a word, and those of them equal to an earlier line, for each text."""
        start, end, row = self.lines()
        filled = np.concatenate(([0], np.cumsum(self.inside, dtype=np.int64)))
        keep = filled[end] > filled[start]
        start, end, row = start[keep], end[keep], row[keep]
        keys = mix(self.spans(start, end) + row.astype(_U) * PLACES[12])
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        return (
            np.bincount(row, minlength=self.rows),
            np.bincount(row[order[1:][same]], minlength=self.rows),
        )
