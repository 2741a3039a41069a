"""The vectorised text functions against plain Python."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import ODD, prose, words

from imageset_spark.llm import text as T

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t 𝒳A.", max_size=60)), min_size=1, max_size=8)


def chunked(texts, limit=None):
    for first, data, offsets in T.chunks(pa.array(texts, pa.string()), limit):
        yield first, T.Chunk(data, offsets)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.sampled_from([None, 1, 40]))
def test_measures_match_plain_python(texts, limit):
    seen = 0
    for first, chunk in chunked(texts, limit):
        hashes = chunk.word_hashes()
        repeated, (filled, dup) = chunk.repeated_words(hashes), chunk.repeated_lines()
        distinct, most = chunk.distinct_words(hashes)
        for i in range(chunk.rows):
            text = texts[first + i] or ""
            w = words(text)
            assert chunk.words[i] == len(w)
            triples = Counter(zip(w, w[1:], w[2:]))
            covered = {j + k for j in range(len(w) - 2) if triples[tuple(w[j : j + 3])] > 1 for k in range(3)}
            assert repeated[i] == len(covered)
            lines = [x for x in text.split("\n") if words(x)]
            assert (filled[i], dup[i]) == (len(lines), len(lines) - len(set(lines)))
            assert (distinct[i], most[i]) == (len(set(w)), max(Counter(w).values(), default=0))
        seen += chunk.rows
    assert seen == len(texts)


@settings(max_examples=40, deadline=None)
@given(TEXTS)
def test_equal_words_have_equal_hashes_wherever_they_stand(texts):
    known = {}
    for first, chunk in chunked(texts, 30):
        hashes = chunk.word_hashes(fold=True)
        for row, value, a, b in zip(chunk.row, hashes, chunk.start, chunk.end):
            word = bytes(chunk.data[a:b]).decode().lower() if chunk.data[a:b].max() < 128 else None
            if word:
                assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)


def test_shingles_of_short_and_long_texts():
    texts = ["a b c d", "a b c", "a b c d e", "A B C D E f", "", None, "a b c d"]
    (_, chunk), = chunked(texts)
    values, row = chunk.shingles(chunk.word_hashes(fold=True))
    by_row = [set(values[row == i].tolist()) for i in range(len(texts))]
    assert [len(s) for s in by_row] == [1, 1, 1, 2, 0, 0, 1]
    assert by_row[0] == by_row[6] and by_row[2] < by_row[3] and not by_row[0] & by_row[1]


def test_empty_array_and_huge_text():
    assert list(T.chunks(pa.array([], pa.string()))) == []
    long = prose(400_000, 9)
    (_, chunk), = list(chunked([long], 1000))
    assert chunk.words.tolist() == [len(words(long))]


@pytest.mark.parametrize("n", [1, 7])
def test_slices_of_arrow_arrays(n):
    array = pa.array([t for _, t in ODD], pa.string()).slice(n)
    got = np.concatenate([T.Chunk(d, o).words for _, d, o in T.chunks(array)])
    assert got.tolist() == [len(words(t)) for _, t in ODD[n:]]
