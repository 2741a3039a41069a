import random
from collections import Counter

import zstandard
from samples import clashing, documents, odd_documents, prose, words

from imageset_spark.llm import quality


def model(text):
    text = text or ""
    w = words(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    covered = {j + k for j in range(len(w) - 2) if triples[tuple(w[j : j + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    raw = text.encode()
    pack = lambda b: len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(b)) / len(b)
    low, high = next((a, b) for limit, a, b in quality.BANDS if len(raw) < limit)
    verdicts = []
    for size, least, most in quality.CHUNK_BANDS:
        begin = 0
        while len(raw) >= size:
            piece = raw[begin : begin + size] if begin + size < len(raw) else raw[-size:]
            verdicts.append(least <= pack(piece) <= most)
            begin += size
            if begin >= len(raw):
                break
    bad = verdicts.count(False)
    kept = not failed and low <= pack(raw) <= high and 20 * bad <= len(verdicts)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed, kept)


def check(docs, **options):
    out = quality.judge_documents(docs, **options).collect()
    for r in out:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
        assert got == model(r.text), r.text and r.text[:80]
    return out


def test_measures_and_verdicts_match_the_model(spark):
    rng = random.Random(3)
    noise = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(9000))
    noise = " ".join(noise[i : i + 60] for i in range(0, 9000, 60))
    block = prose(70, 5)
    texts = [prose(n, n) for n in (49, 50, 51, 400, 5000)] + [
        noise, "\n".join([block] * 30), "a b c " * 40, prose(60, 8) + " #*|" * 30, "Ω𝒳ß " * 60, prose(3000, 6) + noise * 2,
    ]
    out = {r.doc_id: r for r in check(documents(spark, list(enumerate(texts))))}
    assert out[3].kept and out[4].kept
    assert not out[5].kept and not out[5].base_failed  # does not compress
    assert out[6].base_failed and out[7].base_failed


def test_bands_reject_what_the_base_rule_passes(spark):
    # Long-range repetition of a block with other words between: few repeated windows by share, small ratio.
    text = " ".join(f"item{i} has value{i}" for i in range(4000))
    row, = check(documents(spark, [(1, text)]))
    assert not row.base_failed and not row.kept


def noise(n, seed):
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    return " ".join("".join(rng.choices(letters, k=60)) for _ in range(n // 61))


def running_text(n, seed):
    return prose(n // 4, seed)[:n]


def test_planted_junk_is_rejected_and_prose_kept(spark):
    junk, clean = [], []
    for i in range(40):
        a = running_text(3000 + 700 * i, i)
        junk.append(a + " " + noise(1100 + 200 * i, i))
        junk.append(noise(600 + 300 * i, i) + " " + a)
        junk.append(a[: len(a) // 2] + " " + noise(4000, i) + " " + a[len(a) // 2 :])
        block = running_text(340, 900 + i)
        junk.append(a + " " + (block + " ") * (4 + len(a) // 1500))
        clean.append(a)
    out = {r.doc_id: r for r in check(documents(spark, list(enumerate(junk + clean))))}
    passed = [i for i in range(len(junk)) if not out[i].base_failed]
    assert len(passed) > 120
    assert sum(out[i].kept for i in passed) == 0
    assert all(out[len(junk) + i].kept for i in range(len(clean)))


def test_no_byte_is_left_without_a_chunk():
    for size in (512, 4096):
        for n in (0, 1, size - 1, size, size + 1, 2 * size, 5 * size + 17):
            starts = quality.chunk_starts(n, size)
            covered = {b for a in starts for b in range(a, a + size)}
            assert covered == (set(range(n)) if n >= size else set())


def test_all_given_documents_that_pass_the_base_rule_stay(spark):
    rows = quality.judge_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text"))
    assert rows.where("not base_failed and not kept").count() == 0


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = check(docs)
    assert len(out) == docs.count()
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(r.text for r in docs.collect() if model(r.text)[-1])
    assert check(clashing(documents(spark, []))) == []


def test_text_column_named_like_a_measure(spark):
    docs = documents(spark, [(1, prose(80, 1))]).withColumnRenamed("text", "ratio")
    assert quality.judge_documents(docs.select("doc_id", "ratio").withColumnRenamed("ratio", "body"), "body").first().n_words == 80
