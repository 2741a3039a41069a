"""Small inputs and row-at-a-time models shared by the tests of the corpus operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(n, seed, vocabulary=5000):
    """``n`` made-up words in sentences, one line every few sentences."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        value = rng.randrange(vocabulary) ** 2 // vocabulary + 37
        word = ""
        while value:
            word += "bcdfglmnprst"[value % 12] + "aeiou"[value // 12 % 5]
            value //= 60
        out.append(word.capitalize() if i % 11 == 0 else word)
        if i % 11 == 10:
            out[-1] += ".\n" if i % 33 == 32 else "."
    return " ".join(out).replace("\n ", "\n")


def documents(spark, rows, extra=False):
    """A documents table from (id, text) or (id, text, lang, source) rows."""
    full = [(r[0], r[1], *(r[2:4] if len(r) > 2 else ("en", "s")), len(r[1] or "")) for r in rows]
    frame = spark.createDataFrame(full, SCHEMA)
    return clashing(frame) if extra else frame


def clashing(frame):
    """The frame with columns named like outputs and internals of operators."""
    from pyspark.sql import functions as F

    names = ("size", "shard", "slot", "kept", "ratio", "n_words", "_key", "_t", "_src", "_h", "_copies", "_gone",
             "_component", "_spans", "_marks", "component", "id", "t", "n", "score", "target", "taken", "name")
    return frame.withColumns({c: F.lit("x") for c in names})


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, prose(120, 1)), (6, prose(120, 1)),
    (7, prose(120, 1)), (8, "é" * 4000 + " ß𝒳 " * 50), (9, prose(30_000, 2)), (None, prose(80, 3)),
    (10, "same same " * 60), (11, "\n\n" + prose(90, 4) + "\n\n"), (None, None),
]


def odd_documents(spark, extra=True):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}") for k, (i, t) in enumerate(ODD)]
    return documents(spark, rows, extra)


def words(text, fold=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if fold else text)


def shingles(text):
    w = words(text, fold=True)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
