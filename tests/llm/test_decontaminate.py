import random

import pyarrow as pa
from pyspark.sql import functions as F
from samples import clashing, documents, odd_documents, prose

from imageset_spark.llm import decontaminate as D
from imageset_spark.llm.text import Chunk, chunks

ITEMS = [
    (0, "A train travels 120 km in 3 hours from Paris to the coast. How fast does the train travel on average?"),
    (1, "If Maria buys 7 apples and Peter buys 12 apples then Maria pays 14 dollars and Peter pays 24 dollars in total."),
    (2, prose(40, 501)),
    (3, "only four words here"),
    (4, "12 13 14 15 16 17 18 19"),
    (5, None),
]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id bigint, text string")


def found(spark, texts, items=ITEMS):
    docs = documents(spark, list(enumerate(texts)))
    return {r.doc_id: (r["items"], r.reparameterised) for r in D.leak_report(docs, benchmark(spark, items)).collect()}


def around(text, seed):
    return prose(60, seed) + " " + text + "\n" + prose(60, seed + 1)


def test_templates_type_numbers_units_and_names():
    def typed(text):
        _, data, offsets = next(chunks(pa.array([text])))
        return D.template_windows(Chunk(data, offsets), D._unit_hashes())

    a, b = "we saw Anna run 12 km in Oslo on one day", "we saw Bert run 7 hours in Rome on one day"
    (_, ha, pa_, sa, _), (_, hb, _, sb, _) = typed(a), typed(b)
    assert ha.tolist() == hb.tolist() and pa_.tolist() == [0, 1, 2, 3, 4, 5, 6]
    assert (sa != sb).any() and ((sa == 0) == (sb == 0)).all()
    # "Run" opens a sentence, so it is a plain word.
    assert typed("it stops. Run far from here now")[1].tolist() == typed("it stops, run far from here now")[1].tolist()


def test_copies_are_found_and_clean_texts_left(spark):
    texts = [around(t, 10 * i) for i, (_, t) in enumerate(ITEMS[:4])]
    texts += [ITEMS[2][1].upper(), ITEMS[2][1].replace(" ", "\n").replace(".", " ."), prose(500, 77), around("5 6 7 8 9", 3)]
    got = found(spark, texts)
    assert [got[i][0] for i in range(6)] == ["0", "1", "2", "3", "2", "2"]
    assert got[6] == ("", False) and got[7] == ("", False)
    assert found(spark, ["Only four words here!"])[0][0] == "3"


def test_other_values_count_only_if_consistent(spark):
    same = ITEMS[1][1].replace("Maria", "Lena").replace("Peter", "Omar").replace("7", "9").replace("12", "5")
    mixed = ITEMS[1][1].replace("Maria buys", "Lena buys").replace("Peter pays", "Kurt pays").replace("7 apples", "24 apples")
    swapped = ITEMS[0][1].replace("120 km", "90 miles").replace("3 hours", "2 days").replace("Paris", "Rome")
    got = found(spark, [around(same, 1), around(mixed, 2), around(swapped, 3), around(ITEMS[1][1], 4)])
    assert got[0] == ("1", True) and got[2] == ("0", True) and got[3] == ("1", False)
    assert got[1][0] == ""


def test_partial_copies_follow_the_share(spark):
    w = ITEMS[2][1].split()
    got = found(spark, [around(" ".join(w[:36]), 1), around(" ".join(w[:20]), 2), around(" ".join(w[:20] + ["zz"] + w[20:]), 3)])
    assert [got[i][0] for i in range(3)] == ["2", "", "2"]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    out = D.leak_report(docs, benchmark(spark)).collect()
    assert len(out) == docs.count() and not any(r.contaminated for r in out)
    kept = D.drop_leaks(docs, clashing(benchmark(spark)))
    assert kept.columns == docs.columns and kept.count() == docs.count()
    none = documents(spark, [])
    assert D.leak_report(clashing(none), benchmark(spark)).collect() == []
    assert D.drop_leaks(docs, benchmark(spark, [])).count() == docs.count()
    twice = [(1, around(ITEMS[2][1], 5))] * 2 + [(None, around(ITEMS[2][1], 6)), (2, prose(10_000, 8) + ITEMS[2][1])]
    items = ITEMS + [ITEMS[2], (2, prose(30, 44))]
    got = D.leak_report(documents(spark, twice), benchmark(spark, items)).collect()
    assert [r["items"] for r in got] == ["2"] * 4
    assert D.drop_leaks(documents(spark, twice), benchmark(spark)).collect() == []


def test_names_that_open_sentences_and_number_words_are_slots(spark):
    item = "Alice has 5 apples. Bob has three apples. How many apples do they have together?"
    other = "Carol has 7 apples. Dan has eight apples. How many apples do they have together?"
    inside = "we read that Carol has 7 apples and more. " + prose(9, 4)
    got = found(spark, [around(other, 1), "so " + other, other.replace("eight", "8"), inside, around(item, 2)], [(0, item)])
    assert [got[i] for i in range(5)] == [("0", True)] * 3 + [("", False), ("0", False)]


def test_only_inconsistent_windows_are_discarded(spark):
    # Two values become one; and one value of a long item becomes two.
    short = "Alice has 5 apples and Bob has 3 apples. How many apples do they have together?"
    long = "we count 3 pears at noon " + prose(40, 601) + " we count 3 plums later on " + prose(9, 602)
    texts = [around(short.replace("5", "4").replace("3", "4"), 1), around(long.replace("3 pears", "8 pears"), 2)]
    got = found(spark, texts, [(0, short), (1, long)])
    assert [got[i] for i in range(2)] == [("0", True), ("1", True)]


def test_short_and_slot_heavy_items_are_found_inside_texts(spark):
    items = ["Solve x plus y", "Compute 12 + 7 * 3 - 4 = 37 now", "Alice Bob Carol Dan Eve Frank Grace", "12 13 14 15 16 17 18 19",
             "Paris", "two words"]
    texts = [around(t, 20 * i) for i, t in enumerate(items)] + [
        around("Compute 13 + 7 * 3 - 4 = 38 now", 1), around("Alice Bob Carol Dan Ida Frank Grace", 2), "Paris.", "two",
        around("solve x\nplus\ty", 3), around("solve x minus y", 4),
    ]
    got = found(spark, texts, list(enumerate(items)))
    assert [got[i][0] for i in range(len(texts))] == ["0", "1", "2", "3", "", "5", "", "", "4", "", "0", ""]
    assert not any(changed for _, changed in got.values())


def test_other_values_in_four_languages(spark):
    items = [
        "Anna fährt in zwei Stunden mit dem Rad 24 Kilometer weit und ruht dann noch drei Minuten. Wie schnell fährt sie?",
        "Le train roule pendant trois heures et parcourt 240 kilomètres avant de voir Émile. Quelle est sa vitesse moyenne?",
        "Hoy compra María siete libros y paga 35 euros por todos ellos. Cuánto cuesta entonces cada uno de los libros?",
        "A boat with Tom sails for five hours and covers 60 miles before it stops. How fast does it sail?",
    ]
    others = [
        "Berta fährt in fünf Stunden mit dem Rad 70 Kilometer weit und ruht dann noch neun Minuten. Wie schnell fährt sie?",
        "Le train roule pendant 4 heures et parcourt 300 kilomètres avant de voir Zoé. Quelle est sa vitesse moyenne?",
        "Hoy compra Íñigo nueve libros y paga 81 dólares por todos ellos. Cuánto cuesta entonces cada uno de los libros?",
        "A boat with Sue sails for six hours and covers 90 km before it stops. How fast does it sail?",
    ]
    got = found(spark, [around(t, 30 * i) for i, t in enumerate(others)], list(enumerate(items)))
    assert [got[i] for i in range(4)] == [(str(i), True) for i in range(4)]


def test_a_stock_phrase_of_many_documents_and_items_pairs_nothing(spark):
    phrase = "answer the following question in as few words as you can please"
    items = [(i, f"{phrase} {prose(12, 7000 + i)}") for i in range(100)]
    docs = documents(spark, [(i, f"{prose(30, i)} {phrase} {prose(30, 5000 + i)}") for i in range(1000)]
                     + [(1000 + i, around(items[i][1], 9000 + i)) for i in range(5)])
    texts = D._windows_frame(docs.select(F.col("doc_id").alias("id"), F.lit(0).alias("t"), "text"), "text", None, ())
    known = D._windows_frame(benchmark(spark, items).select(F.col("item_id").alias("item"), F.lit(0).alias("it"), "text"),
                             "text", None, "items").withColumn("w", F.col("wh"))
    size = known.groupBy("item", "it").agg(F.count_distinct("w").alias("n"))
    held = texts.select("id", "t", "wh").distinct()
    rare = D._rarest(held, known.join(size, ["item", "it"]).select("item", "it", "wh", "w", "n").distinct(), 0.75)
    assert held.join(rare, "wh").select("id", "item").distinct().count() == 5
    out = D.leak_report(docs, benchmark(spark, items)).where("contaminated").collect()
    assert sorted((r.doc_id, r["items"]) for r in out) == [(1000 + i, str(i)) for i in range(5)]


def matches(text, item):
    """Whether a text holds three quarters of an item's untyped windows, a window at a time."""
    fold = lambda t: ["".join(c for c in w if c.isalnum()) for w in t.lower().split()]
    a, b = fold(text), fold(item)
    k = min(5, len(b))
    held = {tuple(a[i : i + k]) for i in range(len(a) - k + 1)}
    wanted = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)}
    return len(wanted & held) >= 0.75 * len(wanted)


def test_plain_items_match_the_model(spark):
    rng = random.Random(5)
    items = [(i, prose(rng.randrange(2, 30), 300 + i).lower().replace("\n", " ")) for i in range(25)]
    texts = []
    for i in range(120):
        w = items[i % 25][1].split()
        a, b = sorted((rng.randrange(len(w) + 1), rng.randrange(len(w) + 1)))
        part = w if i % 3 == 0 else w[a:b] if i % 3 == 1 else w[:a] + ["zz"] + w[a:]
        texts.append(prose(20, i).lower() + " " + " ".join(part) + " " + prose(20, 200 + i).lower())
    got = found(spark, texts, items)
    for i, text in enumerate(texts):
        assert got[i][0] == ",".join(str(k) for k in sorted(k for k, t in items if matches(text, t))), (i, text)
