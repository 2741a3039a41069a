"""Benchmark decontamination by canonical templates.

Words are compared by their letters and digits, in lower case. A word with a
digit and a number word become a number slot ("three" holds the value of "3"),
a unit behind a number a unit slot, and a capitalised word inside a sentence a
name slot. Windows of five template words are hashed and joined to those of the
benchmark. A document is contaminated with an item if it holds three quarters or
more of the item's different windows, each with consistent slots: within an
alignment a value of the item stands for one value of the document among slots of
a kind (the one with the most window slots), and windows with another are left
out, not the alignment. Two values may become the same. So copies are caught as
well as questions with other numbers and names.

Only windows with two or more plain words count, as a row of numbers says
nothing about a template. Items that templates cannot show are found as they are:
items of two to four words by a window of their own length anywhere in a text, items of
five or more words without a counting window by their untyped windows of five words.
A single word matches only a text that consists of it. A capitalised word that opens a sentence may be a name or not, so on both
sides its windows are made with it as a plain word and as a name; of several such
words in a window, with every choice. The window counts if it does with all of them
plain.

Documents are read once. A bitmap of the benchmark's windows, ``BITMAP_BITS``
long whatever the benchmark's size, drops nearly all windows where they are
made; the joins that follow are exact. Of ``n`` windows three quarters must be
found, so a document holds at least one of any ``n - ceil(3n/4) + 1``: documents meet
an item through its rarest windows in the corpus, and a phrase that many documents
and many items share pairs nothing. Only pairs that hold enough distinct windows are
aligned.

Defined results: null and empty texts and items match nothing; a text of fewer than
five words is one window as well; repeated
documents get the same result; repeated item ids with different texts are told
apart inside and reported once; empty tables match nothing.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .rows import bound_batches, fresh, left_join, text_key
from .text import FOLDED_VALUES, PLACES, Chunk, chunks, mix, powers, series, windows

WINDOW = 5
LEAST_PLAIN = 2
CONTAINED = 0.75
BITMAP_BITS = 1 << 23
#: Units as they are written behind numbers, in four languages.
UNITS = {
    "any": "kg g mg t km m cm mm ml l s h min kmh hz khz mhz w kw v a j kj cal kcal b kb mb gb tb euro euros",
    "en": "percent lb lbs oz ton tons mi mile miles ft feet foot inch inches yard yards meter meters metre metres "
    "kilometer kilometers litre litres liter liters gallon gallons sec second seconds minute minutes hr hour hours day "
    "days week weeks month months year years dollar dollars cent cents pound pounds degree degrees mph",
    "de": "prozent tonne tonnen meile meilen kilometer sekunde sekunden minuten stunde stunden tag tage tagen woche "
    "wochen monat monate monaten jahr jahre jahren grad pfund",
    "fr": "pour-cent tonnes mètre mètres kilomètre kilomètres seconde secondes heure heures jour jours semaine semaines "
    "mois an ans année années degré degrés livres",
    "es": "toneladas metro metros kilómetro kilómetros litro litros segundo segundos minuto minutos hora horas día días "
    "semana semanas mes meses año años grado grados dólares libras",
}
#: Words for whole numbers from zero on, and the tens from twenty on, as they are read here without
#: hyphens; "-" stands for a word that is also an article or a common word of another of the languages.
COUNTING = {
    "en": "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
    "seventeen eighteen nineteen",
    "de": "null - zwei drei vier fünf sechs sieben acht neun zehn - zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn "
    "achtzehn neunzehn",
    "fr": "zéro - deux trois quatre cinq six sept huit neuf dix onze douze treize quatorze quinze seize dixsept dixhuit "
    "dixneuf",
    "es": "cero - dos tres cuatro cinco seis siete ocho nueve diez - doce trece catorce quince dieciséis diecisiete "
    "dieciocho diecinueve",
}
TENS = {
    "en": "twenty thirty forty fifty sixty seventy eighty ninety",
    "de": "zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig",
    "fr": "vingt trente quarante cinquante soixante",
    "es": "veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa",
}
NUMBER_WORDS = {"dozen": 12, "hundred": 100, "thousand": 1000, "million": 10**6, "billion": 10**9, "hundert": 100,
                "tausend": 1000, "mille": 1000, "cien": 100, "mil": 1000}
for _language, _said in COUNTING.items():
    NUMBER_WORDS |= {w: n for n, w in enumerate(_said.split()) if w != "-"}
    NUMBER_WORDS |= {w: 10 * n for n, w in enumerate(TENS[_language].split(), 2)}
for _tens, _ten in zip(TENS["en"].split(), range(20, 100, 10)):
    NUMBER_WORDS |= {_tens + w: _ten + n for n, w in enumerate(COUNTING["en"].split()[1:10], 1)}
_U = np.uint64
NUMBER, NAME, UNIT, EXACT = series(4, 11)
SOLID = np.zeros(256, bool)
SOLID[48:58] = SOLID[65:91] = SOLID[97:123] = True
SOLID[128:] = True
IS_DIGIT, IS_UPPER, IS_LOWER = (np.zeros(256, bool) for _ in range(3))
IS_DIGIT[48:58] = IS_UPPER[65:91] = IS_LOWER[97:123] = True
IS_LOWER[128:] = True
#: Capitals among the characters of two bytes (Latin, Greek, Cyrillic and others), by code point.
WIDE_UPPER = np.array([chr(c).isupper() for c in range(0x800)])
ENDS = np.zeros(256, bool)
ENDS[list(b".!?:")] = True

WINDOW_COLUMNS = "wh bigint, pos bigint, slots array<bigint>, exact int"


def _running(mask):
    return np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))


def _capitals(data):
    """Marks of the first bytes of capitals, and of the bytes of other letters."""
    follower = np.append(data[1:], np.uint8(0))[: len(data)]
    wide = (data >= 0xC2) & (data < 0xE0) & (follower & 0xC0 == 0x80)
    wide &= WIDE_UPPER[(data & 0x1F).astype(np.int64) << 6 | (follower & 0x3F)]
    small = IS_LOWER[data] & ~wide
    small[1:] &= ~wide[:-1]
    return IS_UPPER[data] | wide, small


def words(chunk):
    """Text, hash, and the three slot tests of the words that hold a letter or digit."""
    data, start, end = chunk.data, chunk.start, chunk.end
    solid = SOLID[data]
    count = _running(solid)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(np.where(solid, FOLDED_VALUES[data] * up[count[:-1]], _U(0)), out=total[1:])
    n = count[end] - count[start]
    hashes = mix((total[end] - total[start]) * down[count[start]] + n.astype(_U))
    upper, lower = _capitals(data)
    digits, uppers, lowers, breaks = (_running(m) for m in (IS_DIGIT[data], upper, lower, data == 10))
    number = digits[end] > digits[start]
    opens = np.ones(len(start), bool)
    opens[1:] = (chunk.row[1:] != chunk.row[:-1]) | ENDS[data[end[:-1] - 1]] | (breaks[start[1:]] > breaks[end[:-1]])
    head = start + np.argmax(SOLID[data[np.minimum(start[:, None] + np.arange(3), len(data) - 1)]], axis=1) \
        if len(start) else start
    capital = upper[head] & (uppers[end] - uppers[start] == 1) & (lowers[end] > lowers[start])
    keep = n > 0
    return chunk.row[keep], hashes[keep], number[keep], (capital & ~number)[keep], opens[keep]


def _word_hashes(texts):
    _, data, offsets = next(chunks(pa.array(texts)))
    return words(Chunk(data, offsets))[1]


def _unit_hashes():
    return np.unique(_word_hashes(" ".join(UNITS.values()).split()))


def _number_hashes():
    """Hashes of the number words in order, and of their digits."""
    said = _word_hashes(list(NUMBER_WORDS))
    order = np.argsort(said)
    return said[order], _word_hashes([str(n) for n in NUMBER_WORDS.values()])[order]


def template_windows(chunk, unit_hashes, variants=False, keep_hashes=None, exact=()):
    """(text, window hash, position, slot values, length if untyped else 0) of the windows that count.

    With ``variants`` also those with words that open a sentence as names;
    ``keep_hashes`` filters hashes. ``exact`` gives the lengths of the untyped windows
    to add: numbers, or ``"items"`` for those that the texts need as items.
    """
    row, value, number, capital, opens = words(chunk)
    said, digits = _number_hashes()
    place = np.minimum(np.searchsorted(said, value), len(said) - 1)
    spoken = said[place] == value
    value = np.where(spoken, digits[place], value)
    number, capital = number | spoken, capital & ~spoken
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    opens = opens | first
    unit = np.zeros(len(row), bool)
    unit[1:] = number[:-1] & ~first[1:] & np.isin(value[1:], unit_hashes) & ~number[1:]
    name = capital & ~opens & ~unit
    either = capital & opens
    slot = number | name | unit
    kind = np.where(number, NUMBER, np.where(unit, UNIT, NAME))
    template = np.where(slot, kind, value)
    # Values of different kinds of slots are never equal.
    held = np.where(slot, value ^ kind, _U(0))
    hashes, at = windows(template, row, WINDOW)
    plain = _running(~slot)
    keep = plain[at + WINDOW] - plain[at] >= LEAST_PLAIN
    hashes, at = hashes[keep], at[keep]
    begins = np.flatnonzero(first)
    count = np.diff(np.concatenate((begins, [len(row)])))
    steps = np.arange(WINDOW)
    out = []

    def add(hashes, at, length, names, untyped=0):
        """Windows of ``length`` words, of which those of the bits ``names`` are names."""
        if keep_hashes is not None:
            some = keep_hashes(hashes)
            hashes, at = hashes[some], at[some]
        pos = at - begins[np.searchsorted(begins, at, "right") - 1] if len(at) else at
        words_at = np.minimum(at[:, None] + steps, max(len(row) - 1, 0))
        slots = np.where((names >> steps) & 1 > 0, value[words_at] ^ NAME, held[words_at])
        slots[:, length:] = 0
        out.append((row[at], hashes, pos, slots, np.full(len(at), untyped, np.int32)))

    def add_variants(at, length):
        bits = sum((either[at + j].astype(np.int64) << j for j in range(length)), np.zeros(len(at), np.int64))
        at, bits = at[bits > 0], bits[bits > 0]
        for names in range(1, 1 << length) if len(at) else ():
            some = at[bits & names == names]
            if len(some):
                total = np.full(len(some), _U(length if length < WINDOW else WINDOW * int(PLACES[15]) & ((1 << 64) - 1)))
                for j in range(length):
                    total += (np.full(len(some), NAME) if names >> j & 1 else template[some + j]) * PLACES[j]
                add(mix(total), some, length, names)

    add(hashes, at, WINDOW, 0)
    if variants:
        add_variants(at, WINDOW)
    # Texts of fewer words: all of them are one window.
    for i in np.flatnonzero(count < WINDOW) if len(begins) else ():
        a, n = begins[i], int(count[i])
        if plain[a + n] - plain[a] >= min(n, LEAST_PLAIN):
            total = (template[a : a + n] * PLACES[:n]).sum(dtype=_U, keepdims=True) + np.array([n], _U)
            add(mix(total), np.array([a]), n, 0)
            if variants:
                add_variants(np.array([a]), n)
    for length in range(2, WINDOW + 1) if exact == "items" else exact:
        same, at = windows(value ^ EXACT, row, length)
        if exact == "items":
            number_of_words = np.bincount(row, minlength=chunk.rows)[row[at]]
            needed = number_of_words == length
            if length == WINDOW:
                counted = np.unique(np.concatenate([part[0] for part in out]))
                needed = (number_of_words >= length) & ~np.isin(row[at], counted)
            same, at = same[needed], at[needed]
        add(same, at, 0, 0, length)
    return [np.concatenate(part) for part in zip(*out)]


def _windows_frame(rows, text_col, keep, exact):
    """Windows of the texts of ``rows``, with its other columns; ``keep`` filters hashes."""
    bound_batches(rows.sparkSession)
    others = [f for f in rows.schema.fields if f.name != text_col]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + [WINDOW_COLUMNS])

    def run(batches):
        unit_hashes = _unit_hashes()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            for begin, data, offsets in chunks(texts):
                chunk = Chunk(data, offsets)
                row, hashes, pos, slots, untyped = template_windows(chunk, unit_hashes, True, keep, exact)
                taken = pa.array(row + begin)
                columns = [batch.column(batch.schema.get_field_index(f.name)).take(taken) for f in others]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(row) + 1, dtype=np.int32) * WINDOW),
                    pa.array(np.ascontiguousarray(slots).reshape(-1).view(np.int64)),
                )
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(hashes.view(np.int64)), pa.array(pos.astype(np.int64)), lists, pa.array(untyped)],
                    [*[f.name for f in others], "wh", "pos", "slots", "exact"],
                )

    return rows.mapInArrow(run, schema)


def bitmap(benchmark_windows):
    """Bits of the windows' hashes: at most ``BITMAP_BITS / 64`` rows reach the driver."""
    bit = F.pmod("wh", F.lit(BITMAP_BITS))
    rows = (
        benchmark_windows.select(F.shiftright(bit, 6).alias("w"), F.expr(f"shiftleft(1L, int(pmod(wh, {BITMAP_BITS}) & 63))").alias("b"))
        .groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    )
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    for r in rows:
        out[r.w] = r.b
    return out.view(_U)


def _on_key(left, right, names):
    """Inner join on ``names``, null equal to null."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}" if c in names else c) for c in right.columns])
    on = F.lit(True)
    for name in names:
        on = on & left[name].eqNullSafe(renamed[f"__r_{name}"])
    return left.join(renamed, on).drop(*[f"__r_{c}" for c in names])


def _rarest(held, wanted, contained):
    """The windows of each item by which documents meet it: (wh, item, it).

    ``held`` has the distinct windows of each document, ``wanted`` those of each item,
    with their number ``w`` among the item's ``n``. A document with a share of
    ``contained`` of an item's windows lacks at most ``n - ceil(contained * n)``, so it
    holds one of any that are one more.
    """
    counts = held.groupBy("wh").agg(F.count("*").alias("c"))
    item = ["item", "it"]
    number = wanted.join(counts, "wh", "left").groupBy(*item, "w").agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.first("n").alias("n")
    )
    place = F.row_number().over(W.partitionBy(*item).orderBy("c", "w"))
    chosen = number.withColumn("place", place).where(
        F.col("place") <= F.col("n") - F.ceil(F.lit(contained) * F.col("n")) + 1
    ).select(*item, "w")
    return _on_key(chosen, wanted.select(*item, "w", "wh"), [*item, "w"]).select("wh", *item).distinct()


def find_leaks(docs, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
               contained=CONTAINED):
    """One row per contaminated (id, ``t``) and item: containment, and whether values were changed."""
    items = benchmark.select(
        F.col(item_col).alias("item"), text_key(item_text_col).alias("it"), F.col(item_text_col).alias("text")
    ).dropDuplicates(["item", "it"])
    known = stage(_windows_frame(items, "text", None, "items"), "benchmark-windows")
    bits = bitmap(known)
    # Lengths of the items found by untyped windows: four numbers at most.
    lengths = [r.exact for r in known.where("exact > 0").select("exact").distinct().collect()]

    def keep(hashes):
        at = hashes & _U(BITMAP_BITS - 1)
        return (bits[at >> _U(6)] >> (at & _U(63))) & _U(1) > 0

    texts = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(text_col).alias("text"))
    hits = stage(_windows_frame(texts, "text", keep, lengths), "window-hits").drop("exact").dropDuplicates(
        ["id", "t", "pos", "wh"]
    )
    # Window number: the variants of a window count as that window.
    first = known.groupBy("item", "it", "pos").agg(F.min("wh").alias("w"))
    numbered = known.join(first, ["item", "it", "pos"])
    size = numbered.groupBy("item", "it").agg(F.count_distinct("w").alias("n"))
    numbered = stage(numbered.join(size, ["item", "it"]).withColumnRenamed("pos", "ipos")
                     .withColumnRenamed("slots", "islots"), "item-windows")
    key = ["id", "t", "item", "it"]
    held = hits.select("id", "t", "wh").distinct()
    wanted = numbered.select("item", "it", "wh", "w", "n").distinct()
    rare = _rarest(held, wanted, contained)
    met = stage(held.join(rare, "wh").select(*key).distinct(), "leak-candidates")
    found = (
        _on_key(met, held, ["id", "t"]).join(wanted.select(*[F.col(c).alias(f"k_{c}") for c in ("item", "it", "wh")], "w", "n"),
                F.col("item").eqNullSafe(F.col("k_item")) & (F.col("it") == F.col("k_it")) & (F.col("wh") == F.col("k_wh")))
        .groupBy(*key, "w").agg(F.first("n").alias("n"))
        .groupBy(*key).agg(F.count("*").alias("found"), F.first("n").alias("n"))
    )
    pairs = stage(found.where(F.col("found") >= contained * F.col("n")).select(*key), "leak-pairs")
    aligned = _on_key(pairs, hits, ["id", "t"])
    items_of = numbered.select(*[F.col(c).alias(f"k_{c}") for c in ("item", "it", "wh")], "ipos", "islots", "w", "n")
    aligned = aligned.join(
        items_of, aligned["item"].eqNullSafe(items_of["k_item"]) & (aligned["it"] == items_of["k_it"])
        & (aligned["wh"] == items_of["k_wh"]),
    ).select(*key, (F.col("pos") - F.col("ipos")).alias("delta"), "ipos", "wh", "w", "n", F.explode_outer(
        F.filter(F.arrays_zip("islots", "slots"), lambda s: (s["islots"] != 0) | (s["slots"] != 0))
    ).alias("s")).select("*", F.col("s.islots").alias("a"), F.col("s.slots").alias("b")).drop("s")
    # A value of the item stands for the value of the document that most window slots give it.
    support = aligned.withColumn("support", F.count("*").over(W.partitionBy(*key, "delta", "a", "b")))
    chosen = F.max(F.struct("support", "b")).over(W.partitionBy(*key, "delta", "a"))["b"]
    changed = F.max(F.coalesce(F.col("a") != F.col("b"), F.lit(False))).over(W.partitionBy(*key, "delta"))
    judged = support.withColumns({"chosen": chosen, "changed": changed}).groupBy(*key, "delta", "ipos", "wh").agg(
        F.first("w").alias("w"), F.first("n").alias("n"), F.first("changed").alias("changed"),
        F.count_if(F.col("b") != F.col("chosen")).alias("other"),
    ).where("other = 0")
    per_delta = judged.groupBy(*key, "delta").agg(
        F.collect_set("w").alias("ws"), F.first("n").alias("n"), F.first("changed").alias("changed")
    )
    # Chance alignments of a few windows say nothing about the values of one that holds the item.
    whole = F.when(F.size("ws") >= contained * F.col("n"), F.col("changed"))
    return (
        per_delta.select(*key, "n", "changed", whole.alias("whole"), F.explode("ws").alias("w"))
        .groupBy(*key).agg(F.count_distinct("w").alias("found"), F.first("n").alias("n"),
                           F.coalesce(F.max("whole"), F.max("changed")).alias("changed"))
        .where(F.col("found") >= contained * F.col("n"))
        .select("id", "t", "item", (F.col("found") / F.col("n")).alias("contained"), "changed")
    )


def leak_report(docs, benchmark, id_col="doc_id", text_col="text", **options):
    """One row per document: the items it holds, and whether any has other values than the benchmark's."""
    leaks = find_leaks(docs, benchmark, id_col, text_col, **options).groupBy("id", "t").agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.max("changed").alias("changed"),
        F.max("contained").alias("contained"),
    )
    keyed = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"))
    return left_join(keyed, stage(leaks, "leaks"), ["id", "t"]).select(
        F.col("id").alias(id_col), F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce(F.array_join(F.col("items").cast("array<string>"), ","), F.lit("")).alias("items"),
        F.coalesce("changed", F.lit(False)).alias("reparameterised"),
        F.coalesce("contained", F.lit(0.0)).alias("contained"),
    )


def drop_leaks(docs, benchmark, id_col="doc_id", text_col="text", **options):
    """The documents that hold no benchmark item, with the columns they came with."""
    key, gone = fresh(docs, "_key", "_gone")
    leaks = find_leaks(docs, benchmark, id_col, text_col, **options).select(
        F.col("id").alias(id_col), F.col("t").alias(key), F.lit(True).alias(gone)
    ).distinct()
    joined = left_join(docs.withColumn(key, text_key(text_col)), stage(leaks, "leaks"), [id_col, key])
    return joined.where(F.col(gone).isNull()).select(*docs.columns)
