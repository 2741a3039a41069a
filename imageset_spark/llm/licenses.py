"""License scan: MinHash bands retrieve templates, exact containment verifies (DataFrame functions only).

A template of ``m`` shingles (five words) is looked for in windows of ``2m``
shingles that start every ``m`` shingles, so each occurrence lies whole in
some window. A window that holds all of a template has a Jaccard similarity of
1/2 to it, and one that holds three quarters of it 1/3 at least; with ``BANDS``
bands of one row each, a window of 1/3 meets its template in some band with
probability 1 - (2/3)**32 > 0.999997. A match is exact: three quarters or more
of the template's different shingles lie in the window.

With one row per band, a window can only meet a template if it holds one of
the template's own band minima. Texts and windows without any are left out
before their bands are computed, which changes no result.

The template library is a parameter, kept on the driver and broadcast with the
plan: ``MAX_TEMPLATES`` bounds it.

Defined results: null and empty texts, and texts of fewer than five words, match
nothing; repeated rows get the same result; empty tables give empty results; an
empty library matches nothing.
"""

from pyspark.sql import functions as F

from .rows import left_join, let, text_key, text_of

SHINGLE = 5
BANDS = 32
CONTAINED = 0.75
MAX_TEMPLATES = 10_000
WORD = r"[^\s\p{Punct}]+"

#: Public license notices.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                "the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
)


def shingles(text_col):
    """Hashes of the five-word shingles of a text, in order."""
    words = F.regexp_extract_all(F.lower(text_of(text_col)), F.lit(WORD), F.lit(0))
    return let(words, lambda w: F.when(
        F.size(w) >= SHINGLE,
        F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))),
    ).otherwise(F.array().cast("array<bigint>")))


def _seeds():
    return F.transform(F.sequence(F.lit(1), F.lit(BANDS)), lambda i: F.xxhash64(i))


def minima(hashes):
    """The band values of a shingle array: least shingle under each seed, and which one it is."""
    return F.transform(
        _seeds(), lambda s: F.array_min(F.transform(hashes, lambda x: F.struct(x.bitwiseXOR(s).alias("v"), x.alias("x"))))
    )


def template_table(spark, templates=TEMPLATES):
    """Templates with their distinct shingles and band values, one row each."""
    templates = list(templates)
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    frame = spark.createDataFrame(
        [(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string"
    )
    known = frame.select("template", "license", F.array_distinct(shingles("text")).alias("set"))
    return known.where("size(set) > 0").withColumn("m", F.size("set")).withColumn("bands", minima(F.col("set")))


def windows_of(m, own):
    """Windows of ``2m`` shingles, every ``m``, that hold one of the shingles ``own``."""
    starts = F.sequence(F.lit(0), F.size("h") - 1, F.lit(m))
    cut = F.transform(
        starts, lambda s: F.struct(F.lit(m).alias("m"), s.alias("start"), F.slice("h", s + 1, 2 * m).alias("win"))
    )
    return F.filter(cut, lambda w: F.arrays_overlap(w["win"], F.lit(own)))


def scan_licenses(docs, templates=TEMPLATES, id_col="doc_id", text_col="text"):
    """Matches: id, ``t`` (text key), template, license, first shingle of the window, shingles found."""
    spark = docs.sparkSession
    known = template_table(spark, templates)
    rows = known.collect()
    lengths = {}
    for r in rows:
        lengths.setdefault(r.m, set()).update(b.x for b in r.bands)
    every = sorted(set().union(*lengths.values())) if lengths else []
    table = spark.createDataFrame(
        [(r.template, r.license, r.m, list(r["set"])) for r in rows],
        "template int, license string, m int, set array<bigint>",
    )
    bands = spark.createDataFrame(
        [(r.template, r.m, i, b.v) for r in rows for i, b in enumerate(r.bands)],
        "template int, m int, band int, value bigint",
    )
    texts = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"), shingles(text_col).alias("h"))
    hit = F.arrays_overlap("h", F.lit(every)) if every else F.lit(False)
    found = texts.where(hit).dropDuplicates(["id", "t"])
    cuts = [windows_of(m, sorted(own)) for m, own in sorted(lengths.items())] or [
        F.array().cast("array<struct<m:int,start:int,win:array<bigint>>>")
    ]
    windows = found.select("id", "t", F.explode(F.concat(*cuts)).alias("w")).select("id", "t", "w.*")
    retrieved = (
        windows.select("*", F.posexplode(F.transform(minima(F.col("win")), lambda b: b["v"])).alias("band", "value"))
        .join(bands, ["m", "band", "value"])
        .groupBy("id", "t", "start", "template").agg(F.first("win").alias("win"))
    )
    n = F.size(F.array_intersect("win", "set"))
    return (
        retrieved.join(table, "template").withColumn("n_found", n)
        .where(F.col("n_found") >= CONTAINED * F.col("m"))
        .select("id", "t", "template", "license", "start", "n_found", "m")
    )


def license_report(docs, templates=TEMPLATES, id_col="doc_id", text_col="text"):
    """One row per document: number of licenses, their names, templates and first matching window."""
    found = scan_licenses(docs, templates, id_col, text_col).groupBy("id", "t").agg(
        F.sort_array(F.collect_set("license")).alias("names"),
        F.sort_array(F.collect_set("template")).alias("which"), F.min("start").cast("bigint").alias("first_window"),
    )
    keyed = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("t"))
    return left_join(keyed, found, ["id", "t"]).select(
        F.col("id").alias(id_col),
        F.coalesce(F.size("names"), F.lit(0)).cast("bigint").alias("n_licenses"),
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(F.col("which").cast("array<string>"), ","), F.lit("")).alias("templates"),
        "first_window",
    )
