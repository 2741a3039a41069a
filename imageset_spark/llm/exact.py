"""Exact deduplication by 128-bit content hashes, with bytes compared.

Every row becomes a narrow one: id, MD5 of its normalised text (A-Z read as a-z)
and a number of its own. Rows are grouped by hash; the row with the smallest
(or largest) id stays. Texts of rows whose hash occurs twice or more are then
grouped once more by their bytes: copies within a task are counted before
anything is moved, so a large group of copies costs one row a task. Where bytes
differ under one hash, those rows are grouped by their texts in place of the hash.

Only texts that may be copies are moved: a bitmap of a fixed size, filled with the
hashes of the groups, is broadcast and keeps out the others. It never loses a
group; the join and the comparison behind it are exact.

Defined results: null text equals empty text, and all of these rows are one group; a
row without id stays only if no row of its group has one; rows equal in text
and id are copies like any others, one of them stays; an empty table gives an empty
result; input columns named like output columns are replaced by these.
"""

from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .rows import fresh, left_join, may_be_among, text_of

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded(text_col):
    """The text with A-Z read as a-z and nothing else changed; null is empty."""
    return F.translate(text_of(text_col), _UPPER, _UPPER.lower())


def md5_digest(text):
    """128-bit hash of a text."""
    return F.unhex(F.md5(text))


def _collided(texts, groups):
    """Digests under which texts of different bytes lie."""
    copies = may_be_among(texts.select("digest", "norm"), groups, "digest")
    different = copies.groupBy("digest", "norm").agg(F.lit(1).alias("one"))
    return different.groupBy("digest").agg(F.sum("one").alias("texts")).where("texts > 1").select("digest")


def _groups(rows, by, keep):
    """Groups of two or more rows: size, id and number of the row that stays."""
    if keep == "largest":
        best = F.max(F.struct(F.col("id").isNotNull().alias("named"), "id", "raw", "row"))
    else:
        best = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "raw", "row"))
    found = rows.groupBy(*by).agg(F.count("*").alias("size"), best.alias("best")).where("size > 1")
    return stage(found.select(*by, "size", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row")),
                 "copy-groups")


def _judged(rows, groups, by):
    """Every row with its group; a row outside all groups is its own."""
    alone = F.col("size").isNull()
    return rows.join(groups, by, "left").select(
        "id", "raw", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), "sha",
    )


def _report(docs, keep, id_col, text_col, digest):
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    texts = docs.select(
        F.col(id_col).alias("id"), folded(text_col).alias("norm"), F.xxhash64(text_of(text_col)).alias("raw")
    ).withColumn("digest", digest(F.col("norm")))
    narrow = ["id", "raw", "digest", F.sha2("norm", 256).alias("sha")]
    own = F.monotonically_increasing_id().alias("row")
    rows = stage(texts.select(*narrow, own), "content-hashes")
    groups = _groups(rows, ["digest"], keep)
    collided = stage(_collided(texts, groups), "collided-hashes")
    if collided.isEmpty():
        return _judged(rows, groups, ["digest"])
    # Different texts of one hash: by their texts. All other rows stay with the hash.
    apart = stage(texts.join(collided, "digest", "left_semi").select(*narrow, "norm", own), "collided-texts")
    by = ["digest", "norm"]
    return _judged(rows.join(collided, "digest", "left_anti"), groups, ["digest"]).unionByName(
        _judged(apart, _groups(apart, by, keep), by)
    )


def exact_duplicates(docs, keep="smallest", id_col="doc_id", text_col="text", digest=md5_digest):
    """One row for each row of ``docs``: id, ``keep_id`` (id of the row that stays),
    ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.

    ``digest`` turns a text column into the hash to group by.
    """
    return _report(docs, keep, id_col, text_col, digest).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_duplicates(docs, keep="smallest", id_col="doc_id", text_col="text", digest=md5_digest):
    """The rows of ``docs`` that stay, one of each group, as they are."""
    name, raw, sha, kept, n = fresh(docs, "_name", "_raw", "_sha", "_kept", "_n")
    verdict = _report(docs, keep, id_col, text_col, digest).groupBy("id", "raw", "sha").agg(
        F.bool_or("kept").alias(kept), F.count("*").alias(n)
    )
    # Most rows are their own group and are in no verdict that matters.
    special = stage(verdict.where(~F.col(kept) | (F.col(n) > 1)).select(
        F.col("id").alias(name), F.col("raw").alias(raw), F.col("sha").alias(sha), kept, n
    ), "copy-verdicts")
    keyed = docs.withColumns({
        name: F.col(id_col), raw: F.xxhash64(text_of(text_col)), sha: F.sha2(folded(text_col), 256)
    })
    joined = left_join(keyed, special, [name, raw, sha]).where(F.coalesce(kept, F.lit(True)))
    single = joined.where(F.col(n).isNull())
    # Rows that repeat id and text: one of them.
    repeated = joined.where(F.col(n).isNotNull()).dropDuplicates([name, raw, sha])
    return single.unionByName(repeated).select(*docs.columns)
