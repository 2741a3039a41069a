"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

Texts are searched for three base kinds of secret and for one loose kind, long
tokens of mixed characters. Every candidate value is hashed, and its hash
counted over the corpus by distinct repositories and owners. A value that many
owners have is a widely copied example; one that few owners have and that does
not look like a placeholder is a live-looking credential. Loose candidates are
reported only if they are live-looking and overlap no base finding.

Positions come from the lengths of the pieces around the matches: splitting a
text by a pattern gives the gaps, and a running sum per text and kind over gaps
and matches gives starts. All that is shuffled is one short row per candidate.

Defined results: null text is empty and has no findings; a null owner or
repository counts as one of its own; repeated rows get the same findings; empty
tables give empty results; only the columns below are returned, so input
columns cannot clash.
"""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from imageset_spark.functions import stage

from .rows import left_join, text_key, text_of

#: Kind, pattern, group that is the value, least length of the value. A run of
#: at least n characters of one class is the same match as the whole run
#: filtered by length, so the last three bound the length in the pattern.
KINDS = (
    ("assign",
     r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("loose", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", 0, 20),
)
BASE_KINDS = 3
#: A value of more owners than this is a widely copied example.
FEW_OWNERS = 2
LEAST_CHARACTERS = 8
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|0000|1234"
#: A loose candidate holds a digit, a lower-case and an upper-case letter.
LOOSE_VALUE = r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"


def candidates(docs, text_col):
    """One row per match: the input's other columns, ``kind`` (number), ``value``, ``start``, ``end``."""
    keys = [c for c in docs.columns if c != text_col]
    text = text_of(text_col)
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(0)) for _, p, _, _ in KINDS]
    some = F.lit(False)
    for f in found:
        some = some | (F.size(f) > 0)
    kinds = F.array(*[
        F.struct(
            F.lit(k).alias("kind"),
            F.when(F.size(f) > 0, F.arrays_zip(
                F.split(text, p, -1).alias("gap"), f.alias("hit"),
                F.regexp_extract_all(text, F.lit(p), F.lit(g)).alias("value"),
            )).alias("hits"),
        )
        for k, ((_, p, g, _), f) in enumerate(zip(KINDS, found))
    ])
    hits = (
        docs.where(some).select(*keys, F.explode(kinds).alias("k"))
        .select(*keys, "k.kind", F.posexplode("k.hits").alias("place", "m"))
        .where("m.hit is not null")
        .select(*keys, "kind", "place", F.length("m.gap").cast("bigint").alias("gap"),
                F.length("m.hit").cast("bigint").alias("len"), F.col("m.value").alias("value"))
        .dropDuplicates([*keys, "kind", "place"])
    )
    line = W.partitionBy(*keys, "kind").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(line)
    least = F.element_at(F.array(*[F.lit(n) for *_, n in KINDS]), F.col("kind") + 1)
    return (
        hits.withColumn("end", end).withColumn("start", F.col("end") - F.col("len"))
        .where((F.length("value") >= least)
               & ((F.col("kind") < BASE_KINDS) | F.col("value").rlike(LOOSE_VALUE)))
        .drop("place", "gap", "len")
    )


def ownership(hits):
    """Repositories and owners of each candidate hash, counted in steps that each combine before shuffling."""
    return (
        hits.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n"))
        .groupBy("hash", "owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
        .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repos"), F.sum("n").alias("n_found"))
    )


def scan_secrets(docs, id_col="doc_id", text_col="text", owner_col="source", repo_cols=("source", "lang"),
                 few_owners=FEW_OWNERS):
    """All findings: id, ``t`` (text key), owner, repo, kind, start, end, hash, owner counts and ``class``.

    ``class`` is ``copied``, ``live`` or ``weak`` (few owners, but a placeholder).
    """
    rows = docs.select(
        F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(owner_col).alias("owner"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in repo_cols])).alias("repo"), F.col(text_col).alias("text"),
    )
    hits = candidates(rows, "text").withColumn("hash", F.sha2("value", 256))
    letters = F.size(F.array_distinct(F.split("value", "")))
    hits = hits.withColumn(
        "real", (letters >= LEAST_CHARACTERS) & ~F.col("value").rlike(PLACEHOLDER)
    ).drop("value")
    document = W.partitionBy("id", "t", "owner", "repo").orderBy("start", "kind")
    base = F.col("kind") < BASE_KINDS
    earlier = F.max(F.when(base, F.col("end"))).over(document.rowsBetween(W.unboundedPreceding, 0))
    later = F.min(F.when(base, F.col("start"))).over(document.rowsBetween(0, W.unboundedFollowing))
    inside = ~base & (F.coalesce(earlier > F.col("start"), F.lit(False))
                      | F.coalesce(later < F.col("end"), F.lit(False)))
    hits = stage(hits.withColumn("inside", inside).where("not inside").drop("inside"), "secret-hits")
    counts = stage(ownership(hits), "secret-owners")
    kind = (
        F.when(F.col("n_owners") > few_owners, "copied").when(F.col("real"), "live").otherwise("weak")
    )
    return (
        hits.join(counts, "hash").withColumn("class", kind).drop("real")
        .where((F.col("kind") < BASE_KINDS) | (F.col("class") == "live"))
        .withColumn("kind", F.element_at(F.array(*[F.lit(k) for k, *_ in KINDS]), F.col("kind") + 1))
    )


def secret_report(docs, id_col="doc_id", text_col="text", owner_col="source", repo_cols=("source", "lang"),
                  few_owners=FEW_OWNERS):
    """One row per document: counts and spans of its findings."""
    order = F.array_position(F.array(*[F.lit(k) for k, *_ in KINDS]), F.col("kind"))
    span = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    entry = F.struct("start", order.alias("k"), span.alias("span"))
    found = scan_secrets(docs, id_col, text_col, owner_col, repo_cols, few_owners)
    base = F.col("kind") != KINDS[BASE_KINDS][0]

    def joined(entries):
        return F.array_join(F.transform(F.sort_array(entries), lambda e: e["span"]), ",")

    per_doc = found.groupBy("id", "t", "owner", "repo").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k, *_ in KINDS],
        F.count_if(F.col("class") == "live").alias("n_live"),
        F.count_if(F.col("class") == "copied").alias("n_copied"),
        joined(F.collect_list(F.when(base, entry))).alias("base"),
        joined(F.collect_list(entry)).alias("spans"),
    )
    keyed = docs.select(
        F.col(id_col).alias("id"), text_key(text_col).alias("t"), F.col(owner_col).alias("owner"),
        F.to_json(F.array(*[F.col(c).cast("string") for c in repo_cols])).alias("repo"),
    )
    return left_join(keyed, per_doc, ["id", "t", "owner", "repo"]).select(
        F.col("id").alias(id_col),
        *[F.coalesce(f"n_{k}", F.lit(0).cast("bigint")).alias(f"n_{k}") for k, *_ in KINDS[:BASE_KINDS]],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_loose", "n_live", "n_copied")],
    )
