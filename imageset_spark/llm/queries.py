"""The registered queries of the subpackage, and their check SQL."""

from pyspark.sql import functions as F

from . import (
    classifier,
    decontaminate,
    exact,
    jaccard,
    licenses,
    merkle,
    mixing,
    quality,
    resampling,
    secrets,
    sharding,
    substrings,
    url_rules,
)

QUERIES = {}
ORACLES = {}

#: (action, host, path): the fixed rules of the url query.
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark, sf_dir, table, *columns):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


@query
def op2_sharding(spark, sf_dir):
    """Every document's shard and slot under the ``rows`` law."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    return sharding.shard_documents(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op7_url_filter(spark, sf_dir):
    """Verdict on every page's url under the fixed rules."""
    pages = read(spark, sf_dir, "pages", "page_id", "url")
    rules = url_rules.rule_table(spark, URL_RULES)
    return url_rules.judge_urls(pages, rules).drop("url")


ORACLES["op7_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
judged AS (
  SELECT host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) u JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, parts.host, parts.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN judged ON parts.host = judged.host AND parts.path = judged.path
"""


@query
def op8_mix_sources(spark, sf_dir):
    """Words the mixture takes of every document."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.take_words(docs).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


@query
def op5_quality_rules(spark, sf_dir):
    """Measures of every document, the base rule and the verdict of the compression bands."""
    judged = quality.judge_documents(read(spark, sf_dir, "documents", "doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "ratio", "n_chunks", "n_bad_chunks",
    )


@query
def op1_secret_scan(spark, sf_dir):
    """Secrets of every document, by kind, with spans and ownership classes."""
    return secrets.secret_report(read(spark, sf_dir, "documents", "doc_id", "text", "source", "lang"))


@query
def op9_license_scan(spark, sf_dir):
    """Licenses whose notices every document holds."""
    return licenses.license_report(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op3_decontamination(spark, sf_dir):
    """Benchmark items that every document holds, as they are or with other values."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.leak_report(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op10_quality_classifier(spark, sf_dir):
    """Quality score of every document, learnt from the labels that are not held out."""
    return classifier.score_documents(
        read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "labels", "doc_id", "quality")
    )


@query
def op6_substring_dedup(spark, sf_dir):
    """Passages of every document that repeat in other documents."""
    return substrings.passage_report(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_jaccard_join(spark, sf_dir):
    """Shingle count and near-duplicate component of every document."""
    return jaccard.jaccard_components(read(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_importance_resampling(spark, sf_dir):
    """Weight, score and draw rank of every document towards the benchmark's texts."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return resampling.resample(docs, read(spark, sf_dir, "benchmark", "text"))


#: CRC-32 of the bytes given as a list of numbers, in SQL: eight shifts a byte.
_CRC32 = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda c, b:
    list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""
_WORD_BYTES = """list_transform(range(0, octet_length(encode(word))), lambda i:
    ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)"""

ORACLES["op11_importance_resampling"] = rf"""
WITH texts AS (
  SELECT doc_id, 0 AS target, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark),
features AS (
  SELECT doc_id, target, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS word
  FROM texts),
vocabulary AS (
  SELECT word, {_CRC32.format(bytes=_WORD_BYTES)} % 10000 AS bucket FROM (SELECT DISTINCT word FROM features)),
counts AS (
  SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t
  FROM features JOIN vocabulary USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE)
           / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM counts),
weights AS (
  SELECT doc_id, count(*) AS n_features, (sum(gain)::BIGINT - (((sum(gain)::BIGINT % count(*)) + count(*)) % count(*)))
           // count(*) AS weight
  FROM features JOIN vocabulary USING (word) JOIN gains USING (bucket) WHERE target = 0 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT
           + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights w USING (doc_id)),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
         10 * count(*) OVER () // 100 AS number
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, place::BIGINT AS rank
FROM scored LEFT JOIN (SELECT * FROM ranked WHERE place <= number) USING (doc_id)
"""


@query
def op12_merkle_manifest(spark, sf_dir):
    """Leaf, proof and roots of every document; every third one is tampered with before its proof is folded."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = read(spark, sf_dir, "documents", *columns)
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(chosen, merkle.leaf_digest([*columns[:-1], lower]))
    found = merkle.proofs(merkle.build_manifest(docs, columns, changed=changed))
    folded = merkle.fold(F.coalesce("changed", "leaf"), F.col("siblings"))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        merkle.proof_digest(F.col("siblings")).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


_ID_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
_FIELD = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"

ORACLES["op12_merkle_manifest"] = rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS grp,
         sha256({" || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         CASE WHEN {_CRC32.format(bytes=_ID_BYTES)} % 3 = 0 THEN
           sha256({" || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))} ||
           {_FIELD.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS changed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
tree AS (
  SELECT grp, 0 AS level, place, leaf AS digest FROM placed
  UNION ALL
  SELECT grp, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM tree) WHERE n > 1 GROUP BY grp, level, place // 8),
height AS (SELECT grp, max(level) AS top FROM tree GROUP BY grp),
subroots AS (
  SELECT tree.grp, digest AS subroot, row_number() OVER (ORDER BY encode(tree.grp)) - 1 AS place
  FROM tree JOIN height ON tree.grp = height.grp AND level = top),
crown AS (
  SELECT 0 AS level, place, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place))
  FROM (SELECT *, count(*) OVER () AS n FROM crown) WHERE n > 1 GROUP BY level, place // 8),
crown_top AS (SELECT max(level) AS top FROM crown),
nodes AS (
  SELECT grp, level, place, digest FROM tree
  UNION ALL SELECT '', level, place, digest FROM crown),
steps AS (
  SELECT l.place AS own, l.grp AS of, t.grp, t.level AS step, t.level, l.place // (8 ** t.level)::BIGINT AS anc
  FROM placed l JOIN (SELECT DISTINCT grp, level FROM tree) t ON l.grp = t.grp JOIN height h ON h.grp = l.grp AND t.level < top
  UNION ALL
  SELECT l.place, l.grp, '', h.top + c.level, c.level, s.place // (8 ** c.level)::BIGINT
  FROM placed l JOIN height h ON h.grp = l.grp JOIN subroots s ON s.grp = l.grp
  JOIN (SELECT DISTINCT level FROM crown) c ON c.level < (SELECT top FROM crown_top)),
siblings AS (
  SELECT s.of, s.own, s.step,
         coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place < anc), '') AS l,
         coalesce(string_agg(n.digest, '' ORDER BY n.place) FILTER (n.place > anc), '') AS r
  FROM steps s JOIN nodes n ON n.grp = s.grp AND n.level = s.level AND n.place // 8 = anc // 8
  GROUP BY s.of, s.own, s.step),
folds AS (
  SELECT grp AS of, place AS own, 0 AS step, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.of, f.own, f.step + 1, sha256(l || digest || r)
  FROM folds f JOIN siblings s ON s.of = f.of AND s.own = f.own AND s.step = f.step),
proofs AS (SELECT of, own, string_agg(l || r, '' ORDER BY step) AS proof FROM siblings GROUP BY of, own),
ends AS (SELECT of, own, arg_max(digest, step) AS folded_root FROM folds GROUP BY of, own),
whole AS (SELECT digest AS root FROM crown JOIN crown_top ON level = top)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed CROSS JOIN whole JOIN subroots ON subroots.grp = placed.grp
LEFT JOIN proofs ON proofs.of = placed.grp AND proofs.own = placed.place
JOIN ends ON ends.of = placed.grp AND ends.own = placed.place
"""


@query
def op13_exact_dedup(spark, sf_dir):
    """Group of equal texts of every document; the largest id stays."""
    return exact.exact_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), keep="largest")


ORACLES["op13_exact_dedup"] = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY norm)
"""


# All pairs that share a shingle, and everything that can be reached by links.
ORACLES["op4_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS node, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT node, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM words),
sizes AS (SELECT node, doc_id, len(s) AS n FROM sets),
shingles AS (SELECT node, md5_number(unnest(s)) AS shingle FROM sets),
shared AS (
  SELECT x.node AS a, y.node AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.node < y.node
  GROUP BY x.node, y.node),
linked AS (
  SELECT a, b FROM shared JOIN sizes p ON p.node = a JOIN sizes q ON q.node = b
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
ends AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (
  SELECT node, node AS other FROM sizes
  UNION
  SELECT r.node, e.b FROM reached r JOIN ends e ON e.a = r.other)
SELECT s.doc_id, s.n AS n_shingles, min(o.doc_id) AS component_id
FROM sizes s JOIN reached r ON r.node = s.node JOIN sizes o ON o.node = r.other
GROUP BY s.node, s.doc_id, s.n
"""
