"""Check SQL for the registered queries, written for DuckDB on the raw tables.

Written from the rules, not from the Spark code: window functions and joins are
used freely here, because these statements only ever run on small data.
"""

SRC_LABELS = """
src_labels AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS patientId,
    CASE WHEN l_orderkey % 4 <> 0 AND l_orderkey % 79 <> 0 THEN NULL
         WHEN l_orderkey % 73 = 0 AND l_partkey % 2 = 0 THEN NULL
         WHEN l_orderkey % 61 = 0 THEN -1.0::DOUBLE
         WHEN l_orderkey % 59 = 0 THEN 1000.0::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 10.0::DOUBLE
         ELSE (l_partkey % 500)::DOUBLE END AS x,
    CASE WHEN l_orderkey % 4 <> 0 THEN NULL
         WHEN l_orderkey % 73 = 0 AND l_partkey % 2 = 0 THEN NULL
         WHEN l_orderkey % 53 = 0 THEN 'Infinity'::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 20.0::DOUBLE
         ELSE (l_suppkey % 400)::DOUBLE END AS y,
    CASE WHEN l_orderkey % 4 <> 0 THEN NULL
         WHEN l_orderkey % 73 = 0 AND l_partkey % 2 = 0 THEN NULL
         WHEN l_orderkey % 71 = 0 THEN NULL
         WHEN l_orderkey % 47 = 0 THEN 30.0::DOUBLE
         ELSE 50.0::DOUBLE + l_quantity END AS width,
    CASE WHEN l_orderkey % 4 <> 0 THEN NULL
         WHEN l_orderkey % 73 = 0 AND l_partkey % 2 = 0 THEN NULL
         WHEN l_orderkey % 67 = 0 THEN 0.0::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 40.0::DOUBLE
         ELSE 60.0::DOUBLE + l_quantity END AS height,
    CAST(CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN l_partkey % 2
         WHEN l_orderkey % 83 = 0 THEN 2 WHEN l_orderkey % 4 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS Target,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS row_seq
  FROM lineitem)"""

SRC_CLASSES = """
src_classes AS (
  SELECT CAST(k AS VARCHAR) AS patientId,
    CASE WHEN k % 37 = 0 THEN 'Unsupported' WHEN k % 4 = 0 THEN 'Lung Opacity'
         WHEN k % 4 = 1 THEN 'Normal' ELSE 'No Lung Opacity / Not Normal' END AS class
  FROM (SELECT o_orderkey AS k FROM orders
        UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0) t
  WHERE k % 43 <> 0
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR),
    CASE WHEN o_orderkey % 4 = 0 THEN 'Normal' ELSE 'Lung Opacity' END
  FROM orders WHERE o_orderkey % 41 = 0 AND o_orderkey % 43 <> 0)"""

SRC_HEADERS = """
src_headers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS sample_id, o_orderkey % 29 <> 0 AS readable,
    CASE WHEN o_orderkey % 23 = 0 THEN 3 ELSE 2 END AS ndim, 1024 AS width, 1024 AS height
  FROM orders WHERE o_orderkey % 31 <> 0)"""

# Mapping stage: one row per patient with labels, or with a class conflict.
VERDICT = f"""{SRC_LABELS},{SRC_CLASSES},
class_stats AS (
  SELECT patientId, count(DISTINCT class) AS n_classes, min(class) AS class
  FROM src_classes GROUP BY patientId),
label_stats AS (
  SELECT patientId, count(*) AS n_rows, count(DISTINCT Target) AS n_targets,
    min(Target) AS target,
    max(CASE WHEN x IS NOT NULL OR y IS NOT NULL OR width IS NOT NULL OR height IS NOT NULL
        THEN 1 ELSE 0 END) = 1 AS has_box_value,
    max(CASE WHEN x IS NULL AND y IS NULL AND width IS NULL AND height IS NULL
        THEN 1 ELSE 0 END) = 1 AS has_empty_row,
    max(CASE WHEN x IS NULL OR y IS NULL OR width IS NULL OR height IS NULL
        THEN 1 ELSE 0 END) = 1 AS has_partial_row,
    max(CASE WHEN width <= 0 OR height <= 0 THEN 1 ELSE 0 END) = 1 AS has_bad_size,
    max(CASE WHEN x < 0 OR y < 0 THEN 1 ELSE 0 END) = 1 AS has_bad_corner
  FROM src_labels GROUP BY patientId),
verdict AS (
  SELECT coalesce(l.patientId, c.patientId) AS sample_id, l.target,
    coalesce(l.n_rows, 0) AS n_rows, c.class AS raw_class,
    CASE WHEN coalesce(c.n_classes, 0) > 1 THEN 'conflicting_classes'
         WHEN coalesce(c.n_classes, 0) = 0 THEN 'missing_class'
         WHEN n_targets = 0 THEN 'missing_target'
         WHEN n_targets > 1 THEN 'conflicting_targets'
         WHEN l.target NOT IN (0, 1) THEN 'invalid_target'
         WHEN NOT ((c.class = 'Lung Opacity' AND l.target = 1)
                OR (c.class IN ('Normal', 'No Lung Opacity / Not Normal') AND l.target = 0))
           THEN 'class_target_mismatch'
         WHEN l.target = 0 AND has_box_value THEN 'unexpected_box_for_negative'
         WHEN l.target = 1 AND has_empty_row THEN 'missing_box_for_positive'
         WHEN l.target = 1 AND has_partial_row THEN 'incomplete_box'
         WHEN l.target = 1 AND has_bad_size THEN 'invalid_box_dimensions'
         WHEN l.target = 1 AND has_bad_corner THEN 'invalid_box_coordinates' END AS reason
  FROM label_stats l FULL OUTER JOIN class_stats c ON l.patientId = c.patientId
  WHERE l.patientId IS NOT NULL OR c.n_classes > 1),
mapped_images AS (
  SELECT sample_id, '/data/train/images/' || sample_id || '.dcm' AS image_path,
    CAST(target AS INTEGER) AS label, 'rsna_pneumonia_2018' AS source_dataset, raw_class
  FROM verdict WHERE reason IS NULL),
mapped_boxes AS (
  SELECT l.patientId AS sample_id, x, y, width, height, row_seq
  FROM src_labels l JOIN mapped_images i ON l.patientId = i.sample_id WHERE i.label = 1)"""

DIRECT = f"""{SRC_HEADERS},
in_images AS (
  SELECT CAST(k AS VARCHAR) AS sample_id, '/data/' || k || '.dcm' AS image_path,
    CASE WHEN k % 13 = 0 THEN 0 ELSE 1 END AS label, 'direct' AS source_dataset,
    'Lung Opacity' AS raw_class
  FROM (SELECT o_orderkey AS k FROM orders
        UNION ALL SELECT o_orderkey FROM orders WHERE o_orderkey % 19 = 0) t),
in_boxes AS (
  SELECT CASE WHEN l_orderkey % 17 = 0 THEN 'u' || l_orderkey
              ELSE CAST(l_orderkey AS VARCHAR) END AS sample_id,
    CASE WHEN l_orderkey % 59 = 0 AND l_linenumber % 2 = 1 THEN -1.0::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 10.0::DOUBLE ELSE (l_partkey % 500)::DOUBLE END AS x,
    CASE WHEN l_orderkey % 53 = 0 THEN 'Infinity'::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 20.0::DOUBLE ELSE (l_suppkey % 400)::DOUBLE END AS y,
    CASE WHEN l_orderkey % 59 = 0 AND l_linenumber % 2 <> 1 THEN 0.0::DOUBLE
         WHEN l_orderkey % 61 = 0 THEN 2000.0::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 30.0::DOUBLE ELSE 50.0::DOUBLE + l_quantity END AS width,
    CASE WHEN l_orderkey % 61 = 0 AND l_linenumber % 2 = 1 THEN 0.0::DOUBLE
         WHEN l_orderkey % 47 = 0 THEN 40.0::DOUBLE ELSE 60.0::DOUBLE + l_quantity END AS height,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS row_seq,
    dense_rank() OVER (ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS source_place
  FROM lineitem)"""

MAPPED = f"""{VERDICT},{SRC_HEADERS},
in_images AS (SELECT * FROM mapped_images),
in_boxes AS (SELECT * FROM mapped_boxes)"""

# Validation stage over in_images, in_boxes and src_headers.
CHECKED = """
id_counts AS (SELECT sample_id, count(*) AS copies FROM in_images GROUP BY sample_id),
image_checks AS (
  SELECT c.sample_id, i.label, h.width AS image_width, h.height AS image_height,
    CASE WHEN c.copies > 1 THEN 'duplicate_image_record'
         WHEN h.sample_id IS NULL THEN 'image_file_not_found'
         WHEN NOT h.readable THEN 'unreadable_dicom'
         WHEN h.ndim <> 2 OR h.width <= 0 OR h.height <= 0 THEN 'invalid_image_dimensions'
    END AS reason
  FROM id_counts c JOIN (SELECT DISTINCT sample_id, label FROM in_images) i USING (sample_id)
  LEFT JOIN src_headers h USING (sample_id)),
unique_boxes AS (
  SELECT sample_id, x, y, width, height, count(*) AS copies, min(row_seq) AS row_seq
  FROM in_boxes GROUP BY sample_id, x, y, width, height),
box_counts AS (SELECT sample_id, count(*) AS n_boxes FROM in_boxes GROUP BY sample_id),
unknown_refs AS (
  SELECT sample_id, x, y, width, height FROM unique_boxes
  WHERE sample_id NOT IN (SELECT sample_id FROM in_images)),
negatives AS (
  SELECT i.sample_id, b.n_boxes FROM image_checks i JOIN box_counts b USING (sample_id)
  WHERE i.reason IS NULL AND i.label = 0),
box_faults AS (
  SELECT b.sample_id, b.row_seq,
    CASE WHEN NOT (isfinite(x) AND isfinite(y) AND isfinite(width) AND isfinite(height))
           THEN 'non_finite_box'
         WHEN x < 0 OR y < 0 THEN 'invalid_box_coordinates'
         WHEN width <= 0 OR height <= 0 THEN 'invalid_box_dimensions'
         WHEN x + width > image_width OR y + height > image_height THEN 'box_outside_image'
    END AS reason
  FROM unique_boxes b JOIN image_checks i USING (sample_id)
  WHERE i.reason IS NULL AND i.label <> 0),
geometry AS (
  SELECT sample_id, reason FROM (
    SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY row_seq) AS place
    FROM box_faults WHERE reason IS NOT NULL) t WHERE place = 1),
good_ids AS (
  SELECT sample_id FROM image_checks WHERE reason IS NULL
  AND sample_id NOT IN (SELECT sample_id FROM negatives)
  AND sample_id NOT IN (SELECT sample_id FROM geometry)),
good_images AS (SELECT * FROM in_images WHERE sample_id IN (SELECT sample_id FROM good_ids)),
good_boxes AS (
  SELECT sample_id, x, y, width, height FROM unique_boxes
  WHERE sample_id IN (SELECT sample_id FROM good_ids)),
late_rejections AS (
  SELECT CAST(1 AS INTEGER) AS stage, sample_id, reason FROM image_checks WHERE reason IS NOT NULL
  UNION ALL SELECT 2, sample_id, 'unknown_image_reference' FROM unknown_refs
  UNION ALL SELECT 3, sample_id, 'unexpected_box_for_negative' FROM negatives
  UNION ALL SELECT 3, sample_id, reason FROM geometry)"""

DIRECT_CHECKED = f"{DIRECT},{CHECKED}"
MAPPED_CHECKED = f"""{MAPPED},{CHECKED},
ledger AS (
  SELECT CAST(0 AS INTEGER) AS stage, sample_id, reason FROM verdict WHERE reason IS NOT NULL
  UNION ALL SELECT * FROM late_rejections)"""

SPLIT_INPUT = """
split_input AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id, quality AS label FROM labels)"""

# Quotas by largest remainder (ties to the lower label), then ranks by hash.
_QUOTAS = """
per_label AS (SELECT label, count(*) AS c FROM split_input GROUP BY label),
sizes AS (SELECT sum(c)::BIGINT AS n,
  CAST(ceil((0.15::DOUBLE + 0.15::DOUBLE) * sum(c)::DOUBLE) AS BIGINT) AS n_rest FROM per_label),
train_parts AS (
  SELECT label, c, n, n_rest, c::DOUBLE / n::DOUBLE * (n - n_rest)::DOUBLE AS exact
  FROM per_label, sizes),
train_quota AS (
  SELECT label, c, n, n_rest, CAST(floor(exact) AS BIGINT)
    + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
           <= (n - n_rest) - CAST(sum(floor(exact)) OVER () AS BIGINT) THEN 1 ELSE 0 END AS q
  FROM train_parts),
rest AS (
  SELECT label, q, c - q AS r, n_rest,
    CAST(ceil(0.15::DOUBLE / (0.15::DOUBLE + 0.15::DOUBLE) * n_rest::DOUBLE) AS BIGINT) AS n_test
  FROM train_quota),
val_parts AS (
  SELECT *, r::DOUBLE / (sum(r) OVER ())::DOUBLE * (n_rest - n_test)::DOUBLE AS exact FROM rest),
quota AS (
  SELECT label, q, CAST(floor(exact) AS BIGINT)
    + CASE WHEN row_number() OVER (ORDER BY exact - floor(exact) DESC, label)
           <= (n_rest - n_test) - CAST(sum(floor(exact)) OVER () AS BIGINT)
      THEN 1 ELSE 0 END AS v
  FROM val_parts),
placed AS (
  SELECT i.*, row_number() OVER (PARTITION BY i.label
    ORDER BY md5('42:' || i.sample_id), i.sample_id) AS place FROM split_input i),
assigned AS (
  SELECT p.sample_id, p.label, CASE WHEN place <= q THEN 'train'
    WHEN place <= q + v THEN 'validation' ELSE 'test' END AS split
  FROM placed p JOIN quota USING (label))"""
SPLIT = f"{SPLIT_INPUT},{_QUOTAS}"

PREDICTIONS = """
scored AS (
  SELECT CAST(l.doc_id AS VARCHAR) AS sample_id, CAST(l.quality AS BIGINT) AS label,
    (2000 - n_chars) / CAST(1000 AS DOUBLE) AS logit,
    1.0::DOUBLE / (1.0::DOUBLE + exp(-((2000 - n_chars) / CAST(1000 AS DOUBLE)))) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _roc(source, prefix=""):
    """Running counts over distinct scores of ``source``, with the anchor point."""
    return f"""
{prefix}totals AS (
  SELECT sum(label)::BIGINT AS n_pos, sum(1 - label)::BIGINT AS n_neg FROM {source}),
{prefix}per_score AS (
  SELECT score, sum(label)::BIGINT AS p, sum(1 - label)::BIGINT AS n FROM {source} GROUP BY score),
{prefix}running AS (
  SELECT score, p, n, CAST(sum(p) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) AS fp
  FROM {prefix}per_score WINDOW w AS (ORDER BY score DESC
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
{prefix}points AS (
  SELECT threshold, tp, fp, tp::DOUBLE / n_pos::DOUBLE AS tpr, fp::DOUBLE / n_neg::DOUBLE AS fpr
  FROM (SELECT score AS threshold, tp, fp FROM {prefix}running
        UNION ALL SELECT 'Infinity'::DOUBLE, 0, 0) t, {prefix}totals),
{prefix}area AS (
  SELECT sum(n * (2 * tp - p))::DOUBLE
    / (2 * any_value(n_pos) * any_value(n_neg))::DOUBLE AS auc
  FROM {prefix}running, {prefix}totals),
{prefix}best AS (
  SELECT threshold, tpr - fpr AS j FROM {prefix}points
  ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1)"""


def _confusion(source, threshold):
    return f"""
  SELECT count(*) FILTER (score >= {threshold} AND label = 1) AS tp,
    count(*) FILTER (score < {threshold} AND label = 0) AS tn,
    count(*) FILTER (score >= {threshold} AND label = 0) AS fp,
    count(*) FILTER (score < {threshold} AND label = 1) AS fn
  FROM {source}"""


_RATES = """
    tp::DOUBLE / nullif(tp + fn, 0) AS sensitivity,
    tn::DOUBLE / nullif(tn + fp, 0) AS specificity,
    coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision,
    coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
    coalesce((2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0), 0) AS f1"""

THRESHOLD = "0.30780404806137085::DOUBLE"

PIXELS = """
grid AS (
  SELECT CAST(vec_id AS VARCHAR) AS sample_id, vec_id, vec_id % 3 = 0 AS mono1,
    CAST(place - 1 AS INTEGER) AS place,
    CAST(least(greatest(floor((embedding[place]::DOUBLE + 1.0::DOUBLE) * 32767.0::DOUBLE), 0),
      65535) AS BIGINT) AS code
  FROM embeddings, range(1, 65) AS r(place)),
scaled AS (
  SELECT sample_id, place, CASE WHEN hi > lo
    THEN (code - lo)::DOUBLE / (hi - lo)::DOUBLE ELSE 0.0::DOUBLE END AS v
  FROM (SELECT *, min(code) OVER (PARTITION BY sample_id) AS lo,
          max(code) OVER (PARTITION BY sample_id) AS hi FROM grid) t)"""


def _resize(source, value, out):
    """8 x 8 to 5 x 5, half-pixel centres: rows across first, then down."""
    return f"""
axis AS (
  SELECT o, CAST(floor(s) AS INTEGER) AS a, least(CAST(floor(s) AS INTEGER) + 1, 7) AS b,
    s - floor(s) AS w
  FROM (SELECT o, greatest((o + 0.5::DOUBLE) * (8.0::DOUBLE / 5.0::DOUBLE) - 0.5::DOUBLE,
          0.0::DOUBLE) AS s
        FROM range(0, 5) AS r(o)) t),
across AS (
  SELECT l.sample_id, CAST(floor(l.place / 8) AS INTEGER) AS y, x.o AS x,
    l.{value} * (1.0::DOUBLE - x.w) + r.{value} * x.w AS v
  FROM {source} l JOIN axis x ON l.place % 8 = x.a
  JOIN {source} r ON r.sample_id = l.sample_id
    AND r.place = l.place - x.a + x.b),
{out} AS (
  SELECT t.sample_id, CAST(y.o * 5 + t.x AS INTEGER) AS place,
    t.v * (1.0::DOUBLE - y.w) + u.v * y.w AS v
  FROM across t JOIN axis y ON t.y = y.a
  JOIN across u ON u.sample_id = t.sample_id AND u.x = t.x AND u.y = y.b)"""


TENSOR = f"""{PIXELS},
turned AS (
  SELECT sample_id, place, CASE WHEN mono1 THEN 65535 - code ELSE code END AS code FROM grid),
flat AS (
  SELECT sample_id, place, CASE WHEN hi > lo
    THEN (code - lo)::DOUBLE / (hi - lo)::DOUBLE ELSE 0.0::DOUBLE END AS v
  FROM (SELECT *, min(code) OVER (PARTITION BY sample_id) AS lo,
          max(code) OVER (PARTITION BY sample_id) AS hi FROM turned) t),
{_resize("flat", "v", "small")},
channels(ch, m, s) AS (VALUES (0, 0.485::DOUBLE, 0.229::DOUBLE),
  (1, 0.456::DOUBLE, 0.224::DOUBLE), (2, 0.406::DOUBLE, 0.225::DOUBLE)),
tensor AS (
  SELECT sample_id, CAST(ch * 25 + place AS INTEGER) AS place,
    ((v::FLOAT::DOUBLE - m) / s)::FLOAT::DOUBLE AS value
  FROM small, channels)"""

# What became of each image file: the first fault counts.
_FILES = """
files AS (
  SELECT vec_id, CAST(vec_id AS VARCHAR) AS sample_id,
    CASE WHEN vec_id % 37 = 0 OR vec_id % 41 = 0 THEN 'image_file_not_found'
         WHEN vec_id % 31 = 0 OR vec_id % 29 = 0 THEN 'unreadable_dicom'
         WHEN vec_id % 23 = 0 THEN 'invalid_image_dimensions' END AS reason
  FROM embeddings)"""

_PATH = "replace(url, 'http://', '/mnt/c/') || '/mnt/c/' || page_id || '.dcm'"
_ROW = "patientId, x, y, width, height, Target"
_BOX = "sample_id, x, y, width, height"

ORACLES = {
    "scan_labels": f"WITH {SRC_LABELS} SELECT {_ROW} FROM src_labels",
    "scan_manifest": f"WITH {VERDICT} SELECT * FROM mapped_images",
    "missing_files": f"""WITH {VERDICT},{SRC_HEADERS}
SELECT sample_id, 'image_file_not_found' AS reason FROM mapped_images
WHERE sample_id NOT IN (SELECT sample_id FROM src_headers)""",
    "image_audit": f"""WITH {SRC_HEADERS} SELECT *, CASE WHEN NOT readable THEN 'unreadable_dicom'
  WHEN ndim <> 2 THEN 'invalid_image_dimensions' END AS reason FROM src_headers""",
    "image_audit_decoded": """SELECT CAST(vec_id AS VARCHAR) AS sample_id,
  vec_id % 29 <> 0 AS readable,
  CASE WHEN vec_id % 29 = 0 THEN NULL WHEN vec_id % 23 = 0 THEN 3 ELSE 2 END AS ndim,
  CASE WHEN vec_id % 29 = 0 OR vec_id % 23 = 0 THEN NULL ELSE 8 END AS width,
  CASE WHEN vec_id % 29 = 0 OR vec_id % 23 = 0 THEN NULL ELSE 8 END AS height,
  CASE WHEN vec_id % 29 = 0 THEN 'unreadable_dicom'
       WHEN vec_id % 23 = 0 THEN 'invalid_image_dimensions' END AS reason
FROM embeddings""",
    "write_canonical": f"WITH {VERDICT} SELECT {_BOX} FROM mapped_boxes",
    "write_splits": f"WITH {SPLIT} SELECT sample_id, label, split FROM assigned",
    "published_files": f"""WITH {SPLIT}
SELECT split, count(*) AS n_rows, true AS all_match FROM assigned GROUP BY split""",
    "smoke_subset": f"WITH {VERDICT} SELECT * FROM mapped_images ORDER BY sample_id LIMIT 64",
    "checksum_manifest": """SELECT 'page-' || page_id || '.html' AS name, sha256(html) AS sha256,
  sha256(html) || '  page-' || page_id || '.html' AS line FROM pages""",
    "checksum_verification": """SELECT 'page-' || page_id AS name,
  sha256(CASE WHEN page_id % 10 = 0 THEN url ELSE html END) AS expected,
  sha256(html) AS actual,
  sha256(CASE WHEN page_id % 10 = 0 THEN url ELSE html END) = sha256(html) AS matches
FROM pages""",
    "canonical_images": f"WITH {VERDICT} SELECT * FROM mapped_images",
    "canonical_boxes": f"WITH {VERDICT} SELECT {_BOX} FROM mapped_boxes",
    "class_label": f"""WITH {SRC_CLASSES} SELECT patientId, class,
  CASE class WHEN 'Lung Opacity' THEN 1 WHEN 'Normal' THEN 0
    WHEN 'No Lung Opacity / Not Normal' THEN 0 END AS class_label FROM src_classes""",
    "remap_paths": f"""SELECT page_id, replace({_PATH}, '/mnt/c/', 'C:/') AS image_path
FROM pages""",
    "remap_prefix": f"""SELECT page_id, CASE WHEN starts_with(p, '/mnt/c/')
  THEN 'C:/' || substr(p, 8) ELSE p END AS image_path
FROM (SELECT page_id, {_PATH} AS p FROM pages) t""",
    "invalid_negative_rows": f"""WITH {SRC_LABELS} SELECT {_ROW} FROM src_labels
WHERE Target = 0 AND coalesce(x, y, width, height) IS NOT NULL""",
    "invalid_positive_rows": f"""WITH {SRC_LABELS} SELECT {_ROW} FROM src_labels
WHERE Target = 1 AND (x IS NULL OR y IS NULL OR width IS NULL OR height IS NULL)""",
    "invalid_geometry_rows": f"""WITH {SRC_LABELS}
SELECT DISTINCT patientId, x, y, width, height FROM src_labels
WHERE Target = 1 AND (x < 0 OR y < 0 OR width <= 0 OR height <= 0)""",
    "label_class_join": f"""WITH {SRC_LABELS},{SRC_CLASSES},
stats AS (SELECT patientId, min(class) AS class FROM src_classes
  GROUP BY patientId HAVING count(DISTINCT class) = 1)
SELECT l.patientId, x, y, width, height, Target, class
FROM src_labels l LEFT JOIN stats s ON l.patientId = s.patientId""",
    "reconcile_sources": f"""WITH {SRC_LABELS},{SRC_CLASSES},
t AS (SELECT patientId, min(Target) AS lo, max(Target) AS hi FROM src_labels
  WHERE patientId IS NOT NULL GROUP BY patientId),
c AS (SELECT patientId, min(class) AS lo, max(class) AS hi FROM src_classes
  WHERE patientId IS NOT NULL GROUP BY patientId),
j AS (SELECT coalesce(t.patientId, c.patientId) AS patientId,
    CASE WHEN t.lo = t.hi THEN t.lo END AS label, CASE WHEN c.lo = c.hi THEN c.lo END AS raw_class,
    CASE WHEN t.patientId IS NULL THEN 'right_only' WHEN c.patientId IS NULL THEN 'left_only'
      ELSE 'both' END AS source,
    coalesce(t.lo <> t.hi, false) OR coalesce(c.lo <> c.hi, false) AS conflict
  FROM t FULL OUTER JOIN c ON t.patientId = c.patientId),
k AS (SELECT *, CASE raw_class WHEN 'Lung Opacity' THEN 1 WHEN 'Normal' THEN 0
    WHEN 'No Lung Opacity / Not Normal' THEN 0 END AS class_label FROM j)
SELECT patientId, label, raw_class, class_label, source, conflict,
  source = 'both' AND coalesce(label <> class_label, true) AS disagrees FROM k""",
    "mergeable_classes": f"""WITH {SRC_CLASSES} SELECT DISTINCT patientId, class FROM src_classes
WHERE patientId NOT IN (SELECT patientId FROM src_classes GROUP BY patientId
  HAVING count(DISTINCT class) > 1)""",
    "unknown_box_refs": f"WITH {DIRECT_CHECKED} SELECT * FROM unknown_refs",
    "valid_boxes": f"WITH {DIRECT_CHECKED} SELECT * FROM good_boxes",
    "valid_images": f"WITH {DIRECT_CHECKED} SELECT * FROM good_images",
    "file_coverage": f"""WITH {VERDICT},{SRC_HEADERS}
SELECT sample_id, 'missing' AS side FROM mapped_images
WHERE sample_id NOT IN (SELECT sample_id FROM src_headers)
UNION ALL SELECT sample_id, 'extra' FROM src_headers
WHERE sample_id NOT IN (SELECT sample_id FROM mapped_images)""",
    "dup_join_keys": f"""WITH {SRC_CLASSES} SELECT patientId, count(*) AS n_rows
FROM (SELECT DISTINCT patientId, class FROM src_classes) t GROUP BY patientId
HAVING count(*) > 1""",
    "training_examples": f"""WITH {SPLIT_INPUT},{TENSOR}
SELECT sample_id, CAST(label AS DOUBLE) AS label, place, value
FROM split_input LEFT JOIN tensor USING (sample_id)""",
    "score_images": f"""WITH {TENSOR}
SELECT sample_id, round(sum(value * (((place * 5) % 11 - 5) / 100.0::DOUBLE)), 4) AS logit
FROM tensor GROUP BY sample_id""",
    "image_listing": r"""SELECT url AS path, regexp_extract(url, '([^/]+)\.html$', 1) AS sample_id
FROM pages WHERE ends_with(url, '.html')""",
    "distinct_classes": f"WITH {SRC_CLASSES} SELECT DISTINCT patientId, class FROM src_classes",
    "conflicting_classes": f"""WITH {SRC_CLASSES}
SELECT patientId, count(DISTINCT class) AS n_classes FROM src_classes
GROUP BY patientId HAVING count(DISTINCT class) > 1""",
    "conflicting_targets": f"""WITH {SRC_LABELS}
SELECT patientId, min(Target) AS lowest, max(Target) AS highest FROM src_labels
GROUP BY patientId HAVING count(DISTINCT Target) > 1""",
    "box_flags": f"""WITH {VERDICT} SELECT patientId, has_box_value, has_empty_row,
  has_partial_row, has_bad_size, has_bad_corner FROM label_stats""",
    "mapping_verdict": f"WITH {VERDICT} SELECT sample_id, reason, target, n_rows FROM verdict",
    "duplicate_images": f"""WITH {DIRECT} SELECT sample_id, count(*) AS copies FROM in_images
GROUP BY sample_id HAVING count(*) > 1""",
    "dedupe_boxes": f"""WITH {DIRECT} SELECT {_BOX}, count(*) AS copies FROM in_boxes
GROUP BY {_BOX}""",
    "geometry_verdict": f"WITH {DIRECT_CHECKED} SELECT * FROM geometry",
    "negative_with_boxes": f"WITH {DIRECT_CHECKED} SELECT * FROM negatives",
    "rejection_histogram": f"""WITH {VERDICT} SELECT reason, count(*) AS n_rows FROM verdict
WHERE reason IS NOT NULL GROUP BY reason""",
    "rejection_ledger": f"WITH {MAPPED_CHECKED} SELECT * FROM ledger",
    "direct_ledger": f"WITH {DIRECT_CHECKED} SELECT * FROM late_rejections",
    "ingest_report": f"""WITH {MAPPED_CHECKED}
SELECT (SELECT count(*) FROM src_labels) AS source_rows,
  (SELECT count(*) FROM good_images) AS accepted_images,
  (SELECT count(*) FROM good_images WHERE label = 1) AS positive_images,
  (SELECT count(*) FROM good_images WHERE label = 0) AS negative_images,
  (SELECT count(*) FROM good_boxes) AS bounding_boxes,
  (SELECT CAST(sum(copies - 1) AS BIGINT) FROM unique_boxes) AS duplicate_boxes_removed,
  (SELECT count(*) FROM ledger) AS rejected_records,
  (SELECT '{{' || string_agg('"' || reason || '":' || n, ',' ORDER BY reason) || '}}'
   FROM (SELECT reason, count(*) AS n FROM ledger GROUP BY reason) t) AS rejection_reasons""",
    "class_distribution": f"""WITH {SRC_CLASSES} SELECT class, count(*) AS n_rows
FROM src_classes WHERE class IS NOT NULL GROUP BY class ORDER BY n_rows DESC, class""",
    "repeated_rows": f"""WITH {SRC_LABELS},{SRC_CLASSES}
SELECT 'classes' AS table_name, CAST(sum(n) AS BIGINT) AS repeated_rows FROM
  (SELECT count(*) AS n FROM src_classes GROUP BY patientId, class HAVING count(*) > 1) t
UNION ALL SELECT 'boxes', CAST(coalesce(sum(n), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM src_labels WHERE Target = 1
   GROUP BY patientId, x, y, width, height HAVING count(*) > 1) t""",
    "profile_counts": f"""WITH {SRC_LABELS},{SRC_CLASSES}
SELECT 'labels' AS table_name, count(*) AS n_rows, count(DISTINCT patientId) AS unique_ids
FROM src_labels
UNION ALL SELECT 'classes', count(*), count(DISTINCT patientId) FROM src_classes""",
    "boxes_per_image_hist": f"""WITH {SRC_LABELS}
SELECT n_boxes, count(*) AS image_count FROM (
  SELECT patientId, count(*) AS n_boxes FROM (
    SELECT DISTINCT patientId, x, y, width, height FROM src_labels WHERE Target = 1) d
  GROUP BY patientId) t GROUP BY n_boxes""",
    "max_boxes_per_image": f"""WITH {SRC_LABELS} SELECT max(n) AS max_boxes FROM (
  SELECT count(*) AS n FROM (
    SELECT DISTINCT patientId, x, y, width, height FROM src_labels WHERE Target = 1) d
  GROUP BY patientId) t""",
    "class_label_crosstab": """SELECT o_orderpriority AS raw_class, o_orderstatus AS label,
  count(*) AS n_rows, CAST(grouping(o_orderpriority) AS INTEGER) AS row_margin,
  CAST(grouping(o_orderstatus) AS INTEGER) AS column_margin
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL
GROUP BY CUBE (o_orderpriority, o_orderstatus)""",
    "image_targets": f"""WITH {SRC_LABELS}
SELECT DISTINCT patientId, Target AS label FROM src_labels""",
    "expectations": f"""WITH {SRC_LABELS},{SRC_CLASSES},{SRC_HEADERS},
t AS (SELECT patientId, count(DISTINCT Target) AS n, count(*) FILTER (Target IS NULL) AS gaps,
    min(Target) AS low FROM src_labels GROUP BY patientId),
cd AS (SELECT DISTINCT patientId, class, CASE class WHEN 'Lung Opacity' THEN 1
    WHEN 'Normal' THEN 0 WHEN 'No Lung Opacity / Not Normal' THEN 0 END AS lab
  FROM src_classes),
c AS (SELECT patientId, count(*) AS n, count(class) AS named, max(lab) AS lab
  FROM cd GROUP BY patientId),
ids AS (SELECT patientId FROM t UNION SELECT patientId FROM c),
found(check_name, violations) AS (
  SELECT 'classes_supported', count(DISTINCT class) FROM src_classes
    WHERE class NOT IN ('Lung Opacity', 'Normal', 'No Lung Opacity / Not Normal')
  UNION ALL SELECT 'no_class_conflicts', count(*) FROM c WHERE named > 1
  UNION ALL SELECT 'classes_map_to_label', count(*) FROM cd WHERE lab IS NULL
  UNION ALL SELECT 'one_class_row_per_image', count(*) FROM c WHERE n > 1
  UNION ALL SELECT 'targets_are_binary', count(*) FROM src_labels WHERE Target NOT IN (0, 1)
  UNION ALL SELECT 'negatives_have_no_box', count(*) FROM src_labels
    WHERE Target = 0 AND coalesce(x, y, width, height) IS NOT NULL
  UNION ALL SELECT 'positives_have_full_box', count(*) FROM src_labels
    WHERE Target = 1 AND (x IS NULL OR y IS NULL OR width IS NULL OR height IS NULL)
  UNION ALL SELECT 'no_target_conflicts', count(*) FROM t WHERE n > 1
  UNION ALL SELECT 'one_target_per_image', count(*) FROM t WHERE n > 1 OR (n = 1 AND gaps > 0)
  UNION ALL SELECT 'box_geometry_valid', count(*) FROM (
    SELECT DISTINCT patientId, x, y, width, height FROM src_labels
    WHERE Target = 1 AND (x < 0 OR y < 0 OR width <= 0 OR height <= 0)) g
  UNION ALL SELECT 'images_in_both_sources',
    (SELECT count(*) FROM t WHERE patientId NOT IN (SELECT patientId FROM c))
    + (SELECT count(*) FROM c WHERE patientId NOT IN (SELECT patientId FROM t))
  UNION ALL SELECT 'labels_agree', count(*) FROM t JOIN c ON t.patientId = c.patientId
    WHERE t.n = 1 AND t.gaps = 0 AND c.n = 1 AND coalesce(low <> lab, true)
  UNION ALL SELECT 'every_image_has_file', count(*) FROM ids
    WHERE patientId NOT IN (SELECT sample_id FROM src_headers)
  UNION ALL SELECT 'every_file_is_labelled', count(*) FROM src_headers
    WHERE sample_id NOT IN (SELECT patientId FROM ids))
SELECT check_name, violations, violations = 0 AS passed FROM found""",
    "unsupported_classes": f"""WITH {SRC_CLASSES} SELECT DISTINCT class FROM src_classes
WHERE class NOT IN ('Lung Opacity', 'Normal', 'No Lung Opacity / Not Normal')""",
    "split_input_checks": f"""WITH {SPLIT_INPUT} SELECT count(*) AS n_rows,
  count(*) FILTER (sample_id IS NULL) AS missing_ids,
  count(*) FILTER (trim(sample_id) = '') AS blank_ids,
  (SELECT count(*) FROM (SELECT sample_id FROM split_input WHERE sample_id IS NOT NULL
    GROUP BY sample_id HAVING count(*) > 1) d) AS duplicate_ids,
  count(*) FILTER (label IS NULL) AS missing_labels,
  count(*) FILTER (label NOT IN (0, 1)) AS other_labels,
  count(*) FILTER (label = 0) AS label_0, count(*) FILTER (label = 1) AS label_1
FROM split_input""",
    "stratified_split": f"""WITH {VERDICT},
split_input AS (SELECT sample_id, label FROM mapped_images),{_QUOTAS}
SELECT sample_id, label, split FROM assigned""",
    "split_report": f"""WITH {SPLIT}
SELECT split, CAST(sum(n) AS BIGINT) AS n_rows,
  '{{' || string_agg('"' || label || '":' || n, ',' ORDER BY label) || '}}' AS class_counts,
  42 AS seed
FROM (SELECT split, label, count(*) AS n FROM assigned GROUP BY split, label) t
GROUP BY split""",
    "split_verification": f"""WITH {SPLIT}
SELECT (SELECT count(*) FROM (SELECT sample_id FROM assigned GROUP BY sample_id
    HAVING count(DISTINCT split) > 1) t) AS overlapping_ids,
  (SELECT count(*) FROM split_input WHERE sample_id NOT IN (SELECT sample_id FROM assigned))
    AS uncovered_ids,
  (SELECT count(*) FROM assigned WHERE sample_id NOT IN (SELECT sample_id FROM split_input))
    AS unknown_ids,
  (SELECT count(*) FROM assigned) - (SELECT count(*) FROM split_input) AS row_difference""",
    "epoch_order": f"""WITH {SPLIT_INPUT}
SELECT sample_id, label, md5('42:1:' || sample_id) AS shuffle_key FROM split_input
ORDER BY shuffle_key""",
    "first_per_class": f"""WITH {VERDICT} SELECT raw_class, min(sample_id) AS sample_id
FROM mapped_images GROUP BY raw_class""",
    "checkpoint_saves": """SELECT event_type AS run, event_id AS epoch, value AS val_loss,
  min(value) OVER w AS best_before,
  coalesce(value < min(value) OVER w, true) AS saved
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
    "append_history": """SELECT event_type AS run, event_id AS epoch, value AS val_loss,
  1.0::DOUBLE / (1.0::DOUBLE + abs(value)) AS val_acc FROM events""",
    "run_summary": """SELECT event_type AS run, min(value) AS best_val_loss,
  (SELECT min(e.event_id) FROM events e WHERE e.event_type = o.event_type
    AND e.value = min(o.value)) AS best_epoch,
  max(event_id) AS last_epoch,
  1.0::DOUBLE / (1.0::DOUBLE + abs(arg_max(value, event_id))) AS final_val_acc
FROM events o GROUP BY event_type""",
    "batches": f"""WITH {SPLIT_INPUT} SELECT sample_id, label,
  CAST(floor((row_number() OVER (ORDER BY sample_id) - 1) / 32) AS BIGINT) AS batch_no
FROM split_input""",
    "batch_score": """WITH z AS (
  SELECT vec_id, sum(embedding[i + 1]::DOUBLE * (((i * 7) % 13 - 6) / 10.0::DOUBLE)) AS logit
  FROM embeddings, range(0, 64) AS r(i) GROUP BY vec_id)
SELECT CAST(vec_id AS VARCHAR) AS sample_id, round(logit, 6) AS logit,
  round(1.0::DOUBLE / (1.0::DOUBLE + exp(-logit)), 6) AS score FROM z""",
    "score": f"""WITH {PREDICTIONS} SELECT sample_id, label, logit, round(score, 12) AS score
FROM scored""",
    "decide": f"""WITH {PREDICTIONS} SELECT sample_id,
  CASE WHEN score >= {THRESHOLD} THEN 'pneumonia' ELSE 'normal' END AS decision FROM scored""",
    "loss_accuracy": f"""WITH {PREDICTIONS},
rows AS (SELECT *, greatest(logit, 0.0::DOUBLE) - logit * label + ln(1 + exp(-abs(logit))) AS loss,
  floor((row_number() OVER (ORDER BY sample_id) - 1) / 32) AS batch_no FROM scored),
per_batch AS (SELECT batch_no, avg(loss) AS loss FROM rows GROUP BY batch_no)
SELECT round((SELECT avg(loss) FROM per_batch), 6) AS batch_mean_loss,
  round(avg(loss), 6) AS row_mean_loss,
  round(count(*) FILTER ((logit > 0) = (label = 1)) / count(*)::DOUBLE, 6) AS accuracy
FROM rows""",
    "roc_points": f"""WITH {PREDICTIONS},{_roc("scored")}
SELECT round(threshold, 12) AS threshold, tp, fp, tpr, fpr FROM points""",
    "roc_auc": f"WITH {PREDICTIONS},{_roc('scored')} SELECT auc FROM area",
    "youden_threshold": f"""WITH {PREDICTIONS},{_roc("scored")}
SELECT round(threshold, 12) AS threshold, j FROM best""",
    "confusion": f"WITH {PREDICTIONS} {_confusion('scored', THRESHOLD)}",
    "binary_metrics": f"""WITH {PREDICTIONS}, m AS ({_confusion('scored', THRESHOLD)})
SELECT tp, tn, fp, fn,{_RATES} FROM m""",
    "eval_report": f"""WITH {PREDICTIONS},{SPLIT},
val AS (SELECT * FROM scored WHERE sample_id IN
  (SELECT sample_id FROM assigned WHERE split = 'validation')),
tst AS (SELECT * FROM scored WHERE sample_id IN
  (SELECT sample_id FROM assigned WHERE split = 'test')),
{_roc("val", "v_")},{_roc("tst", "t_")},
m AS ({_confusion("tst", "(SELECT threshold FROM v_best)")})
SELECT 'chars' AS model, (SELECT round(threshold, 12) FROM v_best) AS threshold,
  (SELECT auc FROM t_area) AS test_auc,{_RATES}, tp, tn, fp, fn FROM m""",
    "invert_mono1": f"""WITH {PIXELS} SELECT sample_id, place,
  CAST(CASE WHEN mono1 THEN 65535 - code ELSE code END AS BIGINT) AS value FROM grid""",
    "min_max_scale": f"WITH {PIXELS} SELECT sample_id, place, v AS value FROM scaled",
    "resize_bilinear": f"""WITH {PIXELS},{_resize("scaled", "v", "small")}
SELECT sample_id, place, v AS value FROM small""",
    "replicate_channels": f"""WITH {PIXELS} SELECT sample_id,
  CAST(ch * 64 + place AS INTEGER) AS place, v AS value FROM scaled, range(0, 3) AS c(ch)""",
    "normalize_channels": f"""WITH {PIXELS},
channels(ch, m, s) AS (VALUES (0, 0.485::DOUBLE, 0.229::DOUBLE),
  (1, 0.456::DOUBLE, 0.224::DOUBLE), (2, 0.406::DOUBLE, 0.225::DOUBLE))
SELECT sample_id, CAST(ch * 64 + place AS INTEGER) AS place, (v - m) / s AS value
FROM scaled, channels""",
    "preprocess_images": f"WITH {TENSOR} SELECT sample_id, place, value FROM tensor",
    "listed_files": f"""WITH {_FILES}
SELECT sample_id, '/p' || vec_id % 8 || '/' || sample_id || '.grid' AS path,
  CASE WHEN vec_id % 31 = 0 THEN 0 WHEN vec_id % 29 = 0 THEN 8
    ELSE 11 + CASE WHEN vec_id % 23 = 0 THEN 6 ELSE 4 END + 1 + 128 END AS length
FROM files WHERE reason IS DISTINCT FROM 'image_file_not_found'""",
    "audited_files": f"""WITH {_FILES}
SELECT sample_id, reason IS DISTINCT FROM 'unreadable_dicom' AS readable,
  CASE WHEN reason = 'unreadable_dicom' THEN NULL WHEN reason IS NULL THEN 2 ELSE 3 END AS ndim,
  CASE WHEN reason IS NULL THEN 8 END AS width, CASE WHEN reason IS NULL THEN 8 END AS height, reason
FROM files WHERE reason IS DISTINCT FROM 'image_file_not_found'""",
    "audited_paths": f"""WITH {_FILES} SELECT sample_id, reason,
  CASE WHEN reason IS NULL THEN 8 END AS image_width, CASE WHEN reason IS NULL THEN 8 END AS image_height FROM files""",
    "preprocessed_paths": f"""WITH {_FILES},{TENSOR}
SELECT f.sample_id, s.place, s.v::FLOAT::DOUBLE AS value
FROM files f LEFT JOIN small s ON s.sample_id = f.sample_id AND reason IS NULL""",
    "scored_files": f"""WITH {_FILES},{TENSOR}
SELECT sample_id, round(sum(value * (((place * 5) % 11 - 5) / 100.0::DOUBLE)), 4) AS logit
FROM tensor JOIN files USING (sample_id) WHERE reason IS NULL GROUP BY sample_id""",
}

# The same answers, however the history arrives.
ORACLES["checkpoint_saves_by_batch"] = ORACLES["checkpoint_saves"]
ORACLES["run_summary_by_batch"] = ORACLES["run_summary"]

# Two halves of a row's number are mixed in turn, eight times and again while the number is too high.
ORACLES["epoch_places"] = f"""WITH RECURSIVE {SPLIT_INPUT},
total AS (SELECT count(*) AS n, floor(sqrt(count(*)))::BIGINT AS top FROM split_input),
dims AS (
  SELECT n, a, (n + a - 1) // a AS b FROM total, unnest(range(greatest(least(2, top), top // 16), top + 1)) AS t(a)
  ORDER BY (n + a - 1) // a * a - n, a DESC LIMIT 1),
mixed AS (
  SELECT epoch, sample_id, label, n, a, b, number // b AS l, number % b AS r, 0 AS step
  FROM (SELECT *, row_number() OVER (ORDER BY sample_id) - 1 AS number FROM split_input), dims, (VALUES (1), (2)) e(epoch)
  UNION ALL
  SELECT epoch, sample_id, label, n, a, b,
    CASE WHEN s % 2 = 0 THEN (l + ('0x' || substr(md5('42:' || epoch || ':' || s || ':' || r), 1, 8))::BIGINT) % a ELSE l END,
    CASE WHEN s % 2 = 1 THEN (r + ('0x' || substr(md5('42:' || epoch || ':' || s || ':' || l), 1, 8))::BIGINT) % b ELSE r END,
    s + 1
  FROM (SELECT *, step % 8 AS s FROM mixed WHERE step < 8 OR l * b + r >= n))
SELECT epoch, sample_id, label, l * b + r AS place, (l * b + r) // 32 AS batch_no FROM mixed WHERE step = 8 AND l * b + r < n"""

ORACLES["sketched_counts"] = f"SELECT table_name, n_rows, unique_ids, true AS is_near FROM ({ORACLES['profile_counts']})"

ORACLES["ordered_ledger"] = f"""WITH {DIRECT_CHECKED},
found AS (
  SELECT stage, sample_id, reason, NULL AS seq FROM late_rejections WHERE stage <> 2
  UNION ALL SELECT 2, sample_id, 'unknown_image_reference', min(source_place) FROM in_boxes
  WHERE sample_id NOT IN (SELECT sample_id FROM in_images) GROUP BY sample_id, x, y, width, height)
SELECT row_number() OVER (ORDER BY stage, seq NULLS FIRST, sample_id, reason) - 1 AS place, stage, sample_id, reason FROM found"""
ORACLES["ordered_rejections"] = f"""WITH {MAPPED_CHECKED}
SELECT row_number() OVER (ORDER BY stage, stage = 0 AND reason <> 'conflicting_classes', sample_id, reason) - 1 AS place,
  stage, sample_id, reason FROM ledger"""

# The sum of a resized plane is the sum of its pixels, each times what all output pixels read of it.
ORACLES["preprocess_large"] = f"""WITH {PIXELS},
turned AS (
  SELECT sample_id, place, CASE WHEN mono1 THEN 65535 - code ELSE code END AS code FROM grid),
flat AS (
  SELECT sample_id, place, CASE WHEN hi > lo
    THEN (code - lo)::DOUBLE / (hi - lo)::DOUBLE ELSE 0.0::DOUBLE END AS v
  FROM (SELECT *, min(code) OVER (PARTITION BY sample_id) AS lo,
          max(code) OVER (PARTITION BY sample_id) AS hi FROM turned) t),
axis AS (
  SELECT o, floor(s)::INTEGER AS a, least(floor(s)::INTEGER + 1, 7) AS b, s - floor(s) AS w
  FROM (SELECT o, greatest((o + 0.5::DOUBLE) * (8.0::DOUBLE / 224.0::DOUBLE) - 0.5::DOUBLE, 0.0::DOUBLE) AS s
        FROM range(0, 224) AS r(o)) t),
shares AS (SELECT i, sum(w) AS w FROM (SELECT a AS i, 1 - w AS w FROM axis UNION ALL SELECT b, w FROM axis) t GROUP BY i),
totals AS (
  SELECT sample_id, sum(v * y.w * x.w) AS total, max(v) FILTER (place = 0) AS first, max(v) FILTER (place = 63) AS last
  FROM flat JOIN shares y ON y.i = place // 8 JOIN shares x ON x.i = place % 8 GROUP BY sample_id)
SELECT sample_id, 50176 AS n_pixels, round(total / 50176, 4) AS mean, first::FLOAT::DOUBLE AS first, last::FLOAT::DOUBLE AS last
FROM totals"""

ORACLES["stored_examples"] = ORACLES["training_examples"]
ORACLES["unparsed_cells"] = """SELECT count(*) FILTER (l_orderkey % 7 = 0) AS x, 0::BIGINT AS y,
  count(*) FILTER (l_orderkey % 11 = 0) AS width, 0::BIGINT AS height, count(*) FILTER (l_orderkey % 13 = 0) AS Target
FROM lineitem"""
