"""DuckDB SQL of the registered queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op9_decontamination"] = r"""
WITH words AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
pieces AS (
  SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM words WHERE len(w) > 0
),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS seq
  FROM pieces
),
d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') END AS w
  FROM documents
),
sizes AS (SELECT DISTINCT n FROM windows),
starts AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n
),
hits AS (
  SELECT s.doc_id, s.i, s.n, t.item_id
  FROM starts s JOIN windows t ON s.n = t.n AND array_to_string(s.w[s.i:s.i + s.n - 1], ' ') = t.seq
),
covered AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""

ORACLE["op2_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w
  FROM documents
),
starts AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
counted AS (
  SELECT rid, i, count(*) OVER (PARTITION BY seq) AS n
  FROM (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS seq FROM starts)
),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS k FROM counted WHERE n > 1),
placed AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d WHERE len(w) > 0),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM placed ANTI JOIN gone USING (rid, k) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

ORACLE["op3_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)
),
steps AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS r FROM d
  UNION
  SELECT reached.doc_id, steps.b FROM reached JOIN steps ON reached.r = steps.a
),
components AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLE["op12_hard_negatives"] = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scores AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, x.r AS r, x.vec_id, x.label = a.label AS same,
    CAST(list_inner_product(a.v, x.v) AS BIGINT) AS score
  FROM rows a JOIN rows x ON x.r <> a.r WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT a, anchor_id, r AS p, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, r) <= 5
),
ranked AS (
  SELECT p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.vec_id, s.r) AS rank
  FROM positives p JOIN scores s ON s.a = p.a
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""

ORACLE["op13_fill_in_middle"] = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
),
pieces AS (
  SELECT doc_id, text, n, form,
    array_to_string(u[1:least(x, y)], '') AS prefix,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
    array_to_string(u[greatest(x, y) + 1:n], '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM pieces
"""
