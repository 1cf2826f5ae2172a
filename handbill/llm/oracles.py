"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""

OP7 = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source
), w AS (
  SELECT *, rank % 3 + 1 AS weight, source_size * 3 AS cap,
    CAST(source_size * 3 AS DOUBLE) / (rank % 3 + 1) AS ratio FROM s
), f AS (
  SELECT *, row_number() OVER o AS place,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY ratio, rank),
    b AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source AS from_source, source_size, least(CAST(cap AS DOUBLE),
    (SELECT level FROM f WHERE level <= ratio ORDER BY place LIMIT 1) * weight) AS target FROM f
), q AS (
  SELECT doc_id, size, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY from_source ORDER BY md5('mix:' || CAST(doc_id AS VARCHAR)), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM from_source
)
SELECT doc_id, size, source_size, target, CAST(
  greatest(0, least(size, floor(target) - ahead))
  + greatest(0, least(size, floor(target) - ahead - source_size))
  + greatest(0, least(size, floor(target) - ahead - 2 * source_size)) AS BIGINT) AS taken
FROM q
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM g) WHERE nth > 1
), x AS (
  SELECT DISTINCT doc_id, i + o AS p FROM (SELECT doc_id, i, unnest(range(20)) AS o FROM r)
), w AS (
  SELECT doc_id, p, ws[p] AS word FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)
), k AS (
  SELECT w.doc_id, count(x.p) AS n_removed,
    string_agg(word, ' ' ORDER BY w.p) FILTER (WHERE x.p IS NULL) AS kept
  FROM w LEFT JOIN x ON w.doc_id = x.doc_id AND w.p = x.p GROUP BY 1
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS u, b.doc_id AS w, count(*) AS same
  FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT u, w FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = w
  WHERE same >= 0.8 * (x.n + y.n - same)
), reach AS (
  SELECT u, w FROM l UNION SELECT reach.u, l.w FROM reach JOIN l ON reach.w = l.u
), c AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN doc_id
    ELSE min(doc_id) OVER (PARTITION BY array_to_string(ws, ' ')) END AS class_id FROM d
), k AS (
  SELECT u, count(*) AS n_links FROM l GROUP BY 1
), m AS (
  SELECT u, min(w) AS least_id FROM reach GROUP BY 1
)
SELECT c.doc_id, class_id, coalesce(n_links, 0) AS n_links, least(c.doc_id, coalesce(least_id, c.doc_id)) AS component_id,
  c.doc_id <= coalesce(least_id, c.doc_id) AS kept
FROM c LEFT JOIN k ON k.u = c.doc_id LEFT JOIN m ON m.u = c.doc_id
"""

OP9 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT u, w FROM l UNION SELECT reach.u, l.w FROM reach JOIN l ON reach.w = l.u
)
SELECT vec_id, (SELECT count(*) FROM l WHERE u = vec_id) AS n_links,
  least(vec_id, coalesce((SELECT min(w) FROM reach WHERE u = vec_id), vec_id)) AS component_id,
  vec_id <= coalesce((SELECT min(w) FROM reach WHERE u = vec_id), vec_id) AS kept
FROM embeddings
"""

OP11 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
    CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM t
), p AS (
  SELECT *, array_to_string(u[1 : least(a, b)], '') AS pre,
    array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS mid, array_to_string(u[greatest(a, b) + 1 :], '') AS suf
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), q AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)
), g AS (
  SELECT rid, size, i, array_to_string(ws[i : i + size - 1], ' ') AS win
  FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM q))
), m AS (
  SELECT rid, i, g.size, item_id FROM g JOIN q USING (size, win)
), h AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS p FROM m) GROUP BY 1
), n AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h ON h.rid = d.rid LEFT JOIN n ON n.rid = d.rid
"""

OP13 = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), f AS (
  SELECT rid, unnest(ws) AS word FROM d
), t AS (
  SELECT unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), w AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM f UNION SELECT word FROM t)
), b AS (
  SELECT word, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda j: CAST('0x' || h[2 * j + 1 : 2 * j + 2] AS BIGINT))),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % 10000 AS bucket FROM w, crc
), s AS (
  SELECT bucket, count(*) AS s FROM f JOIN b USING (word) GROUP BY 1
), u AS (
  SELECT bucket, count(*) AS t FROM t JOIN b USING (word) GROUP BY 1
), g AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST((SELECT count(*) FROM f) AS DOUBLE) + 10000)
    / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (CAST((SELECT count(*) FROM t) AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM s FULL JOIN u USING (bucket)
), m AS (
  SELECT rid, count(*) AS n, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN b USING (word) JOIN g USING (bucket) GROUP BY 1
), x AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5e0) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN m ON m.rid = d.rid
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM (SELECT *, count(*) FILTER (WHERE n_features >= 20) OVER () AS able,
  row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place FROM x)
"""

ORACLES = {"op1_exact_dedup": OP1, "op2_substring_dedup": OP2, "op6_ngram_jaccard": OP6,
           "op7_mixing": OP7, "op9_embedding_near_dedup": OP9,
           "op11_fill_in_middle": OP11, "op12_decontamination": OP12,
           "op13_importance_resampling": OP13}
