"""SQL counterparts of the text queries that SQL can express."""

OP5 = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept
  FROM rows
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
"""

OP8 = r"""
WITH cut AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), named AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS core FROM cut
), wide AS (
  SELECT core FROM named WHERE core <> '' GROUP BY core HAVING count(DISTINCT source) >= 5
), marked AS (
  SELECT doc_id, pos, line, core IN (SELECT core FROM wide) AS removed FROM named
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (removed) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT removed), '')) AS text_sha256
FROM marked
GROUP BY doc_id
"""

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP11 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, translate(coalesce(text, ''), {LOWER}) AS t FROM documents
), terms AS (
  SELECT d, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM docs
), tfs AS MATERIALIZED (
  SELECT d, doc_id, w, count(*) AS tf FROM terms GROUP BY d, doc_id, w
), lengths AS (
  SELECT d, sum(tf)::BIGINT AS n FROM tfs GROUP BY d
), stats AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM lengths
), weights AS (
  SELECT w, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM tfs, stats GROUP BY w, docs
), asked AS (
  SELECT item_id, w, count(*) AS k
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, {LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
        FROM (SELECT DISTINCT item_id, text FROM benchmark))
  GROUP BY item_id, w
), scored AS (
  SELECT item_id, d, doc_id,
         sum(k * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // l))))::BIGINT AS score
  FROM asked JOIN tfs USING (w) JOIN weights USING (w) JOIN lengths USING (d), stats
  GROUP BY item_id, d, doc_id
), ranked AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""

OP12 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {LOWER}) AS t FROM documents
), pieces AS (
  SELECT d, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece,
         generate_subscripts(string_split_regex(t, '[.,;:!?\x0A-\x0D]'), 1) AS p
  FROM docs
), cut AS (
  SELECT lang, d, p, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w,
         generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS pos
  FROM pieces
), words AS MATERIALIZED (
  SELECT lang, w AS w1, lead(w, 1) OVER run AS w2, lead(w, 2) OVER run AS w3 FROM cut WINDOW run AS (PARTITION BY d, p ORDER BY pos)
), one AS (
  SELECT lang, w1, count(*) AS a FROM words GROUP BY lang, w1
), two AS (
  SELECT lang, w1, w2, count(*) AS a FROM words WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
), three AS (
  SELECT lang, w1, w2, w3, count(*) AS a FROM words WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10
), around AS (
  SELECT lang, w1, w2, max(a) AS longer
  FROM (SELECT lang, w1, w2, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY lang, w1, w2
), cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.a, 1 AS k, x.a AS l, y.a AS r
  FROM two t LEFT JOIN around o ON o.lang = t.lang AND o.w1 = t.w1 AND o.w2 = t.w2
  JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN one y ON y.lang = t.lang AND y.w1 = t.w2
  WHERE t.a >= 10 AND (o.longer IS NULL OR 100 * o.longer < 50 * t.a)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 1, x.a, y.a
  FROM three t JOIN one x ON x.lang = t.lang AND x.w1 = t.w1 JOIN two y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, 2, x.a, y.a
  FROM three t JOIN two x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN one y ON y.lang = t.lang AND y.w1 = t.w3
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, sum(a)::BIGINT AS n FROM one GROUP BY lang) USING (lang)
WHERE rank <= 2000
"""

ORACLE = {"op5_exact_dedup": OP5, "op8_line_dedup": OP8, "op11_ranked_search": OP11, "op12_phrase_mining": OP12}
