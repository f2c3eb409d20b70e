"""DuckDB SQL for the queries that SQL can express, over the same tables."""

MIXING = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighed AS (
  SELECT *, [1, 2, 3][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INTEGER]::BIGINT AS w FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source IS NULL, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER (ORDER BY 3 * source_size / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE
    AS l, row_number() OVER (ORDER BY 3 * source_size / w, source IS NULL, source) AS place
  FROM weighed),
level AS (SELECT min_by(l, place) FILTER (WHERE 3 * source_size > w * l) AS l FROM levels),
shares AS (
  SELECT source, source_size, coalesce(least((3 * source_size)::DOUBLE, w * level.l), (3 * source_size)::DOUBLE) AS target
  FROM levels, level),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM sizes),
cut AS (
  SELECT p.*, s.source_size, s.target, round(s.target)::BIGINT AS b,
    CASE WHEN s.source_size > 0 THEN round(s.target)::BIGINT // s.source_size ELSE 0 END AS e
  FROM placed p JOIN shares s ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (e * size + greatest(0, least(size, b - e * source_size - start)))::BIGINT AS taken
FROM cut
"""

QUALITY = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM t),
spots AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
grams AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM spots),
covered AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM grams WHERE c > 1) GROUP BY doc_id),
facts AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper,
    length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower
  FROM w LEFT JOIN covered ON w.doc_id IS NOT DISTINCT FROM covered.doc_id),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 5 * n_dup_lines > 2 * n_lines
    OR 10 * word_chars < 25 * n_words OR word_chars > 12 * n_words OR upper > lower) AS kept
FROM base
"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '### System:', ''))) // 11 + (length(text) - length(replace(text, '### User:', ''))) // 9
      + (length(text) - length(replace(text, '### Assistant:', ''))) // 14
      + (length(text) - length(replace(text, '### Role:', ''))) // 9 + (length(text) - length(replace(text, '</role>', ''))) // 7
      + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 9 WHEN 'assistant' THEN 14 ELSE 16 + length(role) END + 9 AS chars,
    CASE coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), 'start')
      WHEN 'start' THEN role IN ('system', 'user') WHEN 'user' THEN role = 'assistant'
      WHEN 'system' THEN role = 'user' WHEN 'assistant' THEN role = 'user' ELSE false END AS fits,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back
  FROM c),
joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learnt,
    sum(chars)::BIGINT AS formatted_chars, bool_and(fits AND (back > 1 OR role = 'assistant')) AS valid
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
  formatted_chars, valid
FROM joined
"""

NEGATIVES = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM scored WHERE same),
ranked AS (
  SELECT n.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY n.anchor_id, p.id ORDER BY n.score DESC, n.id)::INTEGER AS rank
  FROM near p JOIN scored n ON n.anchor_id = p.anchor_id
  WHERE p.place <= 5 AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""
