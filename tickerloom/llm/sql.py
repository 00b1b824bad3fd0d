"""DuckDB SQL of the operators that SQL can express on whole tables; doc_id and item_id are unique and not null in those."""

#: Operator 3: windows of item words, met by equal windows of document words.
DECONTAMINATE = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
starts AS (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS k FROM starts),
sizes AS (SELECT DISTINCT n FROM wanted),
places AS (SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS i FROM docs JOIN sizes ON len(words) >= n),
met AS (
  SELECT doc_id, item, i, n
  FROM (SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS k FROM places) JOIN wanted USING (n, k)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

#: Operator 9: words under windows of 13 that also start in a document of smaller doc_id.
SUBSTRING_DEDUP = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k FROM places),
firsts AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (k) WHERE doc_id > least),
removed AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
each_word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM docs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS stay FROM each_word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(stay, '')) AS kept_sha256
FROM docs LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: Operator 13: bits of the failed filters of each document, counted along all orders of the filters.
FILTER_AUDIT = r"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
fails AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS bits
  FROM docs),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
found AS (
  SELECT part, bits, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY part, bits),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT v.c || w.c || x.c || y.c || z.c AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bs
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.b + w.b + x.b + y.b + z.b = 31 AND (v.b | w.b | x.b | y.b | z.b) = 31),
steps AS (SELECT filter_order, step, bs[step] AS bit, coalesce(list_sum(bs[1:step - 1]), 0)::BIGINT AS earlier FROM orders, range(1, 6) r(step)),
each AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN bits & bit = 0 AND bits & earlier = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN bits & bit <> 0 AND bits & earlier = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN bits & bit <> 0 AND bits & earlier <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN bits & bit <> 0 AND bits & earlier = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN bits & bit <> 0 AND bits & earlier = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM found, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM each
"""
