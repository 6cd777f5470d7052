"""DuckDB SQL for the operators that SQL can express."""

OP2 = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
starts AS (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM split WHERE len(w) >= 35),
grams AS (SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS g FROM starts),
twice AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1),
hit AS (SELECT r, list(DISTINCT j) AS js FROM (SELECT r, unnest(range(i, i + 35)) AS j FROM grams SEMI JOIN twice USING (g)) GROUP BY r),
words AS (SELECT split.r, doc_id, w, unnest(range(1, len(w) + 1)) AS j FROM split),
gone AS (SELECT DISTINCT r, unnest(js) AS j FROM hit),
kept AS (SELECT words.r, string_agg(w[words.j], ' ' ORDER BY words.j) AS t, count(*) AS n FROM words ANTI JOIN gone ON words.r = gone.r AND words.j = gone.j GROUP BY words.r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (r)
"""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex({LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingled AS (
  SELECT r, doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END) AS s FROM split),
each AS (SELECT r, md5(unnest(s)) AS g FROM shingled),
shared AS (SELECT x.r AS a, y.r AS b, count(*) AS n FROM each x JOIN each y ON x.g = y.g AND x.r < y.r GROUP BY 1, 2),
near AS (SELECT a, b FROM shared JOIN shingled x ON x.r = a JOIN shingled y ON y.r = b WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT r AS a, r AS b FROM split UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(t.doc_id) AS component_id
FROM reach JOIN shingled s ON s.r = reach.a JOIN shingled t ON t.r = reach.b GROUP BY s.r, s.doc_id, s.s
"""

WORDS = rf"list_filter(string_split_regex({LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP10 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
places AS (SELECT item, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM items WHERE len(w) > 0),
grams AS (SELECT DISTINCT item, n, array_to_string(w[i : i + 12], ' ') AS g FROM places),
cells AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n),
hits AS (SELECT r, i, c.n, item FROM (SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM cells) c JOIN grams ON grams.g = c.g AND grams.n = c.n),
cover AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY 1),
found AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN cover USING (r) LEFT JOIN found USING (r)
"""

ORACLES = {"op2_substring_dedup": OP2, "op3_ngram_jaccard": OP3, "op10_decontamination": OP10}
