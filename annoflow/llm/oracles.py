"""DuckDB SQL of the operators that SQL can express, written from their definitions."""

from annoflow.llm import decontamination, sharding

_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_AZ}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, len(ws) AS total, least(len(ws), {decontamination.WINDOW}) AS n FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(ws[s:s + n - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, total - n + 2)) AS s FROM sized)),
docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
places AS (SELECT doc_id, n, s, array_to_string(ws[s:s + n - 1], ' ') AS win
           FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS s
                 FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
hits AS (SELECT p.doc_id, p.n, p.s, w.item_id FROM places p JOIN windows w ON p.n = w.n AND p.win = w.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

LINE_DEDUP = rf"""
WITH texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, i, regexp_extract_all(ls[i + 1], '[^\x20\x09-\x0D]+') AS w
          FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM texts)),
long AS (SELECT doc_id, i, w, len(w) AS n, array_to_string(w, ' ') AS line, row_number() OVER (ORDER BY doc_id, i) AS o
         FROM lines WHERE len(w) >= 1),
firsts AS (SELECT line, min(o) AS o FROM long GROUP BY line),
same AS (SELECT l.o FROM long l JOIN firsts f ON l.line = f.line AND l.o > f.o),
kept AS (SELECT l.o, l.w, l.n, l.line FROM long l JOIN firsts f ON l.o = f.o WHERE l.n >= 4),
variants AS (SELECT o, n, p, array_to_string(w[1:p - 1], ' ') || chr(10) || array_to_string(w[p + 1:], ' ') AS around,
                    array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ') AS rest
             FROM (SELECT *, unnest(range(1, n + 1)) AS p FROM kept WHERE n >= 5)),
near AS (
  SELECT v.o FROM variants v JOIN (SELECT n, p, around, min(o) AS e FROM variants GROUP BY ALL) f USING (n, p, around) WHERE v.o > f.e
  UNION SELECT v.o FROM variants v JOIN kept k ON k.line = v.rest AND v.o > k.o
  UNION SELECT k.o FROM kept k JOIN variants v ON k.line = v.rest AND k.o > v.o),
gone AS (SELECT doc_id, list(i ORDER BY i) AS r FROM long WHERE o IN (SELECT o FROM same UNION SELECT o FROM near) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(len(r), 0) AS BIGINT) AS n_removed, coalesce(array_to_string(r, ','), '') AS removed_lines,
       sha256(CASE WHEN r IS NULL THEN text
              ELSE array_to_string([ls[j + 1] FOR j IN range(0, len(ls)) IF NOT list_contains(r, j)], chr(10)) END)
       AS text_sha256
FROM texts t LEFT JOIN gone USING (doc_id)"""

#: Prefixes of up to 24 bits: enough for 16 million shards of hashed ids.
SHARDING = f"""
WITH rows AS (SELECT doc_id, coalesce(strlen(text), 0) AS b, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
bits AS (SELECT doc_id, b, array_to_string([lpad(bin(instr('0123456789abcdef', h[i]) - 1), 4, '0') FOR i IN range(1, 7)], '') AS a FROM rows),
levels AS (SELECT doc_id, b, d, left(a, d) AS prefix FROM (SELECT *, unnest(range(0, 25)) AS d FROM bits)),
buckets AS (SELECT prefix, sum(b) AS total, count(*) AS n FROM levels GROUP BY prefix),
leaf AS (SELECT l.doc_id, l.b, l.d, l.prefix, k.total, k.n, row_number() OVER (PARTITION BY l.doc_id ORDER BY l.d) AS r
         FROM levels l JOIN buckets k USING (prefix) WHERE greatest(k.total, k.n) <= {sharding.LIMIT} OR k.n = 1)
SELECT doc_id, CAST(b AS BIGINT) AS n_bytes, 's' || prefix AS shard, CAST(d AS INTEGER) AS depth, CAST(total AS BIGINT) AS shard_bytes,
       CAST(n AS BIGINT) AS shard_rows
FROM leaf WHERE r = 1"""

RANKED_SEARCH = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
corpus AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM docs WHERE len(ws) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ws) AS term FROM docs) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark)),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM df, corpus),
parts AS (SELECT i.item_id, d.r, d.doc_id,
                 w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (100 - 90 + (90 * len(d.ws) * n_docs) // n_terms))) AS part
          FROM items i JOIN tf ON i.term = tf.term JOIN weights w ON w.term = i.term JOIN docs d ON d.r = tf.r, corpus),
scored AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
                  doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10"""
