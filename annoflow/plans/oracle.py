"""SQL forms of the derived views and of every registered query.

These strings run on DuckDB against the raw tables (region ... conversations)
and serve as an independent oracle for the DataFrame implementations.
"""

from __future__ import annotations

ANNOTATIONS = """
annotations AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
                   CAST(l_quantity AS BIGINT), CAST(round(l_discount * 100) AS BIGINT),
                   CAST(round(l_tax * 100) AS BIGINT)) AS id,
         l_orderkey AS tweet_id,
         'status ' || CAST(l_orderkey AS VARCHAR) AS text,
         CAST(ascii(l_linestatus) AS BIGINT) AS question_id,
         l_linestatus AS question_tag,
         CAST(ascii(l_returnflag) AS BIGINT) AS answer_id,
         l_returnflag AS answer_tag,
         l_suppkey AS annotator_id,
         CASE WHEN l_tax = 0.08 THEN 'incorrect' WHEN l_tax = 0.0 THEN 'correct' ELSE 'default' END AS flag,
         CASE WHEN l_discount >= 0.05 THEN 'mturk' ELSE 'local' END AS mode,
         {'pos': (l_orderkey * 8 + l_linenumber) * 100000000000 + l_partkey * 100000 + l_suppkey,
          'id': concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
                          CAST(l_quantity AS BIGINT), CAST(round(l_discount * 100) AS BIGINT),
                          CAST(round(l_tax * 100) AS BIGINT))} AS seq,
         CASE WHEN l_discount = 0.0 THEN NULL
              WHEN l_discount >= 0.05 THEN l_quantity
              ELSE (l_quantity * 1000 + l_linenumber * 250) / 1000.0 END AS total_time
  FROM lineitem)
"""

# F8 survivors
ANN_OK = """
a AS (SELECT * FROM annotations
      WHERE id IS NOT NULL AND text IS NOT NULL AND question_id IS NOT NULL AND answer_id IS NOT NULL)
"""


def _merge(source: str, cutoff: int, rule: str) -> str:
    """Consensus over rows of ``source`` (a CTE of annotation rows)."""
    if rule == "majority":
        cond = "n_top = 1"
    elif rule == "unanimous":
        cond = "n_answers = 1"
    else:  # share threshold
        cond = f"CAST(n AS DOUBLE) / total > {rule}"
    return f"""
g AS (SELECT tweet_id, question_tag, answer_tag, count(*) AS n, min(seq) AS first_seq,
             arg_min(answer_id, seq) AS answer_id
      FROM {source} WHERE tweet_id IS NOT NULL AND question_tag IS NOT NULL
      GROUP BY tweet_id, question_tag, answer_tag),
r AS (SELECT *, sum(n) OVER w AS total, max(n) OVER w AS top, count(*) OVER w AS n_answers,
             row_number() OVER (PARTITION BY tweet_id, question_tag ORDER BY n DESC, first_seq) AS rk
      FROM g WINDOW w AS (PARTITION BY tweet_id, question_tag)),
t AS (SELECT *, sum(CASE WHEN n = top THEN 1 ELSE 0 END) OVER (PARTITION BY tweet_id, question_tag) AS n_top
      FROM r),
f AS (SELECT tweet_id, question_tag, arg_min(text, seq) AS text, arg_min(question_id, seq) AS question_id
      FROM {source} WHERE tweet_id IS NOT NULL AND question_tag IS NOT NULL GROUP BY tweet_id, question_tag)
SELECT t.tweet_id AS id, f.text, f.question_id, t.question_tag, t.answer_id AS label_id, t.answer_tag AS label_tag
FROM t JOIN f USING (tweet_id, question_tag)
WHERE rk = 1 AND total >= {cutoff} AND {cond} AND answer_tag IS NOT NULL
"""


LABEL_MAJORITY = f"WITH {ANNOTATIONS}, {ANN_OK}, {_merge('a', 3, 'majority')}"
LABEL_UNANIMOUS = f"WITH {ANNOTATIONS}, {ANN_OK}, {_merge('a', 3, 'unanimous')}"
LABEL_AGREEMENT_GT = f"WITH {ANNOTATIONS}, {ANN_OK}, {_merge('a', 2, '0.6')}"

ROW_COLS = "id, tweet_id, question_tag, answer_tag, annotator_id, flag"

EXCLUDE_INCORRECT_ROWS = f"""
WITH {ANNOTATIONS},
bad AS (SELECT DISTINCT tweet_id, question_tag, answer_tag FROM annotations
        WHERE flag = 'incorrect' AND tweet_id IS NOT NULL AND question_tag IS NOT NULL AND answer_tag IS NOT NULL)
SELECT {ROW_COLS} FROM annotations x
WHERE flag IN ('default', 'correct')
  AND NOT EXISTS (SELECT 1 FROM bad b WHERE b.tweet_id = x.tweet_id AND b.question_tag = x.question_tag
                  AND b.answer_tag = x.answer_tag)
"""

LABEL_CUTOFF_ROWS = f"""
WITH {ANNOTATIONS},
big AS (SELECT tweet_id, question_tag FROM annotations WHERE tweet_id IS NOT NULL AND question_tag IS NOT NULL
        GROUP BY tweet_id, question_tag HAVING count(*) >= 3)
SELECT {ROW_COLS} FROM annotations x WHERE (tweet_id, question_tag) IN (SELECT (tweet_id, question_tag) FROM big)
"""

IS_RELEVANT_ROWS = f"""
WITH {ANNOTATIONS}
SELECT {ROW_COLS} FROM annotations
WHERE tweet_id IN (SELECT tweet_id FROM annotations WHERE answer_tag = 'A')
"""

# agreement per annotator (A6): last answer per (tweet, question, annotator)
AGREEMENT_CTE = """
fin AS (SELECT tweet_id, question_tag, annotator_id, arg_max(answer_tag, seq) AS answer_tag
        FROM a WHERE tweet_id IS NOT NULL AND annotator_id IS NOT NULL AND question_tag IS NOT NULL
        GROUP BY tweet_id, question_tag, annotator_id),
fin2 AS (SELECT * FROM fin WHERE answer_tag IS NOT NULL),
cnt AS (SELECT *, count(*) OVER (PARTITION BY tweet_id, question_tag, answer_tag) AS n_x,
               count(*) OVER (PARTITION BY tweet_id, question_tag) AS n FROM fin2),
ag AS (SELECT annotator_id, CAST(sum(n_x - 1) AS BIGINT) AS agreement_count, CAST(sum(n - 1) AS BIGINT) AS total_count,
              CASE WHEN sum(n - 1) = 0 THEN NULL ELSE CAST(sum(n_x - 1) AS DOUBLE) / sum(n - 1) END AS agreement_ratio
       FROM cnt GROUP BY annotator_id)
"""

ANNOTATOR_AGREEMENT = f"""
WITH {ANNOTATIONS}, {ANN_OK}, {AGREEMENT_CTE}
SELECT annotator_id, agreement_count, total_count, round(agreement_ratio, 9) AS agreement_ratio FROM ag
"""


def _zscore_sql(src: str, value: str, out: str) -> str:
    """Below-median robust z-score CTE chain over ``src`` for column ``value``."""
    return f"""
{out}_m AS (SELECT median({value}) AS med FROM {src}),
{out}_d AS (SELECT median(abs({value} - (SELECT med FROM {out}_m))) AS mad FROM {src}),
{out} AS (SELECT s.*, CASE WHEN s.{value} < m.med THEN
              CASE WHEN d.mad = 0 THEN 'Infinity'::DOUBLE ELSE abs(s.{value} - m.med) / d.mad END END AS z
          FROM {src} s, {out}_m m, {out}_d d)
"""


OUTLIERS_BODY = f"""
WITH {ANNOTATIONS}, a AS (SELECT * FROM annotations), {AGREEMENT_CTE},
pw AS (SELECT annotator_id, count(DISTINCT tweet_id) AS qs_count,
              CASE WHEN count(DISTINCT tweet_id) >= 3 THEN avg(total_time) END AS time_values
       FROM a WHERE annotator_id IS NOT NULL GROUP BY annotator_id HAVING count(DISTINCT tweet_id) > 0),
{_zscore_sql('pw', 'time_values', 'tz')},
agc AS (SELECT annotator_id, agreement_ratio AS agreement_values FROM ag WHERE total_count >= 20),
{_zscore_sql('agc', 'agreement_values', 'az')},
o AS (SELECT tz.annotator_id, tz.time_values, tz.z AS time_zscores, az.z AS agreement_zscores,
             CASE WHEN tz.qs_count >= 3 THEN CASE WHEN tz.z > 3 THEN 'outlier' ELSE 'no_outlier' END END AS time_outlier,
             az.agreement_values,
             CASE WHEN az.annotator_id IS NOT NULL THEN CASE WHEN az.z > 3 THEN 'outlier' ELSE 'no_outlier' END END
               AS agreement_outlier
      FROM tz LEFT JOIN az ON tz.annotator_id = az.annotator_id)
"""


def _summary(by: str) -> str:
    return f"""SELECT '{by}' AS criterion, count(*) AS n_annotators,
       count(*) FILTER (WHERE {by}_outlier = 'outlier') AS n_outlier,
       count(*) FILTER (WHERE {by}_outlier = 'no_outlier') AS n_no_outlier,
       count(*) FILTER (WHERE {by}_outlier IS NULL) AS n_not_considered,
       round(100.0 * count(*) FILTER (WHERE {by}_outlier = 'outlier') / count(*), 9) AS pct_outlier,
       round(avg({by}_values), 9) AS mean_value, round(median({by}_values), 9) AS median_value,
       round(min({by}_values), 9) AS min_value, round(max({by}_values), 9) AS max_value FROM o"""


OUTLIER_SUMMARY = OUTLIERS_BODY + _summary("agreement") + " UNION ALL " + _summary("time")

OUTLIER_LIST = OUTLIERS_BODY + " UNION ALL ".join(
    f"""SELECT '{by}' AS criterion, annotator_id, round({by}_values, 9) AS value, round({by}_zscores, 9) AS zscore
FROM o WHERE {by}_outlier = 'outlier'""" for by in ("agreement", "time"))

OUTLIERS_IN_BOTH = OUTLIERS_BODY + "SELECT annotator_id FROM o WHERE time_outlier = 'outlier' AND agreement_outlier = 'outlier'"

ANNOTATOR_OUTLIERS = f"""
WITH {ANNOTATIONS}, a AS (SELECT * FROM annotations), {AGREEMENT_CTE},
pw AS (SELECT annotator_id, count(DISTINCT tweet_id) AS qs_count,
              CASE WHEN count(DISTINCT tweet_id) >= 3 THEN avg(total_time) END AS time_values
       FROM a WHERE annotator_id IS NOT NULL GROUP BY annotator_id HAVING count(DISTINCT tweet_id) > 0),
{_zscore_sql('pw', 'time_values', 'tz')},
agc AS (SELECT annotator_id, agreement_ratio AS agreement_values FROM ag WHERE total_count >= 20),
{_zscore_sql('agc', 'agreement_values', 'az')}
SELECT tz.annotator_id, tz.qs_count, round(tz.time_values, 9) AS time_values, round(tz.z, 9) AS time_zscores,
       CASE WHEN tz.qs_count >= 3 THEN CASE WHEN tz.z > 3 THEN 'outlier' ELSE 'no_outlier' END END AS time_outlier,
       round(az.agreement_values, 9) AS agreement_values, round(az.z, 9) AS agreement_zscores,
       CASE WHEN az.annotator_id IS NOT NULL THEN CASE WHEN az.z > 3 THEN 'outlier' ELSE 'no_outlier' END END
         AS agreement_outlier
FROM tz LEFT JOIN az ON tz.annotator_id = az.annotator_id
"""

FLEISS_KAPPA = f"""
WITH {ANNOTATIONS},
a AS (SELECT * FROM annotations WHERE tweet_id IS NOT NULL AND question_tag IS NOT NULL AND answer_tag IS NOT NULL),
cells AS (SELECT mode, question_tag, tweet_id, answer_tag, count(*) AS n_ij FROM a GROUP BY ALL),
pt AS (SELECT mode, question_tag, tweet_id, sum(n_ij) AS n_i, sum(n_ij * n_ij) AS s2 FROM cells GROUP BY ALL),
obs AS (SELECT mode, question_tag,
               avg(CASE WHEN n_i > 1 THEN (s2 - n_i) / (n_i * (n_i - 1)) END) AS p_bar, count(*) AS n_tweets
        FROM pt GROUP BY ALL),
pa AS (SELECT mode, question_tag, answer_tag, sum(n_ij) AS n_j FROM cells GROUP BY ALL),
ch AS (SELECT mode, question_tag, CAST(sum(n_j * n_j) AS DOUBLE) / pow(CAST(sum(n_j) AS DOUBLE), 2) AS p_e
       FROM pa GROUP BY ALL)
SELECT mode, question_tag, n_tweets, round(p_bar, 9) AS p_bar, round(p_e, 9) AS p_e,
       round(CASE WHEN p_e = 1 THEN NULL ELSE (p_bar - p_e) / (1 - p_e) END, 9) AS kappa
FROM obs JOIN ch USING (mode, question_tag) WHERE n_tweets > 20
"""

# ---- text views and functions (RE2 spellings of the Java patterns)

WS_RE2 = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
URL_RE2 = rf"((www\.[^{WS_RE2}]+)|(https?://[^{WS_RE2}]+)|(http?://[^{WS_RE2}]+))"
USER_RE2 = r"(^|[^@\p{L}\p{N}_])@([\p{L}\p{N}_]{1,15})($|[^\p{L}\p{N}_])"


def _collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[{WS_RE2}]+', ' ', 'g'), '^ | $', '', 'g')"


def _normalize(x: str) -> str:
    y = f"regexp_replace(regexp_replace(coalesce({x}, ''), '[\\r\\n\\t]+', ' ', 'g'), '\\p{{C}}', '', 'g')"
    return _collapse(y)


def _anonymize(x: str) -> str:
    u = f"replace(regexp_replace({x}, '{URL_RE2}', '<url>', 'g'), '<url>', ' <url> ')"
    u = _collapse(u)
    v = f"replace(regexp_replace({u}, '{USER_RE2}', '@user\\3', 'g'), '@user', ' @user ')"
    return _collapse(v)


TEXTS = """
texts AS (
  SELECT d.doc_id AS id,
         'RT @' || d.source || ': see ' || coalesce(p.url, '') || ' ' || d.text AS text,
         d.text AS raw_text, d.lang, p.url, d.source AS mentions
  FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id)
"""

NORMALIZE_TEXT = f"SELECT doc_id AS id, {_normalize('text')} AS text FROM documents"

TEXT_HASH = f"SELECT doc_id AS id, md5({_normalize('text')}) AS text_hash FROM documents"

ANONYMIZE_TEXT = f"WITH {TEXTS} SELECT id, {_anonymize('text')} AS text FROM texts"

TEXT_CLEARED = f"""WITH {TEXTS}
SELECT id, {_collapse("regexp_replace(lower(" + _anonymize('text') + "), 'rt @user:|@user|<url>', '', 'g')")}
       AS text_cleared FROM texts"""


def _token_count(x: str) -> str:
    from annoflow.functions.stopwords import ENGLISH_STOP_WORDS
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
    y = f"regexp_replace(regexp_replace({x}, '{URL_RE2}', '', 'g'), '(@[^{WS_RE2}]+)', '', 'g')"
    return (f"CAST(len(list_filter(regexp_extract_all({y}, '\\p{{L}}+'), "
            f"lambda t: NOT list_contains([{stops}], lower(t)))) AS INTEGER)")


TOKEN_COUNT = f"SELECT doc_id AS id, {_token_count(_normalize('text'))} AS token_count FROM documents"

KEYWORDS = ("licen[cs]e", "mit", "example\\.org")
_KW = "|".join(f"(?:{k})" for k in KEYWORDS)

CONTAINS_KEYWORDS = f"""WITH {TEXTS}
SELECT id, (regexp_matches(lower(text || mentions), '{_KW}')
            OR coalesce(regexp_matches(lower(url), '(\\b|\\d|_)(?:{_KW})(\\b|\\d|_|cas)'), false))
           AS contains_keywords
FROM texts"""

# ---- annotation statistics

QS = """
qs AS (SELECT annotator_id, tweet_id, count(*) AS results_count FROM annotations
       WHERE annotator_id IS NOT NULL AND tweet_id IS NOT NULL GROUP BY annotator_id, tweet_id)
"""

QS_HISTOGRAM = f"""WITH {ANNOTATIONS}, {QS}
SELECT results_count, count(*) AS n_qs FROM qs GROUP BY results_count"""

WORKERS_PER_TWEET = f"""WITH {ANNOTATIONS}, {QS}
SELECT n_workers, count(*) AS n_tweets FROM (SELECT tweet_id, count(*) AS n_workers FROM qs GROUP BY tweet_id)
GROUP BY n_workers"""

TIME_PER_WORKER = f"""WITH {ANNOTATIONS}
SELECT annotator_id, count(*) AS n_results, count(DISTINCT tweet_id) AS n_qs, round(avg(total_time), 9) AS mean_time
FROM annotations WHERE annotator_id IS NOT NULL GROUP BY annotator_id"""

QS_TIMES = """
qt AS (SELECT annotator_id, tweet_id, arg_min(total_time, seq) AS total_time FROM annotations
       WHERE annotator_id IS NOT NULL AND tweet_id IS NOT NULL AND total_time IS NOT NULL
       GROUP BY annotator_id, tweet_id)
"""

TIME_PER_QS = f"""WITH {ANNOTATIONS}, {QS_TIMES}
SELECT count(*) AS n_qs, round(avg(total_time), 9) AS mean_time, round(median(total_time), 9) AS median_time
FROM qt"""

FASTEST_WORKERS = f"""WITH {ANNOTATIONS},
w AS (SELECT round(avg(total_time), 9) AS mean_time FROM annotations WHERE annotator_id IS NOT NULL
      GROUP BY annotator_id)
SELECT mean_time, CAST(row_number() OVER (ORDER BY mean_time) AS INTEGER) AS rank FROM w WHERE mean_time IS NOT NULL
ORDER BY mean_time LIMIT 10"""

TIME_HISTOGRAM = f"""WITH {ANNOTATIONS}, {QS_TIMES}
SELECT CAST(floor(total_time / 5.0) AS BIGINT) AS bin, count(*) AS n,
       CAST(floor(total_time / 5.0) AS DOUBLE) * 5.0 AS lower
FROM qt GROUP BY 1, 3"""

CLEANED = """
cleaned AS (
  SELECT l.doc_id AS id, d.text, CAST(1 AS BIGINT) AS question_id, 'quality' AS question_tag,
         CAST(l.quality AS BIGINT) AS label_id, CAST(l.quality AS VARCHAR) AS label_tag
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id
  UNION ALL
  SELECT l.doc_id, d.text, CAST(2 AS BIGINT), 'toxic', CAST(l.toxic AS BIGINT), CAST(l.toxic AS VARCHAR)
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
"""

LABEL_SHARE = f"""WITH {CLEANED}
SELECT question_tag, label_tag, count(*) AS n,
       round(100.0 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY question_tag), 9) AS pct
FROM cleaned GROUP BY question_tag, label_tag"""

CLEANED_SUMMARY = f"""WITH {CLEANED}
SELECT count(*) AS n_labels, count(DISTINCT id) AS n_tweets FROM cleaned"""

# ---- interactions and dedup

STATUSES = """
statuses AS (
  SELECT event_id AS id, ts AS created_at, user_id, event_type,
         CASE event_type WHEN 'click' THEN 'reply' WHEN 'purchase' THEN 'quote' WHEN 'view' THEN 'retweet' END AS kind,
         CASE WHEN event_type IN ('click', 'purchase', 'view')
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS target_id,
         value,
         'Event ' || event_type || ' by @u' || CAST(user_id AS VARCHAR) || ' see http://e.example/'
           || CAST(event_id AS VARCHAR) AS text
  FROM events)
"""


def _counts(src: str) -> str:
    return f"""(SELECT target_id AS id,
         count(*) FILTER (WHERE kind = 'quote') AS num_quotes,
         count(*) FILTER (WHERE kind = 'reply') AS num_replies,
         count(*) FILTER (WHERE kind = 'retweet') AS num_retweets
  FROM (SELECT DISTINCT id AS source_id, kind, target_id FROM {src}
        WHERE kind IS NOT NULL AND target_id IS NOT NULL) GROUP BY target_id)"""


INTERACTION_COUNTS = f"WITH {STATUSES} SELECT * FROM {_counts('statuses')}"

PARSED_WITH_COUNTS = f"""WITH {STATUSES}, c AS {_counts('statuses')}
SELECT s.id, s.created_at, s.kind, coalesce(c.num_quotes, 0) AS num_quotes,
       coalesce(c.num_replies, 0) AS num_replies, coalesce(c.num_retweets, 0) AS num_retweets
FROM statuses s LEFT JOIN c ON s.id = c.id"""

# merging the two overlapping batches must equal counting everything once
EXTEND_MERGE = f"""WITH {STATUSES}, c AS {_counts('statuses')}
SELECT s.id, s.created_at, coalesce(c.num_quotes, 0) AS num_quotes,
       coalesce(c.num_replies, 0) AS num_replies, coalesce(c.num_retweets, 0) AS num_retweets
FROM statuses s LEFT JOIN c ON s.id = c.id"""

DEDUP_BY_ID = f"""WITH {STATUSES},
rows AS (
  SELECT id, created_at, user_id, 0 AS priority, created_at AS seen_at, id AS source_id FROM statuses
  UNION ALL
  SELECT CASE WHEN s.kind = 'quote' THEN -1 - o.id ELSE o.id END, o.created_at, o.user_id, 1, s.created_at, s.id
  FROM statuses s JOIN statuses o ON s.target_id = o.id WHERE s.kind IN ('quote', 'retweet'))
SELECT id, created_at, user_id, priority, seen_at, source_id FROM rows
QUALIFY row_number() OVER (PARTITION BY id ORDER BY priority, seen_at, source_id) = 1"""

# ---- sampling and splits


def _key(seed: int, col: str) -> str:
    return f"md5('{seed}:' || CAST({col} AS VARCHAR))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g')"


RANDOM_SAMPLE = f"""WITH {TEXTS},
f AS (SELECT id, text FROM texts WHERE {_token_count(_normalize('raw_text'))} > 3 AND lang IN ('en', 'fr')),
d AS (SELECT * FROM f
      QUALIFY row_number() OVER (PARTITION BY {_strip("regexp_replace(text, '@<user>|<url>', '', 'g')")}
                                 ORDER BY id) = 1)
SELECT id, {_anonymize('text')} AS text FROM d ORDER BY {_key(42, 'id')}, id LIMIT 100"""

MONTHLY_SAMPLE = f"""
WITH o AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS bin FROM orders),
q AS (SELECT CAST(trunc(800 / CAST(count(DISTINCT bin) AS DOUBLE)) AS BIGINT) AS bin_size FROM o)
SELECT id, bin FROM o
QUALIFY row_number() OVER (PARTITION BY bin ORDER BY {_key(7, 'id')}, id) <= (SELECT bin_size FROM q)"""

SAMPLE_TABLES = f"""
s AS (SELECT doc_id AS tweet_id, text AS tweet_text,
             row_number() OVER (ORDER BY {_key(42, 'doc_id')}, doc_id) - 1 AS sample_pos FROM documents),
un AS (SELECT doc_id AS tweet_id FROM documents WHERE lang = 'de'),
lab AS (SELECT doc_id AS tweet_id FROM labels),
bat AS (SELECT doc_id AS tweet_id FROM documents WHERE source = 'src0')
"""

NEXT_BATCH = f"""WITH {SAMPLE_TABLES}
SELECT tweet_id, tweet_text, sample_pos, 2 AS batch_id FROM s
WHERE tweet_id NOT IN (SELECT tweet_id FROM un) AND tweet_id NOT IN (SELECT tweet_id FROM lab)
  AND tweet_id NOT IN (SELECT tweet_id FROM bat)
ORDER BY sample_pos DESC LIMIT 25"""

SAMPLE_STATS = f"""WITH {SAMPLE_TABLES},
ids AS (SELECT tweet_id FROM s UNION SELECT tweet_id FROM un UNION SELECT tweet_id FROM lab
        UNION SELECT tweet_id FROM bat),
f AS (SELECT tweet_id,
             tweet_id IN (SELECT tweet_id FROM s) AS is_s, tweet_id IN (SELECT tweet_id FROM un) AS is_u,
             tweet_id IN (SELECT tweet_id FROM lab) AS is_l, tweet_id IN (SELECT tweet_id FROM bat) AS is_b
      FROM ids)
SELECT count(*) FILTER (WHERE is_s) AS n_sampled, count(*) FILTER (WHERE is_u) AS n_unavailable,
       count(*) FILTER (WHERE is_b) AS n_batched, count(*) FILTER (WHERE is_l) AS n_labelled,
       count(*) FILTER (WHERE is_s AND NOT is_u AND NOT is_l AND NOT is_b) AS n_left,
       count(*) FILTER (WHERE is_s AND NOT is_u AND NOT is_b) AS n_left_incl_labelled,
       round(100.0 * CAST(count(*) FILTER (WHERE is_l) AS DOUBLE) / count(*) FILTER (WHERE is_s), 9) AS pct_labelled
FROM f"""

SAMPLE_DISTRIBUTION = f"""
WITH o AS (SELECT o_orderkey AS id, o_orderdate AS created_at FROM orders),
q AS (SELECT CAST(trunc(800 / CAST(count(DISTINCT strftime(created_at, '%Y-%m')) AS DOUBLE)) AS BIGINT) AS bin_size
      FROM o),
smp AS (SELECT id FROM o QUALIFY row_number() OVER (PARTITION BY strftime(created_at, '%Y-%m')
                                                    ORDER BY {_key(7, 'id')}, id) <= (SELECT bin_size FROM q)),
base AS (SELECT min(created_at) AS b FROM o),
idx AS (SELECT id, created_at, row_number() OVER (ORDER BY created_at, id) - 1 AS idx FROM o)
SELECT id, idx, CAST(date_diff('day', CAST(b AS DATE), CAST(created_at AS DATE)) AS INTEGER) AS day_idx,
       CAST((year(created_at) - year(b)) * 12 + month(created_at) - month(b) AS INTEGER) AS month_idx,
       CAST(year(created_at) - year(b) AS INTEGER) AS year_idx
FROM idx, base WHERE id IN (SELECT id FROM smp)"""


def _split_sql(source: str, seed: int, f1: float, f2: float) -> str:
    return f"""
k AS (SELECT id, question_tag, label,
             row_number() OVER (PARTITION BY question_tag ORDER BY {_key(seed, 'id')}, id) - 1 AS pos,
             count(*) OVER (PARTITION BY question_tag) AS n FROM {source})
SELECT id, question_tag, label,
       CASE WHEN pos < CAST(trunc(CAST('{f1!r}' AS DOUBLE) * n) AS BIGINT) THEN 'train'
            WHEN pos < CAST(trunc(CAST('{f2!r}' AS DOUBLE) * n) AS BIGINT) THEN 'dev' ELSE 'test' END AS split
FROM k"""


_F1, _F2 = (1 - 0.2 - 0.2), (1 - 0.2)

TRAIN_DEV_TEST_SPLIT = f"""WITH {CLEANED},
c AS (SELECT id, question_tag, label_tag AS label FROM cleaned),
{_split_sql('c', 42, _F1, _F2)}"""

BALANCED_SPLIT = f"""WITH {CLEANED},
c0 AS (SELECT id, question_tag, label_tag AS label FROM cleaned),
m AS (SELECT question_tag, min(n) AS min_class
      FROM (SELECT question_tag, label, count(*) AS n FROM c0 GROUP BY ALL) GROUP BY question_tag),
c AS (SELECT c0.* FROM c0 JOIN m USING (question_tag)
      QUALIFY row_number() OVER (PARTITION BY c0.question_tag, c0.label ORDER BY {_key(42, 'c0.id')}, c0.id)
              <= m.min_class),
{_split_sql('c', 42, _F1, _F2)}"""

PRETRAIN_SPLIT = f"""WITH {TEXTS},
f AS (SELECT id, text FROM texts WHERE lang = 'en' AND {_token_count(_normalize('raw_text'))} >= 3),
d AS (SELECT id FROM f QUALIFY row_number() OVER (
        PARTITION BY {_collapse("regexp_replace(lower(" + _anonymize('text') + "), 'rt @user:|@user|<url>', '', 'g')")}
        ORDER BY id) = 1),
k AS (SELECT id, row_number() OVER (ORDER BY {_key(42, 'id')}, id) - 1 AS pos, count(*) OVER () AS n FROM d)
SELECT id, CASE WHEN pos < greatest(CAST(trunc(0.8 * n) AS BIGINT), n - 200000) THEN 'train' ELSE 'dev' END AS split
FROM k"""

HAS_LABEL_FILTER = f"""WITH {CLEANED}
SELECT id, question_tag, label_tag FROM cleaned
WHERE id IN (SELECT id FROM cleaned WHERE label_tag IN ('1')) AND id IN (SELECT id FROM cleaned WHERE label_tag IN ('0'))"""

# ---- raw parsing: every event comes back as one parsed status

EV_TEXT = """
ev AS (SELECT *, CASE WHEN event_type IN ('click', 'purchase', 'view')
                      THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS target,
              'Event ' || event_type || ' of user ' || CAST(user_id AS VARCHAR) || ' & value '
              || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || ' end' AS norm_text
       FROM events)
"""

PARSE_STATUSES = f"""WITH {EV_TEXT}, {STATUSES}, c AS {_counts('statuses')},
p AS (SELECT CAST(e.event_id AS VARCHAR) AS id,
             CASE WHEN e.event_type = 'view' THEN t.norm_text ELSE e.norm_text END AS text,
             e.event_type = 'view' AS is_retweet, e.event_type = 'purchase' AS has_quote,
             e.event_type = 'click' AS is_reply,
             CASE WHEN e.event_type = 'view' THEN CAST(e.target AS VARCHAR) END AS retweeted_status_id,
             CASE WHEN e.event_type = 'purchase' THEN CAST(e.target AS VARCHAR) END AS quoted_status_id,
             CASE WHEN e.event_type = 'click' THEN CAST(e.target AS VARCHAR) END AS in_reply_to_status_id,
             CAST(e.user_id AS VARCHAR) AS user_id, 'about user ' || CAST(e.user_id AS VARCHAR) AS user_description,
             e.user_id % 2 = 0 AS user_is_verified,
             strftime(date_trunc('second', e.ts), '%Y-%m-%d %H:%M:%S') AS created_at,
             CAST(CAST(e.ts AS DATE) AS VARCHAR) AS created_day,
             coalesce(c.num_replies, 0) AS num_replies, coalesce(c.num_quotes, 0) AS num_quotes,
             coalesce(c.num_retweets, 0) AS num_retweets
      FROM ev e LEFT JOIN ev t ON e.target = t.event_id LEFT JOIN c ON e.event_id = c.id)
SELECT *, {_token_count('text')} AS token_count FROM p"""

GEO_ENRICH = f"""WITH ev AS (SELECT event_id, event_type, user_id,
                    (value * 7.3) % 360 - 180 AS x, (value * 3.1) % 160 - 80 AS y FROM events),
boxes AS (SELECT n_nationkey AS k, 'N' || chr(65 + n_nationkey) AS iso, n_name, r_name,
                 -150.0 + (n_nationkey % 5) * 60.0 AS x0, -80.0 + floor(n_nationkey / 5) * 32.0 AS y0
          FROM nation JOIN region ON n_regionkey = r_regionkey),
gaz AS (SELECT lower(n_name) AS name, -125.0 + (n_nationkey % 5) * 60.0 AS gx,
               -66.0 + floor(n_nationkey / 5) * 32.0 AS gy,
               CASE WHEN n_nationkey % 7 = 3 THEN '' ELSE 'N' || chr(65 + n_nationkey) END AS gcode,
               'g' || CAST(n_nationkey AS VARCHAR) AS gid FROM nation),
g AS (SELECT e.event_id, e.user_id,
             CASE WHEN event_type = 'signup' THEN 1 WHEN event_type = 'error' THEN 2
                  WHEN z.name IS NOT NULL THEN 3 ELSE 0 END AS geo_type,
             CASE WHEN event_type IN ('signup', 'error') THEN x ELSE z.gx END AS lon,
             CASE WHEN event_type IN ('signup', 'error') THEN y ELSE z.gy END AS lat,
             CASE WHEN event_type = 'error' THEN
                    CASE WHEN e.user_id % 2 = 0 THEN '' ELSE 'N' || chr(CAST(65 + e.user_id % 25 AS INTEGER)) END
                  WHEN event_type = 'signup' THEN NULL ELSE z.gcode END AS given,
             CASE WHEN event_type = 'error' THEN 'city' WHEN event_type = 'signup' THEN NULL
                  ELSE CASE WHEN z.name IS NOT NULL THEN 'country' END END AS location_type,
             CASE WHEN event_type NOT IN ('signup', 'error') THEN z.gid END AS geoname_id
      FROM ev e LEFT JOIN gaz z ON z.name = 'nation_' || CAST(e.user_id % 25 AS VARCHAR)),
need AS (SELECT DISTINCT lon, lat FROM g WHERE geo_type = 1 OR (geo_type IN (2, 3) AND given = '')),
d AS (SELECT n.lon, n.lat, b.iso, b.k,
             sqrt(pow(greatest(b.x0 - n.lon, 0, n.lon - (b.x0 + 50)), 2)
                  + pow(greatest(b.y0 - n.lat, 0, n.lat - (b.y0 + 28)), 2)) AS dist,
             n.lon > b.x0 AND n.lon < b.x0 + 50 AND n.lat > b.y0 AND n.lat < b.y0 + 28 AS inside
      FROM need n, boxes b),
pip AS (SELECT lon, lat, arg_min(iso, (NOT inside, CASE WHEN inside THEN 0 ELSE dist END, k)) AS code
        FROM d GROUP BY lon, lat)
SELECT CAST(g.event_id AS VARCHAR) AS id, g.geo_type, round(g.lon, 6) AS longitude, round(g.lat, 6) AS latitude,
       CASE WHEN g.geo_type = 1 OR (g.geo_type IN (2, 3) AND g.given = '') THEN pip.code ELSE g.given END
         AS country_code,
       g.geoname_id, g.location_type, b.r_name AS region, b.n_name AS subregion
FROM g LEFT JOIN pip ON g.lon = pip.lon AND g.lat = pip.lat
LEFT JOIN boxes b ON b.iso = (CASE WHEN g.geo_type = 1 OR (g.geo_type IN (2, 3) AND g.given = '')
                                   THEN pip.code ELSE g.given END)"""

# ---- windows, regions, privacy, predictions, overview

DATE_WINDOW_SCAN = f"""WITH {STATUSES}
SELECT id, created_at, kind FROM statuses
WHERE CAST(created_at AS DATE) >= DATE '2024-01-05' AND CAST(created_at AS DATE) < DATE '2024-01-12'"""

OMIT_LAST_DAY = f"""WITH {STATUSES}
SELECT id, created_at FROM statuses
WHERE CAST(created_at AS DATE) < (SELECT max(CAST(created_at AS DATE)) FROM statuses)"""

REGION_LOOKUP = """
SELECT c_custkey, 'N' || chr(65 + c_nationkey) AS country_code, r_name AS region, n_name AS subregion
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

ENCRYPT_ROUNDTRIP = """
SELECT c_custkey, c_custkey AS key_dec, c_name AS name_dec, c_mktsegment || '|' || c_name AS list_dec, true AS hidden FROM customer"""

PREDICTION_JOIN = """
SELECT d.doc_id AS id, d.lang,
       CAST(l.quality AS VARCHAR) AS label_quality,
       CASE WHEN l.doc_id IS NOT NULL THEN CAST(round(0.5 + (l.doc_id % 50) / 100.0, 6) AS DOUBLE) END
         AS probability_quality,
       CAST(l.toxic AS VARCHAR) AS label_toxic,
       CASE WHEN l.doc_id IS NOT NULL THEN CAST(round(0.5 + (l.doc_id % 50) / 100.0, 6) AS DOUBLE) END
         AS probability_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

MEMBERSHIP_FLAGS = """
SELECT d.doc_id AS id, d.source = 'src0' AS S,
       d.doc_id IN (SELECT doc_id FROM labels) AS L,
       d.doc_id IN (SELECT doc_id FROM labels) AS A
FROM documents d"""

STAGE_OVERVIEW = """
SELECT 'raw_lines' AS stage, (SELECT count(*) FROM events)
       + (SELECT count(DISTINCT strftime(ts, '%Y%m%d%H')) FROM events) AS n
UNION ALL SELECT 'parsed', count(*) FROM events
UNION ALL SELECT 'sampled', count(*) FROM documents
UNION ALL SELECT 'cleaned_labels', 2 * count(*) FROM labels l JOIN documents d ON l.doc_id = d.doc_id
UNION ALL SELECT 'annotations_' || CASE WHEN l_discount >= 0.05 THEN 'mturk' ELSE 'local' END, count(*)
FROM lineitem GROUP BY 1"""


# ---- cleaning metrics and the full cleaning chain

_CLEAN_CHAIN = """
bad AS (SELECT DISTINCT tweet_id, question_tag, answer_tag FROM a
        WHERE flag = 'incorrect' AND tweet_id IS NOT NULL AND question_tag IS NOT NULL AND answer_tag IS NOT NULL),
ok AS (SELECT * FROM a x WHERE tweet_id IS NOT NULL AND flag IN ('default', 'correct')
       AND NOT EXISTS (SELECT 1 FROM bad b WHERE b.tweet_id = x.tweet_id AND b.question_tag = x.question_tag
                       AND b.answer_tag = x.answer_tag)),
rel AS (SELECT * FROM ok WHERE tweet_id IN (SELECT tweet_id FROM ok WHERE answer_tag = 'A'))
"""

CLEAN_STEPS = f"""WITH {ANNOTATIONS}, {ANN_OK}, {_CLEAN_CHAIN},
cut AS (SELECT * FROM rel WHERE question_tag IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY tweet_id, question_tag) >= 3),
kw AS (SELECT * FROM cut WHERE tweet_id IN (SELECT event_id FROM events WHERE event_type IN ('click', 'purchase', 'view'))),
steps AS (
SELECT 0 AS o, 'start' AS step, count(*) AS n_rows FROM annotations
UNION ALL SELECT 1, 'drop_nan', count(*) FROM a
UNION ALL SELECT 2, 'exclude_incorrect', count(*) FROM ok
UNION ALL SELECT 3, 'is_relevant', count(*) FROM rel
UNION ALL SELECT 4, 'min_labels_cutoff', count(*) FROM cut
UNION ALL SELECT 5, 'contains_keywords', count(*) FROM kw)
SELECT step, n_rows, round(100.0 * (lag(n_rows) OVER (ORDER BY o) - n_rows) / nullif(lag(n_rows) OVER (ORDER BY o), 0), 9)
         AS pct_removed FROM steps"""

CLEAN_LABELS_FULL = f"""WITH {ANNOTATIONS}, {ANN_OK}, {AGREEMENT_CTE},
agc AS (SELECT annotator_id, agreement_ratio AS v FROM ag WHERE total_count >= 20),
{_zscore_sql('agc', 'v', 'az')},
outl AS (SELECT annotator_id FROM az WHERE z > 2.0),
{_CLEAN_CHAIN},
nout AS (SELECT * FROM rel WHERE annotator_id NOT IN (SELECT annotator_id FROM outl)),
kw AS (SELECT * FROM nout WHERE tweet_id IN (SELECT event_id FROM events
                                             WHERE event_type IN ('click', 'purchase', 'view'))),
{_merge('kw', 3, 'majority')}"""

MEDIA_INFO = """
SELECT CAST(event_id AS VARCHAR) AS id, event_type = 'purchase' AS has_media,
       CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS n_photo,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS n_video,
       CASE WHEN event_type = 'purchase' THEN 'http://m.example/' || CAST(event_id AS VARCHAR) || '/1.jpg '
            || 'http://m.example/' || CAST(event_id AS VARCHAR) || '/2.jpg '
            || 'http://m.example/' || CAST(event_id AS VARCHAR) || '/3.jpg' ELSE '' END AS image_urls
FROM events"""

REPLACE_MENTIONS = """
SELECT CAST(event_id AS VARCHAR) AS id,
       'Event ' || event_type || ' of @user &amp; value ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
       || chr(9) || 'end' AS text
FROM events"""

PREDICTION_INPUT = f"""WITH {STATUSES},
w AS (SELECT id, created_at, text FROM statuses
      WHERE created_at >= TIMESTAMP '2024-01-03 00:00:00' AND created_at <= TIMESTAMP '2024-01-20 23:59:59')
SELECT row_number() OVER (ORDER BY created_at, id) - 1 AS row_id, id, created_at, {_anonymize('text')} AS text
FROM w"""

_TRANSLATION_ROWS = f"""
{EV_TEXT},
f AS (SELECT CAST(event_id AS VARCHAR) AS id, norm_text AS text FROM ev WHERE event_type IN ('signup', 'error')),
d AS (SELECT * FROM f QUALIFY row_number() OVER (
        PARTITION BY {_collapse("regexp_replace(lower(" + _anonymize('text') + "), 'rt @user:|@user|<url>', '', 'g')")}
        ORDER BY id) = 1)
"""

TRANSLATION_INPUT = f"""WITH {_TRANSLATION_ROWS}
SELECT id, text, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 20) AS BIGINT) AS batch FROM d"""

TRANSLATION_INPUT_ALL = TRANSLATION_INPUT.replace("event_type IN ('signup', 'error')", "event_type <> 'view'")

TRANSLATION_COST = f"""WITH {_TRANSLATION_ROWS}
SELECT CAST(sum(length(text)) AS BIGINT) AS n_chars, round(sum(length(text)) / 500 * 0.01, 9) AS cost_eur FROM d"""

# ---- composite jobs

PRETRAIN_TEXT = f"""WITH {EV_TEXT},
f AS (SELECT CAST(event_id AS VARCHAR) AS id, norm_text AS text FROM ev
      WHERE event_type <> 'view' AND event_type IN ('purchase')),
d AS (SELECT * FROM f QUALIFY row_number() OVER (
        PARTITION BY {_collapse("regexp_replace(lower(" + _anonymize('text') + "), 'rt @user:|@user|<url>', '', 'g')")}
        ORDER BY id) = 1),
k AS (SELECT id, text, row_number() OVER (ORDER BY {_key(5, 'id')}, id) - 1 AS pos, count(*) OVER () AS n FROM d)
SELECT id, text, CASE WHEN pos < greatest(CAST(trunc(0.8 * n) AS BIGINT), n - 200000) THEN 'train' ELSE 'dev' END
       AS split
FROM k"""

CLASS_COUNTS = f"""WITH {CLEANED},
c AS (SELECT question_tag, label_tag AS label, count(*) AS n FROM cleaned GROUP BY ALL)
SELECT question_tag, label, n, min(n) OVER (PARTITION BY question_tag) AS min_class FROM c"""

# ---- options of earlier operators

EXTEND_SAMPLE = RANDOM_SAMPLE[:RANDOM_SAMPLE.rindex("SELECT id,")] + f""",
one AS (SELECT id, text FROM d ORDER BY {_key(42, 'id')}, id LIMIT 100)
SELECT id FROM d WHERE id NOT IN (SELECT id FROM one) AND text NOT IN (SELECT text FROM one)
ORDER BY {_key(43, 'id')}, id LIMIT 100"""

QUESTION_LABELS = f"""WITH {CLEANED}
SELECT id, question_tag, label_tag AS label FROM cleaned WHERE question_tag = 'quality'
AND id IN (SELECT id FROM cleaned WHERE label_tag IN ('1', '2'))"""

QUESTION_SPLIT = f"""WITH {CLEANED},
r AS (SELECT id, label_id AS label, row_number() OVER (ORDER BY {_key(8, 'id')}, id) - 1 AS pos, count(*) OVER () AS n
      FROM cleaned WHERE question_id = 1 AND label_id IN (0, 1))
SELECT id, label, CASE WHEN pos < floor((1 - 0.1::DOUBLE - 0.3::DOUBLE) * n) THEN 'train'
                       WHEN pos < floor((1 - 0.3::DOUBLE) * n) THEN 'dev' ELSE 'test' END AS split FROM r"""

GATED_STATUSES = f"SELECT id, text, is_reply FROM ({PARSE_STATUSES}) WHERE NOT is_retweet AND NOT has_quote"

MENTION_IDS = "SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS mentioned FROM events"

ALL_DATA = f"""WITH {STATUSES}
SELECT s.id, s.kind, CAST(l.quality AS VARCHAR) AS label_quality, coalesce(d.source = 'src0', false) AS S, l.doc_id IS NOT NULL AS L
FROM statuses s LEFT JOIN labels l ON s.id = l.doc_id LEFT JOIN documents d ON s.id = d.doc_id
WHERE s.created_at >= TIMESTAMP '2024-01-03 00:00:00' AND s.created_at <= TIMESTAMP '2024-01-20 23:59:59'"""

# ---- stored tables and files read back

WRITE_READ_PARSED = f"""SELECT id, text, created_at, created_day FROM ({PARSE_STATUSES})
WHERE created_day >= '2024-01-05' AND created_day < '2024-01-12'"""

ANNOTATION_FILES = f"""WITH {ANNOTATIONS}
SELECT id, CAST(tweet_id AS VARCHAR) AS tweet_id, question_tag, answer_tag, CAST(annotator_id AS VARCHAR) AS annotator_id,
       flag, mode, total_time FROM annotations"""

SAMPLE_FILES = "SELECT CAST(doc_id AS VARCHAR) AS tweet_id, md5(coalesce(text, '')) AS text_hash FROM documents"

BATCH_FILES = """SELECT CAST(doc_id AS VARCHAR) AS tweet_id, CAST(1 + doc_id % 3 AS INTEGER) AS batch_id, md5(coalesce(text, '')) AS text_hash
FROM documents"""

UPLOADED_FILES = """SELECT CAST(doc_id AS VARCHAR) AS tweet_id, CASE WHEN lang = 'de' THEN 'unavailable' ELSE 'available' END
  AS availability, 'mturk' AS mode FROM documents"""
