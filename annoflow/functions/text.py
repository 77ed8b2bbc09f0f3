"""Text column expressions.

All of them are JVM expressions.  Python's ``\\w``, ``\\s`` and ``\\b``
are Unicode-aware while Java's are ASCII, so the classes are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annoflow.functions import entities
from annoflow.functions.stopwords import ENGLISH_STOP_WORDS

# Fixed values (also the drop patterns and the quote table below): the whitespace characters of Python's str.split()/str.strip(),
# a word character, and the URL / handle patterns with their default fillers.
WS_CHARS = "\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"
WS = f"[{WS_CHARS}]"
NON_WS = f"[^{WS_CHARS}]"
WORD = "[\\p{L}\\p{N}_]"
# Where a word begins or ends; Java's own \\b differs between versions.
EDGE = f"(?:(?<!{WORD})(?={WORD})|(?<={WORD})(?!{WORD}))"
URL_PATTERN = f"((www\\.{NON_WS}+)|(https?://{NON_WS}+)|(http?://{NON_WS}+))"
USER_PATTERN = f"(^|[^@\\p{{L}}\\p{{N}}_])@({WORD}{{1,15}})(?!{WORD})"
CONTROL_PATTERN = "[\\r\\n\\t]+"
URL_FILLER = "<url>"
USER_FILLER = "@user"
CLEARED_DROP_PATTERN = "rt @user:|@user|<url>"
SAMPLE_DEDUP_DROP_PATTERN = "@<user>|<url>"
QUOTE_FOLD_FROM = "‘’´“”–-"
QUOTE_FOLD_TO = "'''\"\"--"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _replacement(s: str) -> str:
    # Java replacement strings treat '\' and '$' specially
    return s.replace("\\", "\\\\").replace("$", "\\$")


def collapse_ws(c) -> Column:
    """Python ``' '.join(s.split())``: runs of Unicode whitespace -> one space, trimmed."""
    return F.regexp_replace(F.regexp_replace(_c(c), f"{WS}+", " "), "^ | $", "")


def strip_ws(c) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(_c(c), f"^{WS}+|{WS}+$", "")


def html_unescape(c) -> Column:
    """Decode HTML entities (Python html.unescape semantics) on the JVM."""
    return entities.unescape(_c(c))


def normalize_str(c, unescape: bool = True) -> Column:
    """P6: '' for null/empty, HTML-unescape, tabs/newlines -> space, drop
    category-C characters, collapse whitespace."""
    col = F.coalesce(_c(c), F.lit(""))
    if unescape:
        col = html_unescape(col)
    col = F.regexp_replace(col, CONTROL_PATTERN, " ")
    col = F.regexp_replace(col, "\\p{C}", "")
    return collapse_ws(col)


def replace_urls(c, filler: str = URL_FILLER) -> Column:
    """URLs -> filler, filler padded with spaces, whitespace collapsed."""
    col = F.regexp_replace(_c(c), URL_PATTERN, _replacement(filler))
    col = F.replace(col, F.lit(filler), F.lit(f" {filler} "))
    return collapse_ws(col)


def replace_usernames(c, filler: str = USER_FILLER) -> Column:
    """Handles -> filler; the character before '@' is consumed with it."""
    col = F.regexp_replace(_c(c), USER_PATTERN, _replacement(filler))
    col = F.replace(col, F.lit(filler), F.lit(f" {filler} "))
    return collapse_ws(col)


def _anonymize_raw(c, url_filler: str, user_filler: str) -> Column:
    # P7 and P8 without their whitespace collapses: both patterns look at
    # non-whitespace runs and at the character before '@', which a collapse
    # does not change, so one collapse at the end gives the same text
    col = F.regexp_replace(_c(c), URL_PATTERN, _replacement(url_filler))
    col = F.replace(col, F.lit(url_filler), F.lit(f" {url_filler} "))
    col = F.regexp_replace(col, USER_PATTERN, _replacement(user_filler))
    return F.replace(col, F.lit(user_filler), F.lit(f" {user_filler} "))


def anonymize_text(c, url_filler: str = URL_FILLER, user_filler: str = USER_FILLER) -> Column:
    """P7 then P8."""
    return collapse_ws(_anonymize_raw(c, url_filler, user_filler))


def text_cleared(c, strip_rt: bool = False) -> Column:
    """Anonymise, lower-case, drop 'rt @user:', '@user', '<url>', collapse.

    The padded filler makes 'rt @user:' unmatchable (it becomes 'rt @user :');
    ``strip_rt=True`` removes that padded form too.
    """
    col = F.lower(_anonymize_raw(c, URL_FILLER, USER_FILLER))
    if strip_rt:
        # the padded form is only recognisable after the whitespace collapse
        col = collapse_ws(col)
    pattern = ("rt @user :|" if strip_rt else "") + CLEARED_DROP_PATTERN
    return collapse_ws(F.regexp_replace(col, pattern, ""))


def sample_dedup_key(c) -> Column:
    """P20: text without '@<user>' / '<url>' tokens, stripped."""
    return strip_ws(F.regexp_replace(_c(c), SAMPLE_DEDUP_DROP_PATTERN, ""))


def text_hash(c) -> Column:
    """md5 hex digest of the (normalised) text."""
    return F.md5(_c(c))


def fold_quotes(c) -> Column:
    """Typographic quotes and dashes -> ASCII."""
    return F.translate(_c(c), QUOTE_FOLD_FROM, QUOTE_FOLD_TO)


def token_candidates(c) -> Column:
    """Letter-run tokens of a text after removing URLs and '@...' words (P15 input)."""
    col = F.regexp_replace(_c(c), URL_PATTERN, "")
    col = F.regexp_replace(col, f"(@{NON_WS}+)", "")
    return F.regexp_extract_all(col, F.lit("\\p{L}+"), 0)


def with_token_count(df: DataFrame, text_col: str, out_col: str = "token_count",
                     stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """Number of letter-run tokens that are not stop words.

    The tokeniser is re-aimed from a per-row NLP library to letter runs; stop
    words are removed by Spark ML's StopWordsRemover (a JVM hash-set lookup,
    case-insensitive).
    """
    from pyspark.ml.feature import StopWordsRemover

    tmp_in, tmp_out = f"_{out_col}_tokens", f"_{out_col}_kept"
    remover = StopWordsRemover(inputCol=tmp_in, outputCol=tmp_out, stopWords=list(stop_words),
                               caseSensitive=False, locale="en_US")
    out = remover.transform(df.withColumn(tmp_in, token_candidates(text_col)))
    return out.withColumn(out_col, F.size(tmp_out)).drop(tmp_in, tmp_out)


def token_count(c, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """P15 as a column expression (linear stop-word scan; prefer ``with_token_count``)."""
    stops = F.array(*[F.lit(w) for w in stop_words])
    return F.size(F.filter(token_candidates(c), lambda t: ~F.array_contains(stops, F.lower(t))))


def contains_keywords(text, mentions=None, urls=None, keywords=()) -> Column:
    """Any keyword regex in lower(text || mention names), or between
    separators in lower(urls).  Keywords are lower-case Java regexes.

    Separators belong to the keyword's own alternatives: of ``a|b`` the first needs one before it, the last one behind it.
    """
    if not keywords:
        return F.lit(False)
    alternation = "|".join(f"(?:{k})" for k in keywords)
    any_text = F.lower(F.concat(_c(text), F.coalesce(_c(mentions), F.lit("")) if mentions is not None else F.lit("")))
    hit = any_text.rlike(alternation)
    if urls is not None:
        between = "|".join(f"(?:({EDGE}|\\p{{Nd}}|_){k}({EDGE}|\\p{{Nd}}|_|cas))" for k in keywords)
        hit = hit | F.coalesce(F.lower(_c(urls)).rlike(between), F.lit(False))
    return hit
