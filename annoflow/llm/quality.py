"""Quality rules (operator 2): robust multivariate outliers.

Counts of each text become a vector of transformed statistics.  For each language
and source a minimum-covariance-determinant estimate (location and scatter of the
share ``support`` of its texts with the smallest determinant) is found by
concentration steps from two starts.  It rests on half of the texts, the breakdown support, and is
then reweighted: location and scatter are taken anew of the texts within a chi-square bound.  Texts
beyond a bound on the squared Mahalanobis distance to that are rejected.

Everything is DataFrame expressions.  Statistics are whole numbers (thousandths), so
sums and exact percentiles do not depend on how rows are dealt out.  Groups are only ever
aggregated: sums of products, and percentile counts whose size is that of the value range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from annoflow.llm.common import row_key, stage

GAP = r"[\x20\x09-\x0D]+"

#: Statistic -> (expression over the counts, resolution).  The resolution is the standard
#: deviation that is natural even where most texts have the same value (no symbols, no
#: repeated line); it keeps the scatter regular.
STATISTICS = {
    "word_length": ("ln(word_chars / n_words)", 0.10),
    "symbols": ("ln(1 + 100.0 * n_symbols / n_words)", 0.40),
    "upper": ("sqrt(n_upper / word_chars)", 0.08),
    "dup_lines": ("sqrt(n_dup_lines / n_lines)", 0.25),
    "repeats": ("sqrt(n_repeat_words / n_words)", 0.25),
}
SCALE = 1000
SUPPORT = 0.75       # share of a group that an estimate rests on unless told otherwise
BREAKDOWN = 0.5      # share that verdicts rest on: just under half of a group may be junk
WITHIN = 0.975       # chance of a normal vector to take part in the reweighted estimate
PRIOR_ROWS = 20      # weight, in texts, of the prior scatter (twice the resolution) in small groups
REJECT = 1e-6        # chance of a normal vector beyond the bound
MAX_STEPS = 10       # concentration steps; they stop when no group's determinant still falls
TOLERANCE = 1e-3     # change of a log determinant that counts as falling


def _chi2_cdf(x: float, p: int) -> float:
    term = total = 1 / math.gamma(p / 2 + 1)
    k = p / 2
    while term > total * 1e-16:
        k += 1
        term *= x / 2 / k
        total += term
    return total * (x / 2) ** (p / 2) * math.exp(-x / 2)


def chi2_quantile(q: float, p: int) -> float:
    lo, hi = 0.0, 1.0
    while _chi2_cdf(hi, p) < q:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, p) < q else (lo, mid)
    return hi


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines, n_repeat_words (long).

    Words are runs of characters other than space and \\t to \\r; a null text has none.
    n_lines counts \\n-split lines with a word, n_dup_lines those equal to an earlier one,
    n_repeat_words the words inside 3-word windows that occur twice or more (windows are
    compared by a 64-bit hash within one text).
    """
    keep = [c for c in docs.columns]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.withColumn("_text", text).withColumns({
        "_words": F.array_remove(F.split("_text", GAP), ""),
        "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_upper": F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long"),
    })
    d = d.select(*keep, "n_symbols", "n_upper", "_words",
                 F.size("_words").cast("long").alias("n_words"),
                 F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
                 F.size("_lines").cast("long").alias("n_lines"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    d = d.withColumn("_grams", F.expr(
        "if(n_words < 3, cast(array() as array<bigint>), transform(sequence(0, cast(n_words as int) - 3), "
        "i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])))")).drop("_words")
    d = d.withColumn("_sorted", F.expr(
        "if(size(array_distinct(_grams)) = size(_grams), cast(array() as array<struct<h:bigint,i:int>>), "
        "array_sort(transform(_grams, (h, i) -> struct(h, i))))")).drop("_grams")
    d = d.withColumn("_again", F.expr(
        "array_sort(transform(filter(_sorted, (x, j) -> x.h = get(_sorted, j - 1).h or x.h = get(_sorted, j + 1).h), x -> x.i))"))
    d = d.withColumn("n_repeat_words", F.expr(
        "aggregate(_again, struct(-3 as last, 0L as n), (a, i) -> struct(i as last, a.n + least(3, i - a.last) as n), a -> a.n)"))
    return d.drop("_sorted", "_again")


def base_failed() -> Column:
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def _names():
    p = len(STATISTICS)
    x = [f"x{i}" for i in range(p)]
    return p, x, [(i, j) for i in range(p) for j in range(i + 1)]


def _with_scatter(moments: DataFrame, factor: float) -> DataFrame:
    """mu, the inverse Cholesky factor of the regularised scatter, and its log determinant, from
    n, sums s<i> and sums of products c<i>_<j>."""
    p, x, pairs = _names()
    d = moments
    d = d.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(p)})
    res = [r * SCALE for _, r in STATISTICS.values()]
    d = d.withColumns({
        f"v{i}_{j}": (F.greatest(F.lit(0.0), F.col(f"c{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) if i == j
                      else F.col(f"c{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * factor * F.col("n")
        / (F.col("n") + PRIOR_ROWS) + (F.lit(4 * res[i] ** 2) * PRIOR_ROWS / (F.col("n") + PRIOR_ROWS) + res[i] ** 2 if i == j else F.lit(0.0))
        for i, j in pairs})
    for i, j in pairs:  # Cholesky factor, row by row
        rest = F.col(f"v{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
        d = d.withColumn(f"l{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}_{j}"))
    for i in range(p):  # its inverse
        for j in range(i, -1, -1):
            if i == j:
                e = 1 / F.col(f"l{i}_{i}")
            else:
                e = -sum((F.col(f"l{i}_{k}") * F.col(f"w{k}_{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}_{i}")
            d = d.withColumn(f"w{i}_{j}", e)
    d = d.withColumn("logdet", sum((F.log(f"l{i}_{i}") for i in range(p)), F.lit(0.0)) * 2)
    return d.select("lang", "source", "start", "n", "logdet", *(f"m{i}" for i in range(p)), *(f"w{i}_{j}" for i, j in pairs))


def _distance() -> Column:
    """Squared Mahalanobis distance of x under the joined estimate."""
    p, x, _ = _names()
    return sum((F.pow(sum((F.col(f"w{i}_{j}") * (F.col(x[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0)), F.lit(2))
                for i in range(p)), F.lit(0.0))


def _moments(rows: DataFrame) -> DataFrame:
    p, x, pairs = _names()
    return rows.groupBy("lang", "source", "start").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(x[i]).alias(f"s{i}") for i in range(p)),
        *(F.sum(F.col(x[i]) * F.col(x[j])).alias(f"c{i}_{j}") for i, j in pairs))


def _on_group(rows: DataFrame, groups: DataFrame, *more: str, how: str = "inner") -> DataFrame:
    """Each row with what its group has; null languages and sources are groups, too."""
    keys = ("lang", "source", *more)
    other = groups.withColumnsRenamed({c: f"_{c}" for c in keys})
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys]
    return rows.join(other, on, how).drop(*(f"_{c}" for c in keys))


def _consistency(share: float, p: int) -> float:
    """Makes the scatter of the nearest share of vectors consistent for normal ones."""
    return share / _chi2_cdf(chi2_quantile(share, p), p + 2)


def mcd(vectors: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Estimate per (lang, source) from rows (lang, source, x0..)."""
    p, x, pairs = _names()
    factor = _consistency(support, p)
    # Start 0: all texts of the group.  Start 1: medians, and medians of absolute deviations.
    med = vectors.groupBy("lang", "source").agg(*(F.percentile(c, 0.5).alias(f"med{i}") for i, c in enumerate(x)))
    spread = (_on_group(vectors, med)
              .groupBy("lang", "source", *(f"med{i}" for i in range(p)))
              .agg(F.count(F.lit(1)).alias("n"),
                   *(F.percentile(F.abs(F.col(c) - F.col(f"med{i}")), 0.5).alias(f"mad{i}") for i, c in enumerate(x))))
    n = F.col("n")
    robust = spread.select("lang", "source", F.lit(1).alias("start"), "n",
                           *((F.col(f"med{i}") * n).alias(f"s{i}") for i in range(p)),
                           *(((F.pow(1.4826 * F.col(f"mad{i}"), F.lit(2)) if i == j else F.lit(0.0))
                              + F.col(f"med{i}") * F.col(f"med{j}")).alias(f"u{i}_{j}") for i, j in pairs)
                           ).select("lang", "source", "start", "n", *(f"s{i}" for i in range(p)),
                                    *((F.col(f"u{i}_{j}") * n).alias(f"c{i}_{j}") for i, j in pairs))
    classic = _moments(vectors.withColumn("start", F.lit(0)))
    now = stage(_with_scatter(classic.unionByName(robust), 1.0).withColumn("changed", F.lit(True)), "mcd")
    for _ in range(MAX_STEPS):
        far = _on_group(vectors, now).withColumn("d", F.floor(F.log1p(_distance()) * 4096).cast("int"))
        cut = far.groupBy("lang", "source", "start").agg(F.percentile("d", support).alias("cut"))
        near = _on_group(far, cut, "start").where("d <= cut").select("lang", "source", "start", *x)
        new = _with_scatter(_moments(near), factor)
        old = now.select("lang", "source", "start", F.col("logdet").alias("was"))
        new = (_on_group(new, old, "start")
               .withColumn("changed", F.abs(F.col("logdet") - F.col("was")) > TOLERANCE).drop("was"))
        now = stage(new, "mcd")
        if not now.where("changed").take(1):
            break
    names = [c for c in now.columns if c not in ("lang", "source", "logdet", "start")]
    best = now.groupBy("lang", "source").agg(F.min(F.struct("logdet", "start", *names)).alias("b"))
    return best.select("lang", "source", *(F.col(f"b.{c}").alias(c) for c in names if c not in ("n", "changed")))


def reweighted(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """The estimate from all vectors within the chi-square bound of ``estimate``, for efficiency."""
    p, x, _ = _names()
    near = _on_group(vectors, estimate).where(_distance() <= chi2_quantile(WITHIN, p)).select("lang", "source", *x)
    return (_with_scatter(_moments(near.withColumn("start", F.lit(0))), _consistency(WITHIN, p))
            .drop("start", "n", "logdet"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", reject: float = REJECT) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, distance (squared, null if
    base_failed), kept.

    A null text has no words and fails.  Null languages and sources form groups of their own.
    Repeated rows are judged alike, each keeping its row.  A group of one text accepts it: its
    distance is 0; small groups lean on the prior scatter.  An empty table gives no rows.  Other
    columns are not read.
    """
    return keyed_judge(docs, id_col, text_col, lang_col, source_col, reject).drop("_k1", "_k2")


def keyed_judge(docs, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", reject=REJECT):
    """``judge`` with the row's key (of id, text, language and source) as _k1 and _k2."""
    p, x, _ = _names()
    named = docs.select(*row_key(id_col, text_col, lang_col, source_col), F.col(id_col).alias("doc_id"),
                        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"),
                        F.col(text_col).cast("string").alias("text"))
    counts = base_counts(named).drop("text").withColumn("base_failed", base_failed())
    counts = counts.withColumns({
        c: F.when(~F.col("base_failed"), F.round(F.expr(e) * SCALE).cast("long"))
        for c, (e, _) in zip(x, STATISTICS.values())})
    counts = stage(counts, "quality")
    vectors = counts.where(~F.col("base_failed")).select("lang", "source", *x)
    estimate = reweighted(vectors, mcd(vectors, BREAKDOWN))
    judged = (_on_group(counts, estimate, how="left")
              .withColumn("distance", F.when(~F.col("base_failed"), F.round(_distance(), 6))))
    bound = chi2_quantile(1 - reject, p)
    return judged.select("_k1", "_k2", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", F.coalesce(~F.col("base_failed") & (F.col("distance") <= bound), F.lit(False)).alias("kept"),
                         "distance")
