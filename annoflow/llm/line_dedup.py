"""Line dedup (operator 3): a deletion-neighbourhood join.

Lines are sequences of words (runs of characters other than space and \\t to \\r).  Two
lines are duplicates if their words are equal, or if one word replaced, added or left out turns one
into the other and the longer has ``EDIT_WORDS`` words or more: then four words in five agree at least.  A line is
removed if an earlier line (by document id, then place) is its duplicate.  Every line with a word takes part; lines
without one stay.

Every line emits the hashes of its variants with one word deleted.  Lines that share a variant
from the same place differ by one replaced word; a line that equals another one's variant
differs by one added word.  Only the earliest line of each variant is needed, so variants meet
in a minimum that is partly aggregated before the shuffle: no pairs are formed, however many
lines share one.  Links are then verified on the words.

A line has as many variants as words.  To keep the shuffle in proportion to the lines, the same
join first runs with deletions of half a line (four keys): a line without a partner there has
none within one word either, and drops out of the full neighbourhood, without loss.  A hash of a
variant is the exclusive or of hashes of its words with their places, so all variants of a line
together take time in proportion to its words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from annoflow.llm.common import row_key, stage
from annoflow.llm.quality import GAP

#: Words of the longer of two lines that differ in one.
EDIT_WORDS = 5

#: Lines with a possible partner whose keys (40 bytes each) may be sent to all executors to fetch their
#: words, unless the caller says otherwise; beyond it the texts are shuffled.  The result is the same.
BROADCAST_ROWS = 1 << 18

_WORD = r"[^\x20\x09-\x0D]"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_k1, _k2, doc_id, line_no, w (words) of every line with a word."""
    d = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("doc_id"),
                    F.split(F.col(text_col).cast("string"), "\n").alias("_lines"))
    d = d.select("_k1", "_k2", "doc_id", F.posexplode("_lines").alias("line_no", "_line"))
    # A test on the line, not on its words: a filter on words would split each line twice.
    d = d.where(F.col("_line").rlike(_WORD))
    return d.select("_k1", "_k2", "doc_id", "line_no", F.array_remove(F.split("_line", GAP), "").alias("w"))


def _line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per line its place in the order (doc_id, _k1, _k2, line_no), n (words), and hashes of the first n div 2 words
    (a), of the others (b), and of the half that a line of one word more or less shares (c).

    n, a and b identify the words of a line, by 128 bits of hashes.
    """
    def half(lo, n):
        return f"xxhash64(array_join(slice(w, {lo}, {n}), ' '))"

    d = _lines(docs, id_col, text_col).withColumn("n", F.size("w")).withColumn("m", F.expr("cast(n div 2 as int)"))
    return d.select("doc_id", "_k1", "_k2", "line_no", "n", F.expr(half("1", "m")).alias("a"), F.expr(half("m + 1", "n")).alias("b"),
                    F.expr(f"if(n % 2 = 0, {half('1', 'm - 1')}, {half('m + 2', 'n')})").alias("c"))


def _order():
    """Order of lines: by document id (null last), key of the row, place."""
    return F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "_k1", "_k2", "line_no")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """_k1, _k2 (row key) and line_no of each line to remove."""
    lines = stage(_line_table(docs, id_col, text_col), "lines")
    # Equal lines: all but the first.
    again = stage(lines.groupBy("a", "b", "n").agg(F.count(F.lit(1)).alias("times"), F.min(_order()).alias("first"))
                  .where("times > 1").drop("times"), "again")
    same = lines.join(again, ["a", "b", "n"]).where(_order() > F.col("first")).select("_k1", "_k2", "line_no")
    near = _near_lines(docs, lines, id_col, text_col, broadcast_rows).select("o._k1", "o._k2", "o.line_no")
    return same.unionByName(near).distinct()


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (key, line, ...) whose key belongs to two lines or more."""
    keys = rows.groupBy("key").agg(F.min("line").alias("l"), F.max("line").alias("m")).where("l <> m").select("key")
    return rows.join(keys, "key", "left_semi")


def _near_lines(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str, broadcast_rows: int) -> DataFrame:
    """o of the first occurrences that have an earlier line within one word."""
    lines = lines.where(F.col("n") >= EDIT_WORDS - 1)  # the least have a partner of one word more only
    # Halves of the line as it is (of n words) and as one that has a word more than its partner (of n - 1).
    keyed = lines.select("a", "b", "n", "c", F.xxhash64("a", "b", "n").alias("line"))
    keyed = keyed.select("line", F.explode(F.expr(
        "array(xxhash64(n, 1, a), xxhash64(n, 2, b), xxhash64(n - 1, 1, if(n % 2 = 0, c, a)), xxhash64(n - 1, 2, if(n % 2 = 0, b, c)))"
    )).alias("key"))
    partnered = stage(_shared(keyed).select("line").distinct(), "partnered")
    few = partnered.count() <= broadcast_rows
    places = (lines.withColumn("line", F.xxhash64("a", "b", "n"))
              .join(F.broadcast(partnered) if few else partnered, "line")
              .groupBy("line", "a", "b", "n").agg(F.min(_order()).alias("o")))
    places = stage(places.select("line", "o", "o._k1", "o._k2", "o.line_no"), "places")
    words = stage(_lines(docs, id_col, text_col).select("_k1", "_k2", "line_no", "w")
                  .join(F.broadcast(places) if few else places, ["_k1", "_k2", "line_no"])
                  .select("line", "o", "w").dropDuplicates(["line", "o"]), "words")
    variants = stage(_variants(words), "variants")
    members = stage(_shared(variants).join(words.select("line", "o"), "line"), "members")
    first = members.groupBy("key", "role").agg(F.min(F.struct("o", "line")).alias("e"))
    # The partner of a replaced word is another such line; that of a deleted word a whole line, and the reverse.
    partner = first.select("key", F.expr("case role when 'whole' then 'shorter' when 'shorter' then 'whole' else role end").alias("role"), "e")
    links = members.join(partner, ["key", "role"]).where("o > e.o").select("line", "o", F.col("e.o").alias("e"), F.col("e.line").alias("l")).distinct()
    pairs = (links.join(words, ["line", "o"])
             .join(words.select(F.col("line").alias("l"), F.col("o").alias("e"), F.col("w").alias("v")), ["l", "e"]))
    longer = F.greatest(F.size("w"), F.size("v"))

    def alike(a, b):  # words that agree from the front
        at = F.array_position(F.expr(f"zip_with({a}, {b}, (x, y) -> x <=> y)"), False)
        return F.when(at == 0, longer).otherwise(at - 1)

    return pairs.where(alike("w", "v") + alike("reverse(w)", "reverse(v)") >= longer - 1).select("o").distinct()


def _variants(words: DataFrame) -> DataFrame:
    """(line, key, role) of the lines' deletion neighbourhoods.

    With h(word, place) as the hash of a word at a place, a line's hash is the exclusive or over its
    words.  Leaving out word i moves the later words a place forward: what changes from one i to the
    next is h(word i, i) and h(word i + 1, i), so a running exclusive or gives all variants.
    """
    d = words.repartition("line").select("line", "o", F.size("w").alias("n"), F.explode(F.expr(
        "transform(w, (x, i) -> struct(i, xxhash64(x, i) as here, if(i + 1 < size(w), xxhash64(get(w, i + 1), i), 0L) as next))")).alias("v"))
    line = Window.partitionBy("line", "o")
    d = d.select("line", "n", F.col("v.i").alias("i"), F.col("v.here").alias("here"),
                 F.bit_xor("v.here").over(line).alias("whole"), F.bit_xor("v.next").over(line).alias("nexts"),
                 F.bit_xor(F.col("v.here").bitwiseXOR(F.col("v.next"))).over(
                     line.orderBy("v.i").rowsBetween(Window.unboundedPreceding, -1)).alias("passed"))
    key = F.expr(f"""array(struct(xxhash64(n, i, whole ^ here) as key, if(n >= {EDIT_WORDS}, 'replaced', null) as role),
                          struct(xxhash64(n - 1, -1, nexts ^ coalesce(passed, 0L)) as key, if(n >= {EDIT_WORDS}, 'shorter', null) as role),
                          struct(xxhash64(n, -1, whole) as key, if(i = 0, 'whole', null) as role))""")
    return d.select("line", F.explode(key).alias("k")).select("line", "k.*").where("role is not null")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with ``text_col`` less its removed lines, and ``removed_lines`` (sorted places, from 0).

    All other columns stay, but for one named ``removed_lines``, which is replaced.  A null text stays null, an empty one empty.  Rows with equal id and
    text count as one document and get equal results; among documents of one id, or without one
    (these come last), a key of the row decides which is earlier.  An empty table gives no rows.
    Columns that begin with an underscore are reserved.
    """
    gone = (removed_lines(docs, id_col, text_col, broadcast_rows).groupBy("_k1", "_k2")
            .agg(F.array_sort(F.collect_list("line_no")).alias("removed_lines")))
    k1, k2 = row_key(id_col, text_col)
    d = docs.drop("removed_lines").withColumns({"_k1": k1, "_k2": k2}).join(gone, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    d = d.withColumn("_lines", F.split(F.col(text_col).cast("string"), "\n"))
    # Runs of kept lines lie between the removed ones.
    kept = F.expr("""array_join(flatten(transform(
        sequence(0, size(removed_lines)),
        j -> slice(_lines, if(j = 0, 1, removed_lines[j - 1] + 2),
                   if(j = size(removed_lines), size(_lines), removed_lines[j])
                   - if(j = 0, 0, removed_lines[j - 1] + 1)))), '\\n')""")
    return (d.withColumn(text_col, F.when(F.col("removed_lines").isNull(), F.col(text_col)).otherwise(kept))
            .withColumn("removed_lines", F.coalesce("removed_lines", F.array().cast("array<int>")))
            .drop("_lines"))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    out = dedup_lines(docs.select(id_col, text_col), id_col, text_col)
    return out.select(F.col(id_col).alias("doc_id"),
                      F.size("removed_lines").cast("long").alias("n_removed"),
                      F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"),
                      F.sha2(F.col(text_col), 256).alias("text_sha256"))
