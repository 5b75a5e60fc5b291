"""Document fingerprints by winnowing, in DataFrame functions only.

Every run of K words is hashed; of every WINDOW consecutive hashes the smallest is
kept, the rightmost of equal ones, with its position. So any passage of
K + WINDOW - 1 words that two texts share leaves a common hash in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import radix
from .shared import LOWER, UPPER, written

K = 5
WINDOW = 4
#: Hexadecimal digits of a hash.
DIGITS = 12
# Code points of scripts without spaces between words; each such letter is a word.
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{2FFFF}"
#: Words are letters and digits; longer runs are cut, so that no text is a single word.
WORD = rf"[{UNSPACED}]|[^\x00-\x2F\x3A-\x60\x7B-\x7F{UNSPACED}]{{1,32}}"
#: What a position is taken from, so that of equal hashes the rightmost is the smallest; both take ten digits.
LAST = 2147483647


def with_fingerprint(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``out``, the fingerprint of column ``text`` (null: empty) as an array of marks: a hash and LAST less its position.

    A text of fewer than k words, but not none, has one hash of all its words; a
    text without words has none. Fewer than ``window`` hashes are one window.
    """
    words, marks = f"_{out}_words", f"_{out}_marks"
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    step = df.withColumn(words, F.regexp_extract_all(low, F.lit(WORD), F.lit(0)))
    one = f"concat(left(md5(array_join(slice({words}, i + 1, {k}), ' ')), {DIGITS}), {LAST} - i)"
    every = f"case when size({words}) = 0 then array() else transform(sequence(0, greatest(size({words}) - {k}, 0)), i -> {one}) end"
    step = step.withColumn(marks, F.expr(every)).withColumn(out, F.col(marks)).drop(words)
    held = 1  # how many marks an entry of ``out`` is the smallest of
    while held < window:
        by = min(held, window - held)
        step = step.withColumn(out, F.expr(f"zip_with({out}, slice({out}, {by + 1}, size({out})), (x, y) -> least(x, y))"))
        held += by
    kept = f"array_distinct(slice({out}, 1, greatest(size({marks}) - {window - 1}, 1)))"
    return step.withColumn(out, F.expr(kept)).drop(marks)


def hashes(marks: str) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.expr(f"array_distinct(transform({marks}, x -> left(x, {DIGITS})))")


def shown(marks: str) -> Column:
    """A fingerprint as text: hash@position, by position."""
    return F.expr(f"array_join(transform({marks}, x -> concat(left(x, {DIGITS}), '@', {LAST} - cast(substring(x, {DIGITS + 1}) as int))), ',')")


def likeness(one: str, other: str) -> Column:
    """Common hashes over all hashes of two sets; two empty sets are alike."""
    every = F.size(F.array_union(one, other))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, other)) / every)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, hash, position: one row for each kept hash of each row of ``docs``; words count from 0."""
    rows = with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), "text", "marks", k, window)
    mark = rows.select("doc_id", F.explode("marks").alias("mark"))
    return mark.select("doc_id", F.expr(f"left(mark, {DIGITS})").alias("hash"), F.expr(f"{LAST} - cast(substring(mark, {DIGITS + 1}) as int)").alias("position"))


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row for each row of ``docs``.

    The next document has the next smaller id, the smallest is followed by the
    largest, and a single one by itself. Null ids count as smallest of all; equal
    ids follow in descending order of their texts' MD5, equal rows follow one
    another. A null text is empty; an empty table has no rows. Only the two named
    columns are read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("mark", F.md5("text"))
    entries = written(rows.groupBy("key", "mark").agg(F.count("*").alias("n")), "entries")
    total, most = entries.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    cut, buckets = radix.measure(entries, [], "key", "mark", "n", coarse=True)
    buckets = written(buckets, "buckets")

    def shaped(df: DataFrame) -> DataFrame:
        """From text, next_text, fp and next_fp to the result."""
        n = F.length("text")
        # the last third goes, as many of the next text come
        edited = F.concat(F.expr("left(text, cast(length(text) - length(text) div 3 as int))"), F.expr("left(next_text, cast(length(text) div 3 as int))"))
        out = with_fingerprint(df.withColumn("edited", edited), "edited", "edited_fp", k, window)
        out = out.withColumns({"own": hashes("fp"), "theirs": hashes("next_fp"), "changed": hashes("edited_fp")})
        return out.select(F.col("key").alias("doc_id"), n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), shown("fp").alias("fingerprint"), shown("edited_fp").alias("edited_fingerprint"), likeness("own", "changed").alias("near_edited"), likeness("own", "theirs").alias("near_next"))

    # copies of a row stand together: the last is followed by another document, each other one by its like
    each = rows.dropDuplicates(["key", "mark"]) if most > 1 else rows
    # texts travel once: the three readers below share this exchange (a column that keeps its name would be planned in two ways)
    dealt = each.withColumns(cut.buckets("key", "mark")).repartition(*cut.columns)
    order = Window.partitionBy(*cut.columns).orderBy(F.col("key").asc_nulls_first(), "mark")
    # inside a bucket the next document is the row before
    marked = with_fingerprint(dealt, "text", "fp", k, window)
    inner = marked.withColumns({"next_text": F.lag("text").over(order), "next_fp": F.lag("fp").over(order)}).filter(F.col("next_text").isNotNull())
    # the first row of a bucket is followed by the last one of the bucket before
    placed = dealt.withColumns({"place": F.row_number().over(order), "last": F.lead(F.lit(1)).over(order).isNull()})
    ends = buckets.select(F.col("_a").alias("_ha"), F.col("_b").alias("_hb"), "_begin", "_rows")
    of_bucket = (F.col("_a") == F.col("_ha")) & (F.col("_b") == F.col("_hb"))
    firsts = placed.filter("place = 1").join(ends, of_bucket).select("key", "text", ((F.col("_begin") - 1 + total) % max(total, 1)).alias("before"))
    lasts = placed.filter("last").join(ends, of_bucket).select((F.col("_begin") + F.col("_rows") - 1).alias("rank"), F.col("text").alias("next_text"))
    outer = firsts.join(lasts, F.col("before") == F.col("rank")).select("key", "text", "next_text")
    outer = with_fingerprint(with_fingerprint(outer, "text", "fp", k, window), "next_text", "next_fp", k, window)
    found = shaped(inner).unionByName(shaped(outer))
    if most > 1:
        repeated = entries.filter("n > 1").select(F.col("key").alias("_key"), F.col("mark").alias("_mark"), "n")
        twins = each.join(repeated, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark"))).select("key", "text", F.col("text").alias("next_text"), "n")
        twins = with_fingerprint(twins, "text", "fp", k, window).withColumn("next_fp", F.col("fp")).withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n") - 1)))
        found = found.unionByName(shaped(twins))
    return found
