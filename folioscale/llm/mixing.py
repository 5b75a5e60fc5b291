"""Mixing sources to target weights with Pareto order sampling, in DataFrame functions only.

Every source has a target in words. Its documents are wanted in proportion to
their weights: document i is expected m_i = min(3, level * weight_i) times, with
the level that makes the expected words of the source its target. The whole
copies, floor(m_i), are allocated for certain; the fraction p_i of m_i is the
document's inclusion probability for one more. Documents are ranked by Pareto's
q_i = (u_i / (1 - u_i)) / (p_i / (1 - p_i)) with u_i hashed from the document,
and a sample of fixed size, the sum of the p_i, is the first in that order.

A sample of a fixed number of documents misses a target in words. So it is
trimmed to the ranks before the first document that would pass the target, and
the room that is left is filled, largest sizes first and by rank within a size,
until no document fits any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranks import bucket_count, running
from .shared import space_words, unit_hash, written

#: No document is taken more often.
MOST_COPIES = 3
#: Weights are whole numbers from 1 to so many, so that a source's level is found on a table of bounded size.
MOST_WEIGHT = 1000


def document_key(id_: Column, text: Column, seed: int) -> Column:
    """An MD5 that is the same for rows of equal id and text, and for no others; null is not empty."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), part(id_), part(text)))


def source_targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with ``target``.

    Sources by code point, null last, weigh 1, 2, 3 and so on again. Targets
    share the size of everything; one stops at ``MOST_COPIES`` times its
    source's size, and the excess is shared by weight until none is above. The
    level of that is found at once: with the sources ordered by cap over
    weight, those before some place are at their cap.
    """
    # one row for each source
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).withColumn("cap", (MOST_COPIES * F.col("source_size")).cast("double"))
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = weighed.select(
        "*",
        F.sum("source_size").over(whole).cast("double").alias("total"),
        (F.sum("cap").over(upto) - F.col("cap")).alias("capped_before"),
        (F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")).alias("weight_from"),
    )
    # the first source that is not at its cap sets the level for all from it on
    placed = placed.withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_from"))
    first = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "level"))).over(whole)["level"]
    return placed.select(*sources.columns, F.least(F.col("cap"), F.coalesce(first * F.col("weight"), F.col("cap"))).alias("target"))


def expected_copies(groups: DataFrame) -> DataFrame:
    """``groups`` (source, weight, n_docs, words, target) with sure, p, n_sample, room and typical.

    ``room`` is what the target leaves beside the copies that are sure, and
    ``n_sample`` the sample's size, both of the whole source; ``typical`` is its
    mean p.
    """
    heavy = Window.partitionBy("source").orderBy(F.col("weight").desc())
    before = heavy.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    source = Window.partitionBy("source")
    load = F.col("words") * F.col("weight")
    placed = groups.withColumns({"capped": F.sum("words").over(before) - F.col("words"), "load": F.sum(load).over(source) - F.sum(load).over(before) + load})
    placed = placed.withColumn("level", F.when(F.col("load") > 0, (F.col("target") - MOST_COPIES * F.col("capped")) / F.col("load")))
    # the heaviest weight that is not at the cap sets the level; none: all are
    free = F.when(F.col("level") * F.col("weight") <= MOST_COPIES, F.struct((-F.col("weight")).alias("w"), "level"))
    level = F.min(free).over(source)["level"]
    m = F.when(F.col("target") <= 0, F.lit(0.0)).otherwise(F.least(F.lit(float(MOST_COPIES)), F.coalesce(level * F.col("weight"), F.lit(float(MOST_COPIES)))))
    parted = placed.withColumn("m", m).withColumn("sure", F.floor("m")).withColumn("p", F.col("m") - F.col("sure"))
    whole = heavy.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # in one order, for equal sums
    share = F.sum(F.col("n_docs") * F.col("p")).over(whole)
    room = F.col("target") - F.sum(F.col("words") * F.col("sure")).over(source)
    return parted.select("source", "weight", "sure", "p", F.floor(share + F.lit(0.5)).alias("n_sample"), room.alias("room"), (share / F.sum("n_docs").over(source)).alias("typical"))


#: Buckets that the documents of one source and size are cut into, to be put in order.
BUCKETS = 256


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None, seed: int = 42) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source, key: one row for each row of ``docs``.

    A null source is a source, a null text has size 0 and takes nothing, and a
    repeated row is a document of its own; equal rows share one random number,
    stand one after the other in every order, and any of them may be the one
    that is taken. A source whose texts are all empty has target 0 and no
    copies. ``weight`` is rounded to whole numbers from 1 to ``MOST_WEIGHT``
    (null counts as 1); without it a document weighs the number of binary
    digits of its size, so that longer ones are somewhat likelier. The rows
    depend on values alone: a rerun gives the same.
    """
    text = F.col(text_col).cast("string")
    small = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), space_words(text).alias("size"), document_key(F.col(id_col), text, seed).alias("key"), (F.lit(None) if weight is None else weight).cast("double").alias("given"))
    own = F.length(F.bin("size")) if weight is None else F.greatest(F.lit(1), F.least(F.lit(MOST_WEIGHT), F.round(F.coalesce("given", F.lit(1.0)))))
    small = written(small.withColumn("weight", own.cast("long")).drop("given"), "sizes")
    groups = small.groupBy("source", "weight").agg(F.count("*").alias("n_docs"), F.sum("size").alias("words"))
    sources = groups.groupBy("source").agg(F.sum("words").alias("source_size"))
    # one row for each source, and for each source and weight
    targets = written(source_targets(sources), "targets")
    t = targets.select(F.col("source").alias("_s"), "target")
    plan = written(expected_copies(groups.join(t, _same(F.col("source"), F.col("_s"))).drop("_s")), "plan")
    p = plan.select(F.col("source").alias("_s"), F.col("weight").alias("_w"), "sure", "p", "n_sample", "room", "typical")
    rows = small.join(p, _same(F.col("source"), F.col("_s")) & (F.col("weight") == F.col("_w"))).drop("_s", "_w")

    u = unit_hash(F.col("key"))
    chance = rows.filter("p > 0").withColumn("q", (u / (1 - u)) / (F.col("p") / (1 - F.col("p"))))
    order = [F.col("q"), F.col("key")]
    # rises with q, and at the source's mean odds spreads its rows evenly over the buckets
    x = F.col("q") * F.col("typical") / (1 - F.col("typical"))
    ranked = running(chance, ["source"], x / (1 + x), order, {"rank": F.lit(1).cast("long"), "before": F.col("size")}, bucket_count(small.count()))
    sampled = (F.col("rank") < F.col("n_sample")) & (F.col("before") + F.col("size") <= F.col("room"))
    rest = rows.filter("p = 0").withColumn("q", F.lit(float("inf")))
    first = ranked.withColumn("extra", sampled.cast("int")).drop("rank", "before").unionByName(rest.withColumn("extra", F.lit(0)))
    first = written(first, "sample")

    # the room that the sample leaves, on the sizes that are left of each source
    used = first.groupBy("source").agg(F.floor(F.max("room") - F.sum(F.col("extra") * F.col("size"))).cast("long").alias("open"))
    spare = first.filter((F.col("extra") == 0) & (F.col("sure") < MOST_COPIES) & (F.col("size") > 0))
    counts = spare.groupBy("source", "size").agg(F.count("*").alias("n"))
    u_ = used.select(F.col("source").alias("_s"), "open")
    fitting = counts.join(u_, _same(F.col("source"), F.col("_s"))).filter("size <= open").groupBy("source", "open").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("sizes"))

    def take(s: Column, x: Column) -> Column:
        n = F.least(x["n"], F.floor(s["open"] / x["size"]).cast("long"))
        return F.struct((s["open"] - n * x["size"]).alias("open"), F.when(n > 0, F.concat(s["picks"], F.array(F.struct(x["size"].alias("size"), n.alias("n"))))).otherwise(s["picks"]).alias("picks"))

    start = F.struct(F.col("open"), F.array().cast("array<struct<size:bigint,n:bigint>>").alias("picks"))
    picks = fitting.select(F.col("source").alias("_s"), F.inline(F.aggregate("sizes", start, take)["picks"])).select("_s", F.col("size").alias("_size"), F.col("n").alias("_n"))
    picks = written(picks, "picks")
    offered = first.join(picks, _same(F.col("source"), F.col("_s")) & (F.col("size") == F.col("_size")), "left").drop("_s", "_size")
    able = (F.col("extra") == 0) & (F.col("sure") < MOST_COPIES) & F.col("_n").isNotNull()
    # rises with q, then, among those without odds, with the key; a size that much of a source has is cut into buckets
    place = F.when(F.col("q") < float("inf"), 0.5 * F.col("q") / (1 + F.col("q"))).otherwise(0.5 + 0.5 * unit_hash(F.col("key")))
    turns = running(offered.filter(able), ["source", "size"], place, [F.col("q"), F.col("key")], {"turn": F.lit(1).cast("long")}, BUCKETS)
    filled = turns.withColumn("extra", (F.col("turn") < F.col("_n")).cast("int")).drop("turn")
    added = filled.unionByName(offered.filter(~able))
    copies = (F.col("sure") + F.col("extra")).cast("int")
    s = targets.select(F.col("source").alias("_t"), "source_size", "target")
    return added.withColumn("copies", copies).join(s, _same(F.col("source"), F.col("_t"))).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "source", "key")


def mixed(docs: DataFrame, seed: int = 42) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the same columns.

    Rows that share doc_id, text and source take their copies in turn, so that
    none of the mix is lost; whatever other columns such rows have, any of them
    may be the one that is repeated.
    """
    share = lambda key, source: F.md5(F.concat_ws("|", key, F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))))
    plan = mix(docs, seed=seed).groupBy(share(F.col("key"), F.col("source")).alias("k")).agg(F.sort_array(F.collect_list("copies"), asc=False).alias("copies")).filter(F.get("copies", F.lit(0)) > 0)
    # the row travels as one value, so that no column of it can clash
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), share(document_key(F.col("doc_id"), F.col("text").cast("string"), seed), F.col("source")).alias("k"))
    joined = packed.join(plan, "k").withColumn("turn", F.row_number().over(Window.partitionBy("k").orderBy("k")) - 1)
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.coalesce(F.get("copies", F.col("turn")), F.lit(0)))).alias("copy")).select("row.*")
