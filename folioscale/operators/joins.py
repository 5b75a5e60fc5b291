"""Joins that a plain equi-join does not say."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import close_match, length_close


def fallback_join(left: DataFrame, right: DataFrame, keys: list[str], preference: Column, choices: list[Column], columns: list[str]) -> DataFrame:
    """Columns of the first ``choices`` value that ``right`` has in ``preference`` for the same keys.

    One equi-join on the keys for all choices: the hits of a left row are few,
    and the best ranked is kept by an aggregate, not by a chain of joins.
    """
    wanted = left.withColumn("_choices", F.array(*choices))
    side = right.groupBy(*keys, preference.alias("_p")).agg(F.max(F.struct(*columns)).alias("_v"))
    by_key = side.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_p", "_v"))).alias("_by"))
    out = wanted.join(by_key, keys, "left")
    hit = F.get(F.filter(F.transform("_choices", lambda c: F.element_at("_by", c)), lambda v: v.isNotNull()), F.lit(0))
    return out.withColumn("_hit", hit).select(*left.columns, *[F.col("_hit")[c].alias(c) for c in columns])


def rank_join(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """The i-th left row of a key with the i-th right row; what has no partner goes."""
    a = left.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*left_order)))
    b = right.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*right_order)))
    return a.join(b, [*keys, "_rank"]).withColumnRenamed("_rank", "rank")


#: Ranges of a point that meet its rows as one list.
PACK = 512


def range_join(points: DataFrame, ranges: DataFrame, keys: list[str], point: str, low: str, high: str, width: int = 64, columns: list[str] | None = None) -> DataFrame:
    """Every point with ``columns`` (or all) of the ranges of its key that hold it, ends included; a null end is open.

    Bins are ``width``, 64 times and 4096 times as wide. A range lies in two
    bins at most of the smallest width that is not below its length, or in one
    for all that are longer or open; a point lies in one bin of every width. So
    the join is an equi-join on (key, width, bin) and no nested loop. Each distinct
    point of a key looks into its bins once, without its rows' other columns; rows
    then meet by their point, so that all that meets there is part of the result.
    They meet lists of ``PACK`` ranges: one list with all rows of its point, then
    the next, so that a result with the square of the rows repeats itself at short
    distance, and is stored in a small part of its size.
    """
    widths = (width, 64 * width, 4096 * width)
    length = F.col(high) - F.col(low)
    level = F.coalesce(*[F.when(length <= w, F.lit(i)) for i, w in enumerate(widths)], F.lit(len(widths)))
    wide = F.element_at(F.array(*[F.lit(w).cast("long") for w in widths], F.lit(1).cast("long")), level + 1)
    first, last = F.floor(F.col(low) / wide), F.floor(F.col(high) / wide)
    bins = F.when(level == len(widths), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(first.cast("long"), last.cast("long")))
    given = F.col(high).isNull() | (F.col(low) <= F.col(high))
    wanted = [c for c in columns or ranges.columns if c not in keys]
    brought = F.struct(*wanted).alias("_range")
    cut = ranges.filter(given).select(*keys, F.col(low).alias("_low"), F.col(high).alias("_high"), brought, level.alias("_level"), F.explode(bins).alias("_bin"))
    own = F.array(*[F.struct(F.lit(i).alias("_level"), F.floor(F.col("_point") / w).cast("long").alias("_bin")) for i, w in enumerate(widths)], F.struct(F.lit(len(widths)).alias("_level"), F.lit(0).cast("long").alias("_bin")))
    at = points.select(*keys, F.col(point).alias("_point")).distinct().select("*", F.inline(own))
    held = (F.col("_point") >= F.col("_low")) & (F.col("_high").isNull() | (F.col("_point") <= F.col("_high")))
    met = at.join(cut, [*keys, "_level", "_bin"]).filter(held).select(*keys, "_point", "_low", "_range")
    place = F.row_number().over(Window.partitionBy(*keys, "_point").orderBy("_low"))
    packs = met.withColumn("_pack", F.floor((place - 1) / PACK)).groupBy(*keys, "_point", "_pack").agg(F.collect_list("_range").alias("_ranges"))
    # a column by itself needs no struct for each row of the result
    packs, each = (packs, F.inline("_ranges")) if len(wanted) > 1 else (packs.withColumn("_ranges", F.col("_ranges")[wanted[0]]), F.explode("_ranges").alias(wanted[0]))
    # what is read says little of how much there will be: a number that is given is not made smaller
    dealt = points.withColumn("_point", F.col(point)).repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "_point")
    # lists come one after the other, each with all rows; a broadcast would turn that round
    rows = packs.drop("_pack").hint("merge").join(dealt, [*keys, "_point"])
    return rows.select(*keys, *[c for c in points.columns if c not in keys], each)


def _halvings(low: Column, end: Column) -> Column:
    """The aligned pieces of [low, end) as (level, cell), a piece of level i being 2**i wide: two of a level at most."""
    start = F.struct(low.alias("a"), end.alias("b"), F.array().cast("array<struct<_level:int,_cell:bigint>>").alias("out"))

    def step(s: Column, level: Column) -> Column:
        piece = lambda x: F.array(F.struct(level.alias("_level"), x.alias("_cell")))
        none, inside = F.array().cast("array<struct<_level:int,_cell:bigint>>"), s["a"] < s["b"]
        left, right = inside & (s["a"].bitwiseAND(F.lit(1)) == 1), inside & (s["b"].bitwiseAND(F.lit(1)) == 1)
        # an odd begin and an odd end are pieces of this level, unless they are the same and the begin took it
        a, b = s["a"] + F.when(left, 1).otherwise(0), s["b"] - F.when(right, 1).otherwise(0)
        out = F.concat(s["out"], F.when(left, piece(s["a"])).otherwise(none), F.when(right & (b >= a), piece(b)).otherwise(none))
        return F.struct(F.shiftright(a, 1).alias("a"), F.shiftright(b, 1).alias("b"), out.alias("out"))

    levels = F.greatest(F.lit(0), F.ceil(F.log2((end - low).cast("double"))).cast("int")) + 1
    return F.aggregate(F.sequence(F.lit(0), levels), start, step)["out"]


def first_range(points: DataFrame, ranges: DataFrame, keys: list[str], id_cols: list[str], point: str, low: str, high: str, order: list[Column], columns: list[str]) -> DataFrame:
    """Every point with ``columns`` of the first range that holds it by ``order``, or nulls; points and bounds are whole numbers, a null high is open.

    A range is cut into aligned pieces of powers of two, and of all ranges on a
    piece the first is kept; a point looks at one piece of every level that there
    is. So no point meets all the ranges that hold it, and each distinct point of
    a key is looked up once, however many rows have it.
    """
    last = points.agg(F.max(F.col(point).cast("long"))).scalar()  # beyond the last point no range matters
    first = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c) for c in columns])
    own = ranges.select(*keys, F.col(low).cast("long").alias("_low"), F.least(F.coalesce(F.col(high).cast("long"), last), last).alias("_high"), first.alias("_first")).filter("_low <= _high")
    whole = own.groupBy(*keys, "_low", "_high").agg(F.min("_first").alias("_first"))
    pieces = whole.select(*keys, F.inline(_halvings(F.col("_low"), F.col("_high") + 1)), "_first").groupBy(*keys, "_level", "_cell").agg(F.min("_first").alias("_first"))
    levels = F.coalesce(pieces.agg(F.collect_set("_level")).scalar(), F.array().cast("array<int>"))
    looked = points.select(*keys, F.col(point).cast("long").alias("_point")).distinct()
    at = looked.select(*keys, "_point", F.explode(levels).alias("_level")).withColumn("_cell", F.expr("shiftright(_point, _level)"))
    best = at.join(pieces, [*keys, "_level", "_cell"]).groupBy(*keys, "_point").agg(F.min("_first").alias("_best"))
    best = best.select(*keys, "_point", *[F.col("_best")[c].alias(c) for c in columns])
    return points.withColumn("_point", F.col(point).cast("long")).join(best, [*keys, "_point"], "left").drop("_point")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], at: str, when: str, columns: list[str]) -> DataFrame:
    """Left rows with ``columns`` of the last right row of their key at or before them; nulls before the first.

    Both sides meet in one window over (key, time): one shuffle, no nested loop.
    Of right rows at one time the greatest by value counts.
    """
    tops = right.groupBy(*keys, F.col(when).alias("_t")).agg(F.max(F.struct(*columns)).alias("_v"))
    a = left.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(tops.schema["_v"].dataType).alias("_v"))
    b = tops.select(*keys, "_t", F.lit(0).alias("_side"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), "_v")
    w = Window.partitionBy(*keys).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = a.unionByName(b).withColumn("_last", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1")
    return filled.select("_row.*", *[F.col("_last")[c].alias(c) for c in columns])


#: Letters of English by how rare they are; what is not here counts as rarer.
RARITY = "zqxjkvbpygfwmucldrhsnioate "


def _numbered(c: Column) -> Column:
    """The characters of a string, rare ones first, each with how often it came before."""
    parts = F.filter(F.split(c, ""), lambda x: x != "")
    ordered = F.transform(F.array_sort(F.transform(parts, lambda x: F.struct(F.instr(F.lit(RARITY), x).alias("at"), x.alias("x")))), lambda s: s["x"])
    # the order is computed once for all characters
    return F.get(F.transform(F.array(ordered), lambda o: F.transform(o, lambda x, i: F.concat(x, (i - F.array_position(o, x)).cast("string")))), F.lit(0))


def fuzzy_pairs(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, least: float = 90.0) -> DataFrame:
    """Pairs of the same key whose strings are close; empty strings are close to empty ones.

    A prefix filter on characters: a string of n characters shares at least
    n r / (2 - r) of them with one of ratio r, so both hold the same character,
    with repeats counted, among their first n (1 - r / (2 - r)) + 1 in one
    order. Pairs meet on the first that they share, and are scored only if
    their characters and lengths leave room for the ratio. Strings are compared
    once for each key, however many rows have them; rows meet by their strings.
    """
    close = _close_strings(left.select(*keys, a).distinct(), right.select(*keys, b).distinct(), keys, a, b, least)
    # few strings may stand for very many pairs of rows: both sides are dealt out, none is broadcast
    met = left.join(close.hint("merge"), [*keys, a]).join(right.hint("merge"), [*keys, b])
    return met.select(*keys, *[c for c in left.columns if c not in keys], *[c for c in right.columns if c not in keys])


def _close_strings(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, least: float) -> DataFrame:
    r = least / 100

    def first(c: str) -> Column:
        n = F.floor(F.size(c) * F.lit(1 - r / (2 - r)) + F.lit(1e-9)).cast("int") + 1
        return F.explode(F.when(F.size(c) > 0, F.slice(c, F.lit(1), n)).otherwise(F.array(F.lit(""))))

    x = left.withColumn("_a", _numbered(F.col(a))).withColumn("_x", first("_a"))
    y = right.withColumn("_b", _numbered(F.col(b))).withColumn("_x", first("_b"))
    shared = F.array_intersect("_a", "_b")
    enough = 2 * F.size(shared) >= F.lit(r) * (F.size("_a") + F.size("_b")) - F.lit(1e-9)
    met = x.join(y, [*keys, "_x"]).filter(length_close(F.col(a), F.col(b)) & enough & (F.col("_x") == F.coalesce(F.get(shared, F.lit(0)), F.lit(""))))
    return met.drop("_x", "_a", "_b").filter(close_match(F.col(a), F.col(b), least))


def fuzzy_anti(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, least: float = 90.0) -> DataFrame:
    """Left rows without a close string on the right of their key."""
    hit = fuzzy_pairs(left.select(*keys, a).distinct(), right.select(*keys, b).distinct(), keys, a, b, least).select(*keys, a).distinct()
    return left.join(hit, [*keys, a], "left_anti")


def anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Work that is left: rows whose key the right side does not have."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows without orphans."""
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one side only, and of which."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("right")))


def conjunction(*conditions: Column | None) -> Column:
    """All of the conditions that are given."""
    return reduce(lambda x, y: x & y, [c for c in conditions if c is not None], F.lit(True))


def facets(isin: dict | None = None, at_least: dict | None = None, at_most: dict | None = None, equal: dict | None = None, flags: list[str] | None = None, like: dict | None = None) -> Column:
    """A filter from whatever facets are set; a None value sets none."""
    parts: list[Column] = []
    parts += [F.col(c).isin(list(v)) for c, v in (isin or {}).items() if v]
    parts += [F.col(c) >= v for c, v in (at_least or {}).items() if v is not None]
    parts += [F.col(c) <= v for c, v in (at_most or {}).items() if v is not None]
    parts += [F.col(c) == v for c, v in (equal or {}).items() if v is not None]
    parts += [F.col(c) for c in flags or []]
    parts += [F.lower(F.col(c)).contains(v.lower()) for c, v in (like or {}).items() if v]
    return conjunction(*parts)
