"""Intervals: coalescing and overlays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coalesce_intervals(df: DataFrame, keys: list[str], low: str, high: str, gap: int = 0) -> DataFrame:
    """Unions of intervals that overlap, touch, or lie at most ``gap`` apart."""
    order = Window.partitionBy(*keys).orderBy(low, high)
    reach = F.max(high).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_fresh", F.when(reach.isNull() | (F.col(low) > reach + gap), 1).otherwise(0))
    numbered = marked.withColumn("_island", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "_island").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("_island")


def blank_ranges(text: Column, ranges: Column, low: str = "char_start", high: str = "char_end") -> Column:
    """The text with [low, high) ranges blanked; line breaks stay, and so do all positions."""

    def step(t: Column, r: Column) -> Column:
        n = F.length(t)
        a, b = F.least(F.greatest(r[low], F.lit(0)), n).cast("int"), F.least(F.greatest(r[high], F.lit(0)), n).cast("int")
        b = F.greatest(a, b)
        return F.concat(F.substring(t, F.lit(1), a), F.regexp_replace(F.substring(t, a + 1, b - a), "[^\n]", " "), F.substring(t, b + 1, n))

    return F.aggregate(F.coalesce(ranges, F.array()), text, step)


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Whether two closed intervals meet."""
    return (a1 >= b0) & (b1 >= a0)


def cluster_positions(df: DataFrame, keys: list[str], x: str, column_gap: float = 50.0, tolerance: float = 10.0) -> DataFrame:
    """Depth of indented lines: columns at gaps over ``column_gap``, then levels within ``tolerance`` of a level's start.

    Returns the distinct positions of each key with column_no and depth.
    """
    places = df.select(*keys, x).distinct()
    w = Window.partitionBy(*keys).orderBy(x)
    columns = places.withColumn("_g", F.when(F.col(x) - F.lag(x).over(w) > column_gap, 1).otherwise(0)).withColumn("column_no", F.sum("_g").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    offset = F.col(x) - F.min(x).over(Window.partitionBy(*keys, "column_no"))
    packed = columns.withColumn("_off", offset).groupBy(*keys).agg(F.array_sort(F.collect_set("_off")).alias("_offs"))

    def step(s: Column, v: Column) -> Column:
        fresh = s["start"].isNull() | (v - s["start"] > tolerance)
        start, level = F.when(fresh, v).otherwise(s["start"]), F.when(fresh, s["level"] + 1).otherwise(s["level"])
        return F.struct(start.alias("start"), level.alias("level"), F.array_append(s["out"], F.struct(v.alias("off"), level.alias("depth"))).alias("out"))

    state = F.struct(F.lit(None).cast("double").alias("start"), F.lit(-1).alias("level"), F.array().cast("array<struct<off:double,depth:int>>").alias("out"))
    levels = packed.select(*keys, F.inline(F.aggregate(F.transform("_offs", lambda v: v.cast("double")), state, step)["out"]))
    return columns.withColumn("off", offset.cast("double")).join(levels, [*keys, "off"]).select(*keys, x, "column_no", "depth")
