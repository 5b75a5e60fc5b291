"""Exact ranks from histograms of key digits: no global sort, and no window over a whole group.

The digits of a key, eight bits each, are counted level by level. What a row's
buckets leave before it at each level adds up to its bucket's first rank; only
inside a bucket of the last level are rows ordered by themselves. Where a key
repeats beyond a bucket's size, the digits of a second key, a hexadecimal
digest, go on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

DIGIT = 8
#: So many buckets of a group are put in order at once; more go one level up first.
BUCKETS = 1024
#: So many bits of the second key can be used: its first 14 hexadecimal digits, below one bit for keys that are not null.
TIE_BITS = 57


@dataclass(frozen=True)
class Cut:
    """Where keys are cut into buckets: bits of the key left out, bits of the second key taken, and the least key, which stands for null."""

    shift: int
    tie_bits: int
    least: int
    width: int

    def buckets(self, key: str, tie: str) -> dict[str, Column]:
        whole = F.coalesce(F.col(key), F.lit(self.least).cast("long")).bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
        first = F.lit(0).cast("long")
        if self.tie_bits:
            digits = F.conv(F.rpad(F.substring(tie, 1, 14), 14, "0"), 16, 10).cast("long") + F.when(F.col(key).isNull(), F.lit(0)).otherwise(F.lit(1 << 56))
            first = F.shiftright(digits, TIE_BITS - self.tie_bits)
        return {"_a": _shifted(whole, self.shift), "_b": first}

    @property
    def columns(self) -> list[str]:
        """The bucket columns that differ between rows."""
        return ["_a", "_b"] if self.tie_bits else ["_a"]

    def coarser(self) -> Cut:
        if self.tie_bits:
            return Cut(self.shift, max(0, self.tie_bits - DIGIT), self.least, self.width)
        return Cut(min(64, self.shift + DIGIT), 0, self.least, self.width)

    @property
    def whole(self) -> bool:
        return not self.tie_bits and self.shift >= self.width


def _shifted(whole: Column, bits: int) -> Column:
    return F.lit(0).cast("long") if bits >= 64 else F.shiftrightunsigned(whole, bits)


def _step(h: DataFrame, group: list[str], fine: Cut) -> tuple[DataFrame, Cut]:
    """The histogram one level up."""
    up = fine.coarser()
    return h.groupBy(*group, *[c.alias(x) for x, c in _parent(fine, up).items()]).agg(F.sum("_rows").alias("_rows"), F.sum("_entries").alias("_entries")), up


def _parent(fine: Cut, up: Cut) -> dict[str, Column]:
    a = F.col("_a") if up.shift == fine.shift else _shifted(F.col("_a"), up.shift - fine.shift)
    return {"_a": a, "_b": F.shiftright("_b", fine.tie_bits - up.tie_bits)}


def _begins(h: DataFrame, group: list[str], cut: Cut) -> DataFrame:
    """The histogram with ``_begin``, the rows of the group before a bucket."""
    in_order = [F.col("_a").bitwiseXOR(F.lit(-(1 << 63)).cast("long")), F.col("_b")]
    if cut.whole or (h.groupBy(*group).count().agg(F.max("count")).first()[0] or 0) <= BUCKETS:
        return h.withColumn("_begin", F.sum("_rows").over(Window.partitionBy(*group).orderBy(*in_order)) - F.col("_rows"))
    above, up = _step(h, group, cut)
    above = _begins(written(above, "digits"), group, up)
    keys = [*group, "_a", "_b"]
    above = above.select(*[F.col(k).alias(f"_up{i}") for i, k in enumerate(keys)], F.col("_begin").alias("_above"))
    # at most 256 buckets below each
    digits = Window.partitionBy(*group, "_pa", "_pb").orderBy(*in_order)
    own = h.withColumns({f"_p{c[1:]}": x for c, x in _parent(cut, up).items()}).withColumn("_before", F.sum("_rows").over(digits) - F.col("_rows"))
    same = [F.col(x) == F.col(f"_up{i}") for i, x in enumerate([*group, "_pa", "_pb"])]
    return own.join(above, same).select(*keys, "_rows", "_entries", (F.col("_above") + F.col("_before")).alias("_begin"))


def measure(entries: DataFrame, group: list[str], key: str, tie: str, n: str, most: int = 1024, coarse: bool = False) -> tuple[Cut, DataFrame]:
    """Buckets of at most ``most`` entries, and their histogram: group, _a, _b, _rows, _entries, _begin.

    ``entries`` holds each (group, key, tie) once, ``n`` times over; group columns are
    not null. Buckets are the finest of the key's digits, or with ``coarse`` the
    coarsest that hold no more than ``most``.
    """
    least, largest = entries.agg(F.min(key), F.max(key)).first()
    least, largest = least or 0, largest or 0
    width = ((least ^ largest) & ((1 << 64) - 1)).bit_length()

    def counted(cut: Cut) -> tuple[DataFrame, int]:
        h = entries.withColumns(cut.buckets(key, tie)).groupBy(*group, "_a", "_b").agg(F.sum(n).alias("_rows"), F.count("*").alias("_entries"))
        h = written(h, "digits")
        return h, h.agg(F.max("_entries")).first()[0] or 0

    cut = Cut(min(DIGIT, width), 0, least, width)
    h, held = counted(cut)
    if held > most:  # one key with very many rows
        cut = Cut(0, min(TIE_BITS, DIGIT * -(-(held // most).bit_length() // DIGIT) + 1), least, width)
        h, held = counted(cut)
    while coarse and not cut.whole:
        above, up = _step(h, group, cut)
        if (above.agg(F.max("_entries")).first()[0] or 0) > most:
            break
        cut, h = up, written(above, "digits")
    return cut, _begins(h, group, cut)


def ranked(entries: DataFrame, group: list[str], key: str, tie: str, n: str, most: int = 1024) -> DataFrame:
    """Add ``rank``: how many rows of the group stand before the entry's first, by key (null first), then by tie."""
    cut, h = measure(entries, group, key, tie, n, most)
    keys = [*group, "_a", "_b"]
    cutrows = entries.withColumns(cut.buckets(key, tie))
    begins = h.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "_begin")
    inside = Window.partitionBy(*keys).orderBy(F.col(key).asc_nulls_first(), F.col(tie)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cutrows.join(begins, [F.col(k) == F.col(f"_h{i}") for i, k in enumerate(keys)])
    return placed.withColumn("rank", F.col("_begin") + F.sum(n).over(inside) - F.col(n)).select(*entries.columns, "rank")
