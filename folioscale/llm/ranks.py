"""Exact ranks and running sums of very large groups, without a task for each group.

Rows are cut into buckets by their order key. Bucket totals, a small table,
give what lies before a bucket; a window inside each bucket gives the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, group: list[str], position: Column, order: list[Column], amounts: dict[str, Column], buckets: int) -> DataFrame:
    """Add a column for each of ``amounts``: its sum over the rows of the same group that come before a row.

    ``position`` in [0, 1] must not fall where ``order`` (a total order) rises.
    """
    names = list(amounts)
    bucket = F.least(F.floor(position * buckets), F.lit(buckets - 1)).cast("long")
    cut = df.withColumns({"_bucket": bucket} | {f"_amount_{x}": amounts[x] for x in names})
    totals = cut.groupBy(*group, "_bucket").agg(*[F.sum(f"_amount_{x}").alias(f"_total_{x}") for x in names])
    # one row for each group and bucket; groups, not rows, come together here
    upto = Window.partitionBy(*group).orderBy("_bucket")
    keys = [*group, "_bucket"]
    b = totals.select(*[F.col(k).alias(f"_b{i}") for i, k in enumerate(keys)], *[(F.sum(f"_total_{x}").over(upto) - F.col(f"_total_{x}")).alias(f"_before_{x}") for x in names])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & cut[k].eqNullSafe(b[f"_b{i}"])
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cut.join(b, same).withColumns({x: F.col(f"_before_{x}") + F.sum(f"_amount_{x}").over(inside) - F.col(f"_amount_{x}") for x in names})
    return placed.select(*df.columns, *names)


def bucket_count(rows: int, each: int = 2000, most: int = 1 << 20) -> int:
    return max(1, min(most, -(-rows // each)))
