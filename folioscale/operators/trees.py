"""Trees from parents: ancestors by pointer doubling, subtrees as intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def closure(nodes: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """key, ancestor, steps: each node with itself (0 steps) and all nodes above it, in as many rounds as the depth has binary digits.

    A parent that is null or no node ends the way up. Nodes on a cycle, or below
    one, have no root: they come with themselves alone and ``steps`` null.
    Repeated rows and null keys are left out.
    """
    own = nodes.filter(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.col(parent).alias("to")).dropDuplicates(["id"])
    ids = own.select("id")
    jump = written(own.join(ids.withColumnRenamed("id", "to"), "to", "left_semi").select("id", "to"), "jump")
    pairs = ids.select("id", F.col("id").alias("ancestor"), F.lit(0).cast("long").alias("steps"))
    reach, total = 1, ids.count()
    while reach <= total and not jump.isEmpty():
        # whoever is above by up to ``reach`` steps is reached from there by as many again
        further = pairs.join(jump.select(F.col("id").alias("ancestor"), "to"), "ancestor").select("id", F.col("to").alias("ancestor"), (F.col("steps") + reach).alias("steps"))
        pairs = written(pairs.unionByName(further), "pairs")
        jump = written(jump.join(jump.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select("id", F.col("next").alias("to")), "jump")
        reach *= 2
    lost = jump.select("id")  # further from a root than there are nodes
    rooted = pairs.join(lost, "id", "left_anti")
    cyclic = lost.select("id", F.col("id").alias("ancestor"), F.lit(None).cast("long").alias("steps"))
    return rooted.unionByName(cyclic).withColumnRenamed("id", key)


def nested(nodes: DataFrame, order: list[str], value: Column, key: str = "id", parent: str = "parent_id", group: str | None = None) -> DataFrame:
    """key, depth, path, low, high, n_below, total: where each node stands in its tree, and what its subtree holds.

    ``path`` has the keys from the root. A subtree is the interval [low, high] of
    its group, in the order of ``order`` (then key) among sisters; ``total`` is the
    sum of ``value`` over it. Nodes on or below a cycle have null depth, path and
    interval, and their own value.
    """
    found = written(closure(nodes, key, parent), "closure")
    own = nodes.filter(F.col(key).isNotNull()).dropDuplicates([key]).select(key, value.alias("_value"), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(key).alias("key")).alias("_order"), (F.col(group) if group else F.lit(0)).alias("_group"))
    sums = found.join(own.select(key, "_value"), key).groupBy("ancestor").agg(F.count("*").alias("n_below"), F.sum("_value").alias("total"))
    steps = F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("up"), "_above")))
    paths = found.filter("steps is not null").join(own.select(F.col(key).alias("ancestor"), F.col("_order").alias("_above")), "ancestor").groupBy(key).agg(F.transform(steps, lambda x: x["_above"]).alias("_path"))
    joined = own.join(sums.withColumnRenamed("ancestor", key), key).join(paths, key, "left")
    # what lies below a cycle is counted nowhere but at itself
    line = Window.partitionBy("_group", F.col("_path").isNull()).orderBy("_path")
    low = F.when(F.col("_path").isNotNull(), F.row_number().over(line) - 1)
    path = F.transform("_path", lambda x: x["key"])
    return joined.select(key, (F.size("_path") - 1).alias("depth"), path.alias("path"), low.alias("low"), (low + F.col("n_below") - 1).alias("high"), "n_below", "total").withColumn("depth", F.when(F.col("path").isNotNull(), F.col("depth")))
