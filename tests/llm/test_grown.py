"""What must not grow with the input: what is broadcast, and what is held for every byte of a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from folioscale.llm import langid, topk


def test_blocks_of_queries_are_not_broadcast(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(900)], "vec_id long, embedding array<float>")
    found = topk.top_k(df, every=30, part=64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin [node") == 1 and "BroadcastExchange" not in plan.split("SortMergeJoin [node")[1].split("Scan parquet")[0]
    assert found.count() == 30 * 10


def test_one_repeated_id_still_gives_a_pivot(spark):
    df = spark.createDataFrame([(100, [float(i), 1.0]) for i in range(600)] + [(7, [3.0, 2.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in topk.top_k(df, pivots=1, part=100).collect()] == [(100, 7)]


def test_scoring_holds_little_for_each_byte():
    model = langid.TextModel(["a", "b"], {"a": ["some words of one language"], "b": ["andere worte einer sprache"]})
    column = pa.array(["words of one language, some " * 4000] * 150, pa.string())
    tracemalloc.start()
    model.score(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * column.nbytes
