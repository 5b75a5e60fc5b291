"""Findings of the fourth round."""

import random
import re
from pathlib import Path

from pyspark.sql import functions as F

from folioscale.operators import joins, spelling


def test_range_join_repeats_at_short_distance(spark, tmp_path):
    ranges = spark.range(2503).select(F.lit("a").alias("k"), F.col("id").alias("r"), F.lit(0).alias("lo"), F.lit(9).alias("hi"))
    points = spark.range(2503).select(F.lit("a").alias("k"), F.col("id").alias("q"), F.lit(5).alias("p"))
    joins.range_join(points, ranges, ["k"], "p", "lo", "hi").select("q", "r").write.parquet(f"{tmp_path}/out")
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.agg(F.count_distinct("q", "r")).first()[0] == got.count() == 2503**2
    # twelve bits for one of the ids of each row, unless rows repeat within a page
    assert sum(f.stat().st_size for f in Path(f"{tmp_path}/out").glob("*.parquet")) < 2503**2 * 0.8


def test_range_join_brings_what_is_asked(spark):
    ranges = [("a", i, None if i % 3 else i, 2 * i % 50, None if i % 7 == 0 else 2 * i % 50 + i % 90) for i in range(1100)] + [("b", 1, 1, 0, 5), (None, 2, 2, 0, 9), ("a", 3, 3, 9, 2), ("a", 4, 4, None, 9)]
    points = [("a", i, i % 60) for i in range(90)] + [("b", 200, 5), ("b", 201, 6), ("c", 202, 1), (None, 203, 1), ("a", 204, None), ("a", 0, 0)]
    p, r = spark.createDataFrame(points, "k string, q int, p int"), spark.createDataFrame(ranges, "k string, r int, v int, lo int, hi int")
    want = sorted(((*x, *y[1:]) for x in points for y in ranges if x[0] is not None and x[0] == y[0] and None not in (x[2], y[3]) and y[3] <= x[2] and (y[4] is None or x[2] <= y[4])), key=str)
    whole = joins.range_join(p, r, ["k"], "p", "lo", "hi")
    assert whole.columns == ["k", "q", "p", "r", "v", "lo", "hi"] and sorted(map(tuple, whole.collect()), key=str) == want
    for columns in (["v"], ["hi", "r"]):
        at = [3 + ["r", "v", "lo", "hi"].index(c) for c in columns]
        assert sorted(map(tuple, joins.range_join(p, r, ["k"], "p", "lo", "hi", columns=columns).collect()), key=str) == sorted(((*w[:3], *[w[i] for i in at]) for w in want), key=str)


def test_words_of_one_beginning_do_not_all_meet(spark):
    rng = random.Random(5)
    word = lambda: "mention" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    one, two = (spark.createDataFrame([(word(),) for _ in range(200)], "word string") for _ in range(2))
    lefts = [spelling.deletion_index(x).select("left", F.col("entry").alias(n)) for x, n in ((one, "a"), (two, "b"))]
    assert lefts[0].join(lefts[1], "left").select("a", "b").distinct().count() < 200 * 200 / 10


def test_places_in_long_texts(spark):
    rng = random.Random(6)
    known = [("castle", 3), ("dragon", 2), ("the", 9)]
    texts = []
    for i, n in enumerate([1, 63, 64, 65, 128, 129, 400]):
        words = [rng.choice(["castle", "Dragon", "the", "7", "--", "of", "é"]) for _ in range(n)]
        for w in ("castel", "qwerty", "drágon"):
            words.insert(rng.randint(0, n), w)
        texts.append((i, rng.choice(["", " ", "1. "]) + " ".join(words) + rng.choice(["", "."])))
    got = spelling.check_texts(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(known, "word string, weight int"), weight="weight", chars=6).collect()
    assert sorted((r.doc_id, r.word) for r in got) == sorted((i, w) for i, _ in texts for w in ("castel", "qwerty", "drágon"))
    for r in got:
        text = texts[r.doc_id][1]
        at = re.search(rf"(?<![^\W\d_]){r.word}(?![^\W\d_])", text.lower()).start()
        assert r.context == text[max(at - 6, 0) : at + len(r.word) + 6]
