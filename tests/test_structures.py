"""Names, spelling, trees and mergeable counts against plain versions; queries on empty tables."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from folioscale import catalogue
from folioscale.operators import names, spelling, trees
from folioscale.plans import marts


@pytest.mark.parametrize("whole", [True, False])
def test_occurrences(spark, monkeypatch, whole):
    monkeypatch.setattr(names, "TEXTS", 300)
    monkeypatch.setattr(names, "NAMES", 2)
    rng = random.Random(4)
    words = ["Aab", "aa", "a", "b-b", "fire ball", "Éa", "İx", "x.", "aaaa", "(ab)"]
    texts = [(rng.choice(["f", "g"]), i, " ".join(rng.choice([*words, "ball", "zz", "fire"]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    texts += [("f", 90, None), (None, 91, "aa"), ("g", 92, ""), ("h", 93, "aa no names"), ("f", 94, "AAAAA aab" * 40)]
    listed = [(f, w) for f in "fg" for w in words] + [("f", "aa"), ("f", ""), ("f", None), (None, "aa"), ("i", "aa"), ("f", "AAB")]
    got = names.occurrences(spark.createDataFrame(listed, "file string, name string"), spark.createDataFrame([(*t, 1) for t in texts], "file string, doc long, text string, name int").drop("name"), ["file"], key="doc", whole=whole)
    want = []
    for f, n in sorted({x for x in listed if x[0] and x[1]}):
        low = names.lowered(n)
        for g, i, t in texts:
            if g == f and t:
                text = names.lowered(t)
                for p in range(len(text)):
                    b = p + len(low)
                    if text.startswith(low, p) and not (whole and ((text[b : b + 1].isalnum() and low[-1].isalnum()) or (p and text[p - 1].isalnum() and low[0].isalnum()))):
                        want.append((f, n, i, p))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_dictionary_check(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(3, 11)))
    entries = [(w, rng.randint(0, 3)) for w in sorted({word() for _ in range(150)})] + [("Castle", 5), ("castle", 1), ("no", 9), (None, 1)]
    texts = [(i, " ".join(rng.choice([word(), rng.choice(entries[:-4])[0]]) for _ in range(20))) for i in range(12)] + [(50, "The castel and a CASTLE, castel!"), (51, None), (52, ""), (53, "castle")]
    got = {(r.doc_id, r.word): r for r in spelling.check_texts(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(entries, "word string, weight int"), weight="weight", chars=5).collect()}
    weights = {}
    for w, n in entries:
        if w and len(w) >= 3:
            weights[w.lower()] = max(n, weights.get(w.lower(), 0))
    seen = {}
    for i, t in texts:
        for w in re.findall(r"[^\W\d_]{3,}", (t or "").lower()):
            if w not in {x.lower() for x, _ in entries if x}:
                seen[i, w] = seen.get((i, w), 0) + 1
    assert set(got) == set(seen)
    for (i, w), n in seen.items():
        allowed = 1 if len(w) <= spelling.SHORT else 2
        near = min(((levenshtein(w, e), -weights[e], e) for e in weights if levenshtein(w, e) <= allowed), default=(None, 0, None))
        r = got[i, w]
        assert (r.n, r.distance, r.suggestion) == (n, near[0], near[2])
        assert w in r.context.lower() and r.context in dict(texts)[i]
    assert got[50, "castel"].context == "The castel and "
    verdicts = spark.createDataFrame([(50, "Castel", "keep", 1), (50, "castel", "fix", 2), (1, "none", "x", 1)], "doc_id long, word string, verdict string, decided_at int")
    merged = spelling.merge_verdicts(spark.createDataFrame([(50, "castel"), (51, "other")], "doc_id long, word string"), verdicts)
    assert {(r.word, r.verdict) for r in merged.collect()} == {("castel", "fix"), ("other", "open")}


def test_trees_with_cycles_and_missing_parents(spark):
    nodes = [(1, None, 5), (2, 1, 3), (3, 1, 2), (4, 2, 7), (5, 77, 1), (6, 7, 1), (7, 8, 1), (8, 6, 1), (9, 8, 4), (10, 10, 1), (None, 1, 9), (4, 2, 7)]
    nodes += [(100 + i, 99 + i if i else 4, 1) for i in range(37)]
    df = spark.createDataFrame(nodes, "id long, parent_id long, v long")
    above = {}
    for r in trees.closure(df).collect():
        above.setdefault(r.id, {})[r.ancestor] = r.steps
    assert above[4] == {4: 0, 2: 1, 1: 2} and above[5] == {5: 0} and len(above[136]) == 40 and above[136][1] == 39
    assert all(above[i] == {i: None} for i in (6, 7, 8, 9, 10))
    got = {r.id: r for r in trees.nested(df, ["v"], F.col("v")).collect()}
    assert got[1].path == [1] and got[4].path == [1, 2, 4] and got[4].depth == 2 and got[136].depth == 39
    assert got[1].n_below == 41 and got[1].total == 5 + 3 + 2 + 7 + 37 and (got[1].high - got[1].low) == 40
    assert got[3].low == got[1].low + 1 and got[2].low == got[3].high + 1  # the smaller sister first
    assert (got[9].depth, got[9].path, got[9].low, got[9].n_below, got[9].total) == (None, None, None, 1, 4)
    rooted = [r for r in got.values() if r.path]
    assert sorted(r.low for r in rooted) == list(range(len(rooted)))
    for r in rooted:
        assert {x.id for x in rooted if r.low <= x.low <= r.high} == {i for i, a in above.items() if r.id in a}
    assert trees.nested(df.limit(0), ["v"], F.col("v")).count() == 0


def test_customers_merge(spark):
    rng = random.Random(3)
    day = lambda: datetime.date(2024, 1, rng.randint(1, 9))
    sales = [(day(), rng.choice(["n", "s", None]), rng.choice(["p", "q"]), rng.choice([1, 2, 40000, 10**12, -5, None]), 1.0, i) for i in range(200)]
    df = spark.createDataFrame(sales, "order_date date, region string, product string, customer long, amount double, order_id long")
    maps = marts.customer_bitmaps(df, F.col("customer"))
    for by in (["region"], ["product", "region"], []):
        want = {}
        for s in sales:
            if s[3] is not None:
                key = tuple({"region": s[1], "product": s[2]}[c] for c in by)
                want.setdefault(key, set()).add(s[3])
        assert {tuple(r)[:-1]: r.customers for r in marts.distinct_customers(maps, by).collect()} == {k: len(v) for k, v in want.items()}


@pytest.mark.parametrize("name", ["cosine_topk", "hybrid_search", "vector_index", "readers", "catalog_listing", "substring_index", "keyword_index", "vector_lists", "name_places", "dictionary_check", "contents_tree", "true_customers", "dashboard_sets", "whole_books", "entry_builder", "expected_content"])
def test_empty_tables(spark, small, tmp_path_factory, name):
    top = tmp_path_factory.mktemp("empty")
    for table in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        spark.read.parquet(f"{small}/{table}.parquet").limit(0).write.parquet(f"{top}/{table}.parquet")
    got = catalogue.queries()[name](spark, str(top)).collect()
    # a listing has its tables
    assert all(r.row_count == 0 for r in got) if name == "catalog_listing" else got == []
