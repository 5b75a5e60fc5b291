"""The vector lists and the trigram index on small tables."""

import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscale.plans import search, trigrams, vectors
from folioscale.sources.catalog import Catalog


def space():
    return f"s_{uuid.uuid4().hex[:8]}"


def exact(data, query, k):
    q = np.array(query) / np.linalg.norm(query)
    sims = sorted(((-float(np.dot(np.array(v) / np.linalg.norm(v), q)), i) for i, v in data))
    return [i for _, i in sims[:k]]


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 18))
    return [(i, (centers[i % 40] + 0.4 * rng.normal(size=18)).tolist()) for i in range(1500)]


def test_vector_lists_recall_and_pruning(spark, clustered):
    rows = spark.createDataFrame([(i, v, i % 3) for i, v in clustered], "id long, embedding array<float>, kind int")
    index = vectors.InvertedVectors(Catalog(spark), space(), "v")
    index.fit(rows)
    index.put(rows)
    assert index.books().probes < len(index.books().lists) / 2
    asked = [x for x in clustered if x[0] % 20 == 0]
    for kind, part in ((None, clustered), (1, [x for x in clustered if x[0] % 3 == 1])):
        got = {}
        for r in index.search(asked, 10, **({} if kind is None else {"kind": kind})).collect():
            got.setdefault(r.query_id, {})[r["rank"]] = r.id
        hits = sum(len(set(exact(part, v, 10)) & set(got[i].values())) for i, v in asked)
        assert hits >= 0.95 * 10 * len(asked) and all(sorted(g) == list(range(1, 11)) for g in got.values())
    # one query reads the partitions of its lists, and the value reaches the scan
    plan = index.search(asked[:1], 10, probes=2, kind=1)._jdf.queryExecution().executedPlan().toString()
    assert "list" in plan.split("PartitionFilters: [")[1].split("]")[0] and "EqualTo(kind,1)" in plan
    # every list read and every row scored again: exact
    near = index.search(asked[:5], 10, probes=10**6, again=1000).collect()
    assert [[r.id for r in sorted(near, key=lambda r: r["rank"]) if r.query_id == i] for i, _ in asked[:5]] == [exact(clustered, v, 10) for i, v in asked[:5]]


def test_vector_lists_take_the_place_of_a_key(spark, clustered):
    schema = "id string, embedding array<float>, list_of string"
    index = vectors.InvertedVectors(Catalog(spark), space(), "v")
    rows = [(str(i), v, "a") for i, v in clustered[:200]]
    hard = [("null", None, "a"), ("zero", [0.0] * 18, "a"), ("nan", [float("nan")] * 18, "a"), ("short", [1.0], "a"), (None, clustered[3][1], "a")]
    index.fit(spark.createDataFrame(rows, schema))
    index.put(spark.createDataFrame(rows + hard, schema))
    index.put(spark.createDataFrame([("7", [-x for x in clustered[7][1]], "b")], schema))  # moves to another list
    found = index.search([("q", [-x for x in clustered[7][1]]), ("none", [0.0] * 18), ("wide", [1.0])], 1, probes=100)
    assert [(r.query_id, r.id) for r in found.collect()] == [("q", "7")]
    assert index.catalog.read(index.namespace, "v").filter("id = '7'").count() == 1
    assert index.catalog.read(index.namespace, "v").count() == 201
    with pytest.raises(ValueError):
        index.fit(spark.createDataFrame([], schema))


def test_many_queries_are_parts_of_tasks(spark, clustered, monkeypatch):
    """Rows and queries go to tasks in parts of bounded size; the rows found do not depend on these, and no query adds to the plan."""
    rows = spark.createDataFrame(clustered + [(1500 + i, clustered[3][1]) for i in range(300)], "id long, embedding array<float>")
    index = vectors.InvertedVectors(Catalog(spark), space(), "v")
    index.fit(rows)
    index.put(rows)
    asked = [x for x in clustered if x[0] % 5 == 0]
    ranked = lambda found: sorted((r.query_id, r["rank"], r.id) for r in found.collect())
    whole = ranked(index.search(asked, 10))
    assert len({x for x, _, _ in whole}) == len(asked) and len(whole) > 9.9 * len(asked)
    monkeypatch.setattr(vectors, "NUMBERS", 18 * 100)
    table = spark.createDataFrame(asked + asked[:9] + [(-1, None), (-2, [0.0] * 18), (-3, [1.0]), (-4, [float("inf")] * 18)], "query_id long, query array<float>")
    for queries in (asked, table):
        found = index.search(queries, 10)
        assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
        got = ranked(found)
        assert len(got) == len(whole) and len(set(got) & set(whole)) >= 0.98 * len(whole)
    # a list larger than a part is split, small ones share a part
    assert vectors._dealt({0: 40, 1: 50, 2: 30, 3: 250, 5: 10}, 6, 100) == ([0, 0, 1, 2, 5, 5], [1, 1, 1, 3, 1, 1])


def test_places_turn_back():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 400):
        steps = rng.integers(0, [1, 130, 20000, 2**21, 2**33][n % 5], n)
        data, begins = trigrams.pack(steps)
        assert trigrams.unpack(data).tolist() == np.cumsum(steps).tolist() and len(begins) == n
    assert trigrams.unpack(trigrams.pack(np.array([127, 128, 2**14, 2**21, 2**28, 2**34]))[0]).tolist() == np.cumsum([127, 128, 2**14, 2**21, 2**28, 2**34]).tolist()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    hard = [None, "", "ab", "abc", "100% SURE_x", "ΟΔΟΣ ΟΔΟΣΑ", "Éa \U0001f600\U0001f600\U0001f600 b", "aaaaaaa", "tie aa", "tie aa", "It's a 'quote' \\ done", "x" * 40000 + "needle" + "y" * 40000]
    return [(i, t) for i, t in enumerate(hard + [" ".join(rng.choice(["Sword", "fire", "of", "the", "ice", "magic", "aab", "ring"]) for _ in range(rng.randint(1, 40))) for _ in range(200)])] + [(None, "no key fire")]


@pytest.fixture(scope="module")
def index(spark, texts):
    made = trigrams.TextIndex(Catalog(spark), space(), "t", "doc", "body")
    made.build(spark.createDataFrame([(*x, 1) for x in texts], "doc long, body string, n int"))
    return made


def test_index_finds_what_contains_finds(spark, texts, index):
    rows = spark.createDataFrame([x for x in texts if x[0] is not None], "doc long, body string")
    for part in ("fire", "the MAGIC", "aab", "aaa", "100%", "_x", "ΟΔΟΣ", "οδοσα", "\U0001f600\U0001f600\U0001f600", "needle", "'quote' \\", "no such", "re", ""):
        want = sorted(r.doc for r in rows.filter(F.lower("body").contains(part.lower())).collect())
        assert sorted(r.doc for r in index.holding(part).collect()) == want, part
    places = {r.doc: r.places for r in index.candidates("needle").collect()}
    assert places == {11: [40000]}


def test_index_keywords_equal_a_scan(spark, texts, index):
    rows = spark.createDataFrame([x for x in texts if x[0] is not None], "doc long, body string")
    for query in ("fire sword", "magic of ice", "fire fire", "at of", "", "ring nowhere"):
        assert [r.doc for r in index.keyword_all(query, 15).collect()] == [r.doc for r in search.keyword_all(rows, query, 15, "body", "doc").collect()]
        assert [(r.doc, r.score) for r in index.keyword_any(query, 15).collect()] == [(r.doc, r.score) for r in search.keyword_any(rows, query, 15, "body", "doc").collect()]


def test_index_reads_its_own_postings(index):
    plan = index.candidates("needle")._jdf.queryExecution().executedPlan().toString()
    assert "body" not in plan and "shard" in plan.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [" in plan


def test_index_of_nothing(spark):
    made = trigrams.TextIndex(Catalog(spark), space(), "t", "doc", "body")
    made.build(spark.createDataFrame([], "doc long, body string"))
    assert made.holding("fire").count() == 0 and made.keyword_any("fire", 3).count() == 0
