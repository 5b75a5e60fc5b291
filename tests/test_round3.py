"""Findings of the third round: each test failed before its finding was mended."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscale.functions.keys import stable_hash
from folioscale.operators import documents, joins, layout, names, spelling
from folioscale.plans import marts, quality, registered_relational, registry, silver

from .test_operators import SPANS, book, spans_of


def test_first_range_without_pairs(spark, monkeypatch):
    """The first range of each point against all of them, and no join of points with every range that holds them."""
    rng = random.Random(6)
    points = [(rng.choice("ab"), i, rng.choice([rng.randint(-70, 70), rng.randint(-(10**12), 10**12), None])) for i in range(400)] + [(None, 900, 3)]
    ranges = [(rng.choice("ab"), lo := rng.randint(-80, 80), rng.choice([lo + rng.randint(-3, 40), lo, None, 2**63 - 1, 10**11]), rng.randint(0, 90), str(i)) for i in range(150)] + [("a", None, 5, 0, "x"), (None, 0, 9, 0, "y")]
    monkeypatch.setattr(joins, "range_join", None)
    got = joins.first_range(spark.createDataFrame(points, "k string, i int, p long"), spark.createDataFrame(ranges, "k string, lo long, hi long, o int, name string"), ["k"], ["i"], "p", "lo", "hi", [F.col("o"), F.col("name")], ["name"])
    want = {}
    for k, i, p in points:
        held = [(o, n) for g, lo, hi, o, n in ranges if k is not None and g == k and p is not None and lo is not None and lo <= p and (hi is None or p <= hi)]
        want[i] = min(held)[1] if held else None
    assert {r.i: r.name for r in got.collect()} == want and got.count() == len(points)


def test_cells_of_a_long_table(spark):
    """Rows are numbered in one pass, not by a list that is copied for each span, and cells are computed once."""
    lines = [("H", 40, [(10, "Name"), (120, "Cost")])] + [("B", 52 + 12 * i, [(10, f"item{i}"), (125, str(i))][: 1 + i % 3 // 1 if i % 3 < 2 else 2]) for i in range(60)]
    df = spark.createDataFrame(spans_of(lines), SPANS)
    regions = layout.table_regions(df, layout.LayoutSettings(header_font="H"))
    got = layout.region_rows(layout.table_cells(df, regions))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "array_append" not in plan and plan.count("FlatMapGroupsInPandas") == 2
    rows = {r.row_index: r.cells for r in got.collect()}
    assert rows[0] == ["Name", "Cost"] and all(rows[i + 1] == ([f"item{i}", str(i)] if i % 3 else [f"item{i}", ""]) for i in range(59))


@pytest.mark.parametrize("tolerance", [0.0, 0.1, 3.0])
def test_row_numbers(tolerance):
    rng = random.Random(2)
    tops = sorted(rng.choice([rng.randint(0, 30) / 10, rng.uniform(0, 40)]) for _ in range(300))
    want, top, row = [], None, -1
    for y in tops:
        if top is None or y - top > tolerance:
            top, row = y, row + 1
        want.append(row)
    assert layout.row_numbers(np.array(tops), tolerance).tolist() == want


def test_sections_without_pages(spark):
    """A section that has no pages is not overfull; a null key is a section, and unknown sizes are not tiny."""
    toc = spark.createDataFrame([("a", False, 1, 400), (None, False, 1, 400)], "source string, is_excluded boolean, page_start int, page_end int")
    chunks = spark.range(18_100).select(F.when(F.col("id") >= 9000, "a").alias("source"), F.lit("t").alias("entry_title"), F.lit(None).cast("long").alias("char_count"))
    assert quality.section_issues(toc, chunks, key="source", crowded=None).collect() == []
    assert sorted(r.issue for r in quality.section_issues(toc, chunks, key="source").collect()) == ["CHUNK_OVERFLOW"] * 2


def test_names_that_overlap_themselves(spark):
    """Without overlapping, the next place is looked for behind the one before, even if that is within a word."""
    texts = spark.createDataFrame([("f", 1, "in in in in in inin in in")], "file string, doc long, text string")
    found = lambda name, **how: sorted(r.place for r in names.occurrences(spark.createDataFrame([("f", name)], "file string, name string"), texts, ["file"], key="doc", **how).collect())
    assert found("In in") == [0, 3, 6, 9, 20]
    # behind 0 and 6 come 12 and 17, which are no whole places but take their letters, those of 20 too
    assert found("In in", overlapping=False) == [0, 6]


def test_copies_are_compared_once(spark):
    """Strings of a key meet once, however many rows have them, and every pair of rows is there."""
    rows = spark.range(600).select((F.col("id") % 2).alias("k"), F.element_at(F.array(F.lit("hot bolt"), F.lit("hot bolts"), F.lit("ring")), (F.col("id") % 3 + 1).cast("int")).alias("a"), "id")
    other = rows.select("k", F.col("a").alias("b"), F.col("id").alias("other"))
    got = joins.fuzzy_pairs(rows, other, ["k"], "a", "b")
    assert got.columns == ["k", "a", "id", "b", "other"] and got.count() == 2 * (200 * 200 + 100 * 100) == got.distinct().count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("ArrowEvalPython") :]
    assert below.count("Aggregate") >= 2


def test_suggestions_without_a_shuffle_of_candidates(spark):
    """Words meet their candidates without sending those on, and a text is not searched again for each of its words."""
    texts = spark.createDataFrame([(1, "ab Castel-castel, the castel12 abc"), (2, "x" * 50 + "castl cas")], "doc_id long, text string")
    entries = spark.createDataFrame([("castle", 2), ("the", 1), ("cat", 1)], "word string, weight int")
    found = spelling.check_texts(texts, entries, weight="weight", chars=4)
    assert sorted((r.doc_id, r.word, r.n, r.context, r.suggestion, r.distance) for r in found.collect()) == [(1, "abc", 1, "l12 abc", None, None), (1, "castel", 3, "ab Castel-cas", "castle", 2), (2, "cas", 1, "stl cas", "cat", 1), (2, "xx" * 25 + "castl", 1, "xx" * 25 + "castl cas", None, None)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_instr" not in plan.lower()
    near = spelling.suggestions(entries, spelling.deletion_index(entries))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[word#\d+, entry", near)


def test_few_customers_take_few_bytes(spark):
    """A stored set grows with its customers; a bitmap has 4,096 bytes for one of them."""
    sales = spark.range(50).select(F.lit("2024-01-01").alias("order_date"), F.lit("n").alias("region"), F.col("id").cast("string").alias("product"), "id")
    maps = marts.customer_bitmaps(sales, F.col("id") * 1000)
    assert maps.agg(F.sum(F.length(F.to_json(F.struct("customers"))))).first()[0] < 50 * 64
    assert [tuple(r) for r in marts.distinct_customers(maps, ["region"]).collect()] == [("n", 50)]


def test_more_sales_are_more_tasks(spark, small, monkeypatch):
    """Line items and orders are dealt into as many parts as there are line items for, whatever else is set."""
    t = lambda name: registry.table(spark, small, name)
    monkeypatch.setattr(registered_relational, "SALES_ROWS", 7)
    plan = registered_relational._sales(t)._jdf.queryExecution().optimizedPlan().toString()
    parts = -(-t("lineitem").count() // 7)
    assert re.search(rf"RepartitionByExpression \[l_orderkey#\d+L?\], {parts}\b", plan) and re.search(rf"RepartitionByExpression \[o_orderkey#\d+L?\], {parts}\b", plan)


def test_range_join_looks_up_distinct_points(spark):
    """Rows of one point look up its ranges once, without their texts, and every row meets each of its ranges."""
    rng = random.Random(5)
    points = [(rng.choice("ab"), rng.choice([None, rng.randint(-9, 9), rng.randint(0, 900)]), f"t{i}") for i in range(300)] + [(None, 3, "null")]
    ranges = [(rng.choice("ab"), lo := rng.randint(-20, 600), rng.choice([None, lo + rng.choice([-1, 0, 9, 70, 10**4, 10**6])]), f"r{i}") for i in range(60)] + [(None, 0, 9, "x"), ("a", None, 5, "y"), ("b", 0, 9, "r0"), ("b", 0, 9, "r0")]
    got = joins.range_join(spark.createDataFrame(points, "k string, p int, page_text string"), spark.createDataFrame(ranges, "k string, lo int, hi int, name string"), ["k"], "p", "lo", "hi")
    assert got.columns == ["k", "p", "page_text", "lo", "hi", "name"]
    want = [(k, t, n) for k, p, t in points for g, lo, hi, n in ranges if k is not None and g == k and p is not None and lo is not None and lo <= p and (hi is None or p <= hi)]
    assert sorted((r.k, r.page_text, r.name) for r in got.collect()) == sorted(want) and len(want) > 300
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [k" in plan and not re.search(r"Generate .*page_text", plan)


def test_descriptions_are_made_once(spark):
    """A text is taken apart once for its head and once for its footer; heads, footers and empty texts as line by line."""
    rng, fields = random.Random(8), ["Range", "Saving Throw", "A.B"]
    lines = ["Range: 1", "  RANGE: 2", "saving throw: none", "\t a.b:", "aXb: 1", "  goes on", "abc", " ab ", "", "It does harm.", "The material component is sand.", " material component: ash", "Range of fire"]
    texts = ["\n".join(rng.choice(lines[:9] if rng.random() < 0.6 else lines) for _ in range(rng.randint(0, 14))) for _ in range(300)] + [None, "", "Range: 1", "Range: 1\nThe material is gone", "x\nThe material is gone"]
    df = spark.createDataFrame([(i, "f", x, i % 3 or None) for i, x in enumerate(texts)], "entry_id int, source_file string, content string, spell_level int")
    want = {}
    for i, x in enumerate(texts):
        shown = (x or "").strip()
        if x is not None and i % 3:
            rows, n = x.split("\n"), 0
            while n < len(rows) and (any(rows[n].strip().lower().startswith(f.lower() + ":") for f in fields) or (n and (rows[n].startswith("  ") or len(rows[n].strip()) < 5))):
                n += 1
            rows = "\n".join(rows[n:]).strip().split("\n")
            cuts = [j for j in range(max(1, len(rows) - 7), len(rows)) if re.match("(?i)the material|material component", rows[j].strip())]
            shown = "\n".join(rows[: cuts[-1]] if cuts else rows).strip()
        if shown:
            want[i] = shown
    got = silver.entry_descriptions(df, fields)
    assert got.columns == ["entry_id", "source_file", "description_type", "content"] and {r.entry_id: r.content for r in got.collect()} == want and 150 < len(want) < 300
    assert silver.entry_descriptions(df, []).count() == sum(bool((x or "").strip()) for x in texts)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2


def test_entries_shuffle_their_texts_three_times(spark):
    """Pages go to their chapters' files, to their chapters and sections to each other; keys of the contents come without a further shuffle."""
    pages, toc, _ = book(spark)
    twice = toc.filter("title = 'Hold'").withColumn("parent_title", F.lit("Other"))
    toc = toc.unionByName(twice).unionByName(toc.filter("title = 'Fly'").withColumn("title", F.lit("Chart")).withColumn("is_table", F.lit(True)))
    tables = spark.createDataFrame([("b", "Chart", 0, '["a"]'), ("b", "Chart", 1, '["1"]')], "source_file string, toc_title string, row_index int, cells string")
    ids = toc.withColumn("id", stable_hash("source_file", "title", "parent_title", "page_start")).groupBy("title").agg(F.min("id").alias("id"))
    got = documents.build_entries(pages, toc, ["Range", "Duration"], tables=tables)
    want = {r.title: r.id for r in ids.collect()}
    assert {r.entry_title: r.toc_id for r in got.collect()} == {None: want["Spells"], "Fly": want["Fly"], "Hold": want["Hold"], "Chart": want["Chart"]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(documents.build_entries(pages, toc, ["Range", "Duration"])._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sent = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len(sent) > 5 and sum(bool(re.search(r"\b(page_text|text|content|_p)#", x)) for x in sent) == 3
