"""Joins, windows, intervals, chunks and layout on small fixtures."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscale.operators import chunks, documents, intervals, joins, layout, stream, titles, windows


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_fallback_join(spark):
    left = spark.createDataFrame([(1, "x", "b"), (2, "y", None), (3, "z", "a")], "id int, k string, c string")
    right = spark.createDataFrame([("x", "a", 10), ("x", "b", 20), ("y", "a", 30)], "k string, p string, v int")
    out = joins.fallback_join(left, right, ["k"], F.col("p"), [F.col("c"), F.lit("a")], ["v"])
    assert {r.id: r.v for r in out.collect()} == {1: 20, 2: 30, 3: None}


def test_range_and_first(spark):
    points = spark.createDataFrame([("f", i) for i in range(0, 300, 7)], "sf string, p int")
    ranges = spark.createDataFrame([("f", 0, 20, "a"), ("f", 10, 9999, "b"), ("f", 50, 40, "none")], "sf string, lo int, hi int, name string")
    got = rows(joins.range_join(points, ranges, ["sf"], "p", "lo", "hi", width=16), "p", "name")
    assert got == sorted((p, n) for p in range(0, 300, 7) for lo, hi, n in ((0, 20, "a"), (10, 9999, "b")) if lo <= p <= hi)


def test_asof(spark):
    left = spark.createDataFrame([("a", 1), ("a", 5), ("a", 9), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 5, 51)], "k string, at int, v int")
    assert {(r.k, r.t): r.v for r in joins.asof_join(left, right, ["k"], "t", "at", ["v"]).collect()} == {("a", 1): None, ("a", 5): 51, ("a", 9): 51, ("b", 5): None}


def test_fuzzy_anti(spark):
    known = spark.createDataFrame([("f", "magic missile"), ("f", "fly")], "sf string, a string")
    listed = spark.createDataFrame([("f", "magic misile")], "sf string, b string")
    assert [r.a for r in joins.fuzzy_anti(known, listed, ["sf"], "a", "b").collect()] == ["fly"]


def test_scope(spark):
    random.seed(3)
    data, want = [], set()
    for g in range(6):
        open_ = None
        for i in range(40):
            depth, opens = random.randint(0, 3), random.random() < 0.2
            data.append((g, i, depth, opens))
            if open_ is not None and depth > open_:
                want.add((g, i))
            else:
                open_ = depth if opens else None
                if opens:
                    want.add((g, i))
    df = spark.createDataFrame(data, "g int, i int, depth int, opens boolean")
    got = windows.scope_rows(df, ["g"], "i", "depth", F.col("opens")).filter("in_scope")
    assert {(r.g, r.i) for r in got.collect()} == want


def test_page_faults(spark):
    df = spark.createDataFrame([("f", i, p) for i, p in enumerate([1, 2, 1, 20, 21])], "sf string, i int, p int")
    assert rows(windows.page_number_faults(df, ["sf"], "i", "p"), "i", "fault") == [(2, "backwards"), (3, "jump"), (4, "beyond")]


@pytest.mark.parametrize("gap", [0, 1])
def test_coalesce(spark, gap):
    random.seed(gap)
    iv = [(s := random.randint(0, 300), s + random.randint(0, 6)) for _ in range(75)]
    want = []
    for s, e in sorted(iv):
        if want and s <= want[-1][1] + gap:
            want[-1][1] = max(want[-1][1], e)
        else:
            want.append([s, e])
    got = intervals.coalesce_intervals(spark.createDataFrame([("k", *x) for x in iv], "k string, s int, e int"), ["k"], "s", "e", gap)
    assert rows(got, "s", "e") == [tuple(x) for x in want]


def test_blank(spark):
    ranges = F.array(F.struct(F.lit(1).alias("char_start"), F.lit(4).alias("char_end")), F.struct(F.lit(6).alias("char_start"), F.lit(99).alias("char_end")))
    got = spark.range(1).select(intervals.blank_ranges(F.lit("ab\ncdefgh"), ranges).alias("x")).first().x
    assert got == "a \n de   " and len(got) == 9


def packed(parts, most, overlap, sep="\n\n"):
    cur, out = "", []
    for p in parts:
        if len(cur) + len(p) + len(sep) > most and cur:
            out.append(cur)
            cur = cur[-overlap:] + sep + p if overlap and not cur.rstrip().endswith("|") else p
        else:
            cur = p if not cur else cur + sep + p
    return out + [cur] if cur else out


@pytest.mark.parametrize("overlap", [0, 20])
def test_pack(spark, overlap):
    random.seed(overlap)
    parts = ["x" * random.randint(1, 90) + random.choice(["", " |"]) for _ in range(40)]
    got = spark.range(1).select(chunks.pack(F.array(*[F.lit(p) for p in parts]), 100, overlap).alias("x")).first().x
    assert got == packed(parts, 100, overlap)


def test_chunk_edges(spark):
    long_ = "y" * 801
    df = spark.createDataFrame([(1, "z" * 800), (2, long_), (3, ""), (4, "a\n\nb")], "id int, t string")
    got = {}
    for r in chunks.chunk_rows(df, "t").collect():
        got.setdefault(r.id, []).append(r.chunk)
    assert got == {1: ["z" * 800], 2: [long_], 3: [""], 4: ["a\n\nb"]}


def test_blocks_keep_tables(spark):
    got = spark.range(1).select(chunks.blocks(F.lit("a\n\n| x |\n\n| y |\n\nb")).alias("x")).first().x
    assert got == ["a", "| x |\n\n| y |", "b"]


def test_headings(spark):
    md = "before\n# One\ntext\n#No\n##### five\n## Two\n"
    df = spark.createDataFrame([(1, md)], "id int, md string")
    assert [(r.section_title, r.content.split("\n")[0]) for r in chunks.heading_sections(df, "md").orderBy("section_index").collect()] == [("", "before"), ("One", "# One"), ("Two", "## Two")]
    assert [(r.level, r.heading, md[r.position]) for r in chunks.headings(df, "md").collect()] == [(1, "One", "#"), (2, "Two", "#")]


def test_overlap_and_contained(spark):
    got = spark.range(1).select(chunks.overlap_concat(F.array(F.lit("abcdef"), F.lit("defgh"), F.lit("zz"))).alias("a"), chunks.drop_contained(F.array(F.lit("bc"), F.lit("abcd"), F.lit("q"))).alias("b"), chunks.drop_repeated_lines(F.lit("x" * 60 + "\nshort\nshort\n" + "x" * 60)).alias("c")).first()
    assert got.a == "abcdefgh\n\nzz" and got.b == ["abcd", "q"] and got.c == "x" * 60 + "\nshort\nshort"


def spans_of(lines):
    out = []
    for n, (font, y, cells) in enumerate(lines):
        for x, t in cells:
            out.append(("f", 0, len(out), n, font, 9.0, font == "H", float(x), float(y), float(x + 8 * len(t)), float(y + 9), t))
    return out


SPANS = "source_file string, page_index int, idx int, line_idx int, font string, size double, bold boolean, x0 double, y0 double, x1 double, y1 double, text string"


def test_layout(spark):
    lines = [("B", 10, [(10, "prose here goes on")]), ("H", 40, [(10, "Name"), (120, "Cost")])]
    lines += [("B", 52 + 12 * i, [(10, f"item{i}"), (125, str(i))]) for i in range(4)]
    lines += [("B", 110, [(10, "a long line of prose")]), ("B", 122, [(10, "another line")])]
    df = spark.createDataFrame(spans_of(lines), SPANS)
    regions = layout.table_regions(df, layout.LayoutSettings(header_font="H")).cache()
    r = regions.collect()
    assert [(x.row_count, x.col_count, x.header_row_count) for x in r] == [(5, 2, 1)]
    cells = layout.table_cells(df, regions)
    assert [r.cells for r in layout.region_rows(cells).orderBy("row_index").collect()] == [["Name", "Cost"]] + [[f"item{i}", str(i)] for i in range(4)]
    text = layout.page_text(df).first().page_text
    (mask,) = layout.text_masks(df, regions).collect()
    assert text[mask.char_start : mask.char_end].startswith("NameCost") and text[mask.char_end :].startswith("\na long")
    assert [x.font for x in layout.font_histogram(df).filter("is_body").collect()] == ["B"]


def test_layout_label_table_and_misses(spark):
    lines = [("H", 10, [(10, "Armor")])] + [("B", 24 + 12 * i, [(10, f"kind{i}"), (120, str(i))]) for i in range(3)]
    df = spark.createDataFrame(spans_of(lines), SPANS)
    got = layout.table_regions(df, layout.LayoutSettings(header_font="H")).collect()
    assert [(x.detection_method, x.row_count, x.col_count) for x in got] == [("label", 4, 2)]
    assert layout.table_regions(df.filter("font = 'B'"), layout.LayoutSettings(header_font="H")).count() == 0


def test_clusters(spark):
    df = spark.createDataFrame([("f", float(x)) for x in (10, 12, 25, 200, 213)], "sf string, x double")
    assert rows(intervals.cluster_positions(df, ["sf"], "x"), "x", "depth") == [(10.0, 0), (12.0, 0), (25.0, 1), (200.0, 0), (213.0, 1)]


def book(spark):
    pages = ["1\nWATER\nIntro text of the chapter.\n", "2\nWATER\nFly\nRange: 10\nDuration: 1 turn\nThe caster can fly about in the air for long.\n\nHold\nRange: 5\nA held per-\nson stays where it is for a while.", "3\nWATER\nEnd of it.\n"]
    p = spark.createDataFrame([("b", i, i + 1, t) for i, t in enumerate(pages)], "source_file string, page_index int, printed_page_num int, page_text string")
    toc = spark.createDataFrame(
        [("b", "Spells", 1, 3, 0, 0, True, False, False, None), ("b", "Fly", 2, 2, 1, 1, False, False, False, "Spells"), ("b", "Hold", 2, 3, 2, 1, False, False, False, "Spells")],
        "source_file string, title string, page_start int, page_end int, sort_order int, depth int, is_chapter boolean, is_table boolean, is_excluded boolean, parent_title string",
    )
    marks = spark.createDataFrame([("b", "WATER", 3)], "source_file string, watermark_text string, occurrence_count int")
    return p, toc, marks


def test_entry_builder(spark):
    p, toc, marks = book(spark)
    e = {r.entry_title: r for r in documents.build_entries(p, toc, ["Range", "Duration"], marks=marks).collect()}
    assert set(e) == {None, "Fly", "Hold"}
    assert e["Fly"].content.startswith("Fly\nRange: 10") and "WATER" not in e["Hold"].content and "held person" in e["Hold"].content
    assert e["Fly"].has_metadata and e["Fly"].has_description and e["Fly"].toc_id != e["Hold"].toc_id


def test_dedupe_blocks():
    text = "Range: 1\nDuration: 2\nBody one is here\nRange: 1\nBody one is here"
    assert documents.dedupe_blocks(text, ["Range", "Duration"]) == "Range: 1\nDuration: 2\n\nBody one is here"
    assert documents.dedupe_blocks(None, ["Range"]) is None
    # cut pieces before the first block, and at the beginning of a description, go
    cut = "Fly\nter can go\nRange: 1\nThe caster can fly.\nRange: 1\nDuration: 2\n\nster can fly.\nIt ends at dusk or dawn."
    assert documents.dedupe_blocks(cut, ["Range", "Duration"]) == "Fly\nRange: 1\nDuration: 2\n\nThe caster can fly.\n\nIt ends at dusk or dawn."
    assert documents.dedupe_blocks("Range: 1\nfine as it is", ["Range"]) == "Range: 1\nfine as it is"


def test_titles_are_matched_folded():
    text = "See Bigby’s   Hand below.\n\nBigby's\nHand\nIt grabs.\n\nThe Wiz-\nard Eye\nsees. Wizard Eyes too."
    folded, places = titles.fold(text)
    assert "bigby's hand below. bigby's hand it" in folded and "the wizard eye sees" in folded
    assert all(folded[i] in (text[p].lower(), " ", "'") for i, p in enumerate(places[: len(folded)]))
    assert titles.find_title("Bigby’s Hand", text) == text.index("Bigby's\n")
    assert titles.find_title("wizard eye", text) == text.index("Wiz-")
    assert titles.find_title("and", text) == -1 and titles.find_title("", text) == -1
    assert titles.find_title("Bigby's Hand", text, 0, 20) == 4


def test_sections_keep_to_pages_and_out_of_tables():
    text = "Intro words.\n\nArmor\nFly 3\n\nFly\nOne can fly.\n\nHold\nStays put, and so on.\n\nFly\nagain on a later page"
    offsets = {1: 0, 2: text.index("Hold")}
    intro, parts = titles.sections(text, [("Fly", 1), ("Hold", 2), ("Gone", 2)], offsets, ["Armor"], True, 5)
    # the best place of Fly is in the table, so it has none
    assert intro.endswith("One can fly.") and [(n, c.split("\n")[1]) for n, c in parts] == [(1, "Stays put, and so on.")]
    assert [n for n, _ in titles.sections(text.replace("Fly 3", "Mail 3"), [("Fly", 1), ("Hold", 2)], offsets, ["Armor"], True, 5)[1]] == [0, 1]
    assert titles.sections(text, [("Fly", 1)], offsets, [], True, 5)[1][0][1].startswith("Fly 3")
    assert titles.sections("", [("Fly", 1)], {}, [], True, 5) == ("", [])


def test_lines_and_columns():
    box = np.array([[0, 10, 5, 20], [8, 12.5, 12, 22], [0, 13.5, 5, 23], [0, 40, 5, 50]], float)
    lines = layout.Lines.of(box, np.arange(4), 3.0)
    assert lines.first.tolist() == [0, 2, 3] and lines.right.tolist() == [12, 5, 5] and lines.sizes().tolist() == [2, 1, 1]
    assert layout.unmerged(np.array([[0, 0, 10, 1], [8, 0, 20, 1], [30, 0, 40, 1]], float)).tolist() == [[0, 20], [30, 40]]
    hits = lambda x: np.array([c == "x" for c in x], dtype=bool)
    assert [len(layout.before_misses(hits(x), 2)) for x in ("xx.x..xx", "..x", ".x.x", "xxx", "")] == [5, 1, 4, 3, 0]


def test_markdown_stream():
    md = "# Front\nelves are named here\n## Races\n**Elves** (any)\nElves live long.\nAs for Dwarfs, they dig.\n# Dwarves\nDwarves dig.\nWM\n# CHAPTER 12\nnot it\n## Magic Itms\nRing 11 is gold\nRing 1\nRing 1 is plain\nby the red door\nit goes on"
    row = lambda title, kind, parent=None, anchor=None: {"title": title, "kind": kind, "parent_title": parent, "page": 1, "anchor": anchor}
    contents = [row("Chapter 1: PC Races", "chapter"), row("Races: Elves", "leaf", "a"), row("Dwarves (hill)", "leaf", "a"), row("Chapter 11: Magic Items", "chapter"), row("Ring 1", "leaf", "b"), row("Doors", "leaf", "b", "red door"), row("Nothing", "leaf", "b")]
    got = stream.stream_sections(md, contents, {"WM"}, 5)
    assert [(c, t, x.split("\n")[0]) for c, t, x, _ in got] == [("a", "Races: Elves", "**Elves** (any)"), ("a", "Dwarves (hill)", "# Dwarves"), ("b", "Ring 1", "Ring 1"), ("b", "Doors", "by the red door")]
    assert got[0][2].endswith("they dig.") and got[1][2].endswith("gold") and "WM" not in got[1][2]
    assert stream.bare("### **Fire Ball** (Evocation) ") == "fire ball" and stream.bare("Light Reversible") == "light"
    assert stream.variants("Chapter 2: PC Classes (all)", True) == ["pc classes (all)", "pc classes", "classes (all)", "classes", "chapter 2: pc classes (all)", "chapter 2: pc classes", "chapter 2"]
    assert stream.stream_sections("", contents, set()) == []
