"""Models, checks, lineage, catalog, search and streams on small tables."""

import json

import pytest
from pyspark.sql import functions as F

from folioscale import session
from folioscale.operators import documents
from folioscale.plans import bronze, enrich, export, gold, lineage, marts, providers, quality, search, silver
from folioscale.sources import config, files
from folioscale.sources.catalog import Busy, Catalog
from folioscale.streaming import ingest

from .test_operators import book


@pytest.fixture(scope="module")
def models(spark):
    p, toc, marks = book(spark)
    spell_list = spark.createDataFrame([("b", "Fly", "wizard", 3, False), ("b", "Hold", "priest", 2, True)], "source_file string, entry_name string, entry_class string, entry_level int, is_reversible boolean")
    raw = spark.createDataFrame([("b", "fly", "wizard", 3, 7, "Spell Index", "Alteration", None), ("b", "fly", "wizard", 3, None, "Spell Index", None, None), ("b", "hold", "priest", 1, 9, "Spell Index", None, "Charm")], "source_file string, entry_name string, entry_class string, entry_level int, ref_page int, source_section string, school string, sphere string")
    known = silver.known_entries(raw)
    entries = documents.build_entries(p, toc, ["Range", "Duration"], known=known, spell_list=spell_list, marks=marks).cache()
    sections = silver.toc_sections(toc, entries).cache()
    check = silver.crosscheck(known, spell_list).cache()
    authority = spark.createDataFrame([], "source_file string, entry_name string, entry_type string")
    index = gold.entry_index(entries, sections, check, authority, []).cache()
    return {"pages": p, "toc": toc, "known": known, "entries": entries, "sections": sections, "check": check, "index": index, "list": spell_list}


def test_silver(models):
    assert [(r.entry_name, r.ref_page, r.school) for r in models["known"].orderBy("entry_name").collect()] == [("fly", 7, "Alteration"), ("hold", 9, None)]
    check = {r.entry_name: r for r in models["check"].collect()}
    assert check["hold"].level_mismatch and check["hold"].is_reversible and not check["fly"].level_mismatch
    s = {r.title: r for r in models["sections"].collect()}
    assert s["Fly"].parent_toc_id == s["Spells"].toc_id and "Fly" in s["Spells"].sub_headings
    meta = {r.range for r in silver.spell_meta(models["entries"]).collect()}
    assert meta == {"10", "5"}
    text = {r.content for r in silver.entry_descriptions(models["entries"].filter("spell_level is not null").withColumn("content", F.regexp_replace("content", r"^\w+\n", "")), ["Range", "Duration"]).collect()}
    assert any(t.startswith("The caster") for t in text)


def test_material(spark):
    lines = [f"l{i}" for i in range(5)] + ["The material component is dust", "and more"]
    assert spark.range(1).select(silver.material_text(F.lit("\n".join(lines))).alias("x")).first().x == "The material component is dust\nand more"
    assert spark.range(1).select(silver.material_text(F.lit("\n".join(["The material x"] + ["y"] * 8))).alias("x")).first().x == ""


def test_gold(models):
    index = {r.entry_title: r for r in models["index"].collect()}
    assert index["Fly"].entry_type == "spell" and index["Fly"].ref_page == 7 and index["Fly"].duration_text == "1 turn"
    assert index[None].entry_type == "rule"
    found = gold.entries(models["sections"], models["entries"])
    assert found.filter("entry_id is null").count() == 0 and found.count() == 3
    c = gold.chunks(models["entries"])
    assert c.select("chunk_id").distinct().count() == c.count() == 3
    f = silver.files(models["entries"], models["pages"].select("source_file", F.lit(5).alias("pdf_size_bytes"), F.lit(3).alias("total_pages")).distinct())
    assert gold.files(c, f, gold.toc(models["sections"])).first().total_chunks == 3
    assert gold.entry_descriptions(silver.entry_descriptions(models["entries"], ["Range"]), models["index"]).count() == 3


def test_search(models, spark):
    c = gold.chunks(models["entries"]).cache()
    assert [r.entry_title for r in search.keyword_any(c, "caster of air", 5, "content", "chunk_id").collect()] == ["Fly"]
    assert search.keyword_any(c, "of it", 5, "content", "chunk_id").count() == 0
    assert search.search_entries(c, gold.toc(models["sections"]), "100%").count() == 0
    routed = search.route_by_keywords(models["sections"], "what does hold do")
    assert "Hold" in {r.title for r in routed.collect()}
    got = spark.range(1).select(search.parse_routing(F.lit("LOOKUP: fly -> 3\nx\nlookup: a b -> 12")).alias("x")).first().x
    assert [(r.what, r.number) for r in got] == [("fly", 3), ("a b", 12)]
    ann = models["index"].filter("entry_title = 'Fly'").select("entry_id", F.lit(True).alias("is_combat"), F.lit(False).alias("is_popular"))
    none = spark.createDataFrame([], "entry_id long, summary string")
    assert [r.entry_title for r in search.compendium(models["index"], ann, none, "spell", level_min=1).collect()] == ["Hold", "Fly"]
    assert [r.entry_title for r in search.compendium(models["index"], ann, none, "spell", combat_only=True).collect()] == ["Fly"]
    assert search.numbered_toc(models["sections"]).filter("line like '1. Spells (p.1)%'").count() == 1
    semantic = c.filter("entry_title = 'Hold'").withColumn("rank", F.lit(1))
    assert {r.entry_title for r in search.search_section(c, "fly air", [r.toc_id for r in models["sections"].collect()], semantic).collect()} == {"Fly", "Hold"}
    assert "[Fly]" in search.context(c, ["chunk_id"]).first().context


def test_export(models):
    c = gold.chunks(models["entries"])
    md = export.whole_book(c, models["sections"]).first().markdown
    assert md.count("### Fly") == 1 and "## Spells" in md
    cat = {r.entry_title: r.markdown for r in export.category(c, models["sections"], ["fly"], ["Range"]).collect()}
    assert "| Range | 10 |" in cat["Fly"] and "| Reversible | No |" in cat["Fly"]


def test_bronze(spark):
    lines = "Contents\nChapter 1: Magic ..... 3\nFly .... 4\nTable 2: Costs .... 4\nA title that\ngoes on .... 5\nChapter 2: War .... 9"
    pages = spark.createDataFrame([("b", 0, 0, lines), ("b", 1, 1, "plain\ntext")], "source_file string, page_index int, printed_page_num int, page_text string")
    got = {r.title: r for r in bronze.toc_rows(pages).collect()}
    assert got["Chapter 1: Magic"].page_end == 8 and got["Chapter 2: War"].page_end == 9999
    assert got["Fly"].page_end == 5 and got["Fly"].parent_title == "Chapter 1: Magic"
    assert got["Table 2: Costs"].depth == 2 and "A title that goes on" in got
    fix = spark.createDataFrame([("b", "Fly", "rename", "Flight"), ("b", "Chapter 2: War", "remove", "")], "source_file string, title string, action string, value string")
    assert {r.title for r in bronze.correct_toc(bronze.toc_rows(pages), fix).collect()} & {"Flight", "Fly", "Chapter 2: War"} == {"Flight"}
    index = spark.createDataFrame([("b", 5, 50, "Alteration\nFly (Wiz 3) ... 7\nnoise\nCharm\nHold (Pr 2)")], "source_file string, page_index int, printed_page_num int, page_text string")
    toc = spark.createDataFrame([("b", "Spell Index", 50, 51, True)], "source_file string, title string, page_start int, page_end int, is_excluded boolean")
    got = {r.entry_name: r for r in bronze.known_entries(index, toc, {"school": ["alteration"], "sphere": ["charm"]}).collect()}
    assert got["Fly"].school == "Alteration" and got["Hold"].sphere == "Charm" and got["Hold"].ref_page is None and got["Fly"].entry_class == "wizard"


def test_cut_names(spark):
    s = spark.createDataFrame([("b", n, "wizard", 1, i) for i, n in enumerate(["Magic", "Missile", "Fly"])], "source_file string, entry_name string, entry_class string, entry_level int, seq int")
    k = spark.createDataFrame([("b", "Magic Missile", "wizard"), ("b", "Fly", "wizard")], "source_file string, entry_name string, entry_class string")
    assert sorted(r.entry_name for r in bronze.join_cut_names(s, k).collect()) == ["Fly", "Magic Missile"]


def test_tables(spark):
    toc = spark.createDataFrame([("b", "Table 1: A", 4, 1, True), ("b", "Table 2: B", 4, 2, True)], "source_file string, title string, page_start int, sort_order int, is_table boolean")
    regions = spark.createDataFrame([("b", 4, 3, 0, 1.0), ("b", 4, 3, 1, 2.0), ("b", 9, 8, 0, 1.0)], "source_file string, printed_page_num int, page_index int, region_index int, bbox_y0 double")
    cells = spark.createDataFrame([("b", 3, 0, 0, ["Name", "x"]), ("b", 3, 0, 1, ["Rope*", "1 gp"]), ("b", 3, 1, 0, ["q"])], "source_file string, page_index int, region_index int, row_index int, cells array<string>")
    t = bronze.tables_from_regions(regions, cells, toc)
    assert sorted((r.table_number, r.row_index) for r in t.collect()) == [(1, 0), (1, 1), (2, 0)]
    wanted = spark.createDataFrame([("b", "Table 1: A", "item", 0)], "source_file string, toc_title string, entry_type string, name_column int")
    assert [r.entry_name for r in bronze.authority_entries(t, wanted).collect()] == ["Rope"]
    md = spark.createDataFrame([("b", "x\n| a | b |\n|---|---|\n| 1 | 2 |\n\n| 3 | 4 |\ny\n| z |")], "source_file string, t string")
    assert [(r.block_index, r.row_index, r.cells) for r in bronze.pipe_tables(md, "t", ["source_file"]).orderBy("block_index", "row_index").collect()] == [(1, 0, ["a", "b"]), (1, 1, ["1", "2"]), (1, 2, ["3", "4"]), (2, 0, ["z"])]


def test_quality(models, spark):
    regions = spark.createDataFrame([], "source_file string, printed_page_num int")
    tables = spark.createDataFrame([], "source_file string, toc_title string")
    authority = spark.createDataFrame([("b", "fly"), ("b", "rope")], "source_file string, entry_name string")
    toc = models["sections"].withColumn("is_table", F.col("title") == "Hold")
    got = {r.check_name: r.status for r in quality.validate_bronze(toc, tables, regions, models["known"], models["list"], models["pages"], authority, models["entries"]).collect()}
    assert got == {"table_completeness": "fail", "region_coverage": "warn", "spell_crosscheck": "pass", "page_gaps": "pass", "duplicates": "pass", "authority_coverage": "warn"}
    head = spark.createDataFrame([("b", "Fly."), ("b", "Nowhere")], "source_file string, heading string")
    assert [r.heading for r in quality.unreviewed(head, models["toc"], []).collect()] == ["Nowhere"]
    with pytest.raises(RuntimeError):
        lineage.require_review(head)
    e = spark.createDataFrame([(1, "x\nRange: 1\nDuration: 2\nshort"), (2, "Range: 1"), (3, "no fields")], "id int, t string")
    issues = {(r.id, r.issue) for r in quality.entry_issues(e, ["Range", "Duration"], "t", "id").collect()}
    assert {(1, "no_description"), (1, "very_short"), (2, "missing_metadata"), (2, "very_short")} == issues


def test_catalog(spark):
    cat = Catalog(spark)
    df = spark.createDataFrame([("a", 1), ("b", 2)], "source_file string, v int")
    cat.replace("t1", "x", df.select("v", "source_file"))
    cat.overwrite_where("t1", "x", spark.createDataFrame([(5, "a")], "v int, source_file string"), "source_file", "a")
    assert {(r.source_file, r.v) for r in cat.read("t1", "x").collect()} == {("a", 5), ("b", 2)}
    cat.overwrite_where("t1", "x", spark.createDataFrame([], "v int, source_file string"), "source_file", "b")
    assert {(r.source_file, r.v) for r in cat.read("t1", "x").collect()} == {("a", 5)}
    cat.append("t1", "y", spark.createDataFrame([(1,)], "v int"))
    cat.append("t1", "y", spark.createDataFrame([(2, "n")], "v int, w string"))
    assert {(r.v, r.w) for r in cat.read("t1", "y").collect()} == {(1, None), (2, "n")}
    cat.upsert("t1", "y", spark.createDataFrame([(2, "m")], "v int, w string"), ["v"])
    assert {(r.v, r.w) for r in cat.read("t1", "y").collect()} == {(1, None), (2, "m")}
    cat.delete_orphans("t1", "y", spark.createDataFrame([(2,)], "v int"), ["v"])
    assert cat.read("t1", "y").count() == 1 and cat.exists("t1", "y") and not cat.exists("t1", "z")
    assert not cat.replace("t1", "y", cat.read("t1", "y").filter("v > 9"), skip_empty=True) and cat.read("t1", "y").count() == 1
    assert cat.tables("t1") == ["x", "y"] and "t1" in cat.namespaces()
    assert [r.row_count for r in cat.row_counts(["t1"]).orderBy("table_name").collect()] == [1, 1]
    assert cat.query("t1", "y", ["v"], "v = 2").first().v == "2"
    assert [r.source_file for r in cat.source_files("t1", "x").collect()] == ["a"]


FILES = "source_file string, id long, v string"


def _held(cat, name):
    return sorted(((r.source_file, r.id, r.v) for r in cat.read("t3", name).collect()), key=repr)


def test_catalog_keeps_rows_of_other_files(spark):
    cat = Catalog(spark)
    old = [("A", 1, "a"), ("B", 2, "b"), ("B", 3, "b"), (None, 4, "n"), (None, 5, "n"), ("it's \\ q", 6, "q")]
    rows = lambda *x: spark.createDataFrame(list(x), FILES)
    cat.replace("t3", "w", rows(*old))
    cat.overwrite_where("t3", "w", rows(("B", 9, "new")), "source_file", "A")
    want = [*old[1:], ("B", 9, "new")]
    assert _held(cat, "w") == sorted(want, key=repr)
    cat.overwrite_where("t3", "w", rows((None, 10, "m"), ("C", 11, "c")), "source_file", None)
    want = [x for x in want if x[0] is not None] + [(None, 10, "m"), ("C", 11, "c")]
    assert _held(cat, "w") == sorted(want, key=repr)
    cat.overwrite_where("t3", "w", rows(), "source_file", None)
    cat.overwrite_where("t3", "w", rows(), "source_file", "it's \\ q")
    want = [x for x in want if x[0] in ("B", "C")]
    assert _held(cat, "w") == sorted(want, key=repr)
    cat.overwrite_where("t3", "w", rows(("D", 2, "d")), "id", 2)
    assert _held(cat, "w") == sorted([x for x in want if x[1] != 2] + [("D", 2, "d")], key=repr)


def test_catalog_upserts_and_deletes_with_nulls(spark):
    cat = Catalog(spark)
    rows = lambda *x: spark.createDataFrame(list(x), FILES)
    cat.replace("t3", "u", rows(("A", 1, "a"), (None, 2, "n"), (None, 3, "n"), ("B", None, "k")))
    cat.upsert("t3", "u", rows((None, 2, "up"), ("A", None, "moved")), ["id"])
    assert _held(cat, "u") == sorted([("A", 1, "a"), (None, 2, "up"), (None, 3, "n"), ("A", None, "moved")], key=repr)
    cat.delete_orphans("t3", "u", spark.createDataFrame([(2,), (None,)], "id long"), ["id"])
    assert _held(cat, "u") == sorted([(None, 2, "up"), ("A", None, "moved")], key=repr)
    cat.delete_orphans("t3", "u", spark.createDataFrame([("A",)], "source_file string"), ["source_file"])
    assert _held(cat, "u") == [("A", None, "moved")]


def test_catalog_changes_are_whole(spark, monkeypatch):
    cat = Catalog(spark)
    rows = lambda *x: spark.createDataFrame(list(x), FILES)
    old = [("A", 1, "a"), ("B", 2, "b")]
    cat.replace("t3", "c", rows(*old))

    # the rows cannot be computed: nothing has changed, and the table is free
    broken = rows(("A", 1, "x")).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        cat.overwrite_where("t3", "c", broken, "source_file", "A")
    assert _held(cat, "c") == old and cat.noted("t3", "c") is None and cat.tables("t3").count("c") == 1

    # the writer is lost before its rows are ready, then while they are put in place
    def lost(*_):
        raise KeyboardInterrupt

    for step, state, want in (("_ready", "undone", old), ("_overwrite", "done", [("A", 7, "new"), ("B", 2, "b")])):
        with monkeypatch.context() as m:
            m.setattr(cat, step, lost)
            m.setattr(cat, "_end", lost)
            with pytest.raises(KeyboardInterrupt):
                cat.overwrite_where("t3", "c", rows(("A", 7, "new")), "source_file", "A")
        with pytest.raises(Busy):  # a second writer waits for the first one's end
            Catalog(spark).upsert("t3", "c", rows(("B", 2, "z")), ["id"])
        assert "c" in cat.tables("t3") and all("__" not in n for n in cat.tables("t3"))
        assert Catalog(spark).recover("t3", "c") == state and cat.recover("t3", "c") is None
        assert _held(cat, "c") == want

    # of a table that gets other columns too
    with monkeypatch.context() as m:
        m.setattr(cat, "_apply", lost)
        with pytest.raises(KeyboardInterrupt):
            cat.replace("t3", "c", spark.createDataFrame([(1,)], "z int"))
    assert cat.recover("t3", "c") == "done" and cat.read("t3", "c").columns == ["z"]


def test_lineage(spark):
    cat = Catalog(spark, partition="none")
    runs = lineage.Lineage(cat, "t2")
    a, b = runs.start("f", "bronze", {"x": 1}), runs.start("g", "bronze", {})
    runs.finish(a, row_counts={"files": 1})
    runs.finish(b, "failed", error="no")
    assert {r.run_id: r.status for r in runs.runs().collect()} == {a: "success", b: "failed"}
    done = []
    out = lineage.run_job({s: (lambda s=s: done.append(s) or s) for s in lineage.STEPS}, "without_enrichment")
    assert done.index("silver_entries") < done.index("gold_chunks") < done.index("gold_files") and not any("ai" in s.split("_") for s in out)
    found = spark.createDataFrame([("a", 1, "h"), ("b", 2, "h")], "source_file string, pdf_size_bytes long, config_hash string")
    old = spark.createDataFrame([("a", 1, "h"), ("b", 1, "h")], "source_file string, pdf_size_bytes long, config_hash string")
    assert [r.source_file for r in lineage.changed_files(found, old).collect()] == ["b"]
    counts = lineage.file_counts({"x": found, "y": old}, "r")
    assert counts.count() == 4


def test_config(spark, tmp_path):
    (tmp_path / "_default.json").write_text(json.dumps({"a": {"x": 1, "l": [1]}, "b": 2}))
    (tmp_path / "My_Book.json").write_text(json.dumps({"a": {"l": [2]}, "b": 3}))
    assert config.load_config(spark, str(tmp_path), "My Book.pdf") == {"a": {"x": 1, "l": [1, 2]}, "b": 3}
    toc = config.toc_review(spark, "b", [{"title": "One", "page": 1, "depth": 0, "type": "chapter"}, {"title": "x", "page": 2, "type": "remove"}, {"title": "s", "page": 3, "depth": 1}, {"title": "T", "page": 3, "depth": 2, "type": "table"}, {"title": "u", "page": 5, "depth": 1}, {"title": "Two", "page": 9, "depth": 0, "type": "chapter"}])
    assert {r.title: (r.page_end, r.parent_title) for r in toc.collect()} == {"One": (8, None), "s": (5, "One"), "T": (5, "One"), "u": (8, "One"), "Two": (9999, None)}


def test_files(spark, tmp_path):
    (tmp_path / "sales.csv").write_text("order_id,customer_id,order_date,product,quantity,amount,region\nO1,C1,2024-01-02,P,2,10.5,N\nO2,C1,2024-01-02,P,1,4.5,N\n")
    mart = marts.daily_revenue(files.read_sales(spark, str(tmp_path / "sales.csv")))
    (r,) = mart.collect()
    assert (r.revenue, r.order_count, r.customer_count, r.avg_order_value) == (15.0, 2, 1, 7.5)
    (tmp_path / "bk").mkdir()
    (tmp_path / "bk" / "page_3.md").write_text("hello\n12")
    p = files.read_markdown_pages(spark, str(tmp_path))
    assert [(r.source_file, r.page_index) for r in p.collect()] == [("bk", 3)]
    assert files.printed_number_in_text(p, "page_text", "page_index").first().printed_page_num == 12
    spans = spark.createDataFrame([("b", 0, 100.0, 0, 93.0, "7"), ("b", 0, 100.0, 1, 95.0, "8"), ("b", 0, 100.0, 2, 50.0, "9"), ("b", 1, 100.0, 0, 10.0, "x")], "source_file string, page_index int, page_height double, idx int, y0 double, text string")
    assert {r.page_index: r.printed_page_num for r in files.printed_page_numbers(spans).collect()} == {0: 8, 1: 1}


def test_enrichment(models):
    done = models["index"].filter("entry_title = 'Hold'").select("entry_id")
    d = silver.entry_descriptions(models["entries"], ["Range"])
    out = enrich.summaries(models["index"], models["entries"], d, done, providers.StubModel(), "Sum up {title}:\n{text}", ["spell"], least=10).collect()
    assert len(out) == 1 and out[0].summary
    v = models["index"].limit(1).select(F.explode(F.array(F.lit('{"combat": true}'), F.lit("none"))).alias("response"))
    assert {(r.is_combat, r.is_popular) for r in enrich.verdicts(v).collect()} == {(True, False), (None, None)}
    vec = providers.embedded(models["entries"].select("entry_id", "content"), "content", providers.HashEmbedder(8))
    assert {len(r.embedding) for r in vec.collect()} == {8}


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("x")
    seen = []
    for _ in range(2):
        ingest.ingest_new_files(spark, str(src), str(tmp_path / "cp"), lambda df, n: seen.extend(r.path for r in df.select("path").collect()))
    assert len(seen) == 1
    mart = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "order_date string, v int")
    fresh = spark.createDataFrame([("2024-01-02", 9)], "order_date string, v int")
    assert sorted(r.v for r in ingest.upsert_days(mart, fresh).collect()) == [1, 9]
    ev = spark.createDataFrame([("2024-01-01 00:00:00", 1), ("2024-01-01 00:10:00", 1), ("2024-01-01 02:00:00", 1)], "ts string, user_id int")
    assert sorted(r.n for r in ingest.sessions(ev).collect()) == [1, 2]


def test_session(spark):
    assert session.query(spark, "select :a as x", {"a": 3}).first().x == 3
    assert session.preview(spark, "select repeat('a', 500) as x").first().x == "a" * 200


def test_extended_contents(spark):
    from folioscale.plans import leaves

    row = lambda title, page, order, chapter=False, parent=None, table=False, out=False: ("b", title, page, 9999, order, 0 if chapter else 1, chapter, table, out, parent)
    toc = spark.createDataFrame(
        [
            row("Wizard Spells", 1, 0, True), row("First-Level Spells", 2, 1, parent="Wizard Spells"), row("Second-Level Spells", 3, 2, parent="Wizard Spells"), row("Table 1: Slots", 3, 3, parent="Wizard Spells", table=True),
            row("Basics", 5, 4, True), row("Fighter", 5, 5, parent="Basics"),
            row("Chapter 5", 7, 6, True), row("Skill Descriptions", 8, 7, parent="Chapter 5"), row("Using Skills", 9, 8, parent="Chapter 5"),
            row("Gone", 10, 9, True, out=True), row("Lost", 10, 10, parent="Gone"),
        ],
        "source_file string, title string, page_start int, page_end int, sort_order int, depth int, is_chapter boolean, is_table boolean, is_excluded boolean, parent_title string",
    )
    spells = spark.createDataFrame([("b", "Light", "Wizard", 1, "alteration", None), ("b", "armor", "wizard", 1, None, None), ("b", "Bless", "priest", 1, None, "all"), ("b", "Web", "wizard", 2, None, None), ("c", "Other", "wizard", 1, None, None)], "source_file string, entry_name string, entry_class string, entry_level int, school string, sphere string")
    names = spark.createDataFrame([("b", "Riding", "proficiency"), ("b", "Cooking", "proficiency"), ("b", "Sword", "weapon")], "source_file string, entry_name string, entry_type string")
    rules = [{"key": "wizard spells", "source": "spells", "pattern": ".*level"}, {"key": "skill desc", "source": "authority", "entry_type": "proficiency"}, {"key": "basics", "source": "anchors", "anchors": ["**The Dice**", "**Fighter**", "Rolls"], "names": {"Rolls": "Dice Rolls"}}]
    got = leaves.extended_toc(toc, rules, spells, names, {"first": 1, "second": 2}).orderBy("sort_order").collect()
    assert [(r.title, r.is_leaf, r.source) for r in got] == [
        ("Wizard Spells", False, "toc"), ("First-Level Spells", False, "toc"), ("armor", True, "spell_list"), ("Light", True, "spell_list"), ("Second-Level Spells", False, "toc"), ("Web", True, "spell_list"), ("Table 1: Slots", True, "toc"),
        ("Basics", False, "toc"), ("Fighter", True, "toc"), ("The Dice", True, "anchor"), ("Dice Rolls", True, "anchor"),
        ("Chapter 5", False, "toc"), ("Skill Descriptions", False, "toc"), ("Cooking", True, "authority"), ("Riding", True, "authority"), ("Using Skills", True, "toc"),
    ]
    by = {r.title: r for r in got}
    assert (by["Light"].spell_class, by["Light"].spell_level, by["Light"].school, by["Light"].parent_title, by["Light"].page_start) == ("wizard", 1, "alteration", "Wizard Spells", 2)
    assert by["The Dice"].anchor == "**The Dice**" and by["Cooking"].parent_title == "Chapter 5" and [r.sort_order for r in got] == list(range(16))
    assert leaves.extended_toc(toc.limit(0), rules, spells, names, {"first": 1}).count() == 0
    assert [r.is_leaf for r in leaves.extended_toc(toc, [], spells, names, {"first": 1}).orderBy("sort_order").collect()] == [False, True, True, False, False, True, False, True, True]
    twice = spark.createDataFrame([("b", "Magic  Web", "wizard", 3), ("b", "magic web", "wizard", 2)], "source_file string, entry_name string, entry_class string, entry_level int")
    assert [r.entry_level for r in leaves.listed_names(twice).collect()] == [2]
