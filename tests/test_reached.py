"""Small functions that no query reaches, and the chains of questions and answers."""

import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from folioscale import session
from folioscale.functions import text
from folioscale.plans import bronze, enrich, gold, lineage, providers, quality, search
from folioscale.sources import files
from folioscale.sources.catalog import Catalog


def test_ask_routes_searches_and_merges(spark):
    toc = spark.createDataFrame([(1, "Fire spells", "", 3, False), (2, "Ice spells", "Cold; Snow", 9, False), (3, "Fire tables", "", 12, True), (4, "Index", "", 20, False)], "toc_id long, title string, sub_headings string, page_start int, is_excluded boolean")
    chunks = spark.createDataFrame(
        [(10, 1, "Ball", "a fire ball that burns"), (11, 1, "Wall", "spells of walls"), (12, 1, "Ball", "a fire ball that burns"), (13, 2, "Snow", "fire melts snow, spells end"), (14, 4, "x", "fire spells in an index"), (15, 1, None, "nothing of it")],
        "chunk_id long, toc_id long, entry_title string, content string",
    )
    got = [(r.place, r["rank"], r.chunk_id) for r in search.ask(chunks, toc, "What fire spells are there").collect()]
    # two sections hold words of it; equal texts come once
    assert [(p, c) for p, _, c in got] == [(0, 10), (0, 11), (1, 13)]
    near = spark.createDataFrame([(15, 1, None, "nothing of it", 1)], "chunk_id long, toc_id long, entry_title string, content string, rank int")
    assert (0, 15) in [(r.place, r.chunk_id) for r in search.ask(chunks, toc, "What fire spells are there", near).collect()]
    assert [r.chunk_id for r in search.ask(chunks, toc.limit(0), "snow index").collect()] == [13, 14]
    assert search.context(search.ask(chunks, toc, "fire"), ["place", "rank"]).first().context.startswith("[Ball]\na fire ball")


def test_prompts_are_filled_at_once(spark):
    row = spark.createDataFrame([("{text} of", "a {title}")], "a string, b string")
    assert row.select(enrich.filled("{title}: {text} {other} {title}", {"title": F.col("a"), "text": F.col("b")})).first()[0] == "{text} of: a {title} {other} {text} of"
    assert row.select(enrich.filled("plain", {"title": F.col("a")})).first()[0] == "plain"
    shown = row.select(enrich.shown_text(F.lit(None).cast("string"), F.lit("s"), F.lit("c"), True), enrich.shown_text(F.lit("d"), F.lit("s"), F.lit("c"), False), enrich.shown_text(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("c"), True)).first()
    assert tuple(shown) == ("s", "d", "c")


def test_files_and_tables(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text("order_id,customer_id,order_date,product,quantity,amount,region\nO1,C1,2024-01-02,P,2,10.5,N\n")
    files.load_sales(spark, str(tmp_path / "s"), "raw_t.sales")
    files.load_sales(spark, str(tmp_path / "s"), "raw_t.sales")
    assert spark.table("raw_t.sales").count() == 1
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "Book One+2.md").write_text("# é\ntext")
    assert [tuple(r) for r in files.read_markdown(spark, str(tmp_path / "m")).collect()] == [("Book One+2", "# é\ntext", 8)]
    session.reset(spark)


def test_gold_and_bronze_parts(spark):
    tables = spark.createDataFrame([tuple("abcdefghij")], ", ".join(f"{c} string" for c in gold.TABLES)).withColumn("more", F.lit(1))
    assert gold.tables(tables).columns == list(gold.TABLES)
    e = spark.createDataFrame([("b", 1, None), ("a", 2, 5), ("a", 1, 9), ("a", 1, None)], "source_file string, sort_order int, entry_id long")
    assert [tuple(r) for r in gold.reading_order(e).collect()] == [("a", 1, 9), ("a", 1, None), ("a", 2, 5), ("b", 1, None)]
    lines = spark.createDataFrame([(" WM ", ["WM"]), ("Page 7 of", ["WM"]), ("see Page 7", None), ("text", ["WM"])], "l string, w array<string>")
    assert [r[0] for r in lines.select(bronze.should_drop_line(F.col("l"), ["page [0-9]+"], F.col("w"))).collect()] == [True, True, False, False]
    listed, index = (spark.createDataFrame(x, "source_file string, entry_name string") for x in ([("f", "A"), ("f", "B")], [("f", "B"), ("f", "C")]))
    assert sorted(r.entry_name for r in quality.index_differences(index, listed).collect()) == ["A", "C"]
    joined = spark.createDataFrame([("a![x](y.png) long-\n  word and fire-\nBall",)], "t string").select(text.rejoin_hyphens_loose(F.col("t"))).first()[0]
    assert joined == "a longword and fireBall"
    spans = [("f", 0, 0, 10.0, 10.0, "Wizard Spells", True, "B"), ("f", 0, 1, 10.0, 20.0, "1st Level", True, "B"), ("f", 0, 2, 10.0, 30.0, "Armor", False, "R"), ("f", 0, 3, 12.0, 40.0, "Light", False, "R-Italic"), ("f", 0, 4, 200.0, 50.0, "far away", False, "R"), ("f", 0, 5, 10.0, 60.0, "Dancing", False, "R"), ("f", 0, 6, 18.0, 70.0, "Lights", False, "R")]
    found = bronze.spell_columns(spark.createDataFrame(spans, "source_file string, page_index int, idx int, x0 double, y0 double, text string, bold boolean, font string"), {"1st level": 1}, ["wizard"])
    assert sorted((r.entry_name, r.entry_class, r.entry_level, r.is_reversible) for r in found.collect()) == [("Armor", "wizard", 1, False), ("Dancing Lights", "wizard", 1, False), ("Light", "wizard", 1, True)]


def test_flags_that_show_rows(spark):
    rows = spark.createDataFrame([(False, None, None), (True, True, False), (True, False, True), (True, False, False)], "a boolean, c boolean, p boolean")
    show = lambda c, p: [r[0] for r in rows.select(search.visible(F.col("a"), F.coalesce("c", F.lit(False)), F.coalesce("p", F.lit(False)), c, p)).collect()]
    assert show(False, False) == [True] * 4 and show(True, False) == [True, True, False, False] and show(True, True) == [True, True, True, False]


def test_project(spark):
    project = lineage.Project(spark, "notes", ["title"])
    docs = spark.createDataFrame([("f", "# One\nfire text\n# Two\nice text")], "source_file string, text string")
    chunks = project.ingest(docs)
    assert chunks.count() == 2 and {r.project for r in chunks.collect()} == {"notes"}
    assert project.embed(chunks, providers.HashEmbedder(8)).count() == 2
    assert [r.content for r in project.search(chunks, "ice text").collect()][0].endswith("ice text")


def test_runs(spark):
    made = lineage.Lineage(Catalog(spark, partition="none"), "t_runs")
    run = made.start("f", "silver", {})
    made.finish(run, row_counts={"x": 2})
    assert [(r.run_id, r.status) for r in made.runs().collect()] == [(run, "success")]


def test_a_model_behind_http():
    class Answers(http.server.BaseHTTPRequestHandler):
        failed = 0

        def log_message(self, *_):
            pass

        def _send(self, what):
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(what).encode())

        def do_GET(self):
            self._send({"models": [{"name": "small"}]})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if Answers.failed < 1:
                Answers.failed += 1
                self.send_error(503)
            else:
                self._send({"response": f"{asked['model']}: {asked['prompt']}"})

    server = http.server.HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        model = providers.HttpModel(f"{url}/api", "small", tries=2, pause=0.0)
        assert model.generate("hello") == "small: hello" and model.available(url)
        assert not providers.HttpModel(url, "large").available(url)
    finally:
        server.shutdown()
    assert providers.HttpModel("http://127.0.0.1:9/none", "x", tries=1, pause=0.0).generate("p") is None


def test_without_a_shared_folder_a_cluster_is_refused(spark):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.work_dir(Session())
    assert session.work_dir(spark)
