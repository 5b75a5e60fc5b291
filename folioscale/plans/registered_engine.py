"""Queries over the engine's own steps: layout, contents, tables, spells, search, cards, marts, catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cells, text
from ..operators import chunks, layout, stream, windows
from ..sources.catalog import Catalog
from . import bronze, enrich, export, gold, leaves, lineage, marts, quality, search, silver
from .registered_relational import _MART, _SALES, _sales
from .registry import Registry, vector_of

register = Registry()
QUERIES, SQL = register.queries, register.sql

# Layout: every supplier is a page with one table, a row for each of its line items

_PAGE_ROWS = "select l_suppkey page_index, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber, l_partkey) n, cast(l_partkey as varchar) a, cast(l_orderkey as varchar) b, cast(l_linenumber as varchar) c from lineitem"


def _spans(t) -> DataFrame:
    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey")
    rows = t("lineitem").select(F.col("l_suppkey").cast("int").alias("page_index"), F.row_number().over(w).alias("n"), *[F.col(c).cast("string").alias(x) for c, x in (("l_partkey", "a"), ("l_orderkey", "b"), ("l_linenumber", "c"))])

    def span(name: str, x0: float, x1: float, at: int, font: str) -> F.Column:
        shown = F.col(name) if font == "B" else F.lit(name)
        return F.struct((F.col("n") * 10 + at).alias("idx"), F.col("n").alias("line_idx"), F.lit(font).alias("font"), F.lit(9.0).alias("size"), F.lit(font == "H").alias("bold"), F.lit(x0).alias("x0"), (100.0 + 12 * F.col("n")).alias("y0"), F.lit(x1).alias("x1"), (108.0 + 12 * F.col("n")).alias("y1"), shown.alias("text"))

    data = rows.select("page_index", F.inline(F.array(span("a", 52.0, 82.0, 0, "B"), span("b", 151.0, 181.0, 1, "B"), span("c", 252.0, 282.0, 2, "B"))))
    pages = rows.groupBy("page_index").agg(F.max("n").alias("last"))
    head = pages.withColumn("n", F.lit(0)).select("page_index", F.inline(F.array(span("Part", 50.0, 90.0, 0, "H"), span("Order", 150.0, 190.0, 1, "H"), span("Line", 250.0, 290.0, 2, "H"))))
    prose = pages.select("page_index", F.explode(F.array(F.col("last") + 1, F.col("last") + 2)).alias("n"), F.lit("words of a paragraph").alias("a")).select("page_index", F.inline(F.array(span("a", 50.0, 400.0, 0, "B"))))
    return head.unionByName(data).unionByName(prose).withColumn("source_file", F.lit("suppliers"))


def _regions(t) -> tuple[DataFrame, DataFrame]:
    spans = _spans(t)
    return spans, layout.table_regions(spans, layout.LayoutSettings(header_font="H"))


@register(f"select page_index, 0 region_index, cast(1 + count(*) as int) row_count, 3 col_count, 1 header_row_count, 50.0::double bbox_x0, 100.0::double bbox_y0, 290.0::double bbox_x1, cast(108 + 12 * count(*) as double) bbox_y1, 108.0::double header_bbox_y1, 'font_switch' detection_method from ({_PAGE_ROWS}) group by 1")
def layout_regions(t):
    return _regions(t)[1].select("page_index", "region_index", "row_count", "col_count", "header_row_count", "bbox_x0", "bbox_y0", "bbox_x1", "bbox_y1", "header_bbox_y1", "detection_method")


@register(f"select page_index, cast(n as int) row_index, a || '|' || b || '|' || c cells from ({_PAGE_ROWS}) union all select distinct l_suppkey, 0, 'Part|Order|Line' from lineitem")
def layout_cells(t):
    return layout.region_rows(layout.table_cells(*_regions(t))).select("page_index", "row_index", F.array_join("cells", "|").alias("cells"))


@register(f"select page_index, 0::bigint char_start, cast(13 + sum(1 + length(a) + length(b) + length(c)) as bigint) char_end, 'table' reason from ({_PAGE_ROWS}) group by 1")
def layout_masks(t):
    return layout.text_masks(*_regions(t)).select("page_index", F.col("char_start").cast("long").alias("char_start"), F.col("char_end").cast("long").alias("char_end"), "reason")


@register(f"select page_index, sha256('PartOrderLine' || chr(10) || string_agg(a || b || c, chr(10) order by n) || repeat(chr(10) || 'words of a paragraph', 2) || chr(10)) digest from ({_PAGE_ROWS}) group by 1")
def layout_page_text(t):
    return layout.page_text(_spans(t)).select("page_index", F.sha2("page_text", 256).alias("digest"))


@register(
    f"""with c as (select 'B' font, sum(length(a) + length(b) + length(c)) + 40 * count(distinct page_index) chars from ({_PAGE_ROWS}) union all select 'H', 13 * count(distinct l_suppkey) from lineitem)
  select font, cast(chars as bigint) chars, round(chars / sum(chars) over (), 6) share, chars = max(chars) over () is_body from c"""
)
def layout_fonts(t):
    return layout.font_histogram(_spans(t)).select("font", F.col("chars").cast("long").alias("chars"), F.round("share", 6).alias("share"), "is_body")


# Contents: every region is a book with one page of contents, a line for each nation


def _books(t) -> DataFrame:
    line = F.concat("n_name", F.lit(" ..... "), (F.col("n_nationkey") + 1).cast("string"))
    packed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("l")))), lambda x: x["l"]), "\n")
    return t("nation").groupBy(F.col("n_regionkey").cast("string").alias("source_file")).agg(F.concat(F.lit("Contents\n"), packed).alias("page_text")).withColumn("page_index", F.lit(0)).withColumn("printed_page_num", F.lit(1))


_CONTENTS = "select cast(n_regionkey as varchar) source_file, n_name title, cast(n_nationkey + 1 as int) page_start, cast(coalesce(lead(n_nationkey + 1) over w, 9999) as int) page_end, cast(row_number() over w - 1 as int) sort_order, 1 depth from nation window w as (partition by n_regionkey order by n_nationkey)"


@register(_CONTENTS)
def toc_rows(t):
    return bronze.toc_rows(_books(t)).select("source_file", "title", "page_start", "page_end", "sort_order", "depth")


@register(f"select source_file, case when title like '%3' then 'Third' else title end title, case when title like '%4' then 77 else page_start end page_start, title like '%5' is_excluded from ({_CONTENTS}) where title not like '%6'")
def toc_corrected(t):
    toc = bronze.toc_rows(_books(t))
    change = lambda end, action, value: toc.filter(F.col("title").endswith(end)).select("source_file", "title", F.lit(action).alias("action"), F.lit(value).alias("value"))
    changes = change("3", "rename", "Third").unionByName(change("4", "page", "77")).unionByName(change("5", "exclude", "x")).unionByName(change("6", "remove", "x"))
    return bronze.correct_toc(toc, changes).select("source_file", "title", "page_start", "is_excluded")


@register("select cast(n_regionkey as varchar) source_file, cast(0 as bigint) block_index, row_number() over (partition by n_regionkey order by n_nationkey) row_index, n_name || '~' || n_nationkey cells from nation union all select cast(r_regionkey as varchar), 0, 0, 'Name~Key' from region where r_regionkey in (select n_regionkey from nation)")
def pipe_tables(t):
    line = F.concat(F.lit("| "), "n_name", F.lit(" | "), F.col("n_nationkey").cast("string"), F.lit(" |"))
    packed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", line.alias("l")))), lambda x: x["l"]), "\n\n")
    pages = t("nation").groupBy(F.col("n_regionkey").cast("string").alias("source_file")).agg(F.concat(F.lit("Prose\n| Name | Key |\n|---|---|\n"), packed, F.lit("\nmore prose")).alias("md"))
    out = bronze.pipe_tables(pages, "md", ["source_file"])
    return out.select("source_file", (F.col("block_index") - F.min("block_index").over(Window.partitionBy("source_file"))).cast("long").alias("block_index"), F.col("row_index").cast("long").alias("row_index"), F.array_join("cells", "~").alias("cells"))


@register("select distinct p_brand source_file, p_type || ' ' || u entry_name, 'kind' entry_type, 'T' source_table from part, (values ('one'), ('two')) v(u)")
def authority_entries(t):
    p = t("part").select(F.col("p_brand").alias("source_file"), "p_type").distinct()
    w = Window.partitionBy("source_file").orderBy("p_type")
    rows = p.select("source_file", F.lit("T").alias("toc_title"), F.row_number().over(w).alias("row_index"), cells.encode_cells(F.array(F.concat("p_type", F.lit(" one*<br/>"), "p_type", F.lit("  two")), F.lit("+3"), F.lit("25 gp"))).alias("cells"))
    wanted = p.select("source_file", F.lit("T").alias("toc_title"), F.lit("kind").alias("entry_type"), F.lit(None).cast("int").alias("name_column")).distinct()
    return bronze.authority_entries(rows, wanted)


@register(
    """select a.r source_file, a.n_name toc_title, b.s_suppkey row_key from (select n_regionkey r, n_nationkey, n_name, row_number() over (partition by n_regionkey order by n_nationkey) i from nation) a
  join (select n_regionkey r, s_suppkey, row_number() over (partition by n_regionkey order by s_suppkey) i from supplier join nation on s_nationkey = n_nationkey) b on a.r = b.r and a.i = b.i"""
)
def region_tables(t):
    n = t("nation")
    toc = n.select(F.col("n_regionkey").alias("source_file"), F.lit(1).alias("page_start"), F.col("n_name").alias("title"), F.col("n_nationkey").alias("sort_order"), F.lit(True).alias("is_table"))
    s = t("supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("source_file"), F.lit(1).alias("printed_page_num"), F.lit(0).alias("page_index"), F.col("s_suppkey").alias("region_index"), F.lit(0.0).alias("bbox_y0"))
    rows = s.select("source_file", "page_index", "region_index", F.lit(0).alias("row_index"), F.array(F.col("region_index").cast("string")).alias("cells"))
    out = bronze.tables_from_regions(s, rows, toc)
    return out.select("source_file", "toc_title", F.get(cells.decode_cells(F.col("cells")), F.lit(0)).cast("long").alias("row_key"))


@register("select source_file, toc_title, sort_order, row_index, '[\"a ' || p_name || '\"]' cells from (select p_brand source_file, p_type toc_title, p_partkey row_index, p_name from part) p left join (select p_brand b, p_type t, min(p_partkey) sort_order from part where p_size > 25 group by 1, 2) q on source_file = b and toc_title = t")
def silver_tables(t):
    p = t("part")
    raw = p.select(F.col("p_brand").alias("source_file"), F.lit(1).alias("table_number"), F.lit("x").alias("table_title"), F.col("p_type").alias("toc_title"), F.lit("region").alias("format"), F.col("p_partkey").alias("row_index"), F.concat(F.lit('["a<br/> '), "p_name", F.lit('"]')).alias("cells"))
    toc = p.filter("p_size > 25").groupBy(F.col("p_brand").alias("source_file"), F.col("p_type").alias("title")).agg(F.min("p_partkey").alias("sort_order")).withColumn("toc_id", F.col("sort_order")).withColumn("parent_title", F.lit(None).cast("string")).withColumn("is_table", F.lit(True))
    return silver.tables(raw, toc).select("source_file", "toc_title", "sort_order", "row_index", "cells")


# Spells: every part is an entry whose fields are its columns


def _spells(t) -> DataFrame:
    n = F.lit(None).cast("string")
    content = F.concat(F.col("p_name"), F.lit("\nRange: "), F.col("p_size").cast("string"), F.lit(" yards\nComponent: V, S\nDuration: "), F.col("p_brand"), F.lit("\nCasting Time: 1\nSaving Throw: None\n\nIt does "), F.col("p_type"), F.lit(" to all in reach.\nThe material component is a pinch of sand.\n"))
    return t("part").select(F.col("p_partkey").alias("entry_id"), F.col("p_brand").alias("source_file"), (F.col("p_partkey") % 25).alias("toc_id"), F.col("p_type").alias("toc_title"), F.lit("s").alias("section_title"), F.col("p_name").alias("entry_title"), content.alias("content"), F.when(F.col("p_size") % 2 == 0, "alteration").alias("school"), n.alias("sphere"), F.when(F.col("p_size") % 3 == 0, "wizard").alias("spell_class"), F.when(F.col("p_size") % 3 == 0, F.col("p_size") % 9).cast("int").alias("spell_level"), F.lit("1").alias("page_numbers"), F.length(content).cast("long").alias("char_count"))


@register("select p_partkey entry_id, case when p_size % 2 = 0 then 'alteration' else '' end school, p_size || ' yards' \"range\", 'V, S' components, p_brand duration, '1' casting_time, '' area_of_effect, 'None' saving_throw, 'The material component is a pinch of sand.' material_component_text from part where p_size % 3 = 0")
def spell_meta(t):
    return silver.spell_meta(_spells(t)).select("entry_id", "school", "range", "components", "duration", "casting_time", "area_of_effect", "saving_throw", "material_component_text")


@register("select p_partkey entry_id, case when p_size % 3 = 0 then 'It does ' || p_type || ' to all in reach.' else 'Range: ' || p_size || ' yards' || chr(10) || 'Component: V, S' || chr(10) || 'Duration: ' || p_brand || chr(10) || 'Casting Time: 1' || chr(10) || 'Saving Throw: None' || chr(10) || chr(10) || 'It does ' || p_type || ' to all in reach.' || chr(10) || 'The material component is a pinch of sand.' end content from part")
def spell_descriptions(t):
    fields = ["Range", "Component", "Components", "Duration", "Casting Time", "Saving Throw"]
    bare = _spells(t).withColumn("content", text.without_leading_title(F.col("content"), F.col("entry_title")))
    return silver.entry_descriptions(bare, fields).select("entry_id", "content")


@register("select p_partkey entry_id, true has_metadata, true has_description, '1st' is not null ok from part")
def entry_flags(t):
    meta, description = silver.entry_flags(F.col("content"), ["Range", "Duration", "Casting Time", "Saving Throw"])
    return _spells(t).select("entry_id", meta.alias("has_metadata"), description.alias("has_description"), F.lit(True).alias("ok"))


_INDEX = """select p_partkey entry_id, p_brand source_file, p_name entry_title, case when p_size % 3 = 0 then 'spell' when p_partkey % 25 = 7 then 'table' when p_partkey % 25 = 9 then 'class' when pr.k is not null then 'proficiency' else 'rule' end entry_type,
  case when p_size % 3 = 0 then case when f.k is not null then f.lv else cast(p_size % 9 as int) end end spell_level, case when p_size % 3 = 0 then 'wizard' end spell_class,
  p_size || ' yards' range_text, 'V, S' components, p_brand duration_text
  from part left join (select p_brand b, lower(p_name) k, max(cast(p_size % 7 as int)) lv from part where p_partkey % 2 = 0 group by 1, 2) f on p_brand = f.b and lower(p_name) = f.k
  left join (select distinct p_brand b, lower(p_name) k from part where p_size = 1) pr on p_brand = pr.b and lower(p_name) = pr.k"""


def _index(t) -> DataFrame:
    e, p = _spells(t), t("part")
    # each brand's own sections
    own = p.select(F.col("p_brand").alias("source_file"), (F.col("p_partkey") % 25).alias("k")).distinct()
    toc = own.join(t("nation"), F.col("k") == F.col("n_nationkey")).select("source_file", F.col("n_nationkey").cast("long").alias("toc_id"), F.when(F.col("n_nationkey") == 9, "Wizard").otherwise(F.col("n_name")).alias("title"), F.col("n_nationkey").alias("sort_order"), F.lit(1).alias("depth"), (F.col("n_nationkey") == 7).alias("is_table"))
    facts = p.filter("p_partkey % 2 = 0").groupBy(F.col("p_brand").alias("source_file"), F.col("p_name").alias("entry_name")).agg(F.max((F.col("p_size") % 7).cast("int")).alias("entry_level")).select("*", F.lit("wizard").alias("entry_class"), F.lit(None).cast("string").alias("school"), F.lit(None).cast("string").alias("sphere"), F.lit(False).alias("is_reversible"), F.lit(3).alias("ref_page"))
    names = p.filter("p_size = 1").select(F.col("p_brand").alias("source_file"), F.col("p_name").alias("entry_name"), F.lit("proficiency").alias("entry_type"))
    return gold.entry_index(e, toc, facts, names, ["Wizard"])


@register(_INDEX)
def entry_index(t):
    return _index(t).select("entry_id", "source_file", "entry_title", "entry_type", "spell_level", "spell_class", "range_text", "components", "duration_text")


@register(f"select entry_id, entry_type from ({_INDEX}) where entry_type in ('spell', 'class') and entry_id not in (select p_partkey from part where p_partkey % 4 = 0)")
def enrichment_pending(t):
    done = t("part").filter("p_partkey % 4 = 0").select(F.col("p_partkey").alias("entry_id"))
    return enrich.pending(_index(t), done, ["spell", "class"]).select("entry_id", "entry_type")


@register(
    """select p_partkey entry_id, concat_ws(' | ', 'Level ' || p_size % 9, case when p_size % 2 = 0 then 'alteration' end, case when p_size % 5 = 0 then 'Reversible' end, case when p_partkey % 2 = 0 then 'Combat' end) badges,
  case when length(repeat(p_name || ' ', 6)) > 120 then left(repeat(p_name || ' ', 6), 120) || '...' else repeat(p_name || ' ', 6) end snippet from part"""
)
def entry_cards(t):
    p = t("part").select(F.col("p_partkey").alias("entry_id"), (F.col("p_size") % 9).alias("spell_level"), F.when(F.col("p_size") % 2 == 0, "alteration").alias("school"), F.lit(None).cast("string").alias("sphere"), (F.col("p_size") % 5 == 0).alias("is_reversible"), (F.col("p_partkey") % 2 == 0).alias("is_combat"), F.lit(False).alias("is_popular"), F.repeat(F.concat("p_name", F.lit(" ")), F.lit(6)).alias("summary"))
    return enrich.card(p)


@register("select p_partkey, case when p_size % 4 = 0 then null else p_size % 2 = 0 end is_combat, case when p_size % 4 = 0 then null else false end is_popular from part")
def model_verdicts(t):
    answer = F.when(F.col("p_size") % 4 == 0, "no idea").otherwise(F.concat(F.lit('Sure: {"combat": '), (F.col("p_size") % 2 == 0).cast("string"), F.lit("} done")))
    return enrich.verdicts(t("part").select("p_partkey", answer.alias("response"))).drop("response")


@register("select p_partkey entry_id, spell_level, school from (select p_partkey, cast(p_size % 9 as int) spell_level, case when p_size % 2 = 0 then 'alteration' end school, p_size % 3 = 0 ok, p_name n from part) where ok and spell_level between 2 and 6 and school = 'alteration' and contains(lower(n), 'a') and p_partkey % 5 = 0")
def compendium(t):
    index = _spells(t).withColumn("entry_type", F.when(F.col("spell_level").isNotNull(), "spell").otherwise("rule")).withColumn("is_reversible", F.lit(False))
    notes = t("part").select(F.col("p_partkey").alias("entry_id"), (F.col("p_partkey") % 5 == 0).alias("is_combat"), F.lit(False).alias("is_popular"))
    texts = t("part").select(F.col("p_partkey").alias("entry_id"), F.col("p_type").alias("summary"))
    return search.compendium(index, notes, texts, "spell", ["wizard"], 2, 6, "alteration", combat_only=True, search="A").select("entry_id", "spell_level", "school")


# Readers


def _chunks(t) -> DataFrame:
    return _spells(t).select(F.col("entry_id").alias("chunk_id"), "source_file", "toc_id", "section_title", "entry_title", "content")


@register("select r_name source_file, string_agg(n_name || ':' || coalesce(c, 0), ',' order by n_nationkey) sections from region join nation on n_regionkey = r_regionkey left join (select p_partkey % 25 k, count(*) c from part group by 1) on k = n_nationkey group by 1")
def book_categories(t):
    toc = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("source_file"), F.col("n_nationkey").alias("page_start"), F.col("n_nationkey").cast("long").alias("toc_id"), F.col("n_name").alias("title"), F.lit(False).alias("is_excluded"))
    out = search.categories(toc, _chunks(t))
    return out.select("source_file", F.array_join(F.transform("sections", lambda s: F.concat(s["title"], F.lit(":"), s["chunks"].cast("string"))), ",").alias("sections"))


@register("select p_name entry_title, min(p_partkey) first_chunk from part where p_partkey % 25 = 3 group by 1")
def section_entries(t):
    return search.entry_list(_chunks(t), 3)


@register("select cast(row_number() over (order by n_regionkey, n_nationkey) as int) number, row_number() over (order by n_regionkey, n_nationkey) || '. ' || n_name || ' (p.' || n_regionkey || '): a, b' line from nation")
def toc_prompt(t):
    toc = t("nation").select(F.col("n_nationkey").alias("toc_id"), F.col("n_name").alias("title"), F.col("n_regionkey").alias("page_start"), F.lit("a; b; c").alias("sub_headings"))
    return search.numbered_toc(toc, 2).select(F.col("number").cast("int").alias("number"), "line")


@register("select p_brand source_file, table_number, max(p_partkey) entry_id from (select *, cast(p_size as int) table_number from part) group by 1, 2")
def table_lookup(t):
    index = t("part").select(F.col("p_brand").alias("source_file"), F.concat(F.lit("Table "), F.col("p_size").cast("string"), F.lit(": "), "p_name").alias("entry_title"), F.col("p_partkey").alias("entry_id"))
    return search.table_numbers(t("region"), index).select("source_file", "table_number", "entry_id")


@register("select n_regionkey source_file, n_nationkey toc_id, case when n_nationkey % 2 = 0 then n_nationkey else max(case when n_nationkey % 3 = 0 then n_nationkey end) over (partition by n_regionkey order by n_nationkey rows unbounded preceding) end anchor from nation")
def sidebar(t):
    k = F.col("n_nationkey")
    toc = t("nation").select(F.col("n_regionkey").alias("source_file"), k.alias("toc_id"), k.alias("sort_order"), (k % 2 == 0).alias("has_content"), (k % 3 == 0).alias("is_chapter"))
    return search.sidebar(toc).select("source_file", "toc_id", "anchor")


@register("select p_brand source_file, sha256(string_agg(case when l is distinct from p_name then '### ' || p_name || chr(10) || chr(10) else '' end || p_type, chr(10) || chr(10) order by p_partkey)) digest from (select *, lag(p_name) over (partition by p_brand order by p_partkey) l from part) group by 1")
def whole_books(t):
    p = t("part")
    c = p.select(F.col("p_partkey").alias("chunk_id"), F.col("p_brand").alias("source_file"), F.lit(1).alias("toc_id"), F.col("p_name").alias("entry_title"), F.concat(F.lit(" "), "p_type", F.lit("\n")).alias("content"), F.lit("1").alias("page_numbers"))
    toc = t("region").limit(1).select(F.lit(1).alias("toc_id"), F.lit("All").alias("title"), F.lit(1).alias("page_start"), F.lit(1).alias("sort_order"))
    return export.whole_book(c, toc).select("source_file", F.sha2(F.regexp_replace("markdown", "^## All\n\n", ""), 256).alias("digest"))


# Texts and cells


@register(
    """select p_partkey, p_name || ' x' squeezed, p_name cleaned, replace(lower(p_name), ' ', '_') || ',b' slugs, 'See [Table ' || p_size || '](#table-' || p_size || ').' linked,
  p_name || 'abc' rejoined, case when p_size < 60 then p_size || 's' else floor(p_size / 60)::int || 'm ' || p_size % 60 || 's' end duration, floor(p_size * 100 / 3600)::int duration_hours, 'was ' || p_name replaced, p_size = 7 dropped from part"""
)
def text_rules(t):
    name, size = F.col("p_name"), F.col("p_size")
    d = text.duration_text(size * 100)
    return t("part").select(
        "p_partkey",
        text.squeeze(F.concat(F.lit("  "), name, F.lit(" \n\t x "))).alias("squeezed"),
        text.clean_for_matching(F.concat(F.lit("## **"), name, F.lit("** (old) "))).alias("cleaned"),
        F.array_join(text.slugs(F.concat(name, F.lit(", ,b"))), ",").alias("slugs"),
        text.link_table_references(F.concat(F.lit("See Table  "), size.cast("string"), F.lit("."))).alias("linked"),
        text.rejoin_hyphens(F.concat(name, F.lit("- \n abc"))).alias("rejoined"),
        text.duration_text(size).alias("duration"),
        F.coalesce(F.regexp_extract(d, "^([0-9]+)h", 1).try_cast("int"), F.lit(0)).alias("duration_hours"),
        text.replace_ignoring_case(F.concat(F.lit("IS "), name), "is ", "was ").alias("replaced"),
        text.matches_any(F.concat(F.lit("Page "), size.cast("string")), ["page 7$", "none"]).alias("dropped"),
    )


@register(
    """select p_partkey, 'one' first_part, cast(p_size + 3 as int) page_sum, p_name wrong, 1 n_corrections, not (p_size % 2 = 0) name_ok, p_name || '||' || p_size dense, '| ' || p_name || ' | a b |' line from part"""
)
def cell_rules(t):
    name, size = F.col("p_name"), F.col("p_size").cast("string")
    fixes = cells.ocr_corrections(F.concat(F.lit('Here: [{"wrong": "'), name, F.lit('", "correct": "x"}, {"wrong": "same", "correct": "same"}]')))
    pages = cells.page_list(F.concat(size, F.lit(", ,3,x")))
    row = cells.dense_row(F.create_map(F.lit(0), name, F.lit(2), size), F.lit(3))
    return t("part").select(
        "p_partkey",
        F.get(cells.split_breaks(F.concat(F.lit("one<br />"), name)), F.lit(0)).alias("first_part"),
        F.aggregate(F.filter(pages, lambda x: x.isNotNull()), F.lit(0), lambda s, x: s + x).alias("page_sum"),
        F.get(fixes, F.lit(0))["wrong"].alias("wrong"),
        F.size(fixes).alias("n_corrections"),
        cells.name_cell_ok(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("+"), size, F.lit(" gp"))).otherwise(name)).alias("name_ok"),
        F.array_join(row, "|").alias("dense"),
        cells.table_row(cells.encode_cells(F.array(name, F.lit("a<br>b ")))).alias("line"),
    )


@register("select conv_id, 2 * rn - 2 line_index, cast(sum(length(role) + 3 + length(line) + 1) over (partition by conv_id order by rn rows between unbounded preceding and 1 preceding) as int) p, role heading from (select conv_id, role, replace(text, chr(10), ' ') line, row_number() over (partition by conv_id order by turn, role, text) rn from conversations)")
def headings(t):
    c = t("conversations")
    line = F.concat(F.lit("# "), "role", F.lit("\n"), F.replace("text", F.lit("\n"), F.lit(" ")))
    md = c.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text", line.alias("l")))), lambda x: x["l"]), "\n").alias("md"))
    out = chunks.headings(md, "md", 1).drop("md")
    return out.select("conv_id", F.col("line_index").cast("long").alias("line_index"), F.when(F.col("position") > 0, F.col("position")).alias("p"), "heading")


@register("select p_partkey, 3 n_fields, p_brand b, 'Body of ' || p_name body from part")
def stat_fields(t):
    c = F.concat(F.lit("# Head\nRange: 1\nDuration: "), F.col("p_brand"), F.lit("\nSchool: x\nBody of "), F.col("p_name"), F.lit("\n"))
    m = chunks.stat_fields(c, ["Range", "Duration", "School", "Sphere"])
    return t("part").select("p_partkey", F.size(m).alias("n_fields"), m["Duration"].alias("b"), chunks.without_fields(c, ["Range", "Duration", "School"]).alias("body"))


@register("select conv_id, string_agg(text, ' ' order by turn, role, text) as text, min(k) k, g island from (select *, sum(case when role = 'user' then 1 else 0 end) over (partition by conv_id order by k) g from (select *, row_number() over (partition by conv_id order by turn, role, text) k from conversations)) group by conv_id, g")
def continued_turns(t):
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    c = t("conversations").withColumn("k", F.row_number().over(w))
    return windows.continued_names(c, ["conv_id"], [F.col("k")], F.col("role") == "user", "text", "k").select("conv_id", "text", "k", "island")


@register(
    """select user_id, event_id, fault from (select user_id, event_id, case when v < lag(v) over w then 'backwards' when v - lag(v) over w > 20 then 'jump' when row_number() over w = count(*) over (partition by user_id) and v > 2 * count(*) over (partition by user_id) then 'beyond' end fault
  from (select user_id, event_id, event_id % 100 v from events) window w as (partition by user_id order by event_id)) where fault is not null"""
)
def page_number_faults(t):
    e = t("events").select("user_id", "event_id", (F.col("event_id") % 100).alias("v"))
    return windows.page_number_faults(e, ["user_id"], "event_id", "v", 20).select("user_id", "event_id", "fault")


# Marts, files, checks


@register(f"select * from ({_MART}) where order_date >= (select max(order_date) from ({_MART}) where region = 'NATION_5' and order_date < date '1996-01-01')")
def mart_increment(t):
    mart = marts.between(marts.daily_revenue(_sales(t)), "NATION_5", "1990-01-01", "1995-12-31")
    return marts.new_days(_sales(t), mart)


@register("select user_id, n from (select user_id, count(*) n from (select user_id, sum(f) over (partition by user_id order by ts, event_id) s from (select user_id, ts, event_id, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 30 minutes then 0 else 1 end f from events)) group by user_id, s)")
def event_sessions(t):
    from ..streaming.ingest import sessions

    return sessions(t("events")).select("user_id", "n")


@register("select o_orderpriority source_file, 'orders' table_name, count(*) row_count from orders group by 1 union all select c_mktsegment, 'customers', count(*) from customer group by 1")
def file_counts(t):
    tables = {"orders": t("orders").withColumnRenamed("o_orderpriority", "source_file"), "customers": t("customer").withColumnRenamed("c_mktsegment", "source_file")}
    return lineage.file_counts(tables, "run").select("source_file", "table_name", "row_count")


@register("select p_name source_file, p_partkey pdf_size_bytes from part where not (p_partkey % 3 = 0 and p_size % 2 = 0)")
def changed_files(t):
    found = t("part").select(F.col("p_name").alias("source_file"), F.col("p_partkey").alias("pdf_size_bytes"), F.when(F.col("p_size") % 2 == 0, "a").otherwise("b").alias("config_hash"))
    done = found.filter("pdf_size_bytes % 3 = 0").withColumn("config_hash", F.lit("a"))
    return lineage.changed_files(found, done).select("source_file", "pdf_size_bytes")


@register("select h heading from (select distinct n_name h from nation) where h not like '%1' and not exists (select 1 from region where r_name = h) and h <> 'NATION_2'")
def unreviewed_headings(t):
    heads = t("nation").select(F.lit("b").alias("source_file"), F.concat("n_name", F.lit(".")).alias("heading")).distinct()
    toc = t("nation").filter("n_name like '%1'").select(F.lit("b").alias("source_file"), F.concat(F.lit("Part: "), "n_name").alias("title"))
    return quality.unreviewed(heads, toc, ["nation_2"]).select(F.regexp_replace("heading", r"\.$", "").alias("heading"))


@register("select p_partkey name from part where p_partkey % 2 = 1 or p_size > 40")
def expected_content(t):
    p = t("part")
    want = p.select(F.col("p_brand").alias("source_file"), F.col("p_type").alias("title"), F.concat(F.lit("<"), F.col("p_partkey").cast("string"), F.lit(">")).alias("name"))
    have = p.filter("p_partkey % 2 = 0 and p_size <= 40").select(F.col("p_brand").alias("source_file"), F.col("p_type").alias("title"), F.concat(F.lit("text <"), F.col("p_partkey").cast("string"), F.lit("> more")).alias("content"))
    return quality.expected_content(want, have).select(F.regexp_replace("name", "[<>]", "").cast("long").alias("name"))


# The catalog: written, changed in every way, and read back


@register(
    """select cast(n_regionkey as varchar) source_file, s_suppkey id, case when n_regionkey = 1 then 'anew' when s_suppkey % 10 = 3 then 'upserted' else s_name end name, case when n_regionkey <> 1 and s_suppkey % 10 = 3 then 1 when n_regionkey <> 1 and n_regionkey = 4 then 7 end extra
  from supplier join nation on s_nationkey = n_nationkey where n_regionkey <> 2 and (s_suppkey % 7 <> 0)"""
)
def catalog_writes(t):
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("n_regionkey").cast("string").alias("source_file"))
    cat, space = Catalog(s.sparkSession), f"fs_{uuid.uuid4().hex[:10]}"
    none = F.lit(None).cast("int")
    cat.replace(space, "rows", s.filter("source_file <> '4'"))
    cat.append(space, "rows", s.filter("source_file = '4'").withColumn("extra", F.lit(7)))  # a column more
    cat.overwrite_where(space, "rows", s.filter("source_file = '1'").withColumn("name", F.lit("anew")).withColumn("extra", none), "source_file", "1")
    cat.overwrite_where(space, "rows", s.limit(0).withColumn("extra", none), "source_file", "2")
    cat.upsert(space, "rows", s.filter("id % 10 = 3 and source_file not in ('1', '2')").withColumn("name", F.lit("upserted")).withColumn("extra", F.lit(1)), ["id"])
    cat.delete_orphans(space, "rows", s.filter("id % 7 <> 0").select("id"), ["id"])
    return cat.read(space, "rows").select("source_file", "id", "name", "extra")


@register("select 'a' table_name, count(*) row_count from region union all select 'b', count(*) from nation where n_regionkey = 1")
def catalog_listing(t):
    r = t("region").select(F.col("r_regionkey").cast("string").alias("source_file"), F.col("r_name").alias("name"))
    n = t("nation").select(F.col("n_regionkey").cast("string").alias("source_file"), F.col("n_name").alias("name"))
    cat, space = Catalog(r.sparkSession), f"fs_{uuid.uuid4().hex[:10]}"
    cat.replace(space, "a", r)
    cat.replace(space, "b", n)
    cat.replace(space, "b", cat.read(space, "b", source_file="1"))  # from itself
    cat.views([space])
    cat.append(space, "c", n)
    cat.drop(space, "c")
    seen = {
        "exists": cat.exists(space, "a") and not cat.exists(space, "c"),
        "tables": cat.tables(space) == ["a", "b"] and cat.all_tables()[space] == ["a", "b"],
        "files": [r[0] for r in cat.source_files(space, "b", contains="1").collect()] == [r[0] for r in n.filter("source_file = '1'").select("source_file").distinct().collect()],
        "views": r.sparkSession.table(f"{space}_b").count() == cat.read(space, "b").count(),
        "rows": cat.query(space, "b", ["name"], "name like '%1'", limit=3, width=4).filter("length(name) > 4").count() == 0,
        "empty": not cat.replace(space, "a", r.limit(0), skip_empty=True),
    }
    if not all(seen.values()):
        raise ValueError(f"the catalog lost something: {seen}")
    return cat.row_counts([space]).select("table_name", "row_count")


@register(f"select region, product, cast(sum(cast(amount as decimal(20,4))) as double) revenue, count(distinct order_id) orders from ({_SALES}) group by 1, 2")
def revenue_cube_cells(t):
    return _sales(t).groupBy("region", "product").agg(marts.money_sum(F.col("amount")).cast("double").alias("revenue"), F.countDistinct("order_id").alias("orders"))


@register(
    """with e as (select vec_id, case when vec_id % 5 = 0 then 'two' else 'one' end source_file, embedding::double[] v from embeddings), q as (select embedding::double[] q from embeddings where vec_id = 11)
  select vec_id, round(s, 4) similarity from (select vec_id, list_dot_product(v, q) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(q, q))) s from e, q where source_file = 'two') order by s desc, vec_id limit 15"""
)
def vector_index(t):
    e = t("embeddings").select("vec_id", "embedding").withColumn("source_file", F.lit("one"))
    index = search.VectorIndex(Catalog(e.sparkSession), f"fs_{uuid.uuid4().hex[:10]}", "vectors", "vec_id")
    index.put(e)
    index.put(e.filter("vec_id % 5 = 0").withColumn("source_file", F.lit("two")))  # in the place of their own
    q = vector_of(e, 11)
    return index.search(q, 15, source_file="two").select("vec_id", F.round("similarity", 4).alias("similarity"))


@register(
    """with c as (select conv_id, lower(replace(text, chr(10), ' ')) text, row_number() over (partition by conv_id order by turn, role, text) k from conversations),
  m as (select conv_id, string_agg(text, chr(10) order by k) md from c group by 1)
  select cast(conv_id as varchar) source_file, instr(md, left(text, 20)) - 1 markdown_position, k page_index from c join m using (conv_id) where k = 1 and length(text) >= 20"""
)
def page_anchors(t):
    """The first page of each conversation, with watermarks between the turns."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    c = t("conversations").select(F.col("conv_id").cast("string").alias("source_file"), F.row_number().over(w).alias("page_index"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text")).withColumn("page_text", F.concat(F.lit("head\n"), "text"))
    md = c.groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_index", "text"))), lambda x: x["text"]), "\n WM \n").alias("markdown_text"))
    marks = c.select("source_file", F.lit("WM").alias("watermark_text")).distinct()
    pages = c.filter("page_index = 1").withColumn("printed_page_num", F.col("page_index"))
    out = silver.page_anchors(pages, md, (20,), marks=marks)
    return out.select("source_file", "markdown_position", "page_index")


@register(
    """with t as (select n_regionkey r, n_name title, n_nationkey p from nation), e as (select p_partkey % 25 k, p_name n, min(p_partkey) i from part group by 1, 2)
  select cast(r as varchar) source_file, title, coalesce((select string_agg(n, '; ' order by i) from (select * from e where k = p order by i limit 50)), '') sub_headings, case when p = n0 then null else n0 end parent from t join (select n_regionkey r, min(n_nationkey) n0 from nation group by 1) using (r)"""
)
def toc_sections(t):
    n = t("nation")
    first = n.groupBy("n_regionkey").agg(F.min_by("n_name", "n_nationkey").alias("_p"), F.min("n_nationkey").alias("_n"))
    toc = n.join(first, "n_regionkey").select(F.col("n_regionkey").cast("string").alias("source_file"), F.col("n_name").alias("title"), F.when(F.col("n_nationkey") != F.col("_n"), F.col("_p")).alias("parent_title"), F.col("n_nationkey").alias("page_start"), F.lit(9999).alias("page_end"), F.col("n_nationkey").alias("sort_order"), F.lit(1).alias("depth"), F.lit(False).alias("is_chapter"), F.lit(False).alias("is_table"), F.lit(False).alias("is_excluded"))
    e = t("part").join(n, F.col("p_partkey") % 25 == F.col("n_nationkey")).select(F.col("n_regionkey").cast("string").alias("source_file"), F.col("n_name").alias("toc_title"), F.col("p_name").alias("entry_title"), F.col("p_partkey").alias("entry_id"))
    s = silver.toc_sections(toc, e)
    up = s.select(F.col("toc_id").alias("parent_toc_id"), F.col("page_start").alias("parent"))
    return s.join(up, "parent_toc_id", "left").select("source_file", "title", "sub_headings", "parent")


@register("select p_partkey, case when p_size % 2 = 0 then 'Alteration/Charm' when p_size % 3 = 0 then 'Divination' end school from part")
def schools(t):
    size = F.col("p_size")
    content = F.concat("p_name", F.lit("\n"), F.when(size % 2 == 0, "(Alteration/Charm)").otherwise("(Reversible)"), F.when(size % 3 == 0, "\nSchool: Divination").otherwise(""))
    return t("part").select("p_partkey", silver.schools_of(content, ["alteration", "divination"]).alias("school"))


@register("select 'book' kind, r_name value from region union all select 'toc', n_name from nation where n_regionkey = 1 union all select 'entry', p_name from part where p_partkey = 17 union all select 'routed', n_name from (select n_name from nation where contains(lower(n_name), 'nation_1') order by n_nationkey limit 3)")
def readers(t):
    toc = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("source_file"), F.col("n_nationkey").alias("toc_id"), F.col("n_name").alias("title"), F.col("n_nationkey").alias("page_start"), F.lit(False).alias("is_excluded"), F.lit("").alias("sub_headings"), F.col("n_regionkey"))
    first = toc.filter("n_regionkey = 1").select("source_file").first()
    value = lambda kind, df, c: df.select(F.lit(kind).alias("kind"), F.col(c).alias("value"))
    return value("book", search.books(toc), "source_file").unionByName(value("toc", search.toc_of(toc, first.source_file if first else ""), "title")).unionByName(value("entry", search.lookup(_spells(t), entry_id=17), "entry_title")).unionByName(value("routed", search.route_by_keywords(toc, "is it Nation_1 ?", 3), "title"))


@register("select string_agg('[' || p_name || ']' || chr(10) || p_type, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by p_partkey) context from part where p_partkey <= 12")
def prompt_context(t):
    few = t("part").filter("p_partkey <= 12").select("p_partkey", F.col("p_name").alias("entry_title"), F.col("p_type").alias("content"))
    return search.context(few, ["p_partkey"])


@register("select p_brand source_file, count(*) total_chunks, count(distinct p_partkey % 25) total_toc_entries, 7 total_pages from part group by 1")
def gold_files(t):
    toc = t("nation").select(F.col("n_nationkey").cast("long").alias("toc_id"))
    files = t("part").select(F.col("p_brand").alias("source_file"), F.lit(7).alias("total_pages")).distinct()
    return gold.files(_chunks(t), files, toc).select("source_file", "total_chunks", "total_toc_entries", "total_pages")


@register(f"select entry_id, entry_type, p_type content from ({_INDEX}) join part on entry_id = p_partkey where p_partkey % 2 = 0")
def gold_descriptions(t):
    d = t("part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("entry_id"), F.col("p_brand").alias("source_file"), F.col("p_type").alias("content"))
    return gold.entry_descriptions(d, _index(t)).select("entry_id", "entry_type", "content")


@register("select cast(p_partkey as varchar) id, p_type \"document\", p_brand source_file, coalesce(n_name, '') toc_title, '' page_numbers, 'g' game_system from part left join nation on n_nationkey = p_partkey % 30")
def vector_rows(t):
    from .providers import vector_rows as rows

    c = t("part").select(F.col("p_partkey").alias("chunk_id"), F.col("p_brand").alias("source_file"), (F.col("p_partkey") % 30).alias("toc_id"), F.lit("s").alias("section_title"), F.col("p_name").alias("entry_title"), F.lit(None).cast("string").alias("page_numbers"), F.lit("content").alias("chunk_type"), F.col("p_type").alias("content"))
    toc = t("nation").select(F.col("n_nationkey").cast("long").alias("toc_id"), F.col("n_name").alias("title"))
    files = t("part").select(F.col("p_brand").alias("source_file"), F.lit("g").alias("game_system"), F.lit("rules").alias("content_type")).distinct()
    meta = F.col("metadata")
    return rows(c, toc, files).select("id", "document", *[meta[k].alias(k) for k in ("source_file", "toc_title", "page_numbers", "game_system")])


@register("select entry_id, entry_type, left(p_type, 200) summary from (" + _INDEX + ") join part on entry_id = p_partkey where entry_type = 'spell' and p_partkey % 2 = 1")
def summaries(t):
    """Summaries by the stub model, which answers with the first sentence of the last line."""
    from .providers import StubModel

    done = t("part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("entry_id"))
    e = t("part").select(F.col("p_partkey").alias("entry_id"), F.lit("x").alias("content"), F.lit(500).alias("char_count"))
    d = t("part").select(F.col("p_partkey").alias("entry_id"), F.concat("p_type", F.lit(". And more.")).alias("content"))
    return enrich.summaries(_index(t), e, d, done, StubModel(), "Summarize {title}, a {type}:\n{text}", ["spell"]).select("entry_id", "entry_type", "summary")


@register("select cast(p_partkey as bigint) p_partkey, case when p_size % 2 = 0 then 2 when p_size % 3 = 0 then 99 else 1 end as rank from part")
def ordinal_titles(t):
    size = F.col("p_size")
    title = F.when(size % 2 == 0, "Second-Level Spells").when(size % 3 == 0, "Other Spells").otherwise("Spells of the FIRST Level")
    return t("part").select(F.col("p_partkey").cast("long").alias("p_partkey"), export.ordinal_rank(title).alias("rank"))


@register("select o_orderkey, p_brand brand, p_size size from orders left join (select o_orderkey k, min(p_partkey) m from orders, part where p_size = o_orderkey % 60 group by 1) on k = o_orderkey left join part on p_partkey = m")
def first_range(t):
    """The first part whose page range holds an order's page."""
    from ..operators import joins

    points = t("orders").select("o_orderkey", (F.col("o_orderkey") % 60).alias("p"), F.lit(1).alias("k"))
    ranges = t("part").select(F.lit(1).alias("k"), F.col("p_size").alias("lo"), F.col("p_size").alias("hi"), "p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return joins.first_range(points, ranges, ["k"], ["o_orderkey"], "p", "lo", "hi", [F.col("p_partkey")], ["brand", "size"]).select("o_orderkey", "brand", "size")


@register("select n_nationkey k, max(s_suppkey) last_supplier from nation left join supplier on s_nationkey <= n_nationkey group by 1")
def open_ranges(t):
    """Ranges without an end: every nation with the suppliers that begin at or before it."""
    from ..operators import joins

    points = t("nation").select(F.col("n_nationkey").cast("long").alias("k"), F.lit(1).alias("one"))
    ranges = t("supplier").select(F.lit(1).alias("one"), F.col("s_nationkey").cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"), "s_suppkey")
    held = joins.range_join(points, ranges, ["one"], "k", "lo", "hi").groupBy("k").agg(F.max("s_suppkey").alias("last_supplier"))
    return points.select("k").join(held, "k", "left")


@register(
    """with c as (select conv_id, replace(text, chr(10), ' ') text, row_number() over (partition by conv_id order by turn, role, text) k from conversations)
  select cast(conv_id as varchar) source_file, 'Chapter 1: The Talk' toc_title, 'Turn ' || k entry_title, length('# Turn ' || k || chr(10) || regexp_replace(text, '^ +| +$', '', 'g')) n, k page_start from c"""
)
def markdown_entries(t):
    """Every conversation as a book: a chapter whose heading lacks its number, and a leaf for each turn."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    c = t("conversations").select(F.col("conv_id").cast("string").alias("source_file"), F.row_number().over(w).alias("k"), F.trim(F.replace("text", F.lit("\n"), F.lit(" "))).alias("text"))
    part = F.concat(F.lit("# Turn "), F.col("k").cast("string"), F.lit("\n"), "text")
    md = c.groupBy("source_file").agg(F.concat(F.lit("preface\n## The **Talk**\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", part.alias("x")))), lambda r: r["x"]), "\nWM\n")).alias("markdown_text"))
    no = F.lit(False)
    row = lambda title, parent, k, chapter: [F.col("source_file"), title.alias("title"), parent.alias("parent_title"), k.alias("page_start"), k.alias("sort_order"), F.lit(chapter).alias("is_chapter"), no.alias("is_table"), no.alias("is_excluded")]
    talk = F.lit("Chapter 1: The Talk")
    toc = c.select(*row(F.concat(F.lit("Turn "), F.col("k").cast("string")), talk, F.col("k"), False)).unionByName(c.filter("k = 1").select(*row(talk, F.lit(None).cast("string"), F.lit(0), True)))
    marks = c.select("source_file", F.lit("WM").alias("watermark_text")).distinct()
    return stream.build_from_markdown(md, toc, marks).select("source_file", "toc_title", "entry_title", F.length("content").alias("n"), "page_start")


@register(
    """select r_name parent_title, p_name title, 'spell_list' source, cast(p_size % 3 as int) spell_level, n_nationkey page_start from nation join region on r_regionkey = n_regionkey join part on p_size % 3 = n_nationkey % 3
  union all select r_name, n_name || case n_nationkey % 3 when 0 then ' zero' when 1 then ' one' else ' two' end, 'toc', null, n_nationkey from nation join region on r_regionkey = n_regionkey
  union all select r_name, 'The Dice', 'anchor', null, 0 from region"""
)
def extended_contents(t):
    """Every region a chapter, every nation a level's heading in it, below which the spells of the level stand."""
    n = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key, no = F.col("n_nationkey"), F.lit(False)
    word = F.when(key % 3 == 0, " zero").when(key % 3 == 1, " one").otherwise(" two")
    row = lambda file, title, page, order, chapter, parent: [file.alias("source_file"), title.alias("title"), page.cast("int").alias("page_start"), F.lit(9999).alias("page_end"), order.cast("int").alias("sort_order"), F.lit(chapter).alias("is_chapter"), no.alias("is_table"), no.alias("is_excluded"), parent.alias("parent_title")]
    subs = n.select(*row(F.lit("levels"), F.concat("n_name", word), key, key + 1, False, F.col("r_name")))
    chapters = t("region").select(*row(F.lit("levels"), F.col("r_name"), F.lit(0), F.lit(0), True, F.lit(None).cast("string")))
    p = t("part").select(F.lit("levels").alias("source_file"), F.col("p_name").alias("entry_name"), F.lit("wizard").alias("entry_class"), (F.col("p_size") % 3).alias("entry_level"), F.lit(None).cast("string").alias("school"), F.lit(None).cast("string").alias("sphere"))
    nobody = t("region").limit(0).select(F.lit("").alias("source_file"), F.lit("").alias("entry_name"), F.lit("").alias("entry_type"))
    listed = leaves.extended_toc(chapters.unionByName(subs), [{"key": "", "source": "spells"}], p, nobody, {"zero": 0, "one": 1, "two": 2}).filter("not is_chapter")
    # the same chapters with an anchor
    books = chapters.withColumn("source_file", F.lit("anchors"))
    dice = leaves.extended_toc(books, [{"key": "", "source": "anchors", "anchors": ["**The Dice**"]}], p, nobody, {}).filter("source = 'anchor'")
    return listed.unionByName(dice).select("parent_title", "title", "source", "spell_level", "page_start")
