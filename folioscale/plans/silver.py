"""Cleaned tables from extracted ones. Every function takes DataFrames and returns one."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import stable_hash
from ..functions.text import field_anywhere, field_line, quote_pattern, squeeze, strip, strip_html
from ..operators.windows import top_one
from ..session import ship

MATERIAL = r"(?i)^(?:the material|material component)"


def known_entries(raw: DataFrame) -> DataFrame:
    """One row for each (file, name, class) of the indexes, with school and sphere from any row of that name.

    Of several rows the one with the lowest page wins, then school and sphere;
    the level breaks the last tie. The two self-joins become two windows'
    worth of work: the least school and sphere of a name, since only the least
    can win behind the page.
    """
    named = raw.groupBy("source_file", "entry_name").agg(F.min("school").alias("_school"), F.min("sphere").alias("_sphere"))
    merged = raw.join(named, ["source_file", "entry_name"], "left").withColumn("school", F.coalesce("school", "_school")).withColumn("sphere", F.coalesce("sphere", "_sphere")).drop("_school", "_sphere")
    section = F.coalesce(F.col("source_section"), F.lit(""))
    kept = merged.filter(section.contains("Spell Index") | section.contains("General Index") | F.col("entry_class").isNotNull())
    order = [F.col(c).asc_nulls_last() for c in ("ref_page", "school", "sphere", "entry_level")]
    return top_one(kept, ["source_file", "entry_name", "entry_class"], order).select("source_file", "entry_name", "entry_class", "entry_level", "ref_page", "school", "sphere")


def tables(raw: DataFrame, toc: DataFrame) -> DataFrame:
    """Table rows with their place in the contents, cells without HTML."""
    t = toc.filter("is_table").select("source_file", F.col("title").alias("toc_title"), "toc_id", "parent_title", "sort_order")
    return raw.join(t, ["source_file", "toc_title"], "left").select("source_file", "table_number", "table_title", "toc_title", "toc_id", "parent_title", "sort_order", "format", "row_index", strip_html(F.col("cells")).alias("cells"))


def files(entries: DataFrame, found: DataFrame) -> DataFrame:
    return (
        entries.join(found.select("source_file", "pdf_size_bytes", "total_pages"), "source_file")
        .groupBy("source_file", "pdf_size_bytes", "total_pages")
        .agg(F.count("*").alias("total_entries"), F.count(F.when(F.col("entry_title").isNotNull(), 1)).alias("named_entries"), F.sum("char_count").cast("long").alias("total_chars"), F.current_timestamp().alias("processed_at"))
    )


def toc_sections(raw: DataFrame, entries: DataFrame, tables_raw: DataFrame | None = None, most_headings: int = 50) -> DataFrame:
    """Contents with keys, the parent's key, and the titles of what stands in each section.

    A parent is looked up by file and title; of parents with one title the
    last that begins at or before the row counts.
    """
    t = raw.withColumn("toc_id", stable_hash("source_file", "title", "parent_title", "page_start"))
    parents = t.select("source_file", F.col("title").alias("_pt"), F.col("toc_id").alias("_pid"), F.col("page_start").alias("_ps"))
    hit = t.join(parents, (t["source_file"] == parents["source_file"]) & (t["parent_title"] == parents["_pt"]) & (parents["_ps"] <= t["page_start"])).groupBy("toc_id").agg(F.max_by("_pid", F.struct("_ps", "_pid")).alias("parent_toc_id"))
    first = entries.filter("entry_title is not null").groupBy("source_file", F.col("toc_title").alias("title"), "entry_title").agg(F.min(F.struct("sort_key")).alias("k") if "sort_key" in entries.columns else F.min(F.struct("entry_id")).alias("k"))
    heads = first.groupBy("source_file", "title").agg(F.array_sort(F.collect_list(F.struct("k", "entry_title"))).alias("_h"))
    heads = heads.select("source_file", "title", F.array_join(F.slice(F.transform("_h", lambda x: x["entry_title"]), 1, most_headings), "; ").alias("sub_headings"))
    out = t.join(hit, "toc_id", "left").join(heads, ["source_file", "title"], "left")
    if tables_raw is not None:
        named = tables_raw.groupBy("source_file", F.col("toc_title").alias("title")).agg(F.array_join(F.array_sort(F.collect_set("table_title")), "; ").alias("tables"))
        out = out.join(named, ["source_file", "title"], "left")
    else:
        out = out.withColumn("tables", F.lit(None).cast("string"))
    return out.select("toc_id", "parent_toc_id", "source_file", "title", "page_start", "page_end", "sort_order", "depth", "is_chapter", "is_table", "is_excluded", "parent_title", F.coalesce("sub_headings", F.lit("")).alias("sub_headings"), F.coalesce("tables", F.lit("")).alias("tables"))


def material_text(content: Column) -> Column:
    """From the first of the last eight lines that tells of a material component through the end; '' without one."""
    lines = F.transform(F.slice(F.split(content, "\n", -1), F.greatest(F.lit(1), F.size(F.split(content, "\n", -1)) - 7), F.lit(8)), strip)
    first = F.array_position(F.transform(lines, lambda x: x.rlike(MATERIAL)), True)
    return F.when(first > 0, strip(F.array_join(F.slice(lines, first.cast("int"), F.lit(8)), "\n"))).otherwise(F.lit(""))


def spell_meta(entries: DataFrame) -> DataFrame:
    """Fields of every spell; a singular 'Component' counts where there is no plural."""
    c = F.coalesce("content", F.lit(""))
    field = lambda name: field_anywhere(c, name)
    return entries.filter("spell_level is not null").select(
        "entry_id",
        "source_file",
        F.coalesce("school", F.lit("")).alias("school"),
        F.coalesce("sphere", F.lit("")).alias("sphere"),
        F.lit("").alias("reversible"),
        field("Range").alias("range"),
        F.coalesce(F.nullif(field("Components"), F.lit("")), field("Component")).alias("components"),
        field("Duration").alias("duration"),
        field("Casting Time").alias("casting_time"),
        field("Area of Effect").alias("area_of_effect"),
        field("Saving Throw").alias("saving_throw"),
        material_text(c).alias("material_component_text"),
    )


def crosscheck(known: DataFrame, spell_list: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Index entries against the spell list by lower-cased name and class."""
    norm = lambda c: F.lower(strip(F.col(c)))
    listed = spell_list.groupBy(F.col("source_file"), norm("entry_name").alias("_n"), norm("entry_class").alias("_c")).agg(F.max(F.struct(F.col("entry_level").alias("lv"), F.col("is_reversible").alias("rev"))).alias("_l"))
    k = known.filter("entry_class is not null").withColumn("_n", norm("entry_name")).withColumn("_c", norm("entry_class"))
    if exclude:
        k = k.filter(~F.lower("entry_name").isin([x.lower() for x in exclude]))
    found = F.col("_l").isNotNull()
    return k.join(listed, ["source_file", "_n", "_c"], "left").select(
        "source_file",
        "entry_name",
        "entry_class",
        "entry_level",
        "ref_page",
        "school",
        "sphere",
        F.coalesce(F.col("_l.rev"), F.lit(False)).alias("is_reversible"),
        found.alias("in_spell_list"),
        F.col("school").isNotNull().alias("in_school_index"),
        F.col("sphere").isNotNull().alias("in_sphere_index"),
        F.coalesce(found & (F.col("_l.lv") != F.col("entry_level")), F.lit(False)).alias("level_mismatch"),
    )


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """What ``then`` makes of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _field_lines(fields: list[str]) -> str:
    """What the lower-cased lines of fields begin with."""
    return r"^\s*+(?:" + "|".join(quote_pattern(f.lower()) for f in fields) + "):"


def description(content: Column, is_spell: Column, fields: list[str]) -> Column:
    """A spell's text without its head of field lines and without its material footer; other texts as they are."""
    if not fields:
        return strip(content)

    def body(lines: Column) -> Column:
        # a head line is a field, or, behind the first, goes on from one: indented, or nearly empty
        more = lambda x, i: F.lower(x).rlike(_field_lines(fields)) | ((i > 0) & (F.startswith(x, F.lit("  ")) | (F.length(strip(x)) < 5)))
        end = F.array_position(F.transform(lines, more), F.lit(False)).cast("int")
        return strip(F.array_join(F.when(end == 0, F.array().cast("array<string>")).otherwise(F.slice(lines, F.greatest(end, F.lit(1)), F.size(lines))), "\n"))

    def bare(rows: Column) -> Column:
        # the last of the last seven lines, but not the first of all, that begins as a footer
        last = F.slice(rows, F.greatest(F.lit(2), F.size(rows) - 6), F.lit(7))
        marks = F.transform(last, lambda x: strip(x).rlike(MATERIAL))
        behind = F.array_position(F.reverse(marks), F.lit(True)).cast("int")
        return F.when(behind > 0, strip(F.array_join(F.slice(rows, F.lit(1), F.size(rows) - behind), "\n"))).otherwise(F.array_join(rows, "\n"))

    return F.when(is_spell, _once(F.split(_once(F.split(content, "\n", -1), body), "\n", -1), bare)).otherwise(strip(content))


def entry_descriptions(entries: DataFrame, fields: list[str]) -> DataFrame:
    text = description(F.col("content"), F.col("spell_level").isNotNull(), fields)
    # the empty ones go where the text is made, so that no filter makes it a second time
    return entries.filter("content is not null").select("entry_id", "source_file", F.lit("original").alias("description_type"), F.explode(F.filter(F.array(text), lambda x: x != "")).alias("content"))


def entry_flags(content: Column, fields: list[str], least: int = 20) -> tuple[Column, Column]:
    """has_metadata: any field is there; has_description: enough text behind the last field line."""
    low = F.lower(content)
    has = reduce(lambda a, f: a | low.contains(f.lower() + ":"), fields, F.lit(False))
    lines = F.split(content, "\n", -1)
    is_field = lambda x: reduce(lambda a, f: a | F.startswith(F.lower(strip(x)), F.lit(f.lower() + ":")), fields, F.lit(False))
    last = F.coalesce(F.array_max(F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: is_field(F.get(lines, i - 1)))), F.lit(0))
    rest = strip(F.array_join(F.slice(lines, last + 1, F.size(lines)), "\n"))
    return has, F.length(rest) >= least


def page_anchors(pages: DataFrame, markdown: DataFrame, sizes: tuple[int, ...] = (40, 30, 20), slack: int = 5000, marks: DataFrame | None = None) -> DataFrame:
    """Where in the markdown each page begins: the first place of a line's beginning, not far before the page before it.

    Lines that are watermarks (``marks``: source_file, watermark_text) go from the
    markdown first, and places count without them. A file is one group: the
    search pointer moves from page to page.
    """
    if marks is not None:
        held = marks.groupBy("source_file").agg(F.collect_set("watermark_text").alias("_w"))
        lines = F.filter(F.split("markdown_text", "\n", -1), lambda x: ~F.array_contains(F.coalesce("_w", F.array().cast("array<string>")), strip(x)))
        markdown = markdown.join(held, "source_file", "left").withColumn("markdown_text", F.array_join(lines, "\n")).drop("_w")
    import pandas as pd

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        text = str(pdf["markdown_text"].iloc[0] or "").lower()
        rows, last = [], 0
        for page in pdf.sort_values("page_index").itertuples():
            lines = [x.strip().lower() for x in (page.page_text or "").split("\n")][1:10]
            places = (text.find(x[:n], max(0, last - slack)) for n in sizes for x in lines if len(x) >= n)
            place = next((p for p in places if p >= 0), -1)
            if place >= 0:
                last = place
                rows.append((page.source_file, place, page.page_index, page.printed_page_num))
        out = pd.DataFrame(rows, columns=["source_file", "markdown_position", "page_index", "printed_page_num"])
        return out.sort_values(["markdown_position", "page_index"])

    ship(pages.sparkSession)
    joined = pages.select("source_file", "page_index", "page_text", "printed_page_num").join(markdown.select("source_file", "markdown_text"), "source_file")
    return joined.groupBy("source_file").applyInPandas(find, "source_file string, markdown_position long, page_index long, printed_page_num long")


def merged_spell_names(known: DataFrame) -> DataFrame:
    """First school, sphere and page of each name, whatever its case."""
    return known.groupBy("source_file", F.lower(squeeze(F.col("entry_name"))).alias("name_key")).agg(F.min("school").alias("school"), F.min("sphere").alias("sphere"), F.min("ref_page").alias("ref_page"))


def schools_of(content: Column, schools: list[str]) -> Column:
    """A school in parentheses in one of the first lines, else of a 'School:' field."""
    closed = F.array(*[F.lit(s.lower()) for s in schools])
    heads = F.slice(F.split(content, "\n", -1), 1, 5)
    inside = F.filter(F.transform(heads, lambda x: F.regexp_extract(x, r"\(([^)]*)\)", 1)), lambda x: F.arrays_overlap(F.transform(F.split(F.lower(x), "[/,]"), lambda y: F.trim(y)), closed))
    return F.coalesce(F.try_element_at(inside, F.lit(1)), field_line(content, "School"))
