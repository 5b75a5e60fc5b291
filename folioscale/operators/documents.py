"""Entries of a book: pages to chapter texts, titles to sections, sections to clean entries."""

from __future__ import annotations

import re
from itertools import dropwhile

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import stable_hash
from ..functions.text import quote_pattern, rejoin_hyphens, strip
from ..session import ship
from .intervals import blank_ranges
from .titles import sections as text_sections
from .windows import top_one

#: Shorter contents are no entries; shorter lines that begin in lower case before a block's fields, or between blocks, are cut pieces.
MIN_ENTRY, FRAGMENT, BETWEEN = 10, 60, 80


def clean_pages(pages: DataFrame, marks: DataFrame | None = None, masks: DataFrame | None = None, edge: int = 3) -> DataFrame:
    """Page texts without tables, watermark lines and page numbers at the edges, and with cut words rejoined."""
    out = pages
    if masks is not None:
        m = masks.groupBy("source_file", "page_index").agg(F.array_sort(F.collect_list(F.struct("char_start", "char_end"))).alias("_m"))
        out = out.join(m, ["source_file", "page_index"], "left").withColumn("page_text", F.when(F.col("_m").isNull(), F.col("page_text")).otherwise(blank_ranges(F.col("page_text"), F.col("_m")))).drop("_m")
    if marks is not None:
        held = marks.groupBy("source_file").agg(F.collect_set("watermark_text").alias("_w"))
        out = out.join(held, "source_file", "left")
    else:
        out = out.withColumn("_w", F.lit(None).cast("array<string>"))
    lines = F.split(F.coalesce("page_text", F.lit("")), "\n", -1)
    n = F.size(lines)
    keep = lambda x, i: ~F.array_contains(F.coalesce("_w", F.array().cast("array<string>")), strip(x)) & ~(strip(x).rlike(r"^[0-9]{1,4}$") & ((i < edge) | (i >= n - edge)))
    return out.withColumn("page_text", rejoin_hyphens(F.array_join(F.filter(lines, keep), "\n"))).drop("_w")


def chapter_texts(pages: DataFrame, toc: DataFrame) -> DataFrame:
    """The text of each chapter with where its pages begin: page_offsets array<struct<page, at>>."""
    from .joins import range_join

    chapters = toc.filter("is_chapter and not is_excluded").select("source_file", F.col("title").alias("chapter_title"), "page_start", "page_end", "sort_order")
    held = range_join(pages.select("source_file", "page_index", "printed_page_num", "page_text"), chapters, ["source_file"], "printed_page_num", "page_start", "page_end")
    # dealt by chapter once: its pages, its text and its titles meet without another shuffle of texts
    held = held.repartition("source_file", "chapter_title")
    # where a page begins is a running sum of what stands before it; empty pages before the first text add nothing
    key = ["source_file", "chapter_title", "page_start", "page_end", "sort_order"]
    line = Window.partitionBy(*key).orderBy("page_index", "printed_page_num", "page_text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = held.withColumn("_begun", F.max(F.col("page_text") != "").over(line))
    placed = begun.withColumn("_long", F.when(F.col("_begun"), F.length("page_text") + 2).otherwise(0)).withColumn("_at", (F.sum("_long").over(line) - F.col("_long")).cast("int"))
    page = F.struct("page_index", "printed_page_num", "page_text", "_begun", "_at")
    packed = placed.groupBy(*key).agg(F.array_sort(F.collect_list(page)).alias("_p"))
    text = F.array_join(F.transform(F.filter("_p", lambda p: p["_begun"]), lambda p: p["page_text"]), "\n\n")
    offsets = F.transform("_p", lambda p: F.struct(p["printed_page_num"].cast("int").alias("page"), p["_at"].alias("at")))
    return packed.select(*key, text.alias("text"), offsets.alias("page_offsets"))


SECTIONS = "source_file string, toc_title string, section_title string, entry_title string, content string, page_start int, seq int"


def with_ids(toc: DataFrame) -> DataFrame:
    """Contents with the key of each row as toc_id, and the least key of its file's rows of that title and page as own_id."""
    keyed = toc.withColumn("toc_id", stable_hash("source_file", "title", "parent_title", "page_start"))
    return keyed.withColumn("own_id", F.min("toc_id").over(Window.partitionBy("source_file", "title", F.col("page_start").cast("int"))))


def split_chapters(chapters: DataFrame, toc: DataFrame, listed: DataFrame | None = None, bound: bool = True) -> DataFrame:
    """Sections of every chapter, each with the own_id of its title (null before the first). ``listed`` (source_file, chapter_title, title, page_start, sort_order) adds titles that the contents lack."""
    kind = "array<struct<sort_order:int,title:string,page:int,is_table:boolean,own_id:bigint>>"
    subs = with_ids(toc).filter("not is_excluded and parent_title is not null").select("source_file", F.col("parent_title").alias("chapter_title"), "title", "page_start", "is_table", "sort_order", "own_id")
    if listed is not None:
        subs = subs.unionByName(listed.select("source_file", "chapter_title", "title", "page_start", F.lit(False).alias("is_table"), "sort_order", F.lit(None).cast("long").alias("own_id")))
    packed = subs.groupBy("source_file", "chapter_title").agg(F.array_sort(F.collect_list(F.struct(F.col("sort_order").cast("int"), "title", F.col("page_start").cast("int").alias("page"), "is_table", "own_id"))).cast(kind).alias("subs"))
    rows = chapters.join(packed, ["source_file", "chapter_title"], "left")
    ship(rows.sparkSession)

    def split(batches):
        for pdf in batches:
            out, ids = [], []
            for r in pdf.itertuples():
                subs_ = list(r.subs) if r.subs is not None else []
                plain = [(s["title"], s["page"]) for s in subs_ if not s["is_table"]]
                own = [s["own_id"] for s in subs_ if not s["is_table"]]
                offsets = {}
                for o in r.page_offsets:
                    offsets.setdefault(o["page"], o["at"])
                intro, parts = text_sections(r.text, plain, offsets, [s["title"] for s in subs_ if s["is_table"]], bound, MIN_ENTRY)
                if len(intro) >= MIN_ENTRY:
                    out.append((r.source_file, r.chapter_title, None, None, intro, int(r.page_start), -1))
                    ids.append(None)
                ids += [own[n] for n, _ in parts]
                out += [(r.source_file, r.chapter_title, plain[n][0], plain[n][0], c, int(plain[n][1]), n) for n, c in parts]
            # keys have more digits than a float
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SECTIONS.split(", ")]).assign(own_id=pd.array(ids, dtype="Int64"))

    return rows.mapInPandas(split, f"{SECTIONS}, own_id long")


def clean_content(c: Column, fields: list[str] | None = None, substitutions: list[tuple[str, str]] | None = None, tags: list[str] | None = None) -> Column:
    """Without images and named tags, with fields on lines of their own, literal substitutions, and no runs of blank lines."""
    out = F.regexp_replace(c, r"(?m)^!\[[^\]]*\]\([^)]*\)[ \t]*\n?", "")
    if fields:
        names = "|".join(map(quote_pattern, fields))
        out = F.regexp_replace(out, rf"(?<=[^\n])[ \t]+(?=(?:{names}):)", "\n")
        out = F.regexp_replace(out, rf"(?m)^((?:{names}):[^\n]*?\S)[ ]{{2,}}(?=\p{{Lu}})", "$1\n")
    for a, b in substitutions or []:
        out = F.replace(out, F.lit(a), F.lit(b))
    for t in tags or []:
        out = F.regexp_replace(out, rf"(?i)</?{t}[^>]*>", "")
    return strip(F.regexp_replace(out, r"\n[ \t]*\n(?:[ \t]*\n)+", "\n\n"))


def dedupe_blocks(text: str | None, fields: list[str], signature: int = 80, least: int = 15) -> str | None:
    """Of blocks that repeat the first field, the fullest fields and every description that begins otherwise.

    Cut pieces of lines before the first block, and at the beginning of a
    description, are left out.
    """
    if not text or not fields:
        return text
    line_of = lambda names: re.compile(r"^[^\S\n]*(" + "|".join(map(re.escape, names)) + r"):.*$", re.IGNORECASE | re.MULTILINE)
    field = line_of(fields)
    heads = list(field.finditer(text))
    starts = [m.start() for m in heads if m[1].lower() == heads[0][1].lower()]
    if len(starts) < 2:
        return text
    cut = lambda line, most: line.strip()[:1].islower() and len(line.strip()) < most
    above = "\n".join(x for x in text[: starts[0]].split("\n") if not cut(x, FRAGMENT)).rstrip()
    metas, described = [], {}
    for block in (text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)):
        end = max(m.end() for m in field.finditer(block))
        metas.append(block[:end])
        body = dropwhile(lambda x: not x.strip() or cut(x, BETWEEN), block[end:].split("\n"))
        shown = "\n".join(body).strip()
        if len(shown) > least:
            described.setdefault(shown[:signature], shown)
    top = "\n".join(x for x in (above, max(metas, key=len)) if x)
    return "\n\n".join([top, *described.values()]).strip()


def _deduped(c: pd.Series, fields: pd.Series) -> pd.Series:
    return pd.Series([dedupe_blocks(t, list(f)) for t, f in zip(c, fields, strict=True)], dtype=object)


def deduped_blocks(c: Column, fields: list[str]) -> Column:
    ship()
    return F.pandas_udf(_deduped, "string")(c, F.array(*[F.lit(f) for f in fields]).cast("array<string>"))


def merge_orphans(entries: DataFrame, has_metadata: Column, has_description: Column, order: list[str], signature: int = 80) -> DataFrame:
    """Equal titles of a section become one entry; an entry with fields but no text takes the untitled or lower-case entries behind it.

    The first pass appends what an entry does not hold yet; the second is a run
    of rows from one that is open to the next that stands for itself.
    """
    from .windows import islands

    key = ["source_file", "toc_title"]
    # both passes and both windows count on a section's rows being together: contents are shuffled once
    named = entries.repartition(*key).withColumn("_m", has_metadata).withColumn("_d", has_description).withColumn("_name", F.coalesce(F.lower("entry_title"), F.concat(F.lit("\0"), *[F.col(c).cast("string") for c in order])))
    packed = F.array_sort(F.collect_list(F.struct(*order, "content", "_m", "_d")))
    held = lambda s, c: F.contains(s, F.left(strip(c), F.lit(signature)))
    joined = F.aggregate(F.transform(packed, lambda x: x["content"]), F.lit(""), lambda s, c: F.when(s == "", c).when(held(s, c), s).otherwise(F.concat(s, F.lit("\n\n"), c)))
    others = [c for c in entries.columns if c not in {*key, "content", *order}]
    one = named.groupBy(*key, "_name").agg(*[F.min_by(c, F.struct(*order)).alias(c) for c in others], *[F.min(c).alias(c) for c in order], joined.alias("content"), F.max("_m").alias("_m"), F.max("_d").alias("_d"))
    w = Window.partitionBy(*key).orderBy(*order)
    orphan = ~F.col("_m") & (F.col("entry_title").isNull() | F.regexp_extract(strip(F.col("content")), r"^(\p{Ll})", 1).isin(*"abcdefghijklmnopqrstuvwxyz"))
    marked = one.withColumn("_o", orphan)
    last = F.last(F.when(~F.col("_o"), F.col("_m") & ~F.col("_d")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = islands(marked.withColumn("_open", F.coalesce(last, F.lit(False))), key, [F.col(c) for c in order], ~(F.col("_o") & F.col("_open")))
    parts = F.array_sort(F.collect_list(F.struct(*order, "content")))
    return runs.groupBy(*key, "island").agg(*[F.min_by(c, F.struct(*order)).alias(c) for c in others], *[F.min(c).alias(c) for c in order], F.array_join(F.transform(parts, lambda x: x["content"]), "\n\n").alias("content")).select(*entries.columns)


def build_entries(pages: DataFrame, toc: DataFrame, fields: list[str], known: DataFrame | None = None, spell_list: DataFrame | None = None, marks: DataFrame | None = None, masks: DataFrame | None = None, tables: DataFrame | None = None, substitutions: list[tuple[str, str]] | None = None) -> DataFrame:
    """silver_entries of every file: clean pages, chapters, sections, clean contents, keys and flags."""
    from ..plans.silver import entry_flags, merged_spell_names

    # a section's key comes with its title, so that no content is shuffled to meet it
    sections = split_chapters(chapter_texts(clean_pages(pages, marks, masks), toc), toc)
    cleaned = sections.withColumn("content", clean_content(F.col("content"), fields, substitutions))
    cleaned = cleaned.withColumn("content", deduped_blocks(F.col("content"), fields))
    flags = entry_flags(F.col("content"), fields)
    merged = merge_orphans(cleaned, *flags, order=["seq"])
    if tables is not None:
        t = tables.groupBy("source_file", "toc_title").agg(F.array_sort(F.collect_list(F.struct("row_index", "cells"))).alias("_r"))
        parents = with_ids(toc).filter("is_table").select("source_file", F.col("title").alias("_t"), "parent_title", F.col("page_start").alias("_p"), "own_id")
        from ..functions.cells import decode_cells, table_row

        width = F.size(decode_cells(F.get("_r", F.lit(0))["cells"]))
        rule = F.concat(F.lit("|"), F.repeat(F.lit(" --- |"), width))
        body = F.array_join(F.concat(F.array(table_row(F.get("_r", F.lit(0))["cells"]), rule), F.transform(F.slice("_r", F.lit(2), F.size("_r")), lambda x: table_row(x["cells"]))), "\n")
        rows = t.join(parents, (t["source_file"] == parents["source_file"]) & (t["toc_title"] == parents["_t"])).select(t["source_file"], F.coalesce("parent_title", "_t").alias("toc_title"), F.col("_t").alias("section_title"), F.col("_t").alias("entry_title"), body.alias("content"), F.col("_p").cast("int").alias("page_start"), (F.lit(100000) + F.col("_p")).cast("int").alias("seq"), "own_id")
        merged = merged.unionByName(rows)
    merged = merged.withColumn("_k", F.lower(strip(F.coalesce("entry_title", F.lit("")))))
    if spell_list is not None:
        s = top_one(spell_list.withColumn("_k", F.lower(strip(F.col("entry_name")))), ["source_file", "_k"], [F.col("entry_class"), F.col("entry_level")]).select("source_file", "_k", F.col("entry_class").alias("spell_class"), F.col("entry_level").cast("int").alias("spell_level"))
        merged = merged.join(s, ["source_file", "_k"], "left")
    else:
        merged = merged.withColumn("spell_class", F.lit(None).cast("string")).withColumn("spell_level", F.lit(None).cast("int"))
    if known is not None:
        merged = merged.join(merged_spell_names(known).select("source_file", F.col("name_key").alias("_k"), "school", "sphere"), ["source_file", "_k"], "left")
    else:
        merged = merged.withColumn("school", F.lit(None).cast("string")).withColumn("sphere", F.lit(None).cast("string"))
    # the section's own row of the contents, or the chapter's
    chapter = top_one(with_ids(toc).filter("parent_title is null"), ["source_file", "title"], [F.col("page_start")]).select("source_file", F.col("title").alias("toc_title"), F.col("toc_id").alias("_chapter"))
    out = merged.join(chapter, ["source_file", "toc_title"], "left")
    meta, description = entry_flags(F.col("content"), fields)
    return out.select(
        stable_hash(F.col("source_file"), F.col("toc_title"), F.col("entry_title"), F.col("section_title"), F.substring("content", 1, 80)).alias("entry_id"),
        F.coalesce("own_id", "_chapter").alias("toc_id"),
        "source_file",
        "toc_title",
        "section_title",
        "entry_title",
        "content",
        "school",
        "sphere",
        "spell_class",
        "spell_level",
        F.col("page_start").cast("string").alias("page_numbers"),
        F.length("content").cast("long").alias("char_count"),
        meta.alias("has_metadata"),
        description.alias("has_description"),
    )
