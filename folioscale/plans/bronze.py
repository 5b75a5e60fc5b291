"""Facts from page texts: watermarks, contents, indexes, lists, tables."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import decode_cells, name_cell_ok, split_breaks
from ..functions.fuzzy import indel_ratio_value
from ..functions.text import squeeze, strip, toc_line
from ..operators import windows as w
from ..operators.joins import range_join, rank_join
from ..session import ship


def watermarks(pages: DataFrame, share: float = 0.3, least: int = 3, key: str = "source_file", text: str = "page_text", longer_than: int = 2) -> DataFrame:
    """Lines on so large a share of a file's pages: watermark_text, occurrence_count."""
    lines = F.array_distinct(F.filter(F.transform(F.split(F.col(text), "\n", -1), strip), lambda x: F.length(x) > longer_than))
    held = pages.select(key, F.explode(lines).alias("watermark_text")).groupBy(key, "watermark_text").agg(F.count("*").alias("occurrence_count"))
    total = pages.groupBy(key).agg(F.count("*").alias("_n"))
    return held.join(total, key).filter(F.col("occurrence_count") >= F.greatest((F.col("_n") * F.lit(float(share))).cast("int"), F.lit(least))).drop("_n")


def page_lines(pages: DataFrame, key: str = "source_file") -> DataFrame:
    """A row for each line of each page, with its number."""
    return pages.select(key, "page_index", "printed_page_num", F.posexplode(F.split("page_text", "\n", -1)).alias("line_index", "line"))


def toc_pages(pages: DataFrame, share: float = 0.3) -> DataFrame:
    """Pages most of whose lines read like lines of a table of contents."""
    lines = page_lines(pages).filter(strip(F.col("line")) != "")
    stats = lines.groupBy("source_file", "page_index").agg(F.avg(F.when(toc_line(F.col("line")).isNotNull(), 1.0).otherwise(0.0)).alias("share"))
    return stats.filter(F.col("share") > share).select("source_file", "page_index")


def toc_rows(pages: DataFrame, positions: DataFrame | None = None, chapters: list[str] | None = None, excluded: list[str] | None = None, table_pattern: str = r"(?i)^table\s+[0-9]+", look_ahead: int = 2) -> DataFrame:
    """The table of contents: title, pages, depth and flags of every line.

    A line without a page number goes before the next one that has it, over
    ``look_ahead`` lines at most. ``positions`` (source_file, page_index,
    line_index, depth) gives depths; without it, or without a row there, a
    chapter is 0 and another row 1.
    """
    lines = page_lines(pages.join(toc_pages(pages), ["source_file", "page_index"], "left_semi")).filter(~strip(F.col("line")).rlike(r"(?i)^(?:(?:table of )?contents)?$"))
    order = Window.partitionBy("source_file").orderBy("page_index", "line_index")
    text = strip(F.col("line"))
    has = toc_line(text).isNotNull()
    carried = lines.withColumn("_has", has).withColumn("_t", text)
    for i in range(look_ahead, 0, -1):
        no = F.lit(True)
        for j in range(1, i + 1):
            no = no & ~F.lag("_has", j, True).over(order)
        carried = carried.withColumn(f"_p{i}", F.when(no & F.col("_has"), F.lag("_t", i).over(order)))
    joined = F.concat_ws(" ", *[F.col(f"_p{i}") for i in range(look_ahead, 0, -1)], F.col("_t"))
    parsed = carried.filter("_has").withColumn("_x", F.coalesce(toc_line(joined), toc_line(F.col("_t"))))
    rows = parsed.select("source_file", "page_index", "line_index", squeeze(F.col("_x.title")).alias("title"), F.col("_x.page").alias("page_start"))
    rows = w.top_one(rows, ["source_file", "title", "page_start"], [F.col("page_index"), F.col("line_index")])
    low = F.lower("title")
    is_chapter = low.rlike(r"^(chapter|appendix)\b") | low.isin([c.lower() for c in chapters or []])
    rows = rows.withColumn("is_chapter", is_chapter).withColumn("is_table", F.col("title").rlike(table_pattern)).withColumn("is_excluded", low.isin([x.lower() for x in excluded or []]))
    if positions is not None:
        rows = rows.join(positions.select("source_file", "page_index", "line_index", F.col("depth").alias("_d")), ["source_file", "page_index", "line_index"], "left")
    else:
        rows = rows.withColumn("_d", F.lit(None).cast("int"))
    rows = rows.withColumn("depth", F.when(F.col("is_chapter"), 0).otherwise(F.coalesce("_d", F.lit(1))))
    sorted_ = Window.partitionBy("source_file").orderBy("page_start", "is_table", "page_index", "line_index")
    rows = rows.withColumn("sort_order", F.row_number().over(sorted_) - 1)
    keys, by = ["source_file"], [F.col("sort_order")]
    rows = w.table_depth(rows, keys, by)
    rows = w.fill_down(rows, keys, by, F.when(F.col("is_chapter"), F.col("title")), "parent_title")
    rows = rows.withColumn("parent_title", F.when(~F.col("is_chapter"), F.col("parent_title")))
    ends = w.chapter_ends(rows.filter("is_chapter"), keys, "page_start", by).select("source_file", "sort_order", F.col("page_end").alias("_e"))
    rows = w.fill_down(rows.join(ends, ["source_file", "sort_order"], "left"), keys, by, F.col("_e"), "_e")
    rows = w.section_ends(rows, keys, "page_start", F.col("is_table"), F.coalesce("_e", F.lit(w.LAST_PAGE)), by)
    end = F.when(F.col("is_chapter"), F.col("_e")).otherwise(F.least("page_end", F.coalesce("_e", F.lit(w.LAST_PAGE))))
    return rows.select("source_file", "title", "page_start", F.greatest(F.coalesce(end, F.lit(w.LAST_PAGE)), "page_start").cast("int").alias("page_end"), "sort_order", "depth", "is_chapter", "is_table", "is_excluded", "parent_title")


def correct_toc(toc: DataFrame, corrections: DataFrame) -> DataFrame:
    """Rows renamed, moved, excluded or removed by (source_file, title, action, value)."""
    c = corrections.groupBy("source_file", "title").pivot("action", ["rename", "page", "exclude", "remove"]).agg(F.first("value"))
    j = toc.join(c, ["source_file", "title"], "left").filter("remove is null")
    out = j.withColumn("page_start", F.coalesce(F.col("page").cast("int"), "page_start")).withColumn("is_excluded", F.col("is_excluded") | F.col("exclude").isNotNull())
    return out.withColumn("title", F.coalesce("rename", "title")).select(*toc.columns)


INDEX_LINE = r"^(.+?)\s*\((Wiz|Pr|wizard|priest)\.?\s*([0-9])\)[\s.…]*([0-9]+)?$"


def known_entries(pages: DataFrame, toc: DataFrame, heading_kinds: dict[str, list[str]], pattern: str = INDEX_LINE) -> DataFrame:
    """Entries of the indexes in excluded sections: name, class, level, page, and the school or sphere whose heading stands above.

    ``heading_kinds`` maps 'school' and 'sphere' to the headings that begin a group.
    """
    sections = toc.filter("is_excluded").select("source_file", F.col("title").alias("source_section"), "page_start", "page_end")
    lines = range_join(page_lines(pages), sections, ["source_file"], "printed_page_num", "page_start", "page_end").withColumn("_l", squeeze(F.col("line")))
    by = Window.partitionBy("source_file", "source_section").orderBy("page_index", "line_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = {k: F.lower("_l").isin([h.lower() for h in v]) for k, v in heading_kinds.items()}
    any_head = F.lit(False)
    for h in heads.values():
        any_head = any_head | h
    # a heading of one kind ends a group of the other
    last = F.last(F.when(any_head, F.struct(*[F.when(c, F.col("_l")).alias(k) for k, c in heads.items()])), ignorenulls=True).over(by)
    grouped = lines.withColumn("_g", last)
    found = grouped.filter(F.col("_l").rlike(pattern))
    x = lambda i: F.regexp_extract("_l", pattern, i)
    cls = F.when(F.lower(x(2)).startswith("wiz"), "wizard").otherwise("priest")
    value = lambda k: F.col(f"_g.{k}") if k in heads else F.lit(None).cast("string")
    rows = found.select("source_file", strip(x(1)).alias("entry_name"), cls.alias("entry_class"), x(3).cast("int").alias("entry_level"), x(4).try_cast("int").alias("ref_page"), "source_section", value("school").alias("school"), value("sphere").alias("sphere"))
    return rows.distinct()


def authority_entries(tables: DataFrame, wanted: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Names from the cells of ``wanted`` tables (source_file, toc_title, entry_type, name_column or null)."""
    rows = tables.join(wanted, ["source_file", "toc_title"]).withColumn("_c", decode_cells(F.col("cells")))
    cells = rows.select("source_file", "toc_title", "entry_type", "row_index", F.col("name_column"), F.posexplode("_c").alias("col", "cell")).filter("row_index > 0 and (name_column is null or col = name_column)")
    names = cells.select("source_file", "toc_title", "entry_type", "row_index", "col", F.posexplode(split_breaks(F.col("cell"))).alias("part", "name")).withColumn("entry_name", squeeze(F.regexp_replace("name", r"[*†]", "")))
    good = names.filter(name_cell_ok(F.col("entry_name"))).select("source_file", "entry_name", "entry_type", F.col("toc_title").alias("source_table"), "row_index", "col", "part")
    if extra is not None:
        good = good.unionByName(extra.select("source_file", "entry_name", "entry_type", F.lit("config").alias("source_table"), F.lit(1 << 20).alias("row_index"), F.lit(0).alias("col"), F.lit(0).alias("part")))
    return w.top_one(good.withColumn("_k", F.lower("entry_name")), ["source_file", "_k", "entry_type"], [F.col(c) for c in ("source_table", "row_index", "col", "part")]).select("source_file", "entry_name", "entry_type", "source_table")


def tables_from_regions(regions: DataFrame, rows: DataFrame, toc: DataFrame) -> DataFrame:
    """The i-th table that the contents put on a page is the i-th region found there; the rest has no partner and goes."""
    t = toc.filter("is_table").select("source_file", F.col("page_start").alias("printed_page_num"), F.col("title").alias("toc_title"), "sort_order")
    r = regions.select("source_file", "printed_page_num", "page_index", "region_index", "bbox_y0")
    pairs = rank_join(t, r, ["source_file", "printed_page_num"], [F.col("sort_order")], [F.col("page_index"), F.col("region_index")])
    number = F.regexp_extract("toc_title", r"(?i)table\s+([0-9]+)", 1).try_cast("long")
    return pairs.join(rows, ["source_file", "page_index", "region_index"]).select("source_file", number.alias("table_number"), F.col("toc_title").alias("table_title"), "toc_title", F.lit("region").alias("format"), F.col("row_index").cast("long").alias("row_index"), F.to_json("cells").alias("cells"))


def pipe_tables(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """Rows of Markdown tables: block_index counts runs of | lines; a blank line between two does not end a run."""
    lines = df.select(*keys, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_index", "line")).withColumn("_s", strip(F.col("line")))
    pipe = F.startswith(F.col("_s"), F.lit("|"))
    order = Window.partitionBy(*keys).orderBy("line_index")
    bridge = (F.col("_s") == "") & F.lag(pipe, 1, False).over(order) & F.lead(pipe, 1, False).over(order)
    marked = lines.withColumn("_in", pipe | bridge).withColumn("_p", pipe)
    runs = w.islands(marked, keys, [F.col("line_index")], F.col("_in") & ~F.lag("_in", 1, False).over(order), "block_index")
    rows = runs.filter("_p").filter(~F.col("_s").rlike(r"^\|[\s:|-]+\|?$"))
    cells = F.transform(F.split(F.regexp_replace("_s", r"^\||\|$", ""), r"\|", -1), lambda x: F.trim(x))
    return rows.withColumn("row_index", F.row_number().over(Window.partitionBy(*keys, "block_index").orderBy("line_index")) - 1).select(*keys, "block_index", "row_index", cells.alias("cells"))


def join_cut_names(spells: DataFrame, known: DataFrame, least: float = 90.0) -> DataFrame:
    """Names that a line break cut in two: neighbours of one class and level that together are close to a known name without a match.

    Goes through each (file, class, level) in order; both halves are used up.
    """
    lost = known.groupBy("source_file", F.lower("entry_class").alias("_c")).agg(F.collect_set("entry_name").alias("_known"))
    rows = spells.withColumn("_c", F.lower("entry_class")).join(lost, ["source_file", "_c"], "left").drop("_c")
    schema = spells.schema

    def close(a: str, b: str) -> bool:
        return min(len(a), len(b)) >= 0.7 * max(len(a), len(b)) and (indel_ratio_value(a, b) or 0) >= least

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq").reset_index(drop=True)
        known_names = [str(x).lower() for x in (pdf["_known"].iloc[0] if pdf["_known"].iloc[0] is not None else [])]
        singles = [str(x).lower() for x in pdf["entry_name"]]
        open_ = [k for k in known_names if not any(close(k, s) for s in singles)]
        out, i = [], 0
        while i < len(pdf):
            row = pdf.iloc[i].copy()
            if i + 1 < len(pdf) and any(close(k, f"{singles[i]} {singles[i + 1]}") for k in open_):
                row["entry_name"] = f"{row['entry_name']} {pdf['entry_name'].iloc[i + 1]}"
                i += 1
            out.append(row)
            i += 1
        return pd.DataFrame(out)[[f.name for f in schema.fields]]

    ship(spells.sparkSession)
    return rows.groupBy("source_file", "entry_class", "entry_level").applyInPandas(fold, schema)


def spell_columns(spans: DataFrame, level_words: dict[str, int], class_words: list[str], x_tolerance: float = 25.0) -> DataFrame:
    """A spell list set in columns: bold headings name classes and levels, what stands below and at the same x belongs to them.

    Italic names (font with 'Italic' or 'Oblique') can be reversed. A name that goes on
    in the next line begins there with a small indent.
    """
    levels, classes = {k.lower(): v for k, v in level_words.items()}, [c.lower() for c in class_words]

    def page(pdf: pd.DataFrame) -> pd.DataFrame:
        shown = pdf[pdf["text"].fillna("").str.strip() != ""].sort_values(["y0", "x0"])
        heads, current = [], []
        for s in shown[shown["bold"]].itertuples():
            text = s.text.strip().lower()
            if c := next((c for c in classes if c in text), None):
                current.append((s.y0, c))
            if v := next((v for k, v in levels.items() if re.search(rf"\b{re.escape(k)}\b", text)), None):
                heads.append((s.x0, s.y0, v))
        rows = []
        for s in shown[~shown["bold"]].itertuples():
            above = [h for h in heads if h[1] < s.y0 and abs(h[0] - s.x0) <= x_tolerance]
            named = [c for c in current if c[0] <= (max(above, key=lambda h: h[1])[1] if above else -1) + 1]
            if above and named:
                head = max(above, key=lambda h: h[1])
                rows.append((s.source_file, s.text.strip(), max(named, key=lambda c: c[0])[1], int(head[2]), "italic" in s.font.lower() or "oblique" in s.font.lower(), int(s.page_index) * 100000 + int(s.idx), float(s.x0), float(head[0])))
        out = pd.DataFrame(rows, columns=["source_file", "entry_name", "entry_class", "entry_level", "is_reversible", "seq", "x0", "head_x"])
        return out

    ship(spans.sparkSession)
    raw = spans.groupBy("source_file", "page_index").applyInPandas(page, "source_file string, entry_name string, entry_class string, entry_level int, is_reversible boolean, seq long, x0 double, head_x double")
    return _join_indented(raw)


def _join_indented(raw: DataFrame, indent: float = 5.0) -> DataFrame:
    keys = ["source_file", "entry_class", "entry_level"]
    runs = w.islands(raw, keys, [F.col("seq")], (F.col("x0") - F.col("head_x") <= indent) | (F.lag("seq").over(Window.partitionBy(*keys).orderBy("seq")).isNull()))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "entry_name"))), lambda x: x["entry_name"]), " ")
    return runs.groupBy(*keys, "island").agg(names.alias("entry_name"), F.max("is_reversible").alias("is_reversible"), F.min("seq").alias("seq")).drop("island")


def should_drop_line(line: Column, patterns: list[str], marks: Column) -> Column:
    """Whether a line is a watermark or matches a pattern from its beginning."""
    from ..functions.text import matches_any

    return F.array_contains(F.coalesce(marks, F.array().cast("array<string>")), strip(line)) | matches_any(strip(line), patterns)
