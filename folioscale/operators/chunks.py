"""Texts into chunks, sections and lines, as folds over arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

MAX_CHARS, OVERLAP, GENERIC_MAX = 800, 200, 2000
_STATE = "struct<cur:string,out:array<string>>"


def blocks(text: Column, separator: str = "\n\n") -> Column:
    """Paragraphs; neighbouring blocks of a table stay together."""
    parts = F.filter(F.split(text, separator, -1), lambda x: strip(x) != "")
    table = lambda x: F.startswith(strip(x), F.lit("|"))

    def step(out: Column, p: Column) -> Column:
        last = F.element_at(out, -1)
        joins = (F.size(out) > 0) & table(p) & table(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit("")))
        return F.when(joins, F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.concat(last, F.lit(separator), p)))).otherwise(F.array_append(out, p))

    return F.aggregate(parts, F.array().cast("array<string>"), step)


def pack(parts: Column, most: int, overlap: int = 0, separator: str = "\n\n") -> Column:
    """Paragraphs packed into chunks of ``most`` characters; a longer paragraph is a chunk.

    A new chunk begins with the last ``overlap`` characters of the one before,
    unless that one ends with a table row.
    """
    sep = len(separator)

    def step(s: Column, p: Column) -> Column:
        full = (F.length(s["cur"]) + F.length(p) + sep > most) & (s["cur"] != "")
        carried = F.when((F.lit(overlap) > 0) & ~F.endswith(F.rtrim(s["cur"]), F.lit("|")), F.concat(F.right(s["cur"], F.lit(overlap)), F.lit(separator), p)).otherwise(p)
        joined = F.when(s["cur"] == "", p).otherwise(F.concat(s["cur"], F.lit(separator), p))
        return F.struct(F.when(full, carried).otherwise(joined).alias("cur"), F.when(full, F.array_append(s["out"], s["cur"])).otherwise(s["out"]).alias("out"))

    start = F.struct(F.lit("").alias("cur"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(parts, start, step, lambda s: F.when(s["cur"] == "", s["out"]).otherwise(F.array_append(s["out"], s["cur"])))


def chunk_text(text: Column, most: int = MAX_CHARS, overlap: int = OVERLAP, separator: str = "\n\n") -> Column:
    """The chunks of a text; one that fits is its only chunk."""
    return F.when(F.length(text) <= most, F.array(text)).otherwise(pack(blocks(text, separator), most, overlap, separator))


def chunk_rows(df: DataFrame, text: str, most: int = MAX_CHARS, overlap: int = OVERLAP, separator: str = "\n\n") -> DataFrame:
    """A row for each chunk: chunk_index, chunk, char_count."""
    return df.select("*", F.posexplode(chunk_text(F.col(text), most, overlap, separator)).alias("chunk_index", "chunk")).withColumn("char_count", F.length("chunk"))


def heading_sections(df: DataFrame, markdown: str, most: int = GENERIC_MAX) -> DataFrame:
    """Sections before each heading of level 1 to 4: section_index, section_title, part_index, content."""
    sections = F.filter(F.transform(F.split(F.col(markdown), r"(?m)(?=^#{1,4}\s)", -1), strip), lambda x: x != "")
    rows = df.select("*", F.posexplode(sections).alias("section_index", "_section"))
    rows = rows.withColumn("section_title", F.when(F.col("_section").rlike(r"^#{1,4}\s"), strip(F.regexp_extract("_section", r"^#{1,4}\s+([^\n]*)", 1))).otherwise(F.lit("")))
    parts = F.when(F.length("_section") <= most, F.array("_section")).otherwise(pack(F.split("_section", "\n\n", -1), most))
    return rows.select(*[c for c in rows.columns if c != "_section"], F.posexplode(parts).alias("part_index", "content"))


def headings(df: DataFrame, markdown: str, levels: int = 2) -> DataFrame:
    """Headings with their line and character positions: line_index, position, level, heading."""
    pattern = rf"^(#{{1,{levels}}})\s+(.+)$"
    lines = F.split(F.col(markdown), "\n", -1)

    def step(s: Column, line: Column) -> Column:
        here = F.struct(s["line_index"].alias("line_index"), s["position"].alias("position"), line.alias("_line"))
        return F.struct((s["line_index"] + 1).alias("line_index"), (s["position"] + F.length(line) + 1).alias("position"), F.when(line.rlike(pattern), F.array_append(s["found"], here)).otherwise(s["found"]).alias("found"))

    # one pass over the lines of a text, which carries where the next begins
    start = F.struct(F.lit(0).alias("line_index"), F.lit(0).alias("position"), F.array().cast("array<struct<line_index:int,position:int,_line:string>>").alias("found"))
    found = df.select("*", F.inline(F.aggregate(lines, start, step)["found"]))
    return found.withColumn("level", F.length(F.regexp_extract("_line", pattern, 1))).withColumn("heading", strip(F.regexp_extract("_line", pattern, 2))).drop("_line")


def ordered_concat(df: DataFrame, keys: list[str], order: list[str], text: str, separator: str = "\n\n") -> DataFrame:
    """The texts of a key in order, joined."""
    packed = F.array_sort(F.collect_list(F.struct(*order, text)))
    return df.groupBy(*keys).agg(F.array_join(F.transform(packed, lambda x: x[text]), separator).alias(text))


def overlap_concat(texts: Column, longest: int = 200) -> Column:
    """Chunks joined without what a chunk repeats of the one before: the longest prefix, to ``longest``, that ends what is there."""

    def step(s: Column, p: Column) -> Column:
        sizes = F.sequence(F.lit(0), F.least(F.length(s), F.length(p), F.lit(longest)))
        best = F.array_max(F.filter(sizes, lambda n: F.right(s, n) == F.left(p, n)))
        return F.when(s == "", p).when(best > 0, F.concat(s, F.substring(p, best + 1, F.length(p)))).otherwise(F.concat(s, F.lit("\n\n"), p))

    return F.aggregate(texts, F.lit(""), step)


def drop_contained(texts: Column, signature: int = 100) -> Column:
    """Longest first, only texts whose beginning no kept text holds."""
    ordered = F.transform(F.array_sort(F.transform(texts, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))), lambda x: x["t"])
    return F.aggregate(ordered, F.array().cast("array<string>"), lambda kept, t: F.when(F.exists(kept, lambda k: F.contains(k, F.left(t, F.lit(signature)))), kept).otherwise(F.array_append(kept, t)))


def drop_repeated_lines(text: Column, signature: int = 80, least: int = 50) -> Column:
    """A long line that begins as an earlier long one did goes; runs of blank lines become one."""

    def step(s: Column, line: Column) -> Column:
        sign = F.left(strip(line), F.lit(signature))
        again = (F.length(strip(line)) >= least) & F.array_contains(s["seen"], sign)
        seen = F.when((F.length(strip(line)) >= least) & ~again, F.array_append(s["seen"], sign)).otherwise(s["seen"])
        return F.struct(seen.alias("seen"), F.when(again, s["out"]).otherwise(F.array_append(s["out"], line)).alias("out"))

    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out"))
    kept = F.aggregate(F.split(text, "\n", -1), start, step)["out"]
    return F.regexp_replace(F.array_join(kept, "\n"), r"\n\s*\n\s*\n+", "\n\n")


def stat_fields(text: Column, fields: list[str]) -> Column:
    """map of the first 'Field: value' line of each field that is there."""
    from ..functions.text import field_line

    pairs = F.array(*[F.struct(F.lit(f).alias("k"), field_line(text, f).alias("v")) for f in fields])
    return F.map_from_entries(F.filter(pairs, lambda x: x["v"].isNotNull()))


def without_fields(text: Column, fields: list[str]) -> Column:
    """The text without its field lines and headings."""
    from ..functions.text import quote_pattern

    out = F.regexp_replace(text, r"(?m)^#{1,6}\s[^\n]*\n?", "")
    for f in fields:
        out = F.regexp_replace(out, rf"(?im)^[ \t]*{quote_pattern(f)}:[^\n]*\n?", "")
    return strip(out)
