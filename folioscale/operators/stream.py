"""Entries of a book's markdown by its contents: chapters at headings, titles at lines, contents between them.

A file is one row with its contents beside it. Every title's fitting lines are
found once; titles that few lines hold are placed first, each between the
places of its neighbours in the contents, so that the order of the contents
always holds.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fuzzy import indel_ratio_value
from ..session import ship
from .documents import MIN_ENTRY, SECTIONS, clean_content

# How like a title a line, and a heading of a chapter, has to be.
LINE_RATIO, CHAPTER_RATIO = 80, 85
# What a chapter's title may begin with that its heading lacks.
CHAPTER_PREFIXES = ("player character ", "pc ")
_MARKS, _NOTE = re.compile(r"^\s*#+|\*"), re.compile(r"(?<=\S)\s*\([^()]*\)$")


def bare(line: str) -> str:
    """A line in lower case without marks, a note in parentheses at its end, and a final 'reversible'."""
    plain = _NOTE.sub("", _MARKS.sub("", line).strip().lower())
    return plain.removesuffix("reversible").strip()


def _numbers(text: str) -> list[str]:
    return [w for w in text.split() if w.isdigit()]


def _agree(a: str, b: str) -> bool:
    """Whether the numbers of two titles are the same, where both have some."""
    x, y = _numbers(a), _numbers(b)
    return not x or not y or x == y


def variants(title: str, chapter: bool = False) -> list[str]:
    """What a title may read like, in the order in which it is looked for, from three letters on."""
    head, colon, tail = (x.strip() for x in title.partition(":"))
    if chapter and colon:
        named = [tail, *(tail[len(p) :].strip() for p in CHAPTER_PREFIXES if tail.lower().startswith(p)), title, head]
    else:
        named = [title, tail] if colon else [title]
    each = [v for x in named for v in (x, x[: x.rfind("(")].strip() if x.rfind("(") > 0 else "")]
    return list(dict.fromkeys(v.lower().strip() for v in each if len(v.strip()) >= 3))


class Stream:
    """The lines of a markdown text, by what they read like."""

    def __init__(self, markdown: str, marks: set[str]):
        self.lines = ["" if x.strip() in marks else x for x in markdown.split("\n")]
        self.bare = [bare(x) for x in self.lines]
        self.headings = [i for i, x in enumerate(self.lines) if re.match(r"\s*(#|\*\*.*\*\*)", x) and len(self.bare[i]) >= 2]
        self._fits: dict[str, list[int]] = {}

    def fits(self, title: str) -> list[int]:
        """Lines that are the title, begin with it, or are short and nearly it."""
        if title not in self._fits:
            self._fits[title] = [i for i, x in enumerate(self.bare) if x and self._reads(x, title)]
        return self._fits[title]

    @staticmethod
    def _reads(line: str, title: str) -> bool:
        if line == title:
            return True
        if not _agree(line, title):
            return False
        if len(title) >= 4 and line.startswith(title) and not line[len(title)].isalpha():
            return True
        return len(line) <= 2 * len(title) + 20 and (indel_ratio_value(line, title) or 0) >= LINE_RATIO

    def first(self, title: str, low: int, high: int, anchor: str | None = None) -> int:
        """The first line in [low, high) of the first variant that has one; else the first with the anchor's text; else -1."""
        for v in variants(title):
            lines = self.fits(v)
            at = bisect_left(lines, low)
            if at < len(lines) and lines[at] < high:
                return lines[at]
        return next((i for i in range(low, high) if anchor and anchor in self.lines[i]), -1)

    def chapter(self, title: str, low: int) -> int:
        """The first heading from ``low`` on that is like the first variant that has one; -1 if there is none."""
        for v in variants(title, chapter=True):
            for i in self.headings[bisect_left(self.headings, low) :]:
                if self.bare[i] == v or _agree(self.bare[i], v) and (indel_ratio_value(self.bare[i], v) or 0) >= CHAPTER_RATIO:
                    return i
        return -1

    def held(self, title: str, low: int, high: int) -> int:
        """How many lines hold a title anywhere."""
        return sum(title.lower().strip() in self.lines[i].lower() for i in range(low, high))


def stream_sections(markdown: str, contents: list[dict], marks: set[str], least: int = MIN_ENTRY) -> list[tuple[str | None, str, str, int]]:
    """(chapter, title, content, page) of the titles that are found, in the order of the text.

    ``contents`` has title, parent_title, page, kind ("chapter", "leaf" or "") and anchor.
    """
    stream = Stream(markdown, marks)
    starts: dict[str, int] = {}
    for row in contents:
        if row["kind"] == "chapter" and (at := stream.chapter(row["title"], max(starts.values(), default=-1) + 1)) >= 0:
            starts.setdefault(row["title"], at)
    order = sorted(starts.values())
    end_of = lambda at: order[bisect_right(order, at)] if bisect_right(order, at) < len(order) else len(stream.lines)
    # each leaf lies in the chapter above it in the contents, or anywhere, if no chapter was found yet
    leaves, bounds = [], (0, len(stream.lines))
    for number, row in enumerate(contents):
        if row["kind"] == "chapter" and row["title"] in starts:
            bounds = (starts[row["title"]], end_of(starts[row["title"]]))
        elif row["kind"] == "leaf":
            leaves.append((stream.held(row["title"], *bounds), number, row, bounds))
    placed: dict[int, int] = {}
    known: list[int] = []
    for _, number, row, (low, high) in sorted(leaves, key=lambda x: x[:2]):
        at = bisect_left(known, number)
        above = placed[known[at - 1]] + 1 if at else 0
        below = placed[known[at]] if at < len(known) else high
        line = stream.first(row["title"], max(low, above), min(high, below), row.get("anchor"))
        if line >= 0:
            placed[number] = line
            insort(known, number)
    cuts = [*(placed[n] for n in known)]
    out = []
    for n, begin, stop in zip(known, cuts, [*cuts, None][1:], strict=True):
        row = contents[n]
        text = "\n".join(stream.lines[begin : end_of(begin) if stop is None else stop]).strip()
        if len(text) >= least:
            out.append((row["parent_title"], row["title"], text, row["page"]))
    return out


def build_from_markdown(markdown: DataFrame, toc: DataFrame, marks: DataFrame | None = None, fields: list[str] | None = None, substitutions: list[tuple[str, str]] | None = None, anchor: Column | None = None) -> DataFrame:
    """Sections (as of the page-based builder) of every file's ``markdown_text`` by its contents.

    Leaves are the rows with ``is_leaf``; without that column, those that are no
    chapter, table or excluded row and no other row's parent. ``anchor`` (or a
    column of that name) is text that marks a leaf whose title is not found.
    """
    anchor = F.col("anchor") if anchor is None and "anchor" in toc.columns else anchor
    parents = toc.select("source_file", F.col("parent_title").alias("title")).distinct().withColumn("_parent", F.lit(True))
    rows = toc.join(parents, ["source_file", "title"], "left")
    leaf = F.col("is_leaf") if "is_leaf" in toc.columns else ~(F.col("is_chapter") | F.col("is_excluded") | F.col("is_table") | F.coalesce("_parent", F.lit(False)))
    kind = F.when(F.col("is_chapter") & ~F.col("is_excluded"), "chapter").when(leaf, "leaf").otherwise("")
    row = F.struct(F.col("sort_order").cast("int").alias("sort_order"), "title", "parent_title", F.col("page_start").cast("int").alias("page"), kind.alias("kind"), (F.lit(None) if anchor is None else anchor).cast("string").alias("anchor"))
    contents = rows.groupBy("source_file").agg(F.array_sort(F.collect_list(row)).alias("contents"))
    text = F.coalesce("markdown_text", F.lit(""))
    for a, b in substitutions or []:
        text = F.replace(text, F.lit(a), F.lit(b))
    joined = markdown.select("source_file", text.alias("markdown_text")).join(contents, "source_file")
    if marks is not None:
        joined = joined.join(marks.groupBy("source_file").agg(F.collect_set("watermark_text").alias("marks")), "source_file", "left")
    else:
        joined = joined.withColumn("marks", F.lit(None).cast("array<string>"))
    ship(joined.sparkSession)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(r.source_file, chapter, title, title, content, page, n) for r in pdf.itertuples() for n, (chapter, title, content, page) in enumerate(stream_sections(r.markdown_text, list(r.contents), set(r.marks) if r.marks is not None else set()))]
            yield pd.DataFrame(found, columns=[x.split()[0] for x in SECTIONS.split(", ")])

    return joined.mapInPandas(split, SECTIONS).withColumn("content", clean_content(F.col("content"), fields))
