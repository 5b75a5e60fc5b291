"""Tables on pages, from layout spans (page_index, idx, font, size, bold, x0, y0, x1, y1, text).

A page is one small group, so the detector works on one page's arrays at a
time; cells, masks and text come from plain DataFrame operations on its result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .intervals import coalesce_intervals


@dataclass(frozen=True)
class LayoutSettings:
    header_font: str | None = None
    header_size: float | None = None
    header_bold: bool | None = None
    size_tolerance: float = 0.1
    row_tolerance: float = 3.0
    cluster_gap: float = 15.0
    outer_margin: float = 80.0
    min_columns: int = 2
    min_rows: int = 2
    misses: int = 2
    label_reach: float = 30.0
    label_rows: int = 2


REGIONS = "source_file string, page_index int, region_index int, bbox_x0 double, bbox_y0 double, bbox_x1 double, bbox_y1 double, header_bbox_x0 double, header_bbox_y0 double, header_bbox_x1 double, header_bbox_y1 double, row_count int, col_count int, header_row_count int, columns array<struct<x0:double,x1:double>>, detection_method string"


@dataclass(frozen=True)
class Lines:
    """Spans as rows from top to bottom: numbers of each row, and the spans in row order."""

    order: np.ndarray
    first: np.ndarray
    left: np.ndarray
    top: np.ndarray
    right: np.ndarray
    bottom: np.ndarray

    @classmethod
    def of(cls, box: np.ndarray, which: np.ndarray, tolerance: float) -> Lines:
        """A row holds what begins no lower than the tolerance below its highest span."""
        high = which[np.argsort(box[which, 1], kind="stable")]
        y, heads = box[high, 1], []
        while (at := heads[-1][1] if heads else 0) < len(y):
            heads.append((at, int(np.searchsorted(y, y[at] + tolerance, side="right"))))
        number = np.repeat(np.arange(len(heads)), [b - a for a, b in heads])
        order = high[np.lexsort((box[high, 0], number))]
        first = np.array([a for a, _ in heads], dtype=np.int64)
        over = [f.reduceat(box[order, i], first) if len(first) else np.zeros(0) for i, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum))]
        return cls(order, first, *over)

    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.first, len(self.order)))

    def spans(self, row: int) -> np.ndarray:
        return np.split(self.order, self.first[1:])[row]

    def beside(self, left: float, right: float) -> np.ndarray:
        """Rows that share some width with a range."""
        return (self.left <= right) & (self.right >= left)


def row_numbers(tops: np.ndarray, tolerance: float) -> np.ndarray:
    """The row of each of ascending tops: one begins with the first that is more than the tolerance below its row's first."""
    heads, at = [], 0
    while at < len(tops):
        heads.append(at)
        end = int(np.searchsorted(tops, tops[at] + tolerance, side="right"))
        # the sum may round to the other side of the difference
        while end < len(tops) and tops[end] - tops[at] <= tolerance:
            end += 1
        while end > at + 1 and tops[end - 1] - tops[at] > tolerance:
            end -= 1
        at = end
    return np.repeat(np.arange(len(heads)), np.diff([*heads, len(tops)]))


def unmerged(box: np.ndarray) -> np.ndarray:
    """[left, right] of spans from left to right, those that run into each other as one."""
    reach = np.maximum.accumulate(box[:, 2])
    begin = np.flatnonzero(np.append(True, box[1:, 0] > reach[:-1]))
    return np.column_stack([box[begin, 0], reach[np.append(begin[1:], len(box)) - 1]])


def column_bounds(columns: np.ndarray, margin: float) -> np.ndarray:
    """Where columns part: halfway between neighbouring middles, and a margin outside."""
    middle = columns.mean(axis=1)
    return np.concatenate([[columns[0, 0] - margin], (middle[1:] + middle[:-1]) / 2, [columns[-1, 1] + margin]])


def columns_met(lines: Lines, box: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many columns each row has a span's middle in."""
    middle = box[lines.order][:, [0, 2]].mean(axis=1)[:, None]
    return np.logical_or.reduceat((middle >= bounds[:-1]) & (middle <= bounds[1:]), lines.first, axis=0).sum(axis=1)


def before_misses(fits: np.ndarray, misses: int) -> np.ndarray:
    """``fits`` up to where so many in a row do not."""
    seen = np.cumsum(~fits)
    run = seen - np.maximum.accumulate(np.where(fits, seen, 0))
    return fits[: int(np.argmax(run >= misses))] if (run >= misses).any() else fits


def is_header(shown: pd.DataFrame, cfg: LayoutSettings) -> np.ndarray:
    wanted = [(cfg.header_font, lambda v: shown["font"] == v), (cfg.header_size, lambda v: (shown["size"].astype(float) - v).abs() <= cfg.size_tolerance), (cfg.header_bold, lambda v: shown["bold"].astype(bool) == v)]
    return np.logical_and.reduce([np.ones(len(shown), bool), *(test(v).to_numpy(dtype=bool) for v, test in wanted if v is not None)])


def page_regions(spans: pd.DataFrame, cfg: LayoutSettings) -> list[dict]:
    """The tables of one page: header rows in another style, and the rows below that keep to their columns."""
    shown = spans[spans["text"].fillna("").str.strip() != ""].sort_values("idx")
    box = shown[["x0", "y0", "x1", "y1"]].to_numpy(dtype=float)
    header = is_header(shown, cfg)
    if not header.any():
        return []
    rows, heads = (Lines.of(box, which, cfg.row_tolerance) for which in (np.arange(len(box)), np.flatnonzero(header)))
    # header rows go with the one above: near it, over or under it, and with about as many spans, or one row a single label
    n = heads.sizes()
    few, many = np.minimum(n[1:], n[:-1]), np.maximum(n[1:], n[:-1])
    near = heads.top[1:] - heads.bottom[:-1] <= cfg.cluster_gap
    meets = (heads.left[1:] <= heads.right[:-1]) & (heads.left[:-1] <= heads.right[1:])
    group = np.append(0, np.cumsum(~(near & meets & (many > 1) & ((few == 1) | (many <= 2 * few)))))
    body = np.add.reduceat((~header[rows.order]).astype(int), rows.first)
    out = []
    for own in (np.flatnonzero(group == g) for g in range(group[-1] + 1)):
        head = [heads.left[own].min(), heads.top[own].min(), heads.right[own].max(), heads.bottom[own].max()]
        begin = int(np.flatnonzero(np.abs(rows.top - heads.top[own[-1]]) <= cfg.row_tolerance)[-1]) + 1
        columns, method = max((unmerged(box[heads.spans(r)]) for r in own), key=len), "font_switch"
        left, right = head[0], head[2]
        if len(columns) < cfg.min_columns:
            # a label alone: the first row below that reaches over its middle gives the columns, if the next rows keep to them
            middle, below = (left + right) / 2, np.arange(len(rows.first)) >= begin
            fit = np.flatnonzero(below & (rows.top <= head[3] + cfg.label_reach) & (rows.left <= middle) & (rows.right >= middle) & (body >= cfg.min_columns))
            if n[own].sum() != 1 or not len(fit):
                continue
            begin, method = int(fit[0]), "label"
            template = rows.spans(begin)
            columns = box[template[~header[template]]][:, [0, 2]]
            left, right = columns[0, 0], columns[-1, 1]
        bounds = column_bounds(columns, cfg.outer_margin)
        under = begin + np.flatnonzero(rows.beside(left, right)[begin:])
        fits = columns_met(rows, box, bounds)[under] >= cfg.min_columns
        if method == "label" and not (len(under) >= cfg.label_rows and fits[1 : cfg.label_rows].all()):
            continue
        data = under[: len(held := before_misses(fits, cfg.misses))][held]
        if not len(data) or len(own) + len(data) < cfg.min_rows:
            continue
        held = slice(max(begin - 1, 0), data[-1] + 1)
        whole = [min(head[0], rows.left[held].min()), min(head[1], rows.top[held].min()), max(head[2], rows.right[held].max()), max(head[3], rows.bottom[held].max())]
        out.append({"box": whole, "head": head, "rows": len(own) + len(data), "zones": np.column_stack([bounds[:-1], bounds[1:]]), "head_rows": len(own), "method": method})
    return out


def table_regions(spans: DataFrame, cfg: LayoutSettings) -> DataFrame:
    """Table regions of every page."""

    def detect(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for n, r in enumerate(page_regions(pdf, cfg)):
            rows.append((pdf["source_file"].iloc[0], int(pdf["page_index"].iloc[0]), n, *map(float, r["box"]), *map(float, r["head"]), r["rows"], len(r["zones"]), r["head_rows"], [{"x0": float(a), "x1": float(b)} for a, b in r["zones"]], r["method"]))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in REGIONS.replace("struct<x0:double,x1:double>", "s").split(", ")])

    ship(spans.sparkSession)
    needed = spans.select("source_file", "page_index", "idx", "font", "size", "bold", "x0", "y0", "x1", "y1", "text")
    return needed.groupBy("source_file", "page_index").applyInPandas(detect, REGIONS)


def _inside(s: str, r: str) -> Column:
    cx, cy = (F.col(f"{s}.x0") + F.col(f"{s}.x1")) / 2, (F.col(f"{s}.y0") + F.col(f"{s}.y1")) / 2
    return cx.between(F.col(f"{r}.bbox_x0"), F.col(f"{r}.bbox_x1")) & cy.between(F.col(f"{r}.bbox_y0"), F.col(f"{r}.bbox_y1"))


def spans_in_regions(spans: DataFrame, regions: DataFrame) -> DataFrame:
    """Spans whose middle is in a region of their page."""
    s, r = spans.alias("s"), regions.alias("r")
    same = (F.col("s.source_file") == F.col("r.source_file")) & (F.col("s.page_index") == F.col("r.page_index"))
    return s.join(r, same & _inside("s", "r")).select("s.*", "r.region_index", "r.columns")


def table_cells(spans: DataFrame, regions: DataFrame, row_tolerance: float = 3.0) -> DataFrame:
    """source_file, page_index, region_index, row_index, col_index, cell_text."""
    key = ["source_file", "page_index", "region_index"]
    inside = spans_in_regions(spans.filter(F.trim("text") != ""), regions)
    middle = (F.col("x0") + F.col("x1")) / 2
    col = F.array_position(F.transform("columns", lambda c: middle.between(c["x0"], c["x1"])), True)
    placed = inside.select(*key, "y0", "x0", "text", (col - 1).cast("int").alias("col_index"))

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["y0"].to_numpy(dtype=float), kind="stable")
        own = [pdf[c].to_numpy()[order] for c in ("y0", "col_index", "x0", "text")]
        held: dict[tuple[int, int], list] = {}
        for r, c, x0, text in zip(row_numbers(own[0], row_tolerance).tolist(), *(v.tolist() for v in own[1:]), strict=True):
            if c >= 0:
                held.setdefault((r, c), []).append((x0, text))
        cells = [(r, c, " ".join(text.strip(" ") for _, text in sorted(found)).strip(" ")) for (r, c), found in held.items()]
        out = pd.DataFrame(cells, columns=["row_index", "col_index", "cell_text"])
        for place, c in enumerate(key):
            out.insert(place, c, pdf[c].iloc[0])
        return out

    ship(spans.sparkSession)
    kinds = ", ".join(f"{c} {placed.schema[c].dataType.simpleString()}" for c in key)
    return placed.groupBy(*key).applyInPandas(read, f"{kinds}, row_index int, col_index int, cell_text string")


def region_rows(cells: DataFrame) -> DataFrame:
    """Cells as dense rows: cells array<string>, with '' for holes."""
    key = ["source_file", "page_index", "region_index"]
    rows = cells.groupBy(*key, "row_index").agg(F.map_from_entries(F.collect_list(F.struct("col_index", "cell_text"))).alias("_m"), (F.max("col_index") + 1).alias("_n"))
    wide = rows.withColumn("_w", F.max("_n").over(Window.partitionBy(*key)))  # the cells are computed once
    return wide.select(*key, "row_index", F.transform(F.sequence(F.lit(0), F.col("_w") - 1), lambda i: F.coalesce(F.element_at("_m", i), F.lit(""))).alias("cells"))


def span_positions(spans: DataFrame) -> DataFrame:
    """char_start and char_end of each span in its page's text; lines end with a line break. Needs line_idx."""
    w = Window.partitionBy("source_file", "page_index").orderBy("idx")
    line_end = F.lead("line_idx").over(w).isNull() | (F.lead("line_idx").over(w) != F.col("line_idx"))
    sized = spans.withColumn("_n", F.length("text") + F.when(line_end, 1).otherwise(0))
    end = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    return sized.withColumn("char_start", end).withColumn("char_end", end + F.length("text")).drop("_n")


def page_text(spans: DataFrame) -> DataFrame:
    """The text of each page, line by line."""
    lines = spans.groupBy("source_file", "page_index", "line_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), "").alias("_l"))
    return lines.groupBy("source_file", "page_index").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_idx", "_l"))), lambda x: x["_l"]), "\n"), F.lit("\n")).alias("page_text"))


def text_masks(spans: DataFrame, regions: DataFrame) -> DataFrame:
    """source_file, page_index, char_start, char_end: what of a page's text its tables hold."""
    inside = spans_in_regions(span_positions(spans), regions).filter(F.col("char_end") > F.col("char_start"))
    return coalesce_intervals(inside.select("source_file", "page_index", "region_index", "char_start", "char_end"), ["source_file", "page_index", "region_index"], "char_start", "char_end", gap=1).drop("region_index").withColumn("reason", F.lit("table"))


def font_histogram(spans: DataFrame) -> DataFrame:
    """Characters of each font, size and weight of a file, their share, and whether it is the most used one."""
    by = spans.groupBy("source_file", "font", F.round("size", 1).alias("size"), "bold").agg(F.sum(F.length("text")).alias("chars"))
    w = Window.partitionBy("source_file")
    first = F.row_number().over(w.orderBy(F.col("chars").desc(), "font", "size", "bold"))
    return by.withColumn("share", F.col("chars") / F.sum("chars").over(w)).withColumn("is_body", first == 1)
