"""Encoded arrays: JSON cells, comma lists, model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, strip_html


def decode_cells(c: Column) -> Column:
    """A JSON array of strings; what is none becomes the only cell."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array(c))


def encode_cells(c: Column) -> Column:
    return F.to_json(c)


def table_row(c: Column) -> Column:
    """Cells as one row of a Markdown table, without HTML."""
    return F.concat(F.lit("| "), F.array_join(F.transform(decode_cells(c), lambda x: F.trim(strip_html(F.coalesce(x, F.lit(""))))), " | "), F.lit(" |"))


def dense_row(cells: Column, width: Column) -> Column:
    """map<int, string> of cells by column as an array without gaps."""
    return F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.coalesce(F.element_at(cells, i), F.lit("")))


def split_breaks(c: Column) -> Column:
    return F.split(c, r"<br\s*/?>")


def page_list(c: Column) -> Column:
    """'3,4,7' as integers."""
    return F.transform(F.filter(F.split(c, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).try_cast("int"))


def answer_object(c: Column, schema: str) -> Column:
    """What a model wrote between the first { and the last }, by a schema; null if it is no JSON."""
    return F.from_json(F.regexp_extract(c, r"(?s)\{.*\}", 0), schema)


def answer_array(c: Column, schema: str) -> Column:
    """The same between [ and ]."""
    return F.from_json(F.regexp_extract(c, r"(?s)\[.*\]", 0), schema)


def ocr_corrections(c: Column) -> Column:
    """Pairs of a model's OCR review that change something."""
    found = answer_array(c, "array<struct<wrong:string,correct:string>>")
    return F.filter(F.coalesce(found, F.array().cast("array<struct<wrong:string,correct:string>>")), lambda x: x["wrong"].isNotNull() & x["correct"].isNotNull() & (x["wrong"] != x["correct"]))


def name_cell_ok(c: Column) -> Column:
    """Whether a table cell may be a name: no price, no modifier, no number, no reference to a table."""
    bare = F.translate(strip(c), "-+–, ", "")
    return (F.length(bare) >= 3) & ~bare.rlike(r"^[0-9]+$") & ~strip(c).rlike(r"(?i)^(?:table\s+[0-9]+|[+-]?[0-9]+(?:\s*(?:gp|sp|cp|%))?)")
