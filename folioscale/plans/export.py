"""Markdown of a category or of a whole book, assembled in the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.chunks import drop_contained, drop_repeated_lines, stat_fields, without_fields

# Ordinal words and what they count.
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth")


def ordinal_rank(title: Column) -> Column:
    """1 for 'first' to 9 for 'ninth' anywhere in a title, else 99."""
    out = F.lit(99)
    for n, word in reversed(list(enumerate(ORDINALS, 1))):
        out = F.when(F.lower(title).contains(word), n).otherwise(out)
    return out


def entry_table(meta: Column, fields: list[str], reversible: Column) -> Column:
    """Fields as a two-column table, and whether the text says that it can be reversed."""
    rows = F.transform(F.filter(F.array(*[F.lit(f) for f in fields]), lambda f: F.map_contains_key(meta, f)), lambda f: F.concat(F.lit("| "), f, F.lit(" | "), F.element_at(meta, f), F.lit(" |")))
    last = F.concat(F.lit("| Reversible | "), F.when(reversible, "Yes").otherwise("No"), F.lit(" |"))
    return F.array_join(F.concat(F.array(F.lit("| Field | Value |"), F.lit("| --- | --- |")), rows, F.array(last)), "\n")


def category(chunks: DataFrame, toc: DataFrame, title_words: list[str], fields: list[str], least: int = 20) -> DataFrame:
    """group, source_file, entry_title, markdown: entries of sections whose title holds a word.

    Chunks of an entry are put together without what others hold already;
    entries without a real description and appendix or chapter titles go.
    """
    from ..functions.text import contains_any

    sections = toc.filter(contains_any(F.col("title"), title_words)).select("toc_id", F.col("title").alias("group"), F.col("page_start").alias("_p"))
    j = chunks.join(sections, "toc_id").filter("entry_title is not null").filter(~F.lower("entry_title").rlike(r"^(appendix|chapter)\b"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("chunk_id", "content"))), lambda x: x["content"])
    one = j.groupBy("group", "_p", "source_file", "entry_title").agg(F.array_join(drop_contained(texts), "\n\n").alias("_t")).withColumn("_t", drop_repeated_lines(F.col("_t")))
    rows = one.withColumn("_m", stat_fields(F.col("_t"), fields)).withColumn("_d", without_fields(F.col("_t"), fields)).filter(F.length("_d") > least)
    text = F.concat(F.lit("### "), F.col("entry_title"), F.lit("\n\n"), F.when(F.size("_m") > 0, F.concat(entry_table(F.col("_m"), fields, F.lower("_t").contains("reversible")), F.lit("\n\n"))).otherwise(F.lit("")), F.col("_d"))
    return rows.select("group", "_p", "source_file", "entry_title", text.alias("markdown")).orderBy(ordinal_rank(F.col("group")), "group", "entry_title", "_p").drop("_p")


def whole_book(chunks: DataFrame, toc: DataFrame, source_file: str | None = None) -> DataFrame:
    """source_file, markdown: every chunk in reading order, with a heading where section or entry changes."""
    j = chunks.join(toc.select("toc_id", F.col("title").alias("_title"), "page_start", "sort_order"), "toc_id")
    j = j.filter(F.col("source_file") == source_file) if source_file else j
    w = Window.partitionBy("source_file").orderBy("page_start", "sort_order", "page_numbers", "chunk_id")
    fresh_section = ~F.lag("toc_id").over(w).eqNullSafe(F.col("toc_id"))
    fresh_entry = F.col("entry_title").isNotNull() & (fresh_section | ~F.lag("entry_title").over(w).eqNullSafe(F.col("entry_title")))
    part = F.concat(F.when(fresh_section, F.concat(F.lit("## "), F.col("_title"), F.lit("\n\n"))).otherwise(F.lit("")), F.when(fresh_entry, F.concat(F.lit("### "), F.col("entry_title"), F.lit("\n\n"))).otherwise(F.lit("")), strip(F.col("content")))
    numbered = j.withColumn("_part", part).withColumn("_n", F.row_number().over(w))
    return numbered.groupBy("source_file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", "_part"))), lambda x: x["_part"]), "\n\n").alias("markdown"))


def write_markdown(df: DataFrame, path: str) -> None:
    """One line-delimited text for each row's markdown."""
    df.select(F.col("markdown").alias("value")).write.mode("overwrite").text(path)
