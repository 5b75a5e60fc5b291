"""Tables for readers: contents, typed index, chunks, rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import stable_hash
from ..functions.text import field_line, strip
from ..operators.chunks import MAX_CHARS, OVERLAP, chunk_text
from ..operators.joins import fallback_join
from ..operators.windows import scope_rows

TOC = ("toc_id", "parent_toc_id", "source_file", "title", "page_start", "page_end", "sort_order", "depth", "is_chapter", "is_table", "is_excluded", "parent_title", "sub_headings", "tables")
TABLES = ("source_file", "table_number", "table_title", "toc_title", "toc_id", "parent_title", "sort_order", "format", "row_index", "cells")


def toc(silver_toc: DataFrame) -> DataFrame:
    return silver_toc.select(*TOC)


def tables(silver_tables: DataFrame) -> DataFrame:
    return silver_tables.select(*TABLES)


def entries(silver_toc: DataFrame, silver_entries: DataFrame) -> DataFrame:
    """Contents in reading order with what was found for each; rows without an entry keep a null entry_id."""
    t = silver_toc.filter("not is_excluded").select("source_file", "toc_id", F.col("title").alias("_t"), "sort_order", "depth", "is_chapter", "is_table", "is_excluded")
    e = silver_entries.select("source_file", "toc_id", "entry_id", "section_title", "entry_title", "content", "char_count", "spell_class", "spell_level")
    return t.join(e, ["source_file", "toc_id"], "left").select("entry_id", "source_file", "toc_id", F.col("_t").alias("toc_title"), "section_title", "entry_title", "content", "char_count", "spell_class", "spell_level", "sort_order", "depth", "is_chapter", "is_table", "is_excluded")


def reading_order(gold_entries: DataFrame) -> DataFrame:
    return gold_entries.orderBy("source_file", "sort_order", F.col("entry_id").asc_nulls_last())


def entry_index(silver_entries: DataFrame, silver_toc: DataFrame, crosscheck: DataFrame, authority: DataFrame, class_names: list[str], strict_case: bool = False) -> DataFrame:
    """Typed index: spell, table, class, proficiency or rule, with the crosscheck's facts for spells.

    Names meet lower-cased; with ``strict_case`` the crosscheck's side keeps its case.
    """
    names = [n.lower().strip() for n in class_names]
    classes = scope_rows(silver_toc, ["source_file"], "sort_order", "depth", F.lower(strip(F.col("title"))).isin(names)).filter("in_scope").select("toc_id").distinct().withColumn("_class", F.lit(True))
    table_ids = silver_toc.filter("is_table").select("toc_id").distinct().withColumn("_table", F.lit(True))
    prof = authority.filter("entry_type = 'proficiency'").select("source_file", F.lower(strip(F.col("entry_name"))).alias("_name")).distinct().withColumn("_prof", F.lit(True))
    name = F.lower(strip(F.coalesce("entry_title", F.lit(""))))
    e = silver_entries.withColumn("_name", name).join(table_ids, "toc_id", "left").join(classes, "toc_id", "left").join(prof, ["source_file", "_name"], "left")
    kind = (
        F.when(F.col("_name") == "", "rule")
        .when(F.coalesce("spell_class", F.lit("")) != "", "spell")
        .when(F.col("_table"), "table")
        .when(F.col("_class"), "class")
        .when(F.col("_prof"), "proficiency")
        .otherwise("rule")
    )
    e = e.withColumn("entry_type", kind)
    facts = crosscheck.select("source_file", (F.col("entry_name") if strict_case else F.lower(strip(F.col("entry_name")))).alias("_name"), F.col("entry_class").alias("x_class"), F.col("entry_level").alias("x_level"), F.col("school").alias("x_school"), F.col("sphere").alias("x_sphere"), F.col("is_reversible").alias("x_rev"), F.col("ref_page").alias("x_page"))
    own = F.nullif(F.col("spell_class"), F.lit(""))
    e = fallback_join(e, facts, ["source_file", "_name"], F.col("x_class"), [own, F.lit("wizard"), F.lit("priest")], ["x_class", "x_level", "x_school", "x_sphere", "x_rev", "x_page"])
    spell, hit = F.col("entry_type") == "spell", F.col("x_class").isNotNull()
    either = lambda a, b: F.when(spell & hit, a).when(spell, b)
    field = lambda f: field_line(F.coalesce("content", F.lit("")), f)
    return e.select(
        "entry_id",
        "source_file",
        "entry_title",
        "entry_type",
        either(F.col("x_level"), F.col("spell_level")).cast("int").alias("spell_level"),
        either(F.col("x_class"), own).alias("spell_class"),
        F.when(spell & hit, F.coalesce("x_school", "school")).otherwise(F.col("school")).alias("school"),
        F.when(spell & hit, F.coalesce("x_sphere", "sphere")).otherwise(F.col("sphere")).alias("sphere"),
        F.when(spell & hit, F.col("x_rev")).alias("is_reversible"),
        F.when(spell & hit, F.col("x_page")).cast("int").alias("ref_page"),
        F.coalesce(field("Components"), field("Component")).alias("components"),
        field("Saving Throw").alias("saving_throw"),
        field("Range").alias("range_text"),
        field("Duration").alias("duration_text"),
        field("Casting Time").alias("casting_time"),
    )


def chunks(silver_entries: DataFrame, most: int = MAX_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """Chunks of every entry, with keys that count through all chunks of a (file, section, title)."""
    from pyspark.sql import Window

    parts = silver_entries.select("entry_id", "source_file", "toc_id", "toc_title", "section_title", "entry_title", "page_numbers", F.posexplode(chunk_text(F.coalesce("content", F.lit("")), most, overlap)).alias("_at", "content"))
    w = Window.partitionBy("source_file", "toc_title", "entry_title").orderBy("entry_id", "_at")
    numbered = parts.withColumn("chunk_index", F.row_number().over(w) - 1)
    pages = F.when(F.coalesce("page_numbers", F.lit("")) == "", F.lit("0")).otherwise(F.col("page_numbers"))
    return numbered.select(stable_hash("source_file", "toc_title", "entry_title", "chunk_index").alias("chunk_id"), "entry_id", "source_file", "toc_id", "section_title", "entry_title", "content", pages.alias("page_numbers"), F.length("content").cast("long").alias("char_count"), F.lit("content").alias("chunk_type"), F.current_timestamp().alias("chunked_at"))


def entry_descriptions(silver_descriptions: DataFrame, index: DataFrame) -> DataFrame:
    return silver_descriptions.select("entry_id", "source_file", "content").join(index.select("entry_id", "entry_type"), "entry_id").select("entry_id", "source_file", "entry_type", "content")


def files(gold_chunks: DataFrame, silver_files: DataFrame, gold_toc: DataFrame) -> DataFrame:
    j = gold_chunks.select("source_file", "toc_id").join(silver_files.select("source_file", "total_pages"), "source_file").join(gold_toc.select("toc_id"), "toc_id")
    return j.groupBy("source_file", "total_pages").agg(F.count("*").alias("total_chunks"), F.countDistinct("toc_id").alias("total_toc_entries"), F.current_timestamp().alias("built_at"))
