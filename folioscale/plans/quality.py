"""Checks of extracted and cleaned tables. Each gives rows (source_file, check_name, status, message, details).\n\nDetails name the first so many of what was found, beside how many there are.\n"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.joins import differences, fuzzy_anti
from ..operators.names import occurrences
from ..operators.windows import gaps


def _row(name: str, status: Column, message: Column, **details: Column) -> list[Column]:
    return ["source_file", F.lit(name).alias("check_name"), status.alias("status"), message.alias("message"), F.to_json(F.struct(*[v.alias(k) for k, v in details.items()])).alias("details")]


def graded(share: Column, warn: float, fail: float) -> Column:
    return F.when(share < fail, "fail").when(share < warn, "warn").otherwise("pass")


def table_completeness(toc: DataFrame, tables: DataFrame, warn: float = 0.95, fail: float = 0.8, most: int = 50) -> DataFrame:
    """Share of the contents' tables of which rows were found."""
    found = tables.select("source_file", F.col("toc_title").alias("title")).distinct().withColumn("_hit", F.lit(1))
    by = toc.filter("is_table").select("source_file", "title").distinct().join(found, ["source_file", "title"], "left").groupBy("source_file").agg(F.count("*").alias("declared"), F.count("_hit").alias("found"), F.array_sort(F.collect_set(F.when(F.col("_hit").isNull(), F.col("title")))).alias("missing"))
    share = F.col("found") / F.col("declared")
    return by.select(*_row("table_completeness", graded(share, warn, fail), F.format_string("%d of %d tables", "found", "declared"), missing=F.slice("missing", 1, most), n_missing=F.size("missing")))


def region_coverage(toc: DataFrame, regions: DataFrame, most: int = 50) -> DataFrame:
    """Pages on which fewer or more table regions were found than the contents say."""
    want = toc.filter("is_table").groupBy("source_file", F.col("page_start").alias("page")).agg(F.count("*").alias("want"))
    have = regions.groupBy("source_file", F.col("printed_page_num").alias("page")).agg(F.count("*").alias("have"))
    pages = want.join(have, ["source_file", "page"], "full_outer").na.fill(0, ["want", "have"])
    kind = F.when((F.col("want") == 0) & (F.col("have") == 0), "EMPTY").when(F.col("want") == F.col("have"), "OK").when(F.col("have") == 0, "MISSING").when(F.col("want") == 0, "EXTRA").when(F.col("have") < F.col("want"), "UNDER").otherwise("OVER")
    by = pages.withColumn("kind", kind).groupBy("source_file").agg(F.count("*").alias("pages"), F.sum(F.when(F.col("kind").isin("MISSING", "UNDER"), 1).otherwise(0)).alias("short"), F.array_sort(F.collect_set(F.when(F.col("kind").isin("MISSING", "UNDER"), F.col("page")))).alias("at"))
    return by.select(*_row("region_coverage", F.when(F.col("short") == 0, "pass").otherwise("warn"), F.format_string("%d of %d pages short", "short", "pages"), pages=F.slice("at", 1, most), n_pages=F.size("at")))


def spell_crosscheck(known: DataFrame, spell_list: DataFrame, least: float = 90.0, most: int = 50) -> DataFrame:
    """Index names without a close name in the spell list of their class."""
    a = known.filter("entry_class is not null").select("source_file", F.lower("entry_class").alias("entry_class"), F.lower("entry_name").alias("name"))
    b = spell_list.select("source_file", F.lower("entry_class").alias("entry_class"), F.lower("entry_name").alias("other"))
    lost = fuzzy_anti(a, b, ["source_file", "entry_class"], "name", "other", least).groupBy("source_file").agg(F.count("*").alias("lost"), F.array_sort(F.collect_set("name")).alias("names"))
    by = a.select("source_file").distinct().join(lost, "source_file", "left")
    n = F.coalesce("lost", F.lit(0))
    return by.select(*_row("spell_crosscheck", F.when(n == 0, "pass").otherwise("warn"), F.format_string("%d names without a match", n), names=F.slice("names", 1, most), n_names=n))


def page_gaps(pages: DataFrame, most: int = 2, shown: int = 50) -> DataFrame:
    found = gaps(pages.filter("printed_page_num is not null"), ["source_file"], "printed_page_num", most).groupBy("source_file").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("previous", "printed_page_num"))).alias("at"))
    by = pages.select("source_file").distinct().join(found, "source_file", "left")
    n = F.coalesce("n", F.lit(0))
    return by.select(*_row("page_gaps", F.when(n == 0, "pass").otherwise("warn"), F.format_string("%d gaps", n), gaps=F.slice("at", 1, shown), n_gaps=n))


def duplicate_names(entries: DataFrame, keys: tuple[str, ...] = ("source_file", "entry_name", "entry_class"), most: int = 20) -> DataFrame:
    twice = entries.groupBy(*keys).count().filter("count > 1").groupBy("source_file").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("minus"), F.col(keys[1]).alias("name")))).alias("names"))
    by = entries.select("source_file").distinct().join(twice, "source_file", "left")
    n = F.coalesce("n", F.lit(0))
    return by.select(*_row("duplicates", F.when(n == 0, "pass").otherwise("warn"), F.format_string("%d repeated names", n), names=F.transform(F.slice("names", 1, most), lambda x: x["name"]), n_names=n))


def authority_coverage(authority: DataFrame, entries: DataFrame, warn: float = 0.9, fail: float = 0.5) -> DataFrame:
    """Share of the names of authority tables that are titles of entries."""
    low = lambda c: F.lower(strip(F.col(c)))
    titles = entries.select("source_file", low("entry_title").alias("name")).distinct().withColumn("_hit", F.lit(1))
    by = authority.select("source_file", low("entry_name").alias("name")).distinct().join(titles, ["source_file", "name"], "left").groupBy("source_file").agg(F.count("*").alias("names"), F.count("_hit").alias("found"))
    share = F.col("found") / F.col("names")
    return by.select(*_row("authority_coverage", graded(share, warn, fail), F.format_string("%d of %d names", "found", "names"), share=share))


def index_differences(index: DataFrame, listed: DataFrame) -> DataFrame:
    return differences(index, listed, ["source_file", "entry_name"])


def validate_bronze(toc: DataFrame, tables: DataFrame, regions: DataFrame, known: DataFrame, spell_list: DataFrame, pages: DataFrame, authority: DataFrame, entries: DataFrame) -> DataFrame:
    """All six checks."""
    parts = [table_completeness(toc, tables), region_coverage(toc, regions), spell_crosscheck(known, spell_list), page_gaps(pages), duplicate_names(known), authority_coverage(authority, entries)]
    return reduce(DataFrame.unionByName, parts)


def section_issues(toc: DataFrame, chunks: DataFrame, key: str = "toc_id", longest: int = 999, crowded: int | None = 20) -> DataFrame:
    """toc_id, issue: sections without chunks, with too few, too many, mostly unnamed or tiny ones.

    An end beyond page ``longest`` stands for an open one and counts as it.
    More than ``crowded`` chunks a page are too many; with None, any number is
    right. A null key is a key, and sizes that are all unknown are not tiny.
    """
    stats = chunks.groupBy(key).agg(F.count("*").alias("n"), F.sum(F.when(F.col("entry_title").isNull(), 1).otherwise(0)).alias("unnamed"), F.sum("char_count").alias("chars")).withColumnRenamed(key, "_key")
    s = toc.filter("not is_excluded").join(stats, F.col(key).eqNullSafe(F.col("_key")), "left").na.fill(0, ["n", "unnamed"])
    n, span = F.col("n"), F.least("page_end", F.lit(longest)) - F.col("page_start") + 1
    issues = F.array(
        F.when(n == 0, "EMPTY_SECTION"),
        F.when((n > 0) & (n < span * F.lit(0.3)) & (span > 3), "LOW_CHUNKS"),
        F.when((n > span * F.lit(crowded)) & (span > 2), "CHUNK_OVERFLOW"),
        F.when((n > 5) & (F.col("unnamed") > n * F.lit(0.8)), "MOSTLY_UNNAMED"),
        F.when((n > 3) & (F.col("chars") / n < 30), "TINY_CHUNKS"),
    )
    return s.select(key, F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))


def entry_issues(entries: DataFrame, required: list[str], text: str, key: str, signature: int = 200, least: int = 50, description: int = 20) -> DataFrame:
    """key, issue: missing_metadata, no_description, duplicate_content, very_short, hyphenated_words.

    Entries without any of the required fields are of another kind and are not judged.
    """
    from pyspark.sql import Window

    low = F.lower(F.col(text))
    missing = F.filter(F.array(*[F.when(~low.contains(f.lower()), F.lit(f)) for f in required]), lambda x: x.isNotNull())
    fields = "|".join(required)
    after = F.regexp_replace(F.col(text), rf"(?is)^.*(?:^|\n)(?:{fields})\w*\s*:[^\n]*\n?", "")
    w = Window.partitionBy(F.substring(text, 1, signature)).orderBy(key)
    judged = entries.withColumn("_missing", F.size(missing)).filter(F.col("_missing") < len(required)).withColumn("_n", F.row_number().over(w))
    has_field = F.col(text).rlike(rf"(?i)\n(?:{fields})\w*\s*:")
    issues = F.array(
        F.when(F.col("_missing") > 0, "missing_metadata"),
        F.when(has_field & (F.length(strip(after)) < description), "no_description"),
        F.when(F.col("_n") > 1, "duplicate_content"),
        F.when(F.length(text) < least, "very_short"),
        F.when(F.regexp_replace(F.col(text), r"[0-9]+(?:st|nd|rd|th)- \w+", "").rlike(r"\w+- \w+"), "hyphenated_words"),
    )
    return judged.select(key, F.explode(F.filter(issues, lambda x: x.isNotNull())).alias("issue"))


def expected_content(expected: DataFrame, sections: DataFrame) -> DataFrame:
    """Expected names (source_file, title, name) that their section's text does not hold."""
    key = ["source_file", "title"]
    held = occurrences(expected, sections.select(*key, "content", F.lit(0).alias("_row")), key, key="_row", text="content", whole=False)
    # an empty name is in every section that there is
    empty = expected.filter("name = ''").join(sections.select(*key).distinct(), key, "left_semi").select(*key, "name")
    return expected.join(held.select(*key, "name").unionByName(empty).distinct(), [*key, "name"], "left_anti").select(*expected.columns)


def unreviewed(headings: DataFrame, toc: DataFrame, allowed: list[str]) -> DataFrame:
    """Headings that no title of the contents, no part behind a colon and no allowed name explains."""
    norm = lambda c: F.lower(F.regexp_replace(strip(c), r"\.$", ""))
    titles = toc.select("source_file", norm(F.col("title")).alias("_h")).unionByName(toc.select("source_file", norm(F.substring_index("title", ":", -1)).alias("_h"))).distinct()
    open_ = headings.withColumn("_h", norm(F.col("heading"))).filter(~F.col("_h").isin([a.lower() for a in allowed]) if allowed else F.lit(True))
    return open_.join(titles, ["source_file", "_h"], "left_anti").drop("_h")


def coverage_by_type(index: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Entries of each type and how many of them have a description."""
    d = descriptions.select("entry_id").distinct().withColumn("_hit", F.col("entry_id"))
    return index.join(d, "entry_id", "left").groupBy("entry_type").agg(F.countDistinct("entry_id").alias("entries"), F.countDistinct("_hit").alias("described"))
