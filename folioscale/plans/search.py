"""Retrieval: keywords, vectors, both, and what readers browse."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import contains_all, search_words
from ..operators.joins import facets

# What a stat block holds.
STAT_FIELDS = ("casting time:", "range:", "duration:", "components:", "saving throw:", "area of effect:", "sphere:", "school:")


def match_score(text: Column, words: list[str]) -> Column:
    """How many of the words a text holds."""
    return reduce(lambda a, w: a + F.when(F.lower(text).contains(w), 1).otherwise(0), words, F.lit(0))


def keyword_all(df: DataFrame, query: str, limit: int, text: str, key: str) -> DataFrame:
    """Rows with every word of a query, the shortest first; no usable word, no rows."""
    return df.filter(contains_all(F.col(text), search_words(query))).orderBy(F.length(text), key).limit(limit)


def keyword_any(df: DataFrame, query: str, limit: int, text: str, key: str, ids: list | None = None, id_col: str = "toc_id") -> DataFrame:
    """Rows with any word, those with most first, in some sections or in all."""
    words = search_words(query)
    if not words:
        return df.withColumn("score", F.lit(0)).limit(0)
    scored = (df.filter(F.col(id_col).isin(list(ids))) if ids is not None else df).withColumn("score", match_score(F.col(text), words))
    return scored.filter("score > 0").orderBy(F.col("score").desc(), key).limit(limit)


def cosine(vector: Column, query: list[float]) -> Column:
    """Cosine similarity with a fixed vector; null if either has no length."""
    q = F.array(*[F.lit(float(x)) for x in query]).cast("array<double>")
    dot = F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    length = math.sqrt(sum(float(x) ** 2 for x in query))
    return F.when((norm > 0) & F.lit(length > 0), dot / (norm * F.lit(length or 1.0)))


def vector_top_k(df: DataFrame, query: list[float], k: int, vector: str = "embedding", key: str = "vec_id", condition: Column | None = None) -> DataFrame:
    """The k most similar rows, exactly, after a metadata filter."""
    rows = df if condition is None else df.filter(condition)
    return rows.withColumn("similarity", cosine(F.col(vector), query)).filter("similarity is not null").orderBy(F.col("similarity").desc(), key).limit(k)


class VectorIndex:
    """Vectors with their texts and metadata as a table: put by id, searched with conditions on any column."""

    def __init__(self, catalog, namespace: str, name: str, key: str = "id", vector: str = "embedding"):
        self.catalog, self.namespace, self.name, self.key, self.vector = catalog, namespace, name, key, vector

    def put(self, rows: DataFrame) -> None:
        """Add rows; those whose id is there already take its place."""
        self.catalog.upsert(self.namespace, self.name, rows, [self.key])

    def search(self, query: list[float], k: int, **equal: object) -> DataFrame:
        """The k most similar rows of those with the given values; conditions reach the scan."""
        return vector_top_k(self.catalog.read(self.namespace, self.name, **equal), query, k, self.vector, self.key)

    def count(self) -> int:
        return self.catalog.read(self.namespace, self.name).count()


def hybrid(semantic: DataFrame, keyword: DataFrame, content: str, key: str, limit: int) -> DataFrame:
    """Semantic hits, then keyword hits; of equal first 200 characters the first stays. Inputs have a ``rank``."""
    both = semantic.withColumn("_from", F.lit(0)).unionByName(keyword.withColumn("_from", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(F.substring(content, 1, 200)).orderBy("_from", "rank", key)
    first = both.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return first.orderBy("_from", "rank", key).limit(limit).drop("_n", "_from")


def dedupe_prefix(df: DataFrame, content: str, order: list[Column], chars: int = 200) -> DataFrame:
    """Of rows that begin alike, the first."""
    w = Window.partitionBy(F.substring(content, 1, chars)).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def rerank_score(query: str, content: Column, title: Column) -> Column:
    """3 for each word in the title, 0.5 for each stat field, 5 for a titled full block, up to 2 for length, 0.5 for each word in the text."""
    words = search_words(query)
    in_title = match_score(F.coalesce(title, F.lit("")), words)
    stats = match_score(content, list(STAT_FIELDS))
    bonus = F.when((in_title > 0) & (stats >= 3), 5.0).otherwise(0.0)
    return 3.0 * in_title + 0.5 * stats + bonus + F.least(F.length(content) / 500.0, F.lit(2.0)) + 0.5 * match_score(content, words)


def rerank(df: DataFrame, query: str, content: str, title: str, order: list[Column]) -> DataFrame:
    return df.withColumn("score", rerank_score(query, F.col(content), F.col(title))).orderBy(F.col("score").desc(), *order)


def search_section(chunks: DataFrame, query: str, toc_ids: list | None, semantic: DataFrame, limit: int = 10) -> DataFrame:
    """Both kinds of hits of some sections, reranked."""
    found = keyword_any(chunks, query, 2 * limit, "content", "chunk_id", toc_ids)
    ranked = found.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), "chunk_id"))).drop("score")
    return rerank(hybrid(semantic, ranked, "content", "chunk_id", 2 * limit), query, "content", "entry_title", [F.col("rank")]).limit(limit)


def ask(chunks: DataFrame, toc: DataFrame, question: str, semantic: DataFrame | None = None, sections: int = 3, each: int = 10, most: int = 12) -> DataFrame:
    """toc_id, place, rank and the columns of ``chunks``: what a question is answered from.

    The question's words route it to ``sections`` sections; each is searched by
    itself, keyword hits behind ``semantic`` ones (chunks with a ``rank``), and
    reranked; of hits that begin alike the first stays. Without a section that
    fits, all chunks are searched as one.
    """
    routed = [r.toc_id for r in route_by_keywords(toc, question, sections).select("toc_id").collect()]
    near = chunks.limit(0).withColumn("rank", F.lit(0)) if semantic is None else semantic
    parts = []
    for place, ids in enumerate([[i] for i in routed] or [None]):
        own = near if ids is None else near.filter(F.col("toc_id").isin(ids))
        found = search_section(chunks, question, ids, own, each)
        order = Window.orderBy(F.col("score").desc(), "rank", "chunk_id")
        parts.append(found.withColumn("rank", F.row_number().over(order)).withColumn("place", F.lit(place)).select("place", "rank", *chunks.columns))
    # sections, and hits of each, at most as many as asked for
    held = dedupe_prefix(reduce(DataFrame.unionByName, parts), "content", [F.col("place"), F.col("rank"), F.col("chunk_id")])
    return held.orderBy("place", "rank", "chunk_id").limit(most)


def route_by_keywords(toc: DataFrame, question: str, limit: int = 3) -> DataFrame:
    """Sections for a question without a model: those whose title and headings hold most of its words."""
    text = F.concat_ws(" ", "title", "sub_headings")
    return toc.filter("not is_excluded").withColumn("score", match_score(text, search_words(question))).filter("score > 0").orderBy(F.col("score").desc(), "page_start", "toc_id").limit(limit)


def parse_routing(response: Column) -> Column:
    """(what, number) of 'LOOKUP: what -> number' lines of a model's answer."""
    lines = F.filter(F.split(response, "\n"), lambda x: x.rlike(r"(?i)LOOKUP:\s*.+->\s*[0-9]+"))
    return F.transform(lines, lambda x: F.struct(F.trim(F.regexp_extract(x, r"(?i)LOOKUP:\s*(.+?)\s*->", 1)).alias("what"), F.regexp_extract(x, r"->\s*([0-9]+)", 1).cast("int").alias("number")))


def numbered_toc(toc: DataFrame, most: int = 15) -> DataFrame:
    """A prompt's line for each section: number, title, pages and the first headings."""
    w = Window.orderBy("page_start", "toc_id")
    heads = F.array_join(F.slice(F.split("sub_headings", "; "), 1, most), ", ")
    n = F.row_number().over(w)
    line = F.concat(n.cast("string"), F.lit(". "), F.col("title"), F.lit(" (p."), F.col("page_start").cast("string"), F.lit(")"), F.when(F.col("sub_headings") != "", F.concat(F.lit(": "), heads)).otherwise(F.lit("")))
    return toc.select("toc_id", n.alias("number"), line.alias("line"))


def context(chunks: DataFrame, order: list[str]) -> DataFrame:
    """One text of all chunks for a prompt, in order; few chunks come here."""
    packed = F.array_sort(F.collect_list(F.struct(*order, F.concat(F.lit("["), F.coalesce("entry_title", F.lit("-")), F.lit("]\n"), F.col("content")).alias("_t"))))
    return chunks.agg(F.array_join(F.transform(packed, lambda x: x["_t"]), "\n\n---\n\n").alias("context"))


# What readers browse


def books(toc: DataFrame) -> DataFrame:
    return toc.select("source_file").distinct().orderBy("source_file")


def toc_of(toc: DataFrame, source_file: str | None = None) -> DataFrame:
    df = toc.filter("not is_excluded")
    return (df.filter(F.col("source_file") == source_file) if source_file else df).orderBy("source_file", "page_start", "toc_id")


def entry_list(chunks: DataFrame, toc_id: int) -> DataFrame:
    """Titles of a section in the order in which they come first."""
    return chunks.filter((F.col("toc_id") == toc_id) & F.col("entry_title").isNotNull()).groupBy("entry_title").agg(F.min("chunk_id").alias("first_chunk")).orderBy("first_chunk")


def chapter_sections(chunks: DataFrame, toc_id: int) -> DataFrame:
    """Sections of a chapter with their titles, both in the order in which they come first."""
    firsts = chunks.filter(F.col("toc_id") == toc_id).groupBy("section_title", "entry_title").agg(F.min("chunk_id").alias("at"))
    packed = F.array_sort(F.collect_list(F.struct("at", "entry_title")))
    return firsts.groupBy("section_title").agg(F.min("at").alias("at"), F.transform(packed, lambda x: x["entry_title"]).alias("entries")).orderBy("at")


def lookup(df: DataFrame, **equal: object) -> DataFrame:
    """Rows with given values, for point lookups by key."""
    for c, v in equal.items():
        df = df.filter(F.col(c) == F.lit(v))
    return df


def search_entries(chunks: DataFrame, toc: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """Titles or texts that hold ``text``, whatever the case; % and _ are plain characters."""
    low = text.lower()
    hit = F.lower(F.coalesce("entry_title", F.lit(""))).contains(low) | F.lower("content").contains(low)
    found = chunks.filter(hit).drop("toc_title").join(toc.select("toc_id", F.col("title").alias("toc_title")), "toc_id")
    return found.select("toc_id", "toc_title", "entry_title", "source_file").distinct().orderBy(F.col("entry_title").asc_nulls_last(), "source_file", "toc_id").limit(limit)


def table_numbers(toc: DataFrame, index: DataFrame) -> DataFrame:
    """table_number to entry for titles 'Table 12: ...'; the last by id counts."""
    named = index.filter(F.startswith(F.col("entry_title"), F.lit("Table "))).withColumn("table_number", F.regexp_extract("entry_title", r"Table\s+([0-9]+)", 1).try_cast("int"))
    return named.filter("table_number is not null").groupBy("source_file", "table_number").agg(F.max_by("entry_title", "entry_id").alias("entry_title"), F.max("entry_id").alias("entry_id"))


def compendium(index: DataFrame, annotations: DataFrame, summaries: DataFrame, entry_type: str, spell_classes: list[str] | None = None, level_min: int | None = None, level_max: int | None = None, school: str | None = None, sphere: str | None = None, is_reversible: bool | None = None, combat_only: bool = False, popular_only: bool = False, search: str | None = None) -> DataFrame:
    """The index with annotations and summaries, by whatever facets are set."""
    flags = [c for c, on in (("is_combat", combat_only), ("is_popular", popular_only)) if on]
    condition = facets(isin={"spell_class": spell_classes}, at_least={"spell_level": level_min}, at_most={"spell_level": level_max}, equal={"entry_type": entry_type, "school": school, "sphere": sphere, "is_reversible": True if is_reversible else None}, flags=flags, like={"entry_title": search})
    joined = index.join(annotations.select("entry_id", "is_combat", "is_popular"), "entry_id", "left").join(summaries.select("entry_id", "summary"), "entry_id", "left")
    return joined.filter(condition).orderBy(F.col("spell_level").asc_nulls_last(), "entry_title", "entry_id")


def filter_options(index: DataFrame, entry_type: str, columns: tuple[str, ...] = ("spell_class", "school", "sphere")) -> DataFrame:
    """Distinct non-empty values of each facet, sorted."""
    rows = index.filter(F.col("entry_type") == entry_type)
    return rows.agg(*[F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c)))).alias(c) for c in columns])


def categories(toc: DataFrame, chunks: DataFrame) -> DataFrame:
    """Sections of each book with their chunk counts, those without chunks too."""
    n = chunks.groupBy("toc_id").agg(F.count("*").alias("chunks"))
    rows = toc.filter("not is_excluded").join(n, "toc_id", "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))
    return rows.groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("page_start", "toc_id", "title", "chunks"))).alias("sections"))


def visible(annotated: Column, combat: Column, popular: Column, want_combat: bool, want_popular: bool) -> Column:
    """Rows without an annotation always show; the others if a wanted flag is set, or none is wanted."""
    if not (want_combat or want_popular):
        return F.lit(True)
    return ~annotated | (F.lit(want_combat) & combat) | (F.lit(want_popular) & popular)


def badges(parts: list[tuple[Column, Column]]) -> Column:
    """Those texts whose condition holds, joined with bars."""
    return F.array_join(F.filter(F.array(*[F.when(c, t) for c, t in parts]), lambda x: x.isNotNull()), " | ")


def snippet(text: Column, chars: int = 120) -> Column:
    return F.when(F.length(text) > chars, F.concat(F.left(text, F.lit(chars)), F.lit("..."))).otherwise(text)


def sidebar(toc: DataFrame) -> DataFrame:
    """Contents with the anchor of each row: its own, or its chapter's where nothing was found for it."""
    w = Window.partitionBy("source_file").orderBy("sort_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return toc.withColumn("anchor", F.coalesce(F.when(F.col("has_content"), F.col("toc_id")), F.last(F.when(F.col("is_chapter"), F.col("toc_id")), ignorenulls=True).over(w)))
