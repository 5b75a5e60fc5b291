"""Contents with leaves that the contents themselves lack: listed spells, names of authority tables, anchors.

A rule (a dict) names by ``key`` the chapters or sub-sections whose titles hold
it, and what their leaves come from: ``source`` "spells" (a level's spells below
the sub-section that names the level), "authority" (names of ``entry_type``, all
without one) or "anchors" (texts, with ``names`` for what is shown instead). The
first rule that fits a row counts, and a chapter's goes before its sub-sections'.
Everything is a union of joins; rows keep the order of the book by ``sort_order``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..operators.windows import top_one

LAST_PAGE = 9999
ORDER = ("_at", "_sub", "_name")


def _rule_of(title: Column, rules: list[dict]) -> Column:
    """The number of the first rule whose key the title holds; null if none."""
    hits = [F.when(F.lower(title).contains(r["key"].lower()), F.lit(i)) for i, r in enumerate(rules)]
    return F.coalesce(*hits, F.lit(None).cast("int"))


def _class_of(title: Column) -> Column:
    low = F.lower(title)
    return F.when(low.contains("wizard"), "wizard").when(low.contains("priest"), "priest")


def extended_toc(toc: DataFrame, rules: list[dict], spells: DataFrame, authority: DataFrame, levels: dict[str, int]) -> DataFrame:
    """``toc`` with is_leaf, source, anchor, spell_class, spell_level, school and sphere, and the added leaves.

    Excluded rows go, and rows whose chapter is excluded. Of a row without a rule
    every sub-section that is no table is a leaf. Titles of added leaves are
    compared by their lower-cased form; a null title fits no rule.
    """
    none = F.lit(None).cast("string")
    empty = {"source": F.lit("toc"), "anchor": none, "spell_class": none, "spell_level": F.lit(None).cast("int"), "school": none, "sphere": none}
    shown = toc.filter("not is_excluded")
    chapters = shown.filter("is_chapter").withColumn("_rule", _rule_of(F.col("title"), rules)).withColumn("_at", F.struct(F.col("sort_order").alias("a"), F.lit(-1).alias("b")))
    owner = chapters.select("source_file", F.col("title").alias("parent_title"), F.col("_rule").alias("_chapter_rule"), F.col("sort_order").alias("_chapter_at"))
    subs = shown.filter("not is_chapter").join(owner, ["source_file", "parent_title"]).withColumn("_rule", F.coalesce("_chapter_rule", _rule_of(F.col("title"), rules)))
    subs = subs.withColumn("_at", F.struct(F.col("_chapter_at").alias("a"), F.col("sort_order").alias("b")))
    kinds = {k: [i for i, r in enumerate(rules) if r["source"] == k] for k in ("spells", "authority", "anchors")}
    of = lambda column, kind: F.coalesce(F.col(column).isin(kinds[kind]), F.lit(False))

    # rows of the contents: in listed chapters only tables stay leaves, and a sub-section with a rule of its own is none
    listed = of("_chapter_rule", "spells") | of("_chapter_rule", "authority")
    own = F.col("_chapter_rule").isNull() & F.col("_rule").isNotNull()
    leaf = F.when(listed, F.col("is_table")).when(own & (of("_rule", "authority") | of("_rule", "anchors")), F.lit(False)).otherwise(~F.col("is_table"))
    base = [c for c in toc.columns if c != "sort_order"]
    parts = [
        chapters.select(*base, F.lit(False).alias("is_leaf"), *[v.alias(k) for k, v in empty.items()], "_at", F.lit(0).alias("_sub"), F.lit("").alias("_name")),
        subs.select(*base, leaf.alias("is_leaf"), *[v.alias(k) for k, v in (empty | {"spell_class": F.when(of("_chapter_rule", "spells"), _class_of(F.col("parent_title")))}).items()], "_at", F.lit(0).alias("_sub"), F.lit("").alias("_name")),
    ]

    def added(rows: DataFrame, title: Column, parent: Column, extra: dict[str, Column], sub: int = 1) -> DataFrame:
        made = {"title": title, "parent_title": parent, "is_chapter": F.lit(False), "is_table": F.lit(False), "is_excluded": F.lit(False), "page_end": F.coalesce("page_end", F.lit(LAST_PAGE))}
        return rows.select(*[made.get(c, F.col(c)).alias(c) for c in base], F.lit(True).alias("is_leaf"), *[v.alias(k) for k, v in (empty | extra).items()], "_at", F.lit(sub).alias("_sub"), F.lower(title).alias("_name"))

    # spells: the first level word that a sub-section's title holds
    word = F.coalesce(*[F.when(F.lower("title").contains(w.lower()), F.lit(n)) for w, n in levels.items()], F.lit(None).cast("int"))
    heads = subs.filter(of("_chapter_rule", "spells") & ~F.col("is_table")).withColumn("_level", word).withColumn("_class", _class_of(F.col("parent_title"))).filter("_level is not null")
    patterns = F.coalesce(*[F.when(F.col("_chapter_rule") == i, F.col("title").rlike("(?i)^(?:" + r["pattern"] + ")")) for i, r in enumerate(rules) if r.get("pattern")], F.lit(True))
    s = spells.select(F.col("source_file").alias("_file"), F.col("entry_name").alias("_spell"), F.lower("entry_class").alias("_c"), F.col("entry_level").cast("int").alias("_l"), F.col("school").alias("_school"), F.col("sphere").alias("_sphere"))
    same = (F.col("source_file") == F.col("_file")) & (F.col("_level") == F.col("_l")) & (F.col("_class").isNull() | (F.col("_class") == F.col("_c")))
    parts.append(added(heads.filter(patterns).join(s, same), F.col("_spell"), F.col("parent_title"), {"source": F.lit("spell_list"), "spell_class": F.col("_class"), "spell_level": F.col("_level"), "school": F.col("_school"), "sphere": F.col("_sphere")}))

    # authority names: at the end of a chapter with the rule, or below a sub-section with it
    end = F.struct(F.col("sort_order").alias("a"), F.lit(1 << 30).alias("b"))
    wanted = F.coalesce(*[F.when(F.col("_rule") == i, F.lit(rules[i].get("entry_type") or "")) for i in kinds["authority"]], F.lit(None).cast("string"))
    places = chapters.withColumn("_at", end).withColumn("_parent", F.col("title")).select(*base, "_rule", "_at", "_parent").unionByName(subs.filter(own).withColumn("_parent", F.col("parent_title")).select(*base, "_rule", "_at", "_parent"))
    names = authority.select(F.col("source_file").alias("_file"), F.col("entry_name").alias("_entry"), "entry_type")
    hits = places.filter(of("_rule", "authority")).withColumn("_type", wanted).join(names, (F.col("source_file") == F.col("_file")) & ((F.col("_type") == "") | (F.col("_type") == F.col("entry_type"))))
    parts.append(added(hits, F.col("_entry"), F.col("_parent"), {"source": F.lit("authority")}))

    # anchors that no sub-section of the chapter names; those of a sub-section's own rule meet no titles
    texts = [(i, n, a, squeeze_marks(a), rules[i].get("names", {}).get(a, squeeze_marks(a))) for i in kinds["anchors"] for n, a in enumerate(rules[i]["anchors"])]
    if texts:
        rows = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(n).alias("n"), F.lit(a).alias("a"), F.lit(raw.lower()).alias("raw"), F.lit(name).alias("name")) for i, n, a, raw, name in texts])).alias("x")
        titles = subs.filter(of("_chapter_rule", "anchors")).select(F.col("source_file").alias("_f"), F.col("parent_title").alias("_p"), F.lower("title").alias("_t")).distinct()
        anchored = places.filter(of("_rule", "anchors")).select("*", rows).filter("x.i = _rule")
        met = (F.col("source_file") == F.col("_f")) & (F.col("_parent") == F.col("_p")) & ((F.col("x.raw") == F.col("_t")) | (F.lower("x.name") == F.col("_t")))
        free = anchored.join(titles, met, "left_anti")
        made = added(free, F.col("x.name"), F.col("_parent"), {"source": F.lit("anchor"), "anchor": F.col("x.a")})
        # anchors keep the order of their rule
        parts.append(made.withColumn("_name", F.lpad(F.coalesce(*[F.when(F.col("anchor") == a, F.lit(str(n))) for _, n, a, *_ in texts]), 6, "0")))
    whole = reduce(DataFrame.unionByName, parts)
    order = Window.partitionBy("source_file").orderBy(*ORDER, "title")
    return whole.withColumn("sort_order", F.row_number().over(order) - 1).drop(*ORDER)


def squeeze_marks(anchor: str) -> str:
    """An anchor without bold marks."""
    return anchor.replace("**", "").strip()


def listed_names(rows: DataFrame) -> DataFrame:
    """One row for each (file, name, class) of a list, whatever the case and spacing: the first by level."""
    named = rows.withColumn("_k", F.lower(squeeze(F.col("entry_name"))))
    return top_one(named, ["source_file", "_k", "entry_class"], [F.col("entry_level"), F.col("entry_name")]).drop("_k")
