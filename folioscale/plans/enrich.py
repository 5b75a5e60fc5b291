"""Summaries and annotations by a model: what is left to do, prompts, answers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import answer_object
from .providers import generated

SUMMARY_LIMIT, ANNOTATION_LIMIT, LEAST = 3000, 2000, 200


def pending(index: DataFrame, done: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Index rows of the wanted types that are not done."""
    rows = index.filter(F.col("entry_type").isin(types)) if types else index
    return rows.join(done.select("entry_id").distinct(), "entry_id", "left_anti")


def cut(c, limit: int):
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("..."))).otherwise(c)


def filled(prompt: str, slots: dict[str, Column]) -> Column:
    """A prompt with its {slots} filled at once: what a value holds is not looked at again."""
    parts = re.split("(" + "|".join(re.escape(f"{{{name}}}") for name in slots) + ")", prompt)
    return F.concat(F.lit(""), *[slots[p[1:-1]] if p[:1] == "{" and p[1:-1] in slots else F.lit(p) for p in parts if p])


def summaries(index: DataFrame, entries: DataFrame, descriptions: DataFrame, done: DataFrame, model: object, prompt: str, types: list[str] | None = None, least: int = LEAST) -> DataFrame:
    """entry_id, source_file, entry_type, summary of what is pending and long enough; ``prompt`` has {title}, {type} and {text}."""
    work = pending(index, done, types).select("entry_id", "source_file", "entry_type", "entry_title")
    text = descriptions.select("entry_id", F.col("content").alias("_d"))
    j = work.join(entries.select("entry_id", "content", "char_count"), "entry_id").filter(F.col("char_count") >= least).join(text, "entry_id", "left")
    asked = filled(prompt, {"title": F.coalesce("entry_title", F.lit("")), "type": F.col("entry_type"), "text": cut(F.coalesce("_d", "content"), SUMMARY_LIMIT)})
    out = generated(j.select("entry_id", "source_file", "entry_type", asked.alias("prompt")), "prompt", model, "summary")
    return out.filter("summary is not null").drop("prompt")


def verdicts(answers: DataFrame, response: str = "response") -> DataFrame:
    """is_combat and is_popular from a model's JSON; a missing key is false, no JSON is null."""
    x = answer_object(F.col(response), "combat boolean, popular boolean")
    ok = F.col(response).rlike(r"(?s)\{.*\}")
    return answers.withColumn("is_combat", F.when(ok, F.coalesce(x["combat"], F.lit(False)))).withColumn("is_popular", F.when(ok, F.coalesce(x["popular"], F.lit(False))))


def annotations(index: DataFrame, entries: DataFrame, done: DataFrame, model: object, prompt: str, types: list[str]) -> DataFrame:
    work = pending(index, done, types).select("entry_id", "source_file", "entry_title").join(entries.select("entry_id", "content"), "entry_id")
    asked = filled(prompt, {"title": F.coalesce("entry_title", F.lit("")), "text": cut(F.col("content"), ANNOTATION_LIMIT)})
    out = verdicts(generated(work.select("entry_id", "source_file", "entry_title", asked.alias("prompt")), "prompt", model, "response"))
    return out.filter("is_combat is not null").select("entry_id", "source_file", "entry_title", "is_combat", "is_popular", F.current_timestamp().alias("annotated_at"))


def card(index: DataFrame) -> DataFrame:
    """The text badges of an entry and the beginning of its summary."""
    from .search import badges, snippet

    level = F.concat(F.lit("Level "), F.col("spell_level").cast("string"))
    parts = [(F.col("spell_level").isNotNull(), level), (F.col("school").isNotNull(), F.col("school")), (F.col("sphere").isNotNull(), F.col("sphere")), (F.coalesce("is_reversible", F.lit(False)), F.lit("Reversible")), (F.coalesce("is_combat", F.lit(False)), F.lit("Combat")), (F.coalesce("is_popular", F.lit(False)), F.lit("Popular"))]
    return index.select("entry_id", badges(parts).alias("badges"), snippet(F.col("summary")).alias("snippet"))


def shown_text(description, summary, content, show_summary: bool):
    """The summary where it is wanted and there, else the description, else the content."""
    plain = F.coalesce(description, content)
    return F.when(F.lit(show_summary) & summary.isNotNull(), summary).otherwise(plain)
