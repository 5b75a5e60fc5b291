"""Nested settings: defaults, and what a book changes."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def deep_merge(base: dict, change: dict) -> dict:
    """Dicts merge, lists are joined, anything else is replaced."""
    out = dict(base)
    for k, v in change.items():
        old = out.get(k)
        if isinstance(old, dict) and isinstance(v, dict):
            out[k] = deep_merge(old, v)
        elif isinstance(old, list) and isinstance(v, list):
            out[k] = old + v
        else:
            out[k] = v
    return out


def _parse(text: str) -> dict:
    try:
        import yaml
    except ImportError:
        return json.loads(text) or {}
    return yaml.safe_load(text) or {}


def load_config(spark: SparkSession, folder: str, book: str) -> dict:
    """_default and <book> (its file stem, spaces as _) merged, from .yaml or .json files that Spark can read."""
    stem = Path(book).stem.replace(" ", "_")
    return deep_merge(_read(spark, folder, "_default"), _read(spark, folder, stem))


def _read(spark: SparkSession, folder: str, stem: str) -> dict:
    """Settings of a name, {} if there are none. Spark's readers skip names with _, so this goes to the file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for end in ("yaml", "yml", "json"):
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{stem}.{end}")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            stream = fs.open(path)
            try:
                return _parse(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
    return {}


def toc_review(spark: SparkSession, source_file: str, entries: list[dict]) -> DataFrame:
    """A reviewed table of contents as rows; removed entries are out, depth 0 makes a chapter.

    Ends are set anew: a chapter's is the page before the next chapter (the
    last has 9999), another row's the start of the next one that is no table.
    """
    from ..operators import windows as w

    kept = [e for e in entries if e.get("type") != "remove"]
    rows = [(source_file, i, e["title"], int(e["page"]), int(e.get("depth", 1)), e.get("depth", 1) == 0, e.get("type") == "table", bool(e.get("excluded", False)), e.get("page_end")) for i, e in enumerate(kept)]
    df = spark.createDataFrame(rows, "source_file string, sort_order int, title string, page_start int, depth int, is_chapter boolean, is_table boolean, is_excluded boolean, given_end int")
    keys, order = ["source_file"], [F.col("sort_order")]
    filled = w.fill_down(df, keys, order, F.when(F.col("is_chapter"), F.col("title")), "parent_title")
    filled = filled.withColumn("parent_title", F.when(F.col("is_chapter"), F.lit(None)).otherwise(F.col("parent_title")))
    chapters = w.chapter_ends(df.filter("is_chapter"), keys, "page_start", order).select("source_file", "sort_order", F.col("page_end").alias("_ce"))
    joined = w.fill_down(filled.join(chapters, ["source_file", "sort_order"], "left"), keys, order, F.col("_ce"), "_ce")
    ends = w.section_ends(joined, keys, "page_start", F.col("is_table"), F.coalesce("_ce", F.lit(w.LAST_PAGE)), order)
    end = F.coalesce("given_end", F.when(F.col("is_chapter"), F.col("_ce")).otherwise(F.least("page_end", F.coalesce("_ce", F.lit(w.LAST_PAGE)))))
    return ends.withColumn("page_end", F.greatest(end, F.col("page_start"))).drop("_ce", "given_end")
