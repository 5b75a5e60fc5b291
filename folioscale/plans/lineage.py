"""Runs, what they wrote, and the order of steps."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import config_hash

RUNS = "run_id string, source_file string, step string, pipeline_version string, config_hash string, status string, started_at timestamp, finished_at timestamp, row_counts string, error_message string"


class Lineage:
    """Append-only events of runs; the last event of a run is its state."""

    def __init__(self, catalog, namespace: str = "bronze", version: str = "1"):
        self.catalog, self.namespace, self.version = catalog, namespace, version
        self.open: dict[str, tuple] = {}

    def _append(self, row: tuple) -> None:
        self.catalog.append(self.namespace, "pipeline_runs", self.catalog.spark.createDataFrame([row], RUNS))

    def start(self, source_file: str, step: str, config: dict) -> str:
        run = uuid.uuid4().hex[:12]
        self.open[run] = (run, source_file, step, self.version, config_hash(config), "running", datetime.now(timezone.utc), None, None, None)
        self._append(self.open[run])
        return run

    def finish(self, run: str, status: str = "success", row_counts: dict | None = None, error: str | None = None) -> None:
        first = self.open.pop(run)
        self._append((*first[:5], status, first[6], datetime.now(timezone.utc), json.dumps(row_counts) if row_counts else None, error))

    def runs(self) -> DataFrame:
        return latest(self.catalog.read(self.namespace, "pipeline_runs"), ["run_id"], "finished_at")


def latest(events: DataFrame, keys: list[str], when: str) -> DataFrame:
    """The last event of each key; one without a time is the first."""
    w = Window.partitionBy(*keys).orderBy(F.col(when).desc_nulls_last())
    return events.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def file_counts(tables: dict[str, DataFrame], run_id: str) -> DataFrame:
    """source_file, table_name, row_count of every table: one row for each file and table."""
    from functools import reduce

    parts = [df.groupBy("source_file").agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).select("source_file", "table_name", "row_count", F.current_timestamp().alias("refreshed_at"), F.lit(run_id).alias("run_id"))


def changed_files(found: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Files whose size or settings differ from what was done."""
    return found if force else found.join(done.select("source_file", "pdf_size_bytes", "config_hash").distinct(), ["source_file", "pdf_size_bytes", "config_hash"], "left_anti")


# The steps, and what each waits for.
STEPS: dict[str, set[str]] = {
    "bronze": set(),
    "toc_review": {"bronze"},
    "bronze_ocr_check": {"toc_review"},
    "bronze_validate": {"toc_review"},
    "silver_entries": {"bronze", "toc_review"},
    "silver_toc_sections": {"silver_entries"},
    "silver_known_entries": {"bronze"},
    "silver_spell_crosscheck": {"silver_known_entries"},
    "silver_spell_meta": {"silver_entries"},
    "silver_entry_descriptions": {"silver_entries"},
    "silver_page_anchors": {"bronze"},
    "silver_files": {"silver_entries"},
    "silver_tables": {"silver_toc_sections"},
    "gold_toc": {"silver_toc_sections"},
    "gold_tables": {"silver_tables"},
    "gold_entries": {"silver_toc_sections", "silver_entries"},
    "gold_entry_index": {"silver_entries", "silver_toc_sections", "silver_spell_crosscheck", "bronze"},
    "gold_chunks": {"silver_entries", "silver_toc_sections"},
    "gold_entry_descriptions": {"silver_entry_descriptions", "gold_entry_index"},
    "gold_files": {"gold_chunks", "silver_files", "gold_toc"},
    "gold_ai_summaries": {"gold_entry_descriptions"},
    "gold_ai_annotations": {"gold_ai_summaries"},
}

_AI = {"gold_ai_summaries", "gold_ai_annotations"}
# The jobs, by their steps.
JOBS: dict[str, set[str]] = {
    "full": set(STEPS),
    "without_enrichment": set(STEPS) - _AI,
    "bronze_and_review": {"bronze", "toc_review", "bronze_ocr_check", "bronze_validate"},
    "silver_and_publish": {s for s in STEPS if s.startswith(("silver", "gold"))} - _AI,
    "enrichment_only": _AI,
}


def run_job(steps: dict[str, Callable[[], object]], job: str = "full", needs: dict[str, set[str]] | None = None) -> dict[str, object]:
    """Run the job's steps, each after what it waits for; what has no function is skipped."""
    needs = needs or STEPS
    wanted = JOBS.get(job, set(needs))
    order = TopologicalSorter({s: needs[s] & wanted for s in needs if s in wanted}).static_order()
    return {s: steps[s]() for s in order if s in steps}


def require_review(pending: DataFrame) -> None:
    """A gate: raises while books wait for a review of their contents."""
    waiting = [r.source_file for r in pending.select("source_file").distinct().orderBy("source_file").limit(20).collect()]
    if waiting:
        raise RuntimeError("contents not reviewed: " + ", ".join(waiting))


class Project:
    """A document project by its parameters: what it ingests, embeds and asks, without generated code."""

    def __init__(self, spark: SparkSession, slug: str, fields: list[str]):
        self.spark, self.slug, self.fields = spark, slug, fields

    def ingest(self, documents: DataFrame, text: str = "text", most: int = 2000) -> DataFrame:
        from ..operators.chunks import heading_sections

        return heading_sections(documents, text, most).withColumn("project", F.lit(self.slug))

    def embed(self, chunks: DataFrame, embedder: object) -> DataFrame:
        from .providers import embedded

        return embedded(chunks, "content", embedder)

    def search(self, chunks: DataFrame, query: str, limit: int = 5) -> DataFrame:
        from .search import keyword_any

        return keyword_any(chunks, query, limit, "content", "content")
