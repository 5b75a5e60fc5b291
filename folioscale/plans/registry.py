"""Registers queries under their function's name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vector_of(embeddings: DataFrame, vec_id: int) -> list[float]:
    """One vector, to search with; empty if it is not there."""
    found = embeddings.filter(F.col("vec_id") == vec_id).select("embedding").first()
    return list(found.embedding or []) if found else []


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable:
        """Decorates f(t), where t(name) is a table."""

        def register(f: Callable[[Callable[[str], DataFrame]], DataFrame]) -> Callable:
            self.queries[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
            if sql:
                self.sql[f.__name__] = sql
            return f

        return register
