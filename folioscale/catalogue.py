"""All registered queries outside the optional packages, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import registered_documents, registered_engine, registered_relational, registered_search

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return registered_relational.QUERIES | registered_documents.QUERIES | registered_engine.QUERIES | registered_search.QUERIES


def oracle_sql() -> dict[str, str]:
    return registered_relational.SQL | registered_documents.SQL | registered_engine.SQL | registered_search.SQL
