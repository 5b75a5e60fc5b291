"""What several operators of this package need."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import forget, ship, work_dir, written

__all__ = ["LOWER", "UPPER", "arrow_map", "ascii_lower", "forget", "space_words", "table", "unit_hash", "work_dir", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """How many words between white space; a null text has none."""
    # one letter for each word: an array of all words of a long text would be far larger
    marks = F.translate(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def unit_hash(key: Column) -> Column:
    """A number in (0, 1) from the first digits of an MD5."""
    return (F.conv(F.substring(key, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package on the executors' path, wherever the driver has it from."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
