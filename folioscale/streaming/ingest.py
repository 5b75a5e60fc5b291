"""Files and events as streams: batches of new files, windows with late rows. An extension: batch is the rule."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ingest_new_files(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None], schema: StructType | None = None, source: str = "binaryFile", most_files: int = 1000) -> None:
    """Give every file that was not seen before to ``handle``, once, in batches; then stop."""
    reader = spark.readStream.format(source).option("maxFilesPerTrigger", most_files)
    reader = reader.schema(schema) if schema is not None else reader.schema("path string, modificationTime timestamp, length long, content binary")
    reader.load(folder).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def event_windows(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "2 hours", at: str = "ts", keys: tuple[str, ...] = ("event_type",), value: str = "value") -> DataFrame:
    """Counts and sums in time windows; works on streams and on tables."""
    when = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    span = F.window(at, width, slide) if slide else F.window(at, width)
    return when.groupBy(span, *keys).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours", at: str = "ts", key: str = "user_id") -> DataFrame:
    """Runs of a key's events without a longer pause."""
    when = events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return when.groupBy(F.session_window(at, gap).alias("session"), key).agg(F.count("*").alias("n"))


def upsert_days(mart: DataFrame, fresh: DataFrame, column: str = "order_date") -> DataFrame:
    """A mart with the days of an increment in the place of its own."""
    return mart.join(fresh.select(column).distinct(), column, "left_anti").unionByName(fresh)
