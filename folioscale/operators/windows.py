"""Order-dependent columns: fills, gaps, runs and scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LAST_PAGE = 9999


def top_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. ``order`` has to be total for equal results on every run."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def chapter_ends(df: DataFrame, keys: list[str], start: str, order: list[Column], last: int = LAST_PAGE) -> DataFrame:
    """page_end: the page before the next row's start, ``last`` for the last row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("page_end", F.coalesce(F.lead(start).over(w) - 1, F.lit(last)))


def section_ends(df: DataFrame, keys: list[str], start: str, is_table: Column, chapter_end: Column, order: list[Column]) -> DataFrame:
    """page_end: the start of the next row that is no table, else the chapter's end."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn("page_end", F.coalesce(F.first(F.when(~is_table, F.col(start)), ignorenulls=True).over(w), chapter_end))


def fill_down(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    """The last value that is not null, at or above each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def table_depth(df: DataFrame, keys: list[str], order: list[Column], is_table: str = "is_table", depth: str = "depth") -> DataFrame:
    """Tables are one level below the last row that is none."""
    filled = fill_down(df, keys, order, F.when(~F.col(is_table), F.col(depth)), "_d")
    return filled.withColumn(depth, F.when(F.col(is_table), F.coalesce("_d", F.lit(0)) + 1).otherwise(F.col(depth))).drop("_d")


def gaps(df: DataFrame, keys: list[str], value: str, more_than: int) -> DataFrame:
    """Rows that come more than so much after the one before them: (keys, previous, value, gap)."""
    w = Window.partitionBy(*keys).orderBy(value)
    return df.withColumn("previous", F.lag(value).over(w)).withColumn("gap", F.col(value) - F.col("previous")).filter(F.col("gap") > more_than).select(*keys, "previous", value, "gap")


def page_number_faults(df: DataFrame, keys: list[str], index: str, printed: str, jump: int = 5) -> DataFrame:
    """Printed page numbers that go back, jump, or end beyond twice the page count."""
    w = Window.partitionBy(*keys).orderBy(index)
    whole = Window.partitionBy(*keys)
    x = df.withColumn("previous", F.lag(printed).over(w)).withColumn("_pages", F.count("*").over(whole)).withColumn("_last", F.max(index).over(whole))
    fault = F.when(F.col(printed) < F.col("previous"), "backwards").when(F.col(printed) - F.col("previous") > jump, "jump").when((F.col(index) == F.col("_last")) & (F.col(printed) > 2 * F.col("_pages")), "beyond")
    return x.withColumn("fault", fault).filter("fault is not null").drop("_pages", "_last")


def changes(df: DataFrame, keys: list[str], order: list[Column], watched: list[str], name: str = "changed") -> DataFrame:
    """Whether any watched column differs from the row before; true for the first."""
    w = Window.partitionBy(*keys).orderBy(*order)
    same = F.row_number().over(w) > 1
    for c in watched:
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c))
    return df.withColumn(name, ~same)


def running_index(df: DataFrame, keys: list[str], order: list[Column], name: str = "chunk_index") -> DataFrame:
    """0, 1, 2 and so on inside each key."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("int"))


def islands(df: DataFrame, keys: list[str], order: list[Column], starts: Column, name: str = "island") -> DataFrame:
    """Numbered runs; a row for which ``starts`` is true begins one."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(w))


def continued_names(df: DataFrame, keys: list[str], order: list[Column], is_start: Column, text: str, sequence: str) -> DataFrame:
    """Names whose lines were cut: each run joined with spaces."""
    runs = islands(df, keys, order, is_start)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(sequence, text))), lambda x: x[text])
    return runs.groupBy(*keys, "island").agg(F.min(sequence).alias(sequence), F.array_join(ordered, " ").alias(text))


def scope_rows(df: DataFrame, keys: list[str], sequence: str, depth: str, opens: Column, longest: int | None = None) -> DataFrame:
    """in_scope: whether a row opens a scope or stands deeper below one that is not closed.

    A row at the depth of the opener, or above it, closes the scope. Since an
    opener at depth d lasts until depth d or less comes, a row is in scope
    exactly if the nearest row above with less depth is, or if it opens one: a
    fold over a document's headings in order says so in one pass.
    """
    rows = df.withColumn("_opens", opens)
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(sequence, depth, "_opens"))).alias("_rows"))
    state = F.struct(F.lit(None).cast("int").alias("open"), F.array().cast(f"array<{df.schema[sequence].dataType.simpleString()}>").alias("held"))

    def step(s: Column, r: Column) -> Column:
        still = s["open"].isNotNull() & (r[depth] > s["open"])
        now = F.when(still, s["open"]).when(r["_opens"], r[depth].cast("int"))
        return F.struct(now.alias("open"), F.when(now.isNotNull(), F.array_append(s["held"], r[sequence])).otherwise(s["held"]).alias("held"))

    held = packed.select(*keys, F.explode(F.aggregate("_rows", state, step)["held"]).alias(sequence)).withColumn("in_scope", F.lit(True))
    return df.join(held, [*keys, sequence], "left").withColumn("in_scope", F.coalesce("in_scope", F.lit(False)))
