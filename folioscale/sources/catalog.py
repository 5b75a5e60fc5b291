"""Namespaces of tables, and the ways to write them."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LAYERS = ("bronze", "silver", "gold")
#: Behind a table's name: the note of a change under way, and its rows before they are in place.
NOTE, STAGED = "__change", "__staged_"


class Busy(RuntimeError):
    """Another writer changes the table."""


def _matched(rows: DataFrame, others: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join on keys in which null equals null."""
    mine = others.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    return rows.join(mine, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]), how)


class Catalog:
    """Tables of a Spark catalog as Parquet, partitioned by ``partition`` where a table has that column."""

    def __init__(self, spark: SparkSession, partition: str = "source_file"):
        self.spark, self.partition = spark, partition

    def ensure(self, namespace: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}`")

    def read(self, namespace: str, name: str, **equal: object) -> DataFrame:
        """A table; equalities on it reach the scan, those on the partition column prune it."""
        df = self.spark.table(f"`{namespace}`.`{name}`")
        for column, value in equal.items():
            df = df.filter(F.col(column) == F.lit(value))
        return df

    def exists(self, namespace: str, name: str) -> bool:
        try:
            return self.spark.catalog.tableExists(f"{namespace}.{name}")
        except AnalysisException:
            return False

    def tables(self, namespace: str) -> list[str]:
        self.ensure(namespace)
        return sorted(t.name for t in self.spark.catalog.listTables(namespace) if not t.isTemporary and STAGED not in t.name and not t.name.endswith(NOTE))

    def namespaces(self) -> list[str]:
        return sorted(d.name for d in self.spark.catalog.listDatabases())

    def all_tables(self) -> dict[str, list[str]]:
        return {n: self.tables(n) for n in self.namespaces()}

    def views(self, namespaces: list[str] | None = None) -> None:
        """Temporary views namespace_table, for SQL over several layers."""
        for n in namespaces or LAYERS:
            for t in self.tables(n):
                self.read(n, t).createOrReplaceTempView(f"{n}_{t}")

    def source_files(self, namespace: str, name: str, contains: str | None = None, **equal: object) -> DataFrame:
        df = self.read(namespace, name, **equal)
        if contains:
            df = df.filter(F.col("source_file").contains(contains))
        return df.select("source_file").distinct().orderBy("source_file")

    def _writer(self, df: DataFrame):
        w = df.write.format("parquet")
        return w.partitionBy(self.partition) if self.partition in df.columns and len(df.columns) > 1 else w

    # A change is whole or not at all: its rows are staged in a table of their own, then
    # noted as ready, then put in place. What is ready and not in place is done again.

    def _note(self, namespace: str, name: str) -> str:
        return f"`{namespace}`.`{name}{NOTE}`"

    def noted(self, namespace: str, name: str) -> dict[str, str] | None:
        """What a change that has not ended is about to do; None if there is none."""
        if not self.exists(namespace, f"{name}{NOTE}"):
            return None
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self._note(namespace, name)}").collect()
        return {r.key.removeprefix("change."): r.value for r in found if r.key.startswith("change.")}

    def _begin(self, namespace: str, name: str) -> str:
        """Claim the table: creating the note's table succeeds for one writer only."""
        self.ensure(namespace)
        staged = f"{name}{STAGED}{uuid.uuid4().hex[:12]}"
        try:
            self.spark.sql(f"CREATE TABLE {self._note(namespace, name)} (x INT) USING parquet TBLPROPERTIES ('change.staged' = '{staged}', 'change.state' = 'staging')")
        except AnalysisException as e:
            if "ALREADY_EXISTS" in str(e):
                raise Busy(f"{namespace}.{name} is being changed, or a change of it was cut short: see Catalog.recover") from None
            raise
        return staged

    def _end(self, namespace: str, name: str, staged: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{staged}`")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._note(namespace, name)}")

    def recover(self, namespace: str, name: str) -> str | None:
        """End a change whose writer is gone: 'done' if its rows were ready, 'undone' if not, None if there was none.

        Only for writers that are known to be gone; a living one holds the note itself.
        """
        note = self.noted(namespace, name)
        if note is None:
            return None
        ready = note["state"] == "ready"
        if ready:
            self._apply(namespace, name, note["staged"], note["how"], json.loads(note["emptied"]))
        self._end(namespace, name, note["staged"])
        return "done" if ready else "undone"

    def _change(self, namespace: str, name: str, df: DataFrame, how: str, touched: DataFrame | None = None) -> None:
        """Stage ``df`` and put it in place: "anew", or "static" (all rows) or "dynamic" (the partitions ``touched``)."""
        staged = self._begin(namespace, name)
        try:
            self._writer(df).saveAsTable(f"`{namespace}`.`{staged}`")
            emptied = []
            if touched is not None:
                # one value for each file that loses all its rows
                held = self.spark.table(f"`{namespace}`.`{staged}`").select(F.col(self.partition).alias("_held")).distinct()
                emptied = [r[0] for r in touched.distinct().join(held, F.col(self.partition).eqNullSafe(F.col("_held")), "left_anti").collect()]
            self._ready(namespace, name, how, emptied)
        except BaseException:
            self._end(namespace, name, staged)
            raise
        self._apply(namespace, name, staged, how, emptied)
        self._end(namespace, name, staged)

    def _ready(self, namespace: str, name: str, how: str, emptied: list) -> None:
        values = json.dumps(emptied, default=str).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {self._note(namespace, name)} SET TBLPROPERTIES ('change.state' = 'ready', 'change.how' = '{how}', 'change.emptied' = '{values}')")

    def _apply(self, namespace: str, name: str, staged: str, how: str, emptied: list) -> None:
        """Put a staged table in place; doing it twice does no harm."""
        if how == "anew":
            if not self.exists(namespace, staged):  # it has the table's name already
                return
            self.spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")
            if self._parted(namespace, staged):  # a catalog may keep the old places of partitions
                self._writer(self.spark.table(f"`{namespace}`.`{staged}`")).saveAsTable(f"`{namespace}`.`{name}`")
            else:
                self.spark.sql(f"ALTER TABLE `{namespace}`.`{staged}` RENAME TO `{namespace}`.`{name}`")
            return
        self._overwrite(namespace, name, self.spark.table(f"`{namespace}`.`{staged}`"), how)
        for value in emptied:
            self._drop_partition(namespace, name, value)

    def _overwrite(self, namespace: str, name: str, df: DataFrame, how: str) -> None:
        """Write the partitions that ``df`` has rows of, and no others ("static": in the place of all rows)."""
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, how)
        try:
            df.select(*self.read(namespace, name).columns).write.insertInto(f"`{namespace}`.`{name}`", overwrite=True)
        finally:
            self.spark.conf.set(mode, before)

    def _drop_partition(self, namespace: str, name: str, value: object) -> None:
        literal = "null" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        self.spark.sql(f"ALTER TABLE `{namespace}`.`{name}` DROP IF EXISTS PARTITION (`{self.partition}` = {literal})")

    def _parted(self, namespace: str, name: str, df: DataFrame | None = None) -> bool:
        columns = self.read(namespace, name).columns
        return self.partition in columns and len(columns) > 1 and (df is None or not set(df.columns) ^ set(columns))

    def replace(self, namespace: str, name: str, df: DataFrame, skip_empty: bool = False) -> bool:
        """Write the whole table anew; with ``skip_empty`` an empty result leaves the old one.

        The rows may come from the table itself. As in every partitioned Parquet
        table an empty string in the partition column is read back as null.
        """
        self.ensure(namespace)
        if skip_empty and df.isEmpty():
            return False
        same = self.exists(namespace, name) and sorted(f.simpleString() for f in self.read(namespace, name).schema.fields) == sorted(f.simpleString() for f in df.schema.fields)
        self._change(namespace, name, df, "static" if same else "anew")
        return True

    def append(self, namespace: str, name: str, df: DataFrame) -> None:
        """Add rows; columns that the table lacks are added to it, those that the rows lack are null."""
        self.ensure(namespace)
        if not self.exists(namespace, name):
            self.replace(namespace, name, df)
            return
        old = self.read(namespace, name)
        fresh = [f for f in df.schema.fields if f.name not in old.columns]
        if fresh:
            added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
            self.spark.sql(f"ALTER TABLE `{namespace}`.`{name}` ADD COLUMNS ({added})")
            old = self.read(namespace, name)
        for f in old.schema.fields:
            if f.name not in df.columns:
                df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
        df.select(*old.columns).write.insertInto(f"`{namespace}`.`{name}`")

    def overwrite_where(self, namespace: str, name: str, df: DataFrame, column: str, value: object) -> None:
        """Delete the rows with ``column`` = ``value`` (None: null), then add all rows of ``df``, whatever they hold there.

        Rows of other values stay. On the partition column only that partition and
        those that ``df`` has rows of are written.
        """
        if not self.exists(namespace, name):
            self.replace(namespace, name, df)
            return
        old, gone = self.read(namespace, name), F.col(column).eqNullSafe(F.lit(value))
        if column != self.partition or not self._parted(namespace, name, df):
            self.replace(namespace, name, old.filter(~gone).unionByName(df, allowMissingColumns=True))
            return
        mine = df.select(self.partition).distinct()
        # the partition filter prunes; what other files of ``df`` hold already is carried over
        kept = self._of(old.filter(~gone), mine)
        touched = old.filter(gone).select(self.partition).unionByName(mine)
        self._change(namespace, name, kept.unionByName(df).select(*old.columns), "dynamic", touched)

    def _of(self, rows: DataFrame, partitions: DataFrame) -> DataFrame:
        """The rows of some partitions, the null one included."""
        wanted = partitions.select(F.col(self.partition).alias("_wanted")).distinct()
        return rows.join(wanted, F.col(self.partition).eqNullSafe(F.col("_wanted")), "left_semi")

    def upsert(self, namespace: str, name: str, df: DataFrame, keys: list[str]) -> None:
        """Rows of ``df`` in the place of those with their keys; only partitions that this touches are written.

        A null in a key is a value like any other.
        """
        if not self.exists(namespace, name):
            self.replace(namespace, name, df)
            return
        old = self.read(namespace, name)
        if not self._parted(namespace, name, df):
            self.replace(namespace, name, _matched(old, df, keys, "left_anti").unionByName(df, allowMissingColumns=True))
            return
        touched = _matched(old, df, keys, "left_semi").select(self.partition).unionByName(df.select(self.partition)).distinct()
        rest = _matched(self._of(old, touched), df, keys, "left_anti")
        self._change(namespace, name, rest.unionByName(df).select(*old.columns), "dynamic", touched)

    def delete_orphans(self, namespace: str, name: str, owners: DataFrame, keys: list[str]) -> None:
        """Keep only rows whose key ``owners`` has (null is a value like any other); only partitions that lose rows are written."""
        old = self.read(namespace, name)
        if not self._parted(namespace, name):
            self.replace(namespace, name, _matched(old, owners, keys, "left_semi"))
            return
        touched = _matched(old, owners, keys, "left_anti").select(self.partition).distinct()
        self._change(namespace, name, _matched(self._of(old, touched), owners, keys, "left_semi"), "dynamic", touched)

    def drop(self, namespace: str, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")

    def row_counts(self, namespaces: list[str] | None = None) -> DataFrame:
        """namespace, table_name, row_count; -1 where a table cannot be read."""
        rows = []
        for n in namespaces or LAYERS:
            for t in self.tables(n):
                try:
                    rows.append((n, t, self.read(n, t).count()))
                except AnalysisException:
                    rows.append((n, t, -1))
        return self.spark.createDataFrame(rows, "namespace string, table_name string, row_count long")

    def query(self, namespace: str, name: str, columns: list[str] | None = None, where: str = "", limit: int = 0, width: int = 200) -> DataFrame:
        """Ad-hoc look at a table: columns first, then a condition on those, then a limit; cells are cut to ``width``."""
        df = self.read(namespace, name)
        df = df.select(*columns) if columns else df
        df = df.filter(where) if where else df
        df = df.limit(limit) if limit else df
        return df.select(*[F.substring(F.col(c).cast("string"), 1, width).alias(c) for c in df.columns])
