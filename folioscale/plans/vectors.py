"""An inverted file of vectors with product quantization: approximate nearest neighbours that read a part of the rows.

Coarse centroids and code books are fitted on a bounded sample; every row is put
into the list of its nearest centroid, one partition for each list. A search reads
the lists nearest to its queries, adds up table entries for each row's codes, and
scores the best of them again with their whole vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from ..sources.catalog import Catalog

#: Rows that centroids and code books are fitted on, at most.
SAMPLE = 20_000
#: Lists, at most; fewer for small samples.
LISTS = 256
CODES = 256
#: Dimensions that one code stands for.
WIDTH = 4
#: Rows of the sample that are searched for, to choose how many lists a search reads.
TRIALS = 200
#: Numbers of the vectors that a task compares at a time, and queries that it scores at once.
NUMBERS, STRIP = 8_000_000, 32


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    half = (centers * centers).sum(axis=1) / 2
    for a in range(0, len(x), 4096):
        out[a : a + 4096] = (x[a : a + 4096] @ centers.T - half).argmax(axis=1)
    return out


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centers by Lloyd's rounds; one that loses all its rows moves to a row."""
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, centers)
        n = np.bincount(own, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), len(centers))])
    return centers


class Books:
    """Centroids of the lists, and for each part of a vector the values that its codes stand for."""

    def __init__(self, lists: np.ndarray, parts: list[np.ndarray], probes: int):
        self.lists, self.parts, self.probes = lists, parts, probes
        self.cuts = np.cumsum([0, *[p.shape[1] for p in parts]])

    @classmethod
    def fit(cls, sample: np.ndarray, recall: float, k: int, seed: int = 7) -> Books:
        """Fit on rows; a search reads as many lists as ``recall`` of the k nearest rows of some trial rows need."""
        x, rng = _unit(sample.astype(np.float64)), np.random.default_rng(seed)
        lists = _means(x, max(1, min(LISTS, math.isqrt(len(x)))), rng)
        own = _nearest(x, lists)
        rest = x - lists[own]
        cuts = [*range(0, x.shape[1], WIDTH), x.shape[1]]
        books = cls(lists, [_means(rest[:, a:b], CODES, rng) for a, b in zip(cuts, cuts[1:], strict=False)], 1)
        # the place of each near row's list in the order in which its trial row would read them
        trial = x[rng.choice(len(x), min(TRIALS, len(x)), replace=False)]
        near = np.argsort(-(trial @ x.T), axis=1, kind="stable")[:, 1 : k + 1]
        order = np.argsort(np.argsort(-(trial @ lists.T), axis=1, kind="stable"), axis=1)
        places = np.sort(np.take_along_axis(order, own[near], axis=1).ravel())
        books.probes = int(places[min(len(places) - 1, math.ceil(recall * len(places)))]) + 1 if len(places) else len(lists)
        return books

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit = _unit(x)
        own = _nearest(unit, self.lists)
        rest = unit - self.lists[own]
        return own, np.column_stack([_nearest(rest[:, a:b], p) for p, a, b in zip(self.parts, self.cuts, self.cuts[1:], strict=False)])

    def decode(self, lists: np.ndarray, codes: pa.ChunkedArray) -> np.ndarray:
        """The unit vectors that lists and codes stand for."""
        held = np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(len(lists), len(self.parts))
        out = self.lists[lists].astype(np.float32)
        for i, (p, a, b) in enumerate(zip(self.parts, self.cuts, self.cuts[1:], strict=False)):
            out[:, a:b] += p[held[:, i]].astype(np.float32)
        return out

    def wanted(self, query: np.ndarray, probes: int) -> np.ndarray:
        """The lists that a query reads, the nearest ones."""
        return np.argsort(-(self.lists @ query), kind="stable")[:probes]


def _usable(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vector has the right width, only finite numbers and a length, and their vectors."""
    rows, held = [], []
    for i, v in enumerate(column.to_pylist()):
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v) and any(v):
            rows.append(i)
            held.append(v)
    return np.array(rows, np.int64), np.array(held, np.float64).reshape(len(rows), width)


class InvertedVectors:
    """Vectors with metadata as two tables: the books, and all rows in their lists."""

    def __init__(self, catalog: Catalog, namespace: str, name: str, key: str = "id", vector: str = "embedding"):
        self.namespace, self.name, self.key, self.vector = namespace, name, key, vector
        self.catalog = Catalog(catalog.spark, partition="list")

    def fit(self, rows: DataFrame, recall: float = 0.98, k: int = 10) -> None:
        """Fit and store the books on at most SAMPLE rows, chosen by the hash of their key; other widths than the commonest take no part."""
        usable = rows.filter(F.exists(self.vector, lambda x: x != 0) & F.forall(self.vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        picked = usable.orderBy(F.xxhash64(F.col(self.key).cast("string")), self.key).select(self.vector).limit(SAMPLE).collect()
        if not picked:
            raise ValueError("no usable vectors to fit the index on")
        widths = [len(r[0]) for r in picked]
        width = max(set(widths), key=widths.count)
        books = Books.fit(np.array([r[0] for r in picked if len(r[0]) == width]), recall, k)
        model = [(-1, i, v.tolist(), books.probes) for i, v in enumerate(books.lists)]
        model += [(p, i, v.tolist(), books.probes) for p, part in enumerate(books.parts) for i, v in enumerate(part)]
        self.catalog.replace(self.namespace, f"{self.name}_books", self.catalog.spark.createDataFrame(model, "part int, code int, value array<double>, probes int"))

    def books(self) -> Books:
        """The stored books: LISTS centroids and CODES values for each part at most."""
        rows = self.catalog.read(self.namespace, f"{self.name}_books").orderBy("part", "code").collect()
        parts = {}
        for r in rows:
            parts.setdefault(r.part, []).append(r.value)
        return Books(np.array(parts.pop(-1)), [np.array(parts[p]) for p in sorted(parts)], rows[0].probes)

    def put(self, rows: DataFrame) -> None:
        """Put rows into their lists; those whose key is there take its place, from whatever list. Vectors without a length are left out."""
        books, vector = self.books(), self.vector
        width = int(books.cuts[-1])

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, x = _usable(batch.column(batch.schema.get_field_index(vector)), width)
                own, codes = books.encode(x) if len(x) else (np.zeros(0, np.int64), np.zeros((0, len(books.parts)), np.int64))
                out = batch.take(pa.array(kept))
                # codes are below 256: one byte each
                columns = [*out.columns, pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()), pa.array(own.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*out.schema.names, "codes", "list"])

        ship(self.catalog.spark)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
        self.catalog.upsert(self.namespace, self.name, rows.mapInArrow(dealt, f"{schema}, codes binary, list int"), [self.key])

    def search(self, queries: list[tuple[object, list[float]]] | DataFrame, k: int = 10, probes: int | None = None, again: int = 10, **equal: object) -> DataFrame:
        """query_id, rank, the key and similarity: the k rows nearest to each query among those with the given values.

        Queries are a list, or a table of query_id and query; equal ones count
        once, and one without a length has no rows. With values few rows have, more
        ``probes`` are needed for the same recall. ``again`` times k rows of each
        query are scored with their whole vectors. Rows are dealt into parts by
        their lists and queries into parts by their hash, both of bounded size: a
        task holds one part of each, however many rows and queries there are.
        """
        books, spark, key, most = self.books(), self.catalog.spark, self.key, again * k
        probes, width = min(probes or books.probes, len(books.lists)), int(books.cuts[-1])
        rows = self.catalog.read(self.namespace, self.name, **equal)
        if isinstance(queries, DataFrame):
            asked = queries.select("query_id", F.col("query").cast("array<double>").alias("query"))
        else:
            given = [(i, list(map(float, q))) for i, q in queries if len(q) == width and all(map(math.isfinite, q)) and any(q)]
            read = sorted({x for _, q in given for x in books.wanted(np.array(q), probes).tolist()})
            # the lists prune partitions, the given values reach the scan
            rows = rows.filter(F.col("list").isin(read) if read else F.lit(False))
            asked = spark.createDataFrame(given, f"query_id {_id_type(given)}, query array<double>")
        finite = F.forall("query", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        asked = asked.filter((F.size("query") == width) & finite & F.exists("query", lambda x: x != 0)).distinct()

        # at most LISTS counts; large lists are parts of their own, small ones share a part
        most_rows = max(1, NUMBERS // width)
        firsts, slices = _dealt({r.list: r["count"] for r in rows.groupBy("list").count().collect()}, len(books.lists), most_rows)
        pieces = max(1, math.ceil(asked.count() * width / NUMBERS * 32))
        parts_of = [np.arange(f, f + s) for f, s in zip(firsts, slices, strict=True)]
        first, split = (F.element_at(F.array(*[F.lit(v) for v in x]), F.col("list") + 1) for x in (firsts, slices))
        own = rows.select((first + F.pmod(F.xxhash64(key), split)).cast("int").alias("_part"), F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_piece"), key, "codes", "list")

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1), width)
                parts = [np.unique(np.concatenate([parts_of[j] for j in books.wanted(q, probes).tolist()])) for q in x]
                at = pa.array(np.repeat(np.arange(len(x)), [len(p) for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(np.int32)), *[c.take(at) for c in batch.columns]], names=["_part", *batch.schema.names])

        ship(spark)
        kind = {c: t for frame in (asked, rows) for c, t in ((f.name, f.dataType.simpleString()) for f in frame.schema.fields)}
        to = asked.mapInArrow(sent, f"_part int, query_id {kind['query_id']}, query array<double>").withColumn("_piece", F.pmod(F.xxhash64("query_id", "query"), F.lit(pieces)).cast("int"))

        def scored(held: pa.Table, wanting: pa.Table) -> pa.Table:
            held, wanting = held.sort_by([("list", "ascending"), (key, "ascending")]), wanting.sort_by("query_id")
            lists, x = held.column("list").to_numpy(), _matrix(wanting.column("query"), width)
            near = books.decode(lists, held.column("codes"))
            cuts = {j: np.searchsorted(lists, [j, j + 1]) for j in np.unique(lists).tolist()}
            found, value = [], []
            for a in range(0, len(x) if len(lists) else 0, STRIP):
                strip = x[a : a + STRIP]
                readers: dict[int, list[int]] = {}
                for i, q in enumerate(strip):
                    for j in books.wanted(q, probes).tolist():
                        readers.setdefault(j, []).append(i)
                unit = _unit(strip).astype(np.float32)
                scores = np.full((len(strip), len(lists)), -np.inf, np.float32)
                for j, (b, e) in cuts.items():
                    if j in readers:
                        scores[readers[j], b:e] = unit[readers[j]] @ near[b:e].T
                top = np.argpartition(-scores, most - 1, axis=1)[:, :most] if most < len(lists) else np.tile(np.arange(len(lists)), (len(strip), 1))
                values = np.take_along_axis(scores, top, axis=1)
                i, j = np.nonzero(values > -np.inf)
                found.append((a + i, top[i, j]))
                value.append(values[i, j])
            q, r = (np.concatenate([f[n] for f in found]) if found else np.zeros(0, np.int64) for n in (0, 1))
            return pa.table({"query_id": wanting.column("query_id").take(pa.array(q)), "list": held.column("list").take(pa.array(r)), key: held.column(key).take(pa.array(r)), "_near": pa.array(np.concatenate([np.zeros(0, np.float32), *value]).astype(np.float64))})

        cells = ["_part", "_piece"]
        near = own.groupBy(*cells).cogroup(to.groupBy(*cells)).applyInArrow(scored, f"query_id {kind['query_id']}, list int, `{key}` {kind[key]}, _near double")
        first = Window.partitionBy("query_id").orderBy(F.col("_near").desc(), key)
        near = near.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= most).select("query_id", "list", key).dropDuplicates()
        # queries may be many: what meets by their id is dealt out, not broadcast
        pairs = near.join(rows.select("list", key, self.vector), ["list", key]).join(asked.hint("merge"), "query_id")
        dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
        v, q = F.col(self.vector), F.col("query")
        exact = pairs.withColumn("similarity", dot(v, q) / (F.sqrt(dot(v, v)) * F.sqrt(dot(q, q))))
        order = Window.partitionBy("query_id").orderBy(F.col("similarity").desc(), key)
        return exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", key, "similarity")


def _dealt(counts: dict[int, int], lists: int, most: int) -> tuple[list[int], list[int]]:
    """The first part of each list and over how many parts it goes: about ``most`` rows in each."""
    firsts, slices, part, held = [0] * lists, [1] * lists, 0, 0
    for x in range(lists):
        n = counts.get(x, 0)
        if held and held + n > most:
            part, held = part + 1, 0
        firsts[x], slices[x] = part, max(1, math.ceil(n / most))
        part, held = (part + slices[x], 0) if n > most else (part, held + n)
    return firsts, slices


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each as rows."""
    return np.asarray((column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten(), np.float64).reshape(-1, width)


def _id_type(queries: list) -> str:
    return "string" if any(isinstance(i, str) for i, _ in queries) else "long"
