"""Exact top-k inner products with an M-tree.

Candidates get one more coordinate so that all have the length of the longest
vector; then the nearest in Euclidean distance have the highest inner
products, and a metric tree serves. Vectors are dealt by their nearest pivot
(a bounded sample) and, where a pivot draws many, by hash. Each part is one
subtree of paged nodes that keep covering radii and the distance of every
entry to its parent. A query first searches the part it is nearest to, and
then, with the bound from there, only the parts that its bound reaches.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import arrow_map, written

#: Pivots at most, a sample by hash; every vector is indexed below one of them. There is one for every ``PART`` vectors, but ``LEAST_PIVOTS`` where they are fewer.
PIVOTS, LEAST_PIVOTS = 1024, 64
#: Vectors in a part, about; a pivot with more has several parts.
PART = 8192
#: Entries in a page.
PAGE = 64
#: Queries searched together.
QUERY_BLOCK = 256
_EPS = 1e-6


class MTree:
    """An M-tree over the rows of ``points``, bulk-loaded from the root down."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, page: int = PAGE):
        self.points, self.ids, self.page = points, ids, page
        self.nodes: list[dict] = []
        self.computed = self.avoided = 0
        self.root = self._build(np.arange(len(points)), points[0] if len(points) else None)

    def _distance(self, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
        x = self.points[rows] - to
        return np.sqrt(np.einsum("ij,ij->i", x, x))

    def _build(self, rows: np.ndarray, parent: np.ndarray | None) -> int:
        """A page: leaf entries with their parent distances, or routing entries with radius, parent distance and child page."""
        number = len(self.nodes)
        self.nodes.append({})
        if len(rows) <= self.page:
            self.nodes[number] = {"rows": rows, "to_parent": self._distance(rows, parent) if len(rows) else np.zeros(0)}
            return number
        # routing objects far from each other
        chosen = [int(rows[0])]
        nearest = self._distance(rows, self.points[chosen[0]])
        owner = np.zeros(len(rows), np.int64)
        for k in range(1, min(self.page, max(2, len(rows) // self.page + 1))):
            far = int(nearest.argmax())
            if nearest[far] <= 0:
                break
            chosen.append(int(rows[far]))
            d = self._distance(rows, self.points[chosen[-1]])
            closer = d < nearest
            nearest[closer], owner[closer] = d[closer], k
        groups = [rows[owner == k] for k in range(len(chosen))]
        if len(chosen) == 1:  # all vectors alike
            groups = [rows[i : i + self.page] for i in range(0, len(rows), self.page)]
            chosen = [int(g[0]) for g in groups]
        routing = np.array(chosen)
        radius = np.array([self._distance(g, self.points[c]).max() for g, c in zip(groups, chosen, strict=True)])
        self.nodes[number] = {"routing": routing, "radius": radius, "to_parent": self._distance(routing, parent), "child": [self._build(g, self.points[c]) for g, c in zip(groups, chosen, strict=True)]}
        return number

    def search(self, query: np.ndarray, k: int, own: int | None, score_of, bound: float, highest) -> list[tuple[int, int]]:
        """The k best (score, id) at or above ``bound``, best first. ``highest`` turns a distance below every member's into the most they can score."""
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        heap = [(0.0, 0, self.root, 0.0)]
        floor = bound
        if not len(self.points):
            return []
        heap = [(0.0, 0, self.root, float(np.sqrt(((self.points[0] - query) ** 2).sum())))]
        serial = 1
        while heap:
            least, _, number, d_parent = heapq.heappop(heap)
            if highest(least) < floor:
                break  # best first: nothing else reaches the bound
            node = self.nodes[number]
            if "rows" in node:
                # |d(q, p) - d(x, p)| is a lower bound that needs no computation
                rows = node["rows"]
                near = highest(np.abs(d_parent - node["to_parent"])) >= floor
                self.avoided += int((~near).sum())
                rows = rows[near]
                self.computed += len(rows)
                if not len(rows):
                    continue
                score, ids = score_of(rows), self.ids[rows]
                ok = score >= floor
                if ok.sum() > 4 * k:  # what is below the page's own k best, and one more for the query itself, is none of them
                    ok &= score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                for s, i in zip(score[ok].tolist(), ids[ok].tolist(), strict=True):
                    if i == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
                if len(best) == k:
                    floor = max(floor, best[0][0])
                continue
            reach = np.maximum(0, np.abs(d_parent - node["to_parent"]) - node["radius"])
            open_ = np.flatnonzero(highest(reach) >= floor)
            self.avoided += len(reach) - len(open_)
            self.computed += len(open_)
            d = self._distance(node["routing"][open_], query)
            low = np.maximum(least, np.maximum(0, d - node["radius"][open_]))
            for i, x, y in zip(open_.tolist(), low.tolist(), d.tolist(), strict=True):
                heapq.heappush(heap, (x, serial, node["child"][i], y))
                serial += 1
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _extended(x: np.ndarray, most: float) -> np.ndarray:
    """Candidates with one more coordinate, so that all have the length sqrt(most)."""
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0, most - (x * x).sum(axis=1)))])


def _part_tree(ints: np.ndarray, ids: np.ndarray, most: float) -> bytes:
    """A part's tree and vectors; its points are made of the vectors again, and these are stored in as few bytes as they need."""
    tree = MTree(_extended(ints, most), ids)
    tree.points = None
    high = int(np.abs(ints).max()) if ints.size else 0
    return pickle.dumps((tree, ints.astype(np.int16 if high < 1 << 15 else np.int32 if high < 1 << 31 else np.int64)))


def _loaded(blob: bytes, most: float) -> tuple[MTree, np.ndarray]:
    tree, ints = pickle.loads(blob)
    ints = ints.astype(np.int64)
    tree.points = _extended(ints, most)
    return tree, ints


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component; vectors that are null, empty, or hold null or non-finite components are left out."""
    ok = F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ~F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    floor = F.transform(vec_col, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return df.filter(ok & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), floor.alias("v"))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(np.int64) if len(column) else np.zeros((0, 1), np.int64)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten())
    return flat.reshape(len(column), -1)


def top_k(df: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS, part: int = PART) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; a query's own id
    is no candidate for it. Vectors that are null, empty, or hold null or
    non-finite components, rows without id, and vectors of another length than
    the query's take no part. Of rows with one id each is a candidate, and the
    smallest vector, shorter ones first, is the id's query. With fewer
    candidates than k, all are returned.
    """
    vectors = written(integer_vectors(df, id_col, vec_col, scale).withColumn("dim", F.size("v")).withColumn("norm", F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)), "vectors")
    spark = vectors.sparkSession
    out = T.StructType.fromDDL("query_id long, vec_id long, score long")
    asked = vectors.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q"))
    asked = written(asked.select("id", "q.dim", "q.v"), "queries")
    done = None
    # one index for each vector length (embeddings have one); only lengths and their largest norms come to the driver
    for dim, most, n in vectors.groupBy("dim").agg(F.max("norm"), F.count("*")).orderBy("dim").collect():
        found = _top_k_of(vectors.filter(F.col("dim") == dim).select("id", "v"), asked.filter(F.col("dim") == dim).select("id", "v"), float(most), n, k, min(pivots, max(LEAST_PIVOTS, -(-n // part))), part)
        done = found if done is None else done.unionByName(found)
    if done is None:
        done = spark.createDataFrame([], out)
    # each part has given k at most, so a query has as many rows here as k times the parts in its reach
    ranked = done.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k).alias("best"))
    flat = ranked.select("query_id", F.posexplode("best").alias("at", "x"))
    return flat.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.minus")).alias("score"))


def _top_k_of(vectors: DataFrame, asked: DataFrame, most: float, n: int, k: int, pivots: int, part: int) -> DataFrame:
    # a share of all rows first: every task would send as many rows as there are pivots to the driver
    share = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 40)) <= (1 << 40) * min(1.0, 4 * pivots / n)
    sample = vectors.filter(share).orderBy(F.xxhash64("id", F.lit(7)), "id").limit(pivots).collect() or vectors.limit(1).collect()
    centre = _extended(np.array([r.v for r in sample], dtype=np.int64), most)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = (centre * centre).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _extended(_matrix(batch.column(1)), most)
            d = np.maximum(0, (x * x).sum(axis=1)[:, None] + square - 2 * x @ centre.T)
            node = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(node.astype(np.int32)), pa.array(np.sqrt(d[np.arange(len(x)), node]))], names=["id", "v", "node", "far"])

    dealt = written(arrow_map(vectors, assign, "id long, v array<long>, node int, far double"), "dealt")
    # of each pivot: how many vectors, and the covering radius; at most ``pivots`` rows
    about = {r.node: (r.n, r.radius) for r in dealt.groupBy("node").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()}
    parts = {node: max(1, -(-n // part)) for node, (n, _) in about.items()}
    count = F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col("node"))
    tasks = min(sum(parts.values()), 1024)
    keyed = dealt.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(11)), count).cast("int"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": pdf["node"].iloc[:1], "salt": pdf["salt"].iloc[:1], "tree": [_part_tree(_matrix(pdf["v"]), pdf["id"].to_numpy(), most)]})

    trees = written(keyed.select("node", "salt", "id", "v").groupBy("node", "salt").applyInPandas(build, "node int, salt int, tree binary"), "trees")
    radius = np.array([about.get(i, (0, -np.inf))[1] for i in range(len(centre))])

    def search(pdf: pd.DataFrame) -> Iterator[tuple[int, int, int]]:
        for blob, queries in zip(pdf["tree"], pdf["queries"], strict=True):
            tree, ints = _loaded(blob, most)
            for row in queries:
                q = np.array(row["v"], dtype=np.int64)
                extended = np.append(q.astype(np.float64), 0.0)
                length = float((q * q).sum())

                def highest(d):
                    return (length + most - np.maximum(0, d - _EPS) ** 2) / 2 + _EPS * (1 + abs(most))  # noqa: B023

                bound = -np.inf if row["bound"] is None else row["bound"]
                for s, i in tree.search(extended, k, row["id"], lambda rows: ints[rows] @ q, bound, highest):  # noqa: B023
                    yield row["id"], i, s

    def search_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1).to_pydict()
                rows = list(search(one))
                cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])

    def searched(queries: DataFrame) -> DataFrame:
        """``queries``: node, id, v, bound. They meet each part of their node in blocks.

        Blocks hold the vector of a query for every node in its reach, which files
        and estimates show as far smaller than it is: both sides are dealt by part,
        none is broadcast.
        """
        block = F.floor(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.greatest(F.lit(1), F.lit((1 << 20) * QUERY_BLOCK) / F.col("n_queries"))).cast("int")
        load = queries.groupBy("node").agg(F.count("*").alias("n_queries"))
        blocks = queries.join(load, "node").groupBy("node", block.alias("block")).agg(F.collect_list(F.struct("id", "v", "bound")).alias("queries"))
        each = blocks.select("node", F.explode(F.sequence(F.lit(0), count - 1)).alias("salt"), "queries")
        met = trees.repartition(tasks, "node", "salt").join(each.repartition(tasks, "node", "salt").hint("merge"), ["node", "salt"])
        return arrow_map(met.select("tree", "queries"), search_batches, "query_id long, vec_id long, score long")

    queries = dealt.join(asked, ["id", "v"], "left_semi").dropDuplicates(["id"]).select("node", "id", "v")
    home = written(searched(queries.withColumn("bound", F.lit(None).cast("double"))), "home")
    bound = home.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(-F.col("score"))), k, 1).alias("b")).select(F.col("query_id").alias("id"), (-F.get("b", F.lit(0))).cast("double").alias("bound"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square = (centre * centre).sum(axis=1)
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column(2)).astype(np.float64)
            length = (q * q).sum(axis=1)
            d = np.sqrt(np.maximum(0, length[:, None] + square - 2 * q @ centre[:, :-1].T))
            least = np.maximum(0, d - radius - _EPS)
            bounds = np.array([-np.inf if x is None else x for x in batch.column(3).to_pylist()])
            open_ = ((length[:, None] + most - least**2) / 2 + _EPS * (1 + most) >= bounds[:, None]) & np.isfinite(radius)
            open_[np.arange(len(q)), np.asarray(batch.column(0))] = False  # searched already
            at, node = np.nonzero(open_)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(node.astype(np.int32)), *(batch.column(i).take(at) for i in (1, 2, 3))], names=["node", "id", "v", "bound"])

    routed = written(arrow_map(queries.join(bound, "id", "left").select("node", "id", "v", "bound"), route, "node int, id long, v array<long>, bound double"), "routed")
    away = searched(routed)
    return home.unionByName(away)
