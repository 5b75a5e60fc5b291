"""A positional trigram index: substring and keyword search that reads only the texts that can match.

For each three characters of a lower-cased text the index holds their places, as
differences in bytes of seven bits. Texts are taken in blocks, and a trigram has one
row for all texts of a block. A search takes the rarest trigrams of what it looks
for, brings their rows together by block, keeps the texts in which the places fit
together, and looks at those texts themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.text import search_words
from ..session import ship
from ..sources.catalog import Catalog
from .search import match_score

#: Partitions of the postings; a search reads those of its trigrams.
SHARDS = 31
#: Trigrams that one search joins, the rarest.
MOST = 6
#: Characters of the texts of a block, about; a longer text is a block of its own.
BLOCK = 1 << 22
BITS = 21
# A sigma is lower-cased by what follows it; the index does not tell its two forms apart.
ONE_SIGMA = str.maketrans("ς", "σ")


def grams(text: str) -> np.ndarray:
    """The trigrams of a lower-cased text by their places, each packed into one number."""
    c = np.frombuffer(text.translate(ONE_SIGMA).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return (c[:-2] << (2 * BITS)) | (c[1:-1] << BITS) | c[2:] if len(c) > 2 else np.zeros(0, np.int64)


def pack(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Numbers below 2**35 as bytes of seven bits, the last with its high bit unset; and where each begins."""
    values = values.astype(np.uint64)
    sizes = 1 + sum((values >= np.uint64(1 << 7 * i)).astype(np.int64) for i in range(1, 5))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for i in range(5):
        own = sizes > i
        more = (sizes[own] > i + 1).astype(np.uint8) << 7
        out[(ends - sizes)[own] + i] = ((values[own] >> np.uint64(7 * i)) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes(), ends - sizes


def unpack(data: bytes) -> np.ndarray:
    """The places that ``pack`` has the differences of."""
    b = np.frombuffer(data, np.uint8)
    last = b < 128
    begins = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1]) if len(b) else np.zeros(0, np.int64)
    of = np.cumsum(np.concatenate([[0], last[:-1]])) if len(b) else begins
    shifted = (b & 127).astype(np.int64) << (7 * (np.arange(len(b)) - begins[of])) if len(b) else begins
    return np.cumsum(np.add.reduceat(shifted, begins)) if len(b) else begins


class TextIndex:
    """Texts by key, with their postings and how many texts hold each trigram, as three tables."""

    def __init__(self, catalog: Catalog, namespace: str, name: str, key: str = "id", text: str = "text"):
        self.namespace, self.name, self.key, self.text = namespace, name, key, text
        self.catalog, self.sharded = catalog, Catalog(catalog.spark, partition="shard")

    def postings(self, rows: DataFrame) -> DataFrame:
        """gram, block, keys, n, places: a row for each trigram of each block of texts, with how many places each text has; texts never travel.

        A block is known by the first of its keys.
        """
        key, most = self.key, BLOCK
        kind = rows.schema[key].dataType

        def of_block(keys: list, found: list[tuple]) -> pa.RecordBatch:
            gram, n, sizes = (np.concatenate([f[i] for f in found]) for i in range(3))
            data = np.concatenate([f[3] for f in found])
            own = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            order = np.argsort(gram, kind="stable")
            begins, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
            ends = np.cumsum(sizes)
            data = data[np.repeat(begins - (ends - sizes), sizes) + np.arange(len(data))]
            gram = gram[order]
            first = np.flatnonzero(np.diff(gram, prepend=gram[0] - 1))
            counts, places = pack(n[order])
            counts = np.frombuffer(counts, np.uint8)
            cut = lambda at, last: np.concatenate([at[first], [last]]).astype(np.int32)
            binary = lambda at, of: pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(of.tobytes())])
            arrow = to_arrow_type(kind)
            held = pa.ListArray.from_arrays(pa.array(np.concatenate([first, [len(gram)]]).astype(np.int32)), pa.array(keys, arrow).take(pa.array(own[order])))
            block = pa.array([keys[0]], arrow).take(pa.array(np.zeros(len(first), np.int64)))
            return pa.RecordBatch.from_arrays([pa.array(gram[first]), block, held, binary(cut(places, len(counts)), counts), binary(cut(ends - sizes, len(data)), data)], names=["gram", "block", "keys", "n", "places"])

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, found, held = [], [], 0
            for batch in batches:
                for a in range(len(batch)):
                    text = batch.column(1)[a].as_py()
                    g = grams(text) if text else np.zeros(0, np.int64)
                    if not len(g):
                        continue
                    if found and held + len(g) > most:
                        yield of_block(keys, found)
                        keys, found, held = [], [], 0
                    order = np.argsort(g, kind="stable")
                    first = np.flatnonzero(np.diff(g[order], prepend=g[order][0] - 1))
                    steps = np.diff(order, prepend=0)
                    steps[first] = order[first]
                    data, begins = pack(steps)
                    sizes = np.diff(np.concatenate([begins[first], [len(data)]]))
                    keys.append(batch.column(0)[a].as_py())
                    found.append((g[order][first], np.diff(np.concatenate([first, [len(g)]])), sizes, np.frombuffer(data, np.uint8)))
                    held += len(g)
            if found:
                yield of_block(keys, found)

        ship(self.catalog.spark)
        low = rows.select(key, F.lower(self.text).alias("_low"))
        return low.mapInArrow(listed, f"gram long, block {kind.simpleString()}, keys array<{kind.simpleString()}>, n binary, places binary")

    def build(self, rows: DataFrame) -> None:
        """Store texts and postings in the place of what was there. Keys are unique; rows with a null key are left out, a null text is never found."""
        self.catalog.replace(self.namespace, self.name, rows.filter(F.col(self.key).isNotNull()))
        held = self.catalog.read(self.namespace, self.name)
        found = self.postings(held).withColumn("shard", (F.col("gram") % SHARDS).cast("int"))
        # postings stay where their texts are read: each task's are files of their own, in order, and no posting is shuffled
        self.sharded.replace(self.namespace, f"{self.name}_postings", found.sortWithinPartitions("shard", "gram", "block"))
        counts = self.sharded.read(self.namespace, f"{self.name}_postings").groupBy("shard", "gram").agg(F.sum(F.size("keys")).alias("texts"))
        self.sharded.replace(self.namespace, f"{self.name}_grams", counts.select("gram", "texts", "shard").sortWithinPartitions("shard", "gram"))

    def _of_shard(self, table: str, wanted: list[int]) -> DataFrame:
        shards = sorted({g % SHARDS for g in wanted})
        return self.sharded.read(self.namespace, f"{self.name}_{table}").filter(F.col("shard").isin(shards) & F.col("gram").isin(wanted))

    def candidates(self, part: str) -> DataFrame | None:
        """key, places: the texts in which the rarest trigrams of a lower-cased string stand as in it; None if it has no trigram."""
        own = grams(part).tolist()
        if not own:
            return None
        first = {g: i for i, g in reversed(list(enumerate(own)))}
        held = {r.gram: r.texts for r in self._of_shard("grams", list(first)).select("gram", "texts").collect()}
        rare = sorted(first, key=lambda g: (held.get(g, 0), first[g]))[:MOST]
        key, spark = self.key, self.catalog.spark
        kind = self.catalog.read(self.namespace, self.name).schema[key].dataType
        if held.get(rare[0], 0) == 0:
            return spark.createDataFrame([], f"`{key}` {kind.simpleString()}, places array<int>")
        # rows of a block meet; a block that lacks one of the trigrams has no text with all of them
        rows = self._of_shard("postings", rare).groupBy("block").agg(F.collect_list(F.struct("gram", "keys", "n", "places")).alias("rows")).filter(F.size("rows") == len(rare))

        def texts_of(row: dict) -> dict[object, np.ndarray]:
            # how many places there are up to each text's last, and where that ends
            data = row["places"]
            ends = (np.flatnonzero(np.frombuffer(data, np.uint8) < 128)[unpack(row["n"]) - 1] + 1).tolist()
            return {k: data[a:b] for k, a, b in zip(row["keys"], [0, *ends[:-1]], ends, strict=True)}

        def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, places = [], []
                for a in range(len(batch)):
                    held = {r["gram"]: texts_of(r) for r in batch.column(0)[a].as_py()}
                    lists = [held[g] for g in rare]
                    for k in lists[0]:
                        if not all(k in x for x in lists):
                            continue
                        at = reduce(lambda x, y: np.intersect1d(x, y, assume_unique=True), [unpack(x[k]) - first[g] for g, x in zip(rare, lists, strict=True)])
                        if len(at):
                            keys.append(k)
                            places.append(at.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(keys, to_arrow_type(kind)), pa.array(places, pa.list_(pa.int32()))], names=[key, "places"])

        return rows.select("rows").mapInArrow(fitting, f"`{key}` {kind.simpleString()}, places array<int>")

    def _texts(self, part: str) -> DataFrame:
        """The rows that hold a string, whatever the case: read from the candidates, or from all texts where it has no trigram."""
        rows, found = self.catalog.read(self.namespace, self.name), self.candidates(part)
        rows = rows if found is None else rows.join(found.select(self.key), self.key, "left_semi")
        return rows.filter(F.lower(self.text).contains(part))

    def holding(self, part: str) -> DataFrame:
        """Rows whose text holds ``part``, whatever the case; % and _ are plain characters, an empty string is in every text."""
        return self._texts(part.lower())

    def keyword_all(self, query: str, limit: int) -> DataFrame:
        """Rows with every word of a query, the shortest first; no usable word, no rows."""
        words = search_words(query)
        rows = self.catalog.read(self.namespace, self.name)
        if not words:
            return rows.limit(0)
        for w in sorted(set(words), key=len, reverse=True):
            rows = rows.join(self.candidates(w).select(self.key), self.key, "left_semi")
        whole = reduce(lambda a, w: a & F.lower(self.text).contains(w), words, F.lit(True))
        return rows.filter(whole).orderBy(F.length(self.text), self.key).limit(limit)

    def keyword_any(self, query: str, limit: int) -> DataFrame:
        """Rows with any word of a query and their ``score``, those with most first."""
        words = search_words(query)
        rows = self.catalog.read(self.namespace, self.name)
        if not words:
            return rows.withColumn("score", F.lit(0)).limit(0)
        keys = reduce(DataFrame.unionByName, [self.candidates(w).select(self.key) for w in sorted(set(words))]).distinct()
        scored = rows.join(keys, self.key, "left_semi").withColumn("score", match_score(F.col(self.text), words))
        return scored.filter("score > 0").orderBy(F.col("score").desc(), self.key).limit(limit)
