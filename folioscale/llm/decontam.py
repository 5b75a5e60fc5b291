"""Benchmark decontamination with suffix arrays of the training words.

Each shard of documents (a few megabytes of text) gets a suffix array of all
its words, in order to the depth of the longest test item. Every test suffix
that can hold a window is narrowed in it word by word with binary searches. At
the depth of its window the range holds all places of that window; windows of
one item that follow each other in a document make one longer verbatim match,
and a document's matches are returned with their places. Words are compared by
64-bit hashes in the searches; what matches is then compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import arrow_map

#: Words in a window of the contract.
WINDOW = 13
#: Test items are sent to the executors in blocks of at most this many bytes of text, each with a pass over the documents.
BLOCK_BYTES = 16 << 20
#: Bytes of text in a shard, about; a longer document is a shard of its own.
SHARD_BYTES = 4 << 20


class TestSuffixes:
    """Test items as arrays: their words, and the suffixes that hold a window."""

    __test__ = False

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        column = pa.array(texts, pa.string())
        hashes, sizes, spelled, lengths = [], [], [], []
        for _, _, words in tokens.pieces(column, "alnum"):
            h = words.hashes()
            hashes.append(h)
            sizes.append(np.diff(words.rows))
            known, at = np.unique(h, return_index=True)
            spelled += [tokens.LOWER[words.data[x:y]].tobytes() for x, y in zip(words.starts[at], words.ends[at], strict=True)]
            lengths.append(known)
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        self.ids = ids
        self.words = join(hashes, np.uint64)
        size = join(sizes, np.int64)
        begin = np.cumsum(size) - size
        #: words of the window of each item, and the longest item
        self.window = np.minimum(size, window)
        self.longest = int(size.max(initial=0))
        starts = np.where(size > 0, size - self.window + 1, 0)
        self.item = np.repeat(np.arange(len(size)), starts)
        self.at = np.arange(len(self.item)) - np.repeat(np.cumsum(starts) - starts, starts)
        self.first = begin[self.item] + self.at
        self.length = size[self.item] - self.at
        # how each word is spelled, in the order of the hashes
        self.known, keep = np.unique(join(lengths, np.uint64), return_index=True)
        spelled = [spelled[i] for i in keep]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_at = np.cumsum([0, *map(len, spelled)])


def suffix_array(words: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all suffixes in the order of their first ``depth`` words; the distinct words; the number of each place's word.

    A suffix ends with its document, and a shorter one goes before its
    continuations. Ranks are doubled: each round sorts what is still equal by
    the ranks that lie as far ahead as the ranks so far reach.
    """
    known, number = np.unique(words, return_inverse=True)
    n = len(words)
    order = np.argsort(number, kind="stable")
    ordered = number[order]
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    reach = 1
    while reach < depth and n:
        # places in a group of more than one, in the order so far
        alone = fresh & np.append(fresh[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        place = order[slots]
        ahead = place + reach
        key = rank[place] * (n + 1) + np.where(ahead < ends[place], rank[np.minimum(ahead, n - 1)], 0)
        by = np.argsort(key, kind="stable")
        key = key[by]
        order[slots] = place[by]
        change = np.ones(len(slots), dtype=bool)
        change[1:] = key[1:] != key[:-1]
        fresh[slots] = change
        rank[place[by]] = np.maximum.accumulate(np.where(change, slots, 0)) + 1
        reach *= 2
    return order, known, number


def search(order: np.ndarray, number: np.ndarray, ends: np.ndarray, test: np.ndarray, first: np.ndarray, length: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each test suffix: the range of suffixes that begin with its window, and how many words of it match at most.

    ``test`` holds the numbers of the test words (-1: not in the shard), and a
    suffix the ``length`` words from ``first``.
    """
    n = len(first)
    matched = np.zeros(n, np.int64)
    at_window = np.zeros((2, n), np.int64)
    heads = number[order]
    lo, hi = np.searchsorted(heads, test[first], "left"), np.searchsorted(heads, test[first], "right")
    hi = np.where(test[first] < 0, lo, hi)

    def bound(a: np.ndarray, b: np.ndarray, value: np.ndarray, depth: int, right: bool) -> np.ndarray:
        a, b = a.copy(), b.copy()
        todo = np.flatnonzero(a < b)
        while len(todo):
            mid = (a[todo] + b[todo]) >> 1
            place = order[mid]
            x = np.where(place + depth < ends[place], number[np.minimum(place + depth, len(number) - 1)], -1)
            below = (x <= value[todo]) if right else (x < value[todo])
            a[todo[below]] = mid[below] + 1
            b[todo[~below]] = mid[~below]
            todo = todo[a[todo] < b[todo]]
        return a

    live, depth = np.flatnonzero(lo < hi), 1
    while len(live):
        matched[live] = depth
        whole = live[window[live] == depth]
        at_window[:, whole] = lo[whole], hi[whole]
        live = live[length[live] > depth]
        value = test[first[live] + depth]
        live, value = live[value >= 0], value[value >= 0]
        a, b = bound(lo[live], hi[live], value, depth, False), bound(lo[live], hi[live], value, depth, True)
        lo[live], hi[live] = a, b
        live = live[a < b]
        depth += 1
    return at_window[0], at_window[1], matched


def _spelled_alike(words: tokens.Words, places: np.ndarray, hashes: np.ndarray, test: TestSuffixes) -> np.ndarray:
    """Whether the words at ``places`` are spelled as the test words of the same hash."""
    known = np.minimum(np.searchsorted(test.known, hashes), len(test.known) - 1)
    size = words.ends[places] - words.starts[places]
    alike = size == np.diff(test.spelled_at)[known]
    for i in range(int(size.max(initial=0))):
        at = np.flatnonzero(alike & (size > i))
        alike[at] = tokens.LOWER[words.data[words.starts[places[at]] + i]] == test.spelled[test.spelled_at[known[at]] + i]
    return alike


def matches(words: tokens.Words, test: TestSuffixes) -> tuple[np.ndarray, ...]:
    """(row, place in the row, item, place in the item, words) of all maximal verbatim matches from a window on."""
    h, bounds = words.hashes(), words.rows
    size = np.diff(bounds)
    ends = np.repeat(bounds[1:], size)
    order, known, number = suffix_array(h, ends, test.longest)
    at = np.minimum(np.searchsorted(known, test.words), len(known) - 1)
    numbers = np.where(known[at] == test.words, at, -1)
    lo, hi, _ = search(order, number, ends, numbers, test.first, test.length, test.window[test.item])
    found = np.flatnonzero(lo < hi)
    each = hi[found] - lo[found]
    suffix = np.repeat(found, each)
    place = order[np.repeat(lo[found], each) + np.arange(len(suffix)) - np.repeat(np.cumsum(each) - each, each)]
    item, start = test.item[suffix], test.at[suffix]
    # a window whose words are not all spelled alike is none
    held = np.zeros(len(h) + 1, np.int64)
    np.add.at(held, place, 1)
    np.add.at(held, place + test.window[item], -1)
    used = np.flatnonzero(np.cumsum(held)[:-1] > 0)
    wrong = np.zeros(len(h) + 1, np.int64)
    wrong[used + 1] = ~_spelled_alike(words, used, h[used], test)
    wrong = np.cumsum(wrong)
    right = wrong[place + test.window[item]] == wrong[place]
    item, start, place = item[right], start[right], place[right]
    # windows that follow each other in both texts are one match
    row = np.searchsorted(bounds, place, side="right") - 1
    by = np.lexsort((place, place - start, item, row))
    row, item, start, place = row[by], item[by], start[by], place[by]
    fresh = np.ones(len(by), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(fresh)
    run = np.diff(np.append(head, len(by)))
    return row[head], place[head] - bounds[row[head]], item[head], start[head], run + test.window[item[head]] - 1


MATCH = "array<struct<item: string, at: bigint, item_at: bigint, words: bigint>>"


def _scan_batches(test: TestSuffixes, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words = np.zeros(n, np.int64)
            found: list[list[dict]] = [[] for _ in range(n)]
            for first, _, words in tokens.pieces(batch.column(1), "alnum", shard_bytes):
                bounds = words.rows
                n_words[first : first + len(bounds) - 1] = np.diff(bounds)
                if len(test.first) and len(words.starts):
                    for row, at, item, item_at, size in zip(*(x.tolist() for x in matches(words, test)), strict=True):
                        found[first + row].append({"item": test.ids[item], "at": at, "item_at": item_at, "words": size})
            kind = pa.list_(pa.struct([("item", pa.string()), ("at", pa.int64()), ("item_at", pa.int64()), ("words", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(found, kind), *(batch.column(i) for i in range(2, batch.num_columns))], names=["_row", "n_words", "found", *batch.schema.names[2:]])

    return run


def _test_blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[str | None]]]:
    """Test items in blocks of bounded size, streamed to the driver."""
    ids: list[str] = []
    texts: list[str | None] = []
    size = 0
    rows = bench.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).filter(F.col(id_col).isNotNull()).toLocalIterator()
    for i, t in rows:
        ids.append(i)
        texts.append(t)
        size += len(t or "") + 16
        if size >= block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids or not size:
        yield ids, texts


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row for each row of ``docs``: the id, n_words, n_hit, n_items, items_sha256, longest_match, matches, contaminated.

    A document is contaminated if at least one word and at least a twentieth of
    its words lie in occurrences of test windows. ``matches`` holds every
    maximal verbatim match from a window on (item, word place in the document,
    word place in the item, words), ``longest_match`` the words of the longest,
    0 without any. Null and empty texts have no words and are clean. Test items
    without id or words are not searched; of items that share an id each is.
    Without test items every document is clean; items_sha256 is then that of an
    empty text. Repeated rows are judged alike.
    """
    cols = docs.select(F.col(id_col).alias("_row"), F.col(text_col).cast("string").alias("_text"))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_row {kind}, n_words long, found {MATCH}"
    passes = [_scan_batches(TestSuffixes(ids, texts, window), shard_bytes) for ids, texts in _test_blocks(bench, item_col, item_text_col, block_bytes)]
    if len(passes) == 1:
        found = arrow_map(cols, passes[0], schema)
    else:  # one pass for each block of test items; equal rows merge and are counted
        marked = cols.withColumn("_mark", F.xxhash64("_text"))
        each = reduce(DataFrame.unionByName, [arrow_map(marked, run, f"{schema}, _mark long") for run in passes])
        merged = each.groupBy("_row", "n_words", "_mark").agg(F.flatten(F.collect_list("found")).alias("all"), (F.count("*") / len(passes)).cast("int").alias("_n"))
        found = merged.select("_row", "n_words", F.array_distinct("all").alias("found"), F.explode(F.sequence(F.lit(1), "_n"))).drop("col")

    def cover(s, x):  # words up to the end of what came before count once
        end = x["at"] + x["words"]
        return F.struct((s["hit"] + F.greatest(F.lit(0).cast("long"), end - F.greatest(s["end"], x["at"]))).alias("hit"), F.greatest(s["end"], end).alias("end"))

    nothing = F.lit(0).cast("long")
    hit = F.aggregate(F.array_sort(F.transform("found", lambda x: F.struct(x["at"].alias("at"), x["words"].alias("words")))), F.struct(nothing.alias("hit"), nothing.alias("end")), cover)["hit"]
    items = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item"])))
    return found.select(
        F.col("_row").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["words"])), nothing).alias("longest_match"),
        F.col("found").alias("matches"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns.

    Each row is judged on its own text: rows may share a doc_id or have none.
    """
    key = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    judged = contamination(docs.select(key.alias("_key"), F.col("text").alias("_text")), bench, "_key", "_text")
    found = judged.filter("contaminated").select("_key").distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("_key"))
    return packed.join(found, "_key", "left_anti").select("row.*")
