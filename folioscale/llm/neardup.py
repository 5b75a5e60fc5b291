"""Near-duplicate groups with HyperMinHash.

A document's shingle set is split over 128 buckets by hash. Of the smallest
hash in each bucket a register keeps the count of leading zeros and ten
mantissa bits. Bands of registers deal candidates, the collision-corrected
Jaccard estimate drops the hopeless ones, and the rest are confirmed on the
full sets.

Band layouts depend on the set size. If a set of n shingles has a partner of
similarity t, at most n(1-t)/t shingles differ, and each differing shingle can
spoil one register; with more bands than that, some band is whole. A band
whose registers are all empty deals nothing, so a set with no more filled bands
than shingles may differ is dealt by its smallest shingle hashes too: partners
share one of the floor(n(1-t))+1 smallest. So small sets lose no link. From there on 32 bands of 4 registers miss a pair of
similarity 0.85 with a chance under 1e-10 (0.8: 5e-8).

Texts with equal sets are one class from the start. Every class of a band group
is compared with the group's smallest, and what that links is contracted. A
group that still holds several components is open. Open classes meet by a
prefix filter: their shared shingles are ordered from rare to frequent, and two
sets of similarity t share one of their first, at places that leave room for
the overlap. What meets there is confirmed on the full sets, so no link is lost
and no group gives all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .shared import arrow_map, written

BUCKETS = 128
MANTISSA = 10
_REST = 64 - 7  # bits of a hash behind its bucket
#: Edges in a file of the rounds that find components, about.
EDGES = 200_000
LAYOUTS = ((4, 32), (8, 16), (16, 8), (32, 4))  # bands, registers in each


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a set of distinct sorted hashes; 0: empty bucket."""
    edges = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(_REST)
    at = np.searchsorted(hashes, edges)
    full = at < len(hashes)
    least = hashes[np.minimum(at, len(hashes) - 1)]
    full &= (least >> np.uint64(_REST)) == np.arange(BUCKETS, dtype=np.uint64)
    rest = least & np.uint64((1 << _REST) - 1)
    # the position of the highest bit, from the exponent of a double (the low bits cannot round it up after masking)
    high = np.frexp((rest & ~np.uint64((1 << 8) - 1)).astype(np.float64))[1]
    high = np.where(rest < 256, np.frexp(rest.astype(np.float64))[1], high)
    zeros = np.minimum(_REST - high, 62)
    shift = high - 1 - MANTISSA
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
    mantissa = mantissa & np.uint64((1 << MANTISSA) - 1)
    return np.where(full, ((zeros.astype(np.uint64) + np.uint64(1)) << np.uint64(MANTISSA)) | mantissa, np.uint64(0)).astype(np.uint16)


def shingle_sets(column, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    for a, b, words in tokens.pieces(column, "space"):
        h = words.hashes()
        grams = tokens.kgrams(h, k)
        for i in range(b - a):
            lo, hi = int(words.rows[i]), int(words.rows[i + 1])
            if hi - lo >= k:
                yield np.unique(grams[lo : hi - k + 1])
            elif hi > lo:
                yield np.array([tokens.row_sequence_hash(h[lo:hi])], dtype=np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _prefix(s: np.ndarray, sketch: np.ndarray, t: float) -> bytes | None:
    """The smallest hashes of a sorted set, where an empty band can hide a link of it."""
    n = len(s)
    differing = int(np.floor(n * (1 - t) / t + 1e-9))
    for limit, (bands, width) in zip([*layout_limits(t)[:-1], _limit(LAYOUTS[-1][0], t)], LAYOUTS, strict=True):
        # a partner in this layout's range can be as small as n * t
        if np.ceil(n * t - 1e-9) <= limit and sketch.reshape(bands, width).any(axis=1).sum() <= min(differing, bands - 1):
            return s[: int(np.floor(n * (1 - t) + 1e-9)) + 1].tobytes()
    return None


def _signature_batches(k: int, t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, mark_a, mark_b, sketch, prefix = [], [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    mark_a.append(int(tokens.mix(s).sum(dtype=np.uint64)))
                    mark_b.append(int(tokens.mix(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64)))
                regs = registers(s) if len(s) else None
                sketch.append(regs.tobytes() if len(s) else b"")
                prefix.append(_prefix(s, regs, t) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(_signed(np.array(mark_a, np.uint64))), pa.array(_signed(np.array(mark_b, np.uint64))), pa.array(sketch, pa.binary()), pa.array(prefix, pa.binary())],
                names=["doc_id", "n_shingles", "mark_a", "mark_b", "sketch", "prefix"],
            )

    return run


def signatures(docs: DataFrame, k: int, t: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a 128-bit mark of the set, the sketch of each row, and the prefix of those that need one."""
    cols = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(cols, _signature_batches(k, t), "doc_id long, n_shingles long, mark_a long, mark_b long, sketch binary, prefix binary")


def _limit(bands: int, t: float) -> int:
    # b bands are more than n(1-t)/t differing shingles; the small term is for float error at whole numbers
    return int(np.ceil(bands * t / (1 - t) - 1e-9)) - 1


def layout_limits(t: float) -> list[int]:
    """The largest smaller set for which each layout holds; none for the last."""
    return [_limit(b, t) for b, _ in LAYOUTS[:-1]] + [np.iinfo(np.int64).max]


def _band_batches(t: float):
    limits = np.array(layout_limits(t))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            if not len(ids):
                continue
            regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(len(ids), BUCKETS)
            top, low = np.searchsorted(limits, n), np.searchsorted(limits, np.ceil(n * t - 1e-9).astype(np.int64))
            for which, (bands, width) in enumerate(LAYOUTS):
                rows = np.flatnonzero((low <= which) & (which <= top))
                if not len(rows):
                    continue
                part = regs[rows].reshape(len(rows), bands, width)
                weight = tokens.BAND_WEIGHT[:width]
                keys = tokens.mix((part.astype(np.uint64) * weight).sum(axis=2, dtype=np.uint64) + (np.arange(bands, dtype=np.uint64) + np.uint64(64 * (which + 1))) * np.uint64(0xD1342543DE82EF95))
                at, band = np.nonzero(part.any(axis=2))
                yield pa.RecordBatch.from_arrays([pa.array(_signed(keys[at, band])), pa.array(ids[rows[at]])], names=["band", "id"])
            heads = [np.frombuffer(x, np.uint64) if x else np.zeros(0, np.uint64) for x in batch.column(3).to_pylist()]
            src = np.repeat(np.arange(len(ids)), [len(x) for x in heads])
            if len(src):
                yield pa.RecordBatch.from_arrays([pa.array(_signed(tokens.mix(np.concatenate(heads)))), pa.array(ids[src])], names=["band", "id"])

    return run


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register matrices less the expected chance collisions; and how many registers count."""
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    ratio = np.maximum(n, m) / np.maximum(1, np.minimum(n, m))
    # expected collisions of registers with a mantissa of r bits, for sets of sizes n and m
    chance = 0.169919487159739093975315012348 * BUCKETS * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(0, same - chance) / np.maximum(1, either), either


def _likely(j: np.ndarray, count: np.ndarray, t: float) -> np.ndarray:
    """Six standard deviations and two registers of leeway: the sets decide."""
    return j + 6 * np.sqrt(t * (1 - t) / np.maximum(1, count)) + 2 / np.maximum(1, count) >= t


def _estimate_batches(t: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {x: batch.column(i) for i, x in enumerate(batch.schema.names)}
            a, b = (np.frombuffer(b"".join(c[x].to_pylist()), np.uint16).reshape(-1, BUCKETS) for x in ("sk_a", "sk_b"))
            j, count = estimate(a, b, np.asarray(c["n_a"]), np.asarray(c["n_b"]))
            keep = _likely(j, count, t)
            yield pa.RecordBatch.from_arrays([c["a"].filter(pa.array(keep)), c["b"].filter(pa.array(keep))], names=["a", "b"])

    return run


def _set_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in shingle_sets(batch.column(1), k)], pa.binary())], names=["id", "shingles"])

    return run


def _confirm_batches(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def connected(edges: DataFrame) -> DataFrame:
    """(id, root): of every id in an edge the smallest id that it reaches.

    Alternates large-star and small-star; every round is written to the shared
    folder, and only its row count and hash sum come to the driver.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")

    def star(e: DataFrame, large: bool, files: int) -> DataFrame:
        # the smallest neighbours are written before the edges meet them, so that the join is free to split a hub
        if large:
            both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")).coalesce(files), "least")
            out = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            least = written(e.groupBy("u").agg(F.min("v").alias("m")).coalesce(files), "least")
            out = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before, now = None, mark(edges)
    while now != before and now[0]:
        files = 1 + now[0] // EDGES
        edges = written(star(written(star(edges, True, files).coalesce(files), "star"), False, files).coalesce(files), "edges")
        before, now = now, mark(edges)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, id, root, n, mark) of sets (id, root, mark, shingles)."""
    for batch in batches:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(3)]
        if sets:
            size = np.array([len(s) for s in sets])
            at = np.repeat(np.arange(len(sets)), size)
            own = [batch.column(i).take(pa.array(at)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(sets))), *own, pa.array(size[at].astype(np.int64))], names=["shingle", "id", "root", "mark", "n"])


def prefix_rows(sets: DataFrame, t: float) -> DataFrame:
    """(shingle, root, n, at, id): the prefixes of sets (id, root, shingles), written.

    All sets order their shingles alike, rare ones first; ``at`` is a shingle's
    place in a set of n. Two sets of similarity ``t`` share a shingle of both
    prefixes.
    """
    # an id may come with several sets
    rows = arrow_map(sets.select("id", "root", F.xxhash64("shingles").alias("mark"), "shingles"), _shingle_rows, "shingle long, id long, root long, mark long, n long")
    # written, so that the join is free to split a shingle that many sets hold
    shared = written(rows.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1"), "shared")
    # what a set has alone comes first in its order: its number is enough
    own = rows.join(shared.hint("merge"), "shingle").groupBy("id", "root", "mark", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("own"))
    alone = F.col("n") - F.size("own")
    first = F.slice("own", F.lit(1), F.greatest(F.lit(0), _upto(t) - alone.cast("int")))
    prefix = own.select("id", "root", "n", alone.alias("alone"), F.posexplode(first).alias("pos", "x")).select(F.col("x.shingle").alias("shingle"), "root", "n", (F.col("alone") + F.col("pos")).alias("at"), "id")
    return written(prefix.distinct(), "prefixes")


def _upto(share: float) -> Column:
    """A set meets larger partners with the first part of its prefix, and smaller ones with all of it."""
    return (F.col("n") - F.ceil(F.col("n") * F.lit(share) - F.lit(1e-9)) + 1).cast("int")


def prefix_pairs(prefix: DataFrame, t: float, every: bool) -> DataFrame:
    """(a, b): sets of different roots that can have similarity ``t``, from ``prefix_rows``.

    With the first shared shingle at place i of a set of n and place j of one of
    m, both counted from 0, the overlap is at most min(n - i, m - j), and
    t (n + m) / (1 + t) is needed. Sets of one root that agree in size and place
    stand for each other until then; unless ``every``, only the smallest of them
    comes out.
    """
    place = ["shingle", "root", "n", "at"]
    entries = written(prefix.groupBy(*place).agg(F.min("id").alias("id")), "entries")
    x, y = entries.alias("x"), entries.filter(F.col("at") < _upto(2 * t / (1 + t))).alias("y")
    room = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at")) >= (F.col("x.n") + F.col("y.n")) * F.lit(t / (1 + t)) - F.lit(1e-9)
    fits = (F.col("x.n") >= F.col("y.n")) & (F.col("y.n") >= F.col("x.n") * F.lit(t) - F.lit(1e-9)) & room
    met = x.join(y.hint("merge"), (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.root") != F.col("y.root")) & fits)
    if every:
        sides = written(met.select(F.col("x.shingle").alias("shingle"), *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in "xy" for c in place[1:]]), "met")
        for s, name in (("x", "a"), ("y", "b")):
            own = prefix.select("shingle", *[F.col(c).alias(f"{s}_{c}") for c in place[1:]], F.col("id").alias(name))
            sides = sides.join(own, ["shingle", *[f"{s}_{c}" for c in place[1:]]])
        met = sides
    else:
        met = met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are lower-cased (A-Z) runs between ASCII white space; a set holds the
    distinct shingles of k words, or the whole sequence if it is shorter. Texts
    link at ``percent`` of their union or more. Null and empty texts have an
    empty set and link with nothing. Rows that share a doc_id count as one
    document. A row without doc_id is no node: its component_id is null and it
    is kept. Only the two named columns are read.
    """
    t = percent / 100
    sigs = written(signatures(docs, k, t, id_col, text_col), "signatures")
    classes = written(
        sigs.filter("n_shingles > 0 and doc_id is not null").groupBy("mark_a", "mark_b", "n_shingles").agg(F.min("doc_id").alias("id"), F.min("sketch").alias("sketch"), F.min("prefix").alias("prefix")).select("id", F.col("n_shingles").alias("n"), "mark_a", "mark_b", "sketch", "prefix"),
        "classes",
    )
    bands = written(arrow_map(classes.select("id", "n", "sketch", "prefix"), _band_batches(t), "band long, id long"), "banded")
    # written, so that the join is free to split a band that many classes share
    sizes = written(bands.groupBy("band").agg(F.count("*").alias("g"), F.min("id").alias("leader")).filter("g > 1"), "sizes")
    # the same plan at every size: these sides grow with the input
    grouped = written(bands.join(sizes.hint("merge"), "band"), "bands")

    # candidates: each class of a group with the group's smallest
    sketches = classes.select("id", "n", "sketch")
    pairs = grouped.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    with_a = pairs.join(sketches.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sk_a")), "a")
    with_b = with_a.join(sketches.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sk_b")), "b")
    likely = written(arrow_map(with_b.select("a", "b", "n_a", "n_b", "sk_a", "sk_b"), _estimate_batches(t), "a long, b long"), "likely")

    # full sets of all that is compared on them, from one more pass over the texts; in a group of two the pair is all
    several = grouped.filter("g > 2").select("band", "id")
    wanted = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).unionByName(several.select("id")).distinct()
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = written(arrow_map(text.join(wanted.hint("merge"), "id", "left_semi"), _set_batches(k), "id long, shingles binary").filter("length(shingles) > 0").distinct(), "sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        full = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b")
        return arrow_map(full.select("a", "b", "set_a", "set_b"), _confirm_batches(percent), "a long, b long")

    members = sigs.join(classes.select("mark_a", "mark_b", F.col("n").alias("n_shingles"), "id"), ["mark_a", "mark_b", "n_shingles"], "left").select("doc_id", "n_shingles", "id")
    # rows of one doc_id with different sets are one document
    repeated = members.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("doc_id is not null and lo <> hi").select("doc_id", "lo")
    repeated = written(repeated, "repeated")
    same_doc = members.join(repeated, "doc_id").select(F.col("id").alias("a"), F.col("lo").alias("b"))
    roots = connected(confirmed(likely).unionByName(same_doc.filter("a is not null")))

    # groups that still hold several components; a root has no row of its own in roots
    labelled = written(several.join(roots, "id", "left").select("band", "id", F.coalesce("root", "id").alias("root")), "labelled")
    open_ = written(labelled.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("band"), "open_bands")
    left = labelled.join(open_, "band", "left_semi").select("id", "root").distinct()
    prefix = prefix_rows(written(left.join(sets, "id"), "open"), t)
    # first one set for all of its root that agree with it, then, between roots that this leaves apart, every set
    for every in (False, True):
        root_of = lambda side, roots=roots: roots.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
        # those links join components, so only their ends go through the rounds again
        more = confirmed(prefix_pairs(prefix, t, every)).join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
        above = connected(more).select(F.col("id").alias("root"), F.col("root").alias("top"))
        prefix = prefix.join(above, "root", "left").select("shingle", F.coalesce("top", "root").alias("root"), "n", "at", "id")
        roots = written(roots.join(above, "root", "left").select("id", F.coalesce("top", "root").alias("root")).unionByName(above.select(F.col("root").alias("id"), F.col("top").alias("root"))).distinct(), "roots")

    out = members.join(roots, "id", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("root", "id", "doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, all without a group. Rows without doc_id stay."""
    gone = near_duplicates(docs, k, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("_id"))
    return packed.join(gone, F.col("_id") == F.col("_gone"), "left_anti").select("row.*")
