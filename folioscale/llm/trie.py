"""Prefix tries of conversations, built compressed.

A node is a sequence of first turns. It is named by its depth and by the sum of its
turns' hashes (120 bits; a hash covers role, text and place), so that the names
along a very long conversation add up from pieces. Distinct conversations, in
pieces of 64 turns, are sorted; where two neighbours part is a branch. Branches,
ends and leaves are the only points that are made: counts and sums are computed on
the edges between them, and nodes with one child come back from the edges' suffix
sums.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import radix
from .ranks import running
from .shared import arrow_map, space_words, written

#: Turns that one row of the sort holds.
PIECE = 64
#: Turns of one conversation, or points of one path, that one window adds up.
STRETCH = 4096
ROOT = ""


def rebuild(conversations: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(turns, convs): conv_id, depth (from 1), tok, words of every rebuilt turn; conv_id, length of every conversation.

    The first h turns come from conversation ``conv_id - conv_id % every`` (the
    remainder has conv_id's sign), with h the CRC of the decimal conv_id modulo
    ``most``; then the own ones after the first h. Turns stand by number (null
    first), those of one number by the MD5 ``tok`` of role and text. A null role
    or text is empty. Rows without conv_id take no part; equal rows are turns of
    their own.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    tok = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), tok.alias("tok"), space_words(text).alias("words"))
    entries = written(rows.filter("conv_id is not null").groupBy("conv_id", "turn", "tok", "words").agg(F.count("*").alias("n")), "turns")
    placed = radix.ranked(entries, ["conv_id"], "turn", "tok", "n")
    own = written(placed.select("conv_id", F.explode(F.sequence("rank", F.col("rank") + F.col("n") - 1)).alias("pos"), "tok", "words"), "own")

    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    counts = own.groupBy("conv_id").agg((F.max("pos") + 1).alias("n_own")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % every})
    counts = written(counts, "counts")
    lead = counts.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n_own").alias("n_base"))
    convs = counts.join(lead, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    convs = written(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length")), "convs")
    first = own.filter((F.col("conv_id") % every == 0) & (F.col("pos") < most)).select(F.col("conv_id").alias("base"), "pos", "tok", "words")
    # a base has fewer than 2 * every conversations, a conversation fewer than ``most`` such turns
    begun = convs.join(first, "base").filter("pos < h").select("conv_id", (F.col("pos") + 1).alias("depth"), "tok", "words")
    went_on = own.join(convs, "conv_id").filter("pos >= h").select("conv_id", (F.col("taken") + F.col("pos") - F.col("h") + 1).alias("depth"), "tok", "words")
    return begun.unionByName(went_on), convs.select("conv_id", "length")


def _sums(df: DataFrame, group: str, by: str, amounts: dict[str, Column]) -> DataFrame:
    """What the rows of a group hold before each, in order of ``by``, added up in stretches."""
    stretches = (df.agg(F.max(by)).first()[0] or 0) // STRETCH + 1
    return running(df, [group], (F.floor(F.col(by) / STRETCH) + 0.5) / stretches, [F.col(by)], amounts, stretches)


def _named(turns: DataFrame) -> DataFrame:
    """Add ``node`` and ``parent``, the names of the sequences up to and before a turn."""
    digits = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "tok"))
    number = lambda at: F.conv(F.substring(digits, at, 15), 16, 10).cast("decimal(20,0)")
    summed = _sums(turns.withColumns({"one": number(1), "two": number(16)}), "conv_id", "depth", {"ones": F.col("one"), "twos": F.col("two")})
    name = lambda d, x, y: F.md5(F.concat_ws(":", d.cast("string"), x.cast("decimal(30,0)").cast("string"), y.cast("decimal(30,0)").cast("string")))
    node = name(F.col("depth"), F.col("ones") + F.col("one"), F.col("twos") + F.col("two"))
    parent = F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(name(F.col("depth") - 1, F.col("ones"), F.col("twos")))
    return summed.select("conv_id", "depth", "words", node.alias("node"), parent.alias("parent"))


def _branches(reps: DataFrame) -> DataFrame:
    """The nodes at which neighbours in the order of all distinct pieces part."""
    turn = F.struct("depth", "node", "parent")
    pieces = reps.groupBy("conv_id", F.floor((F.col("depth") - 1) / PIECE).alias("piece")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    pieces = pieces.select(F.expr("turns[0].parent").alias("start"), F.transform("turns", lambda t: t["node"]).alias("nodes"), F.element_at("turns", -1)["node"].alias("last"))
    # a piece's last node tells the whole piece
    distinct = pieces.dropDuplicates(["last"]).select("start", "nodes")
    ordered = written(distinct.repartitionByRange("start", "nodes").sortWithinPartitions("start", "nodes").withColumn("at", F.monotonically_increasing_id()), "sorted")
    ordered = ordered.withColumn("part", F.shiftrightunsigned("at", 33))
    # one row for each partition: its last piece is seen by the next one too
    parts = ordered.groupBy("part").agg(F.max("at").alias("end")).select("end", F.lead("part").over(Window.orderBy("part")).alias("next"))
    seen = ordered.join(F.broadcast(parts), F.col("at") == F.col("end")).filter("next is not null").select("start", "nodes", "at", F.col("next").alias("part"))
    line = Window.partitionBy("part").orderBy("at")
    pairs = ordered.unionByName(seen).select("start", "nodes", F.lag("start").over(line).alias("start_before"), F.lag("nodes").over(line).alias("nodes_before")).filter("start = start_before")
    # two pieces share the nodes of their common beginning and no others
    common = F.size(F.array_intersect("nodes", "nodes_before"))
    return pairs.select(F.when(common > 0, F.get("nodes", common - 1)).otherwise(F.col("start")).alias("node"))


def _end_hashes(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 from node, conv_id: the ids of a node, ascending, stream through one hash."""
    held = ends.groupBy("node", F.shiftright("conv_id", 8).alias("first")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            names, sums = [], []
            for own, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if own != node:
                    if state is not None:
                        names.append(node)
                        sums.append(state.hexdigest())
                    node, state = own, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array(names, pa.string()), "ends_sha256": pa.array(sums, pa.string())})
        if state is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends_sha256": [state.hexdigest()]})

    return arrow_map(held.repartition("node").sortWithinPartitions("node", "first"), hashed, "node string, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row for each node.

    ``turns`` holds conv_id, depth (1, 2, ...), tok and words, ``convs`` every
    conv_id with its length. A conversation without turns ends at the root. Without
    conversations there is no node.
    """
    paths = written(_named(turns), "paths")
    lengths = convs.select("conv_id", "length")
    of_turns = paths.join(lengths, "conv_id").filter("depth = length").select("conv_id", "depth", "node")
    ends = written(of_turns.unionByName(lengths.filter("length = 0").select("conv_id", F.col("length").alias("depth"), F.lit(ROOT).alias("node"))), "ends")
    # equal conversations are one: the smallest stands for them
    alike = written(ends.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("depth").alias("length")), "alike")
    reps = written(paths.join(alike.select("conv_id", "n", "length"), "conv_id"), "reps")

    points = written(_branches(reps).unionByName(alike.select("node")).unionByName(alike.select(F.lit(ROOT).alias("node"))).distinct().withColumn("point", F.lit(1)), "points")
    top = alike.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), "n", "length")
    flagged = reps.unionByName(top).join(points, "node", "left").withColumn("point", F.coalesce("point", F.lit(0)))
    # ``edge`` numbers the points of a path, ``before`` has the words of the turns above
    path = written(_sums(flagged, "conv_id", "depth", {"edge": F.col("point"), "before": F.col("words")}), "path")
    on_path = path.filter("point = 1").select("conv_id", "node", "depth", "n", "length", "edge", "words", "before")

    # counts of a point come from the distinct conversations through it
    counted = written(on_path.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.count("*").alias("n_paths")), "counted")
    own = on_path.join(counted, ["node", "conv_id"]).select("node", "conv_id", "depth", "edge", "words", "before", "n_convs")
    above = on_path.select("conv_id", (F.col("edge") + 1).alias("edge"), F.col("node").alias("up"), F.col("depth").alias("up_depth"), (F.col("before") + F.col("words")).alias("up_words"))
    edges = own.join(above, ["conv_id", "edge"], "left")
    # what all turns of an edge save, its point's included
    edges = written(edges.withColumn("saved", F.coalesce((F.col("n_convs") - 1) * (F.col("before") + F.col("words") - F.col("up_words")), F.lit(0).cast("long"))), "edges")

    each = on_path.join(edges.select("node", "conv_id", "saved"), ["node", "conv_id"], "left").withColumn("saved", F.coalesce("saved", F.lit(0).cast("long")))
    each = each.join(counted.select("node", "n_paths"), "node")
    # a path's last point is a leaf if no other path goes through it
    each = each.withColumn("leaf", ((F.col("depth") == F.col("length")) & (F.col("n_paths") == 1)).cast("long"))
    each = written(_sums(each, "conv_id", "edge", {"passed": F.col("saved")}), "each")
    totals = each.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.max("leaf").alias("to_leaf"))
    below = each.join(written(totals, "all"), "conv_id").groupBy("node").agg(F.sum(F.col("all_saved") - F.col("passed") - F.col("saved")).alias("below"), F.sum("to_leaf").alias("n_leaves"))
    children = edges.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("n_children"))
    names = counted.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv"))
    full = edges.join(below, "node").join(children, "node", "left").join(names, "up", "left").withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words") + F.col("below"))
    full = written(full, "full")

    def parent(depth: Column) -> Column:
        """On an edge the node above has the same conversations; at its upper end stands the point above."""
        return F.when(depth - 1 == F.col("up_depth"), F.col("up_conv")).when(depth > 0, F.col("conv_id"))

    nothing = hashlib.sha256(b"").hexdigest()
    hashes = _end_hashes(ends.select("node", "conv_id"))
    real = full.join(hashes, "node", "left").select("conv_id", "depth", parent(F.col("depth")).alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
    inner = path.filter("point = 0").select("conv_id", "edge", F.col("depth").alias("at"), F.col("before").alias("above"))
    unary = inner.join(full.select("conv_id", "edge", "up_depth", "up_conv", "n_convs", "n_leaves", "saved_tokens", "before"), ["conv_id", "edge"])
    suffix = (F.col("n_convs") - 1) * (F.col("before") - F.col("above"))
    unary = unary.select("conv_id", F.col("at").alias("depth"), parent(F.col("at")).alias("parent_conv_id"), "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", (F.col("saved_tokens") + suffix).alias("saved_tokens"), F.lit(nothing).alias("ends_sha256"))
    return real.unionByName(unary)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` as ``rebuild`` makes them; see there for nulls, ties and repeated rows, and ``prefix_trie``."""
    return prefix_trie(*rebuild(conversations))
