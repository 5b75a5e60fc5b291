"""A Merkle manifest of a dataset: every row's digest, and its proof up to one root.

Rows of a language are leaves in the order of doc_id. Their exact ranks come from
histograms of doc_id's digits. A rank written in the base of the fanout is a path
in a trie whose nodes are the runs of the tree: each pass groups nodes by all but
the last digits of their rank, at most 256 below one prefix, and folds that whole
piece of the tree at once. The languages' own roots are the leaves of a last tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import radix
from .shared import written

#: Nodes below one prefix that a pass brings together.
MOST = 256
#: Levels that any count of rows can need, with two below each node.
LEVELS = 63


def field(value: Column) -> Column:
    """'-' for null, else the value with its UTF-8 length before it, so that joined fields cannot be read in two ways."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(*[field(x) for x in (doc_id, source, lang, n_chars, text)])


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, from left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


STEPS = "array<struct<left:string,right:string>>"


def _height(fanout: int) -> str:
    """SQL for the levels above ``total`` leaves."""
    powers = [fanout**j for j in range(LEVELS) if fanout**j < 1 << 63]
    return " + ".join(f"cast({p}L < total as int)" for p in powers)


class _Trie:
    """The trees of all groups, from entries (g, rank, n, item) and totals (g, total); item holds ``digest``."""

    def __init__(self, entries: DataFrame, totals: DataFrame, fanout: int) -> None:
        self.fanout = fanout
        self.span = max(j for j in range(1, 9) if j == 1 or fanout**j <= MOST)
        self.size = fanout**self.span
        last = F.col("rank") + F.col("n") - 1
        pieces = entries.withColumn("block", F.explode(F.sequence(self._above("rank"), self._above("rank + n - 1"))))
        # copies of an entry are told by how many of them a block holds
        first = F.greatest(F.col("rank"), F.col("block") * self.size)
        after = F.least(last + 1, (F.col("block") + 1) * self.size)
        pieces = pieces.select("g", "block", F.struct(first.alias("at"), (after - first).cast("int").alias("times"), "item").alias("piece"))
        heights = written(totals.select("g", F.expr(_height(fanout)).alias("height")), "heights")
        self.highest = heights.agg(F.max("height")).first()[0] or 0
        held = pieces.groupBy("g", "block").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
        items = F.flatten(F.transform("pieces", lambda p: F.array_repeat(p["item"], p["times"])))
        held = held.join(heights, "g").select("g", "block", "height", items.alias("items"))
        self.levels = [written(self._folded(held, 0), "nodes")]
        while len(self.levels) * self.span < self.highest:
            below = self.levels[-1]
            node = F.struct(F.col("block").alias("at"), F.struct(F.col("top").alias("digest")).alias("item"))
            up = below.select("g", self._above("block").alias("block"), "height", node.alias("node")).groupBy("g", "block", "height").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
            up = up.select("g", "block", "height", F.transform("nodes", lambda x: x["item"]).alias("items"))
            self.levels.append(written(self._folded(up, len(self.levels)), "nodes"))

    def _above(self, rank: str) -> Column:
        """The prefix of a rank without the digits that one pass folds."""
        return F.expr(f"({rank}) div {self.size}")

    def _rows(self, blocks: DataFrame, at: int) -> DataFrame:
        """Digests of a block's nodes at each of its levels, as l0, l1, ..."""
        f = self.fanout
        out = blocks.selectExpr("*", f"greatest(0, least({self.span}, height - {at * self.span})) as todo", "transform(items, x -> x.digest) as l0")
        for j in range(self.span):
            runs = f"transform(sequence(0, cast((size(l{j}) - 1) div {f} as int)), i -> sha2(array_join(slice(l{j}, i * {f} + 1, {f}), ''), 256))"
            out = out.selectExpr("*", f"case when {j} < todo then {runs} else l{j} end as l{j + 1}")
        return out

    def _folded(self, blocks: DataFrame, at: int) -> DataFrame:
        return self._rows(blocks, at).select("g", "block", "height", "items", F.get(F.col(f"l{self.span}"), F.lit(0)).alias("top"))

    def tops(self) -> DataFrame:
        """g, top: the root of each group."""
        return self.levels[-1].select("g", "top")

    def paths(self, above: DataFrame) -> DataFrame:
        """g, at, item, path and what else ``above`` (g, path, ...) holds: each leaf with the path that leads over its group's root."""
        more = [c for c in above.columns if c not in ("g", "path")]
        upper = above.withColumn("block", F.lit(0).cast("long"))
        for at in reversed(range(len(self.levels))):
            rows = self._rows(self.levels[at], at).join(upper, ["g", "block"])

            steps = ", ".join(self._step(j) for j in range(self.span))
            leaf = f"named_struct('at', block * {self.size}L + i, 'item', x, 'path', concat(slice(array({steps}), 1, todo), path))"
            upper = rows.selectExpr("g", *more, f"inline(transform(items, (x, i) -> {leaf}))")
            if at:
                upper = upper.select("g", *more, F.col("at").alias("block"), "path")
        return upper

    def _step(self, j: int) -> str:
        """SQL for the run of a block's i-th leaf at level j, without its own node."""
        f, own = self.fanout, f"cast(i div {self.fanout**j} as int)"
        run = f"cast(i div {f ** (j + 1)} * {f} as int)"
        left, right = f"slice(l{j}, {run} + 1, {own} - {run})", f"slice(l{j}, {own} + 2, {f - 1} - ({own} - {run}))"
        return f"named_struct('left', array_join({left}, ''), 'right', array_join({right}, ''))"


def proofs(docs: DataFrame, fanout: int = 2, carry: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, lang, rank, leaf, path, subroot, root and the columns of ``carry``: one row for each row of ``docs``.

    ``path`` lists, from the leaf to the root, the digests left and right of the own
    one in its run. Rows of a null language, and null doc_ids, come first; equal
    doc_ids follow in the order of their leaves, equal rows stand side by side as
    leaves of their own. An empty table has no rows. Columns other than doc_id,
    source, lang, n_chars and text are read only by ``carry``.
    """
    own = {"doc_id": F.col("doc_id").cast("long"), "g": F.coalesce(F.concat(F.lit("+"), F.col("lang").cast("string")), F.lit("-"))}
    own["digest"] = leaf_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    carry = carry or {}
    rows = docs.select(*[x.alias(k) for k, x in own.items()], F.struct(F.lit(0).alias("_"), *[x.alias(k) for k, x in carry.items()]).alias("carried"))
    entries = written(rows.groupBy("g", "doc_id", "digest", "carried").agg(F.count("*").alias("n")), "leaves")
    totals = written(entries.groupBy("g").agg(F.sum("n").alias("total")), "totals")
    ranked = radix.ranked(entries, ["g"], "doc_id", "digest", "n")
    trie = _Trie(ranked.select("g", "rank", "n", F.struct("doc_id", "digest", "carried").alias("item")), totals, fanout)

    # the languages: ranked the same way by the bytes of their names
    tops = trie.tops().withColumnRenamed("g", "lang_key")
    name = F.hex(F.encode(F.substr(F.col("lang_key"), F.lit(2)), "UTF-8"))
    langs = tops.select(F.lit("").alias("g"), "lang_key", "top", F.when(F.col("lang_key") != "-", F.conv(F.rpad(F.substring(name, 1, 14), 14, "0"), 16, 10).cast("long")).alias("first"), name.alias("name"), F.lit(1).cast("long").alias("n"))
    langs = written(langs, "langs")
    over = _Trie(radix.ranked(langs, ["g"], "first", "name", "n").select("g", "rank", "n", F.struct("lang_key", F.col("top").alias("digest")).alias("item")), langs.groupBy("g").agg(F.count("*").alias("total")), fanout)
    ends = over.tops().select("g", F.array().cast(STEPS).alias("path"), F.col("top").alias("root"))
    above = over.paths(ends).select(F.col("item.lang_key").alias("g"), "path", F.col("item.digest").alias("subroot"), "root")
    out = trie.paths(above)
    lang = F.when(F.col("g") != "-", F.substr(F.col("g"), F.lit(2)))
    return out.select(F.col("item.doc_id").alias("doc_id"), lang.alias("lang"), F.col("at").alias("rank"), F.col("item.digest").alias("leaf"), "path", "subroot", "root", *[F.col(f"item.carried.{k}").alias(k) for k in carry])


def verify(docs: DataFrame, fanout: int = 2) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: whether each row's proof holds after tampering.

    Where 7 divides the CRC of the decimal doc_id, a character more is claimed in
    n_chars; a null n_chars or doc_id stays. Other cases as in ``proofs``.
    """
    names = ("doc_id", "source", "lang", "n_chars", "text")
    claimed = F.col("n_chars").cast("decimal(20,0)") + 1
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(hit & F.col("n_chars").isNotNull(), leaf_of(*[claimed if c == "n_chars" else F.col(c) for c in names]))
    folded = proofs(docs, fanout, {"changed": changed}).withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    proof = F.sha2(siblings(F.col("path")), 256)
    return folded.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "lang", "rank", F.size("path").alias("n_levels"))
