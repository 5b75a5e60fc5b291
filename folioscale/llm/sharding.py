"""Proportional stratified interleaving into shards.

Rows of each source are shuffled by a seeded hash and ranked; a rank becomes
the fraction (rank + offset) / rows of the source, with a seeded offset in
(0, 1) for each source, so that sources of a few rows do not all fall on one
place. Sorting all rows by that fraction lays every source evenly along the
line, so cutting the line into equal runs gives every shard the mixture of the
whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .mixing import document_key
from .ranks import bucket_count, running
from .shared import unit_hash, written


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, source, key: one row for each row of ``docs``.

    The law is ``rows``: shard sizes are at most one row apart. A null text has
    16 bytes and the CRC of an empty text; a null source is a source; repeated
    rows are rows of their own, side by side in their source's order. With
    fewer rows than shards, the first shards of the line stay empty or get one.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    small = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        document_key(F.col(id_col), F.col(text_col).cast("string"), seed).alias("key"),
    )
    small = written(small, "rows")
    counts = small.groupBy("source").agg(F.count("*").alias("n"))
    offset = unit_hash(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("source", F.lit("")))))
    counts = counts.select(F.col("source").alias("_s"), "n", offset.alias("offset"))
    total = small.count()
    buckets = bucket_count(total)
    ranked = running(small, ["source"], unit_hash(F.col("key")), [F.col("key")], {"rank": F.lit(1).cast("long")}, buckets)
    placed = ranked.join(counts, ranked["source"].eqNullSafe(counts["_s"])).drop("_s").withColumn("f", (F.col("rank") + F.col("offset")) / F.col("n"))
    line = running(placed, [], F.col("f"), [F.col("f"), F.col("source"), F.col("key")], {"place": F.lit(1).cast("long")}, buckets)
    # shard s has the places from ceil(s * total / shards) on
    exact = F.expr(f"cast((place * {shards}) div {max(1, total)} as long)")
    begin = F.expr(f"cast((_at * {total} + {shards} - 1) div {shards} as long)")
    return line.withColumn("_at", exact).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_at").cast("int").alias("shard"), (F.col("place") - begin).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source", "key")


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 42) -> None:
    """Write the rows of ``docs`` as Parquet in folders shard=0, shard=1 and so on, each file in slot order.

    A column ``slot`` gives the order and the folder the shard; columns of
    ``docs`` with these names are left out. Equal rows take their slots in turn.
    """
    share = lambda key, source: F.md5(F.concat_ws("|", key, F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))))
    plan = shard(docs, shards, seed=seed).groupBy(share(F.col("key"), F.col("source")).alias("k")).agg(F.sort_array(F.collect_list(F.struct("shard", "slot"))).alias("places"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")]).alias("row"), share(document_key(F.col("doc_id"), F.col("text").cast("string"), seed), F.col("source")).alias("k"))
    turn = F.row_number().over(Window.partitionBy("k").orderBy("k")) - 1
    out = packed.join(plan, "k").withColumn("place", F.get("places", turn)).select("row.*", F.col("place.shard").alias("shard"), F.col("place.slot").alias("slot"))
    # ranges of slots, so that a shard is as many files as its rows need
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
