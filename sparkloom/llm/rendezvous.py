"""Sharding by weighted rendezvous hashing, in DataFrame functions only.

Every record draws one number per shard from its key and the shard; the shard with the largest weight / -ln(u) takes it.
A new shard can only win records for itself, and a shard takes its share of the weights.

Defined results: a null text has no bytes and the checksum of the empty text; a null key is the key of its own name, so
such records share a shard; rows that share a key share a shard and have slots of their own; a very long text counts its
bytes; equal scores go to the larger shard; an empty table gives no rows; other columns, of whatever name, play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm import common

OVERHEAD = 16


def _score(key: Column, shard: Column, weight: Column) -> Column:
    digest = F.md5(F.concat(key, F.lit(":"), shard.cast("string")))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return weight / -F.ln(u)


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard 0..n-1 of a record key; equal scores go to the larger shard."""
    text = F.coalesce(key.cast("string"), F.lit("null"))
    table = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    scored = F.transform(table, lambda s: F.struct(_score(text, s["shard"], s["weight"]).alias("score"), s["shard"].alias("shard")))
    return F.array_max(scored)["shard"]


def shard_records(docs: DataFrame, weights: Sequence[float], grown: float | None = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every record.

    `weights` has one number per shard; `grown` is the weight of one more shard (None: no such column value).  Slots
    count from 0 in each shard in doc_id order.  They come from one range shuffle of the small rows and a count per
    partition and shard; no task holds a shard.
    """
    key = F.col("doc_id")
    text = F.coalesce("text", F.lit("")).cast("binary")
    base = common.staged(common.with_ids(docs).select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        (shard_of(key, [*weights, grown]) if grown is not None else F.lit(None).cast("int")).alias("grown_shard"),
    ), "sharded")
    order = ["shard", "doc_id", "size", "text_crc32"]
    ranged = base.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = common.staged(ranged.withColumn("part", F.shiftright("at", 33)), "slots")
    runs = placed.groupBy("part", "shard").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("part", "shard", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(runs, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("at") - F.col("first") + F.col("offset")).alias("slot"), "grown_shard")
