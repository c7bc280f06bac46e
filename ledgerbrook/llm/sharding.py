"""Shards by vector bin packing: bytes, tokens and rows are balanced jointly, groups stay together.

Spark sums the three resources per group and gathers small groups into a fixed number of lots,
so that a bounded list of lots and large groups remains, whatever the number of documents. A group that no shard
could hold is cut into pieces of known size first. The list is packed: largest first, each into the shard with room for
its bytes where the dot product of its resources with the shard's remaining capacity is highest. The
decisions go back to the rows by a join. Rows are numbered within their lot or group in stretches, by an id written
with them, so neither many equal rows nor missing ids meet in one task; the number gives piece and slot.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, no_null, written

#: Lots per shard; the packed list holds at most this many lots and half as many again large groups, and a few pieces per shard.
LOTS = 256
#: Rows that are numbered together within a lot or a group.
STRETCH = 50_000
RESOURCES = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each item; items has one row of resources (bytes first) per item.

    Items go by falling share of their largest resource, ties by position. Of the shards with room for its bytes an
    item gets the one with the highest dot product of its shares and the remaining shares, ties by number;
    where none has room, the one with most bytes left.
    """
    shares = items / np.maximum(items.sum(axis=0), 1) * n_shards
    left = np.ones((n_shards, items.shape[1]))
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.argsort(-shares.max(axis=1), kind="stable"):
        fits = left[:, 0] >= shares[i, 0]
        score = np.where(fits, np.maximum(left, 0) @ shares[i], -np.inf) if fits.any() else left[:, 0]
        out[i] = at = int(np.argmax(score))
        left[at] -= shares[i]
    return out


def shard(docs: DataFrame, n_shards: int, seed: int = 0, tokens: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: one row per row of `docs`.

    Groups are equal texts; a null text counts as empty. Size is the text's UTF-8 bytes plus 16. A group
    is kept in one shard unless it holds more than an even share of a resource (then no shard could hold it): it
    is cut into pieces of half a share. Tokens are white-space separated words, or
    `tokens`. Slots of a shard run from 0 without gaps; repeated rows get slots of their own. Null ids are kept. An empty
    table gives no row; shards may stay empty. Other columns are not looked at.
    """
    spark = docs.sparkSession
    text = no_null("text")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) if tokens is None else tokens
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        words.cast("long").alias("tokens"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("group"),
    ))
    groups = written(rows.groupBy("group").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")))
    total = groups.agg(*(F.sum(c).alias(c) for c in RESOURCES)).first()
    if not total["rows"]:
        total = dict.fromkeys(RESOURCES, 0)
    n_lots = LOTS * n_shards
    share = F.greatest(*(F.col(c) / max(1, total[c]) for c in RESOURCES)) * n_shards
    large = share > 2 / LOTS
    lot_of = F.concat(F.lit("lot "), F.pmod(F.xxhash64("group", F.lit(seed)), F.lit(n_lots)))
    # both lists are bounded: n_lots lots, and fewer than 3 * n_lots / 2 groups above twice a lot's share of a resource
    lots = groups.filter(~large).groupBy(lot_of.alias("item")).agg(*(F.sum(c).alias(c) for c in RESOURCES), F.lit(1).alias("pieces"))
    pieces = F.when(share > 1, F.ceil(share * 2)).otherwise(1).cast("int").alias("pieces")
    whole = lots.unionByName(groups.filter(large).select(F.col("group").alias("item"), *RESOURCES, pieces)).orderBy("item").collect()
    packed = []  # item, pieces, rows of the item, piece, first row of the piece, resources
    for r in whole:
        k, n = min(r["pieces"], r["rows"]), r["rows"]
        starts = [p * n // k for p in range(k + 1)]
        packed += [(r["item"], k, n, p, starts[p], [r[c] * (starts[p + 1] - starts[p]) / n for c in RESOURCES]) for p in range(k)]
    shards = pack(np.array([x[5] for x in packed], dtype=float).reshape(-1, 3), n_shards)
    filled, plan = [0] * n_shards, []
    for (item, k, n, p, start, _), at in zip(packed, shards.tolist()):
        plan.append((item, k, n, p, start, at, filled[at]))
        filled[at] += n * (p + 1) // k - start
    plan = spark.createDataFrame(plan, "item string, pieces long, rows long, piece long, first_row long, shard int, first_slot long")
    known = plan.filter("piece = 0").select("item", "pieces", "rows")
    named = rows.join(F.broadcast(known.select(F.col("item").alias("large"))), F.col("group") == F.col("large"), "left").select(
        "row", "doc_id", "size", "text_crc32", F.coalesce("large", lot_of).alias("item"))
    stretch = F.pmod(F.xxhash64("row"), F.ceil(F.col("rows") / STRETCH)).alias("stretch")
    placed = named.join(F.broadcast(known), "item").select("row", "doc_id", "size", "text_crc32", "item", "pieces", "rows", stretch)
    counts = placed.groupBy("item", "stretch").agg(F.count("*").alias("n"))
    before = Window.partitionBy("item").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("item", "stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy("item", "stretch").orderBy("row")))
    numbered = ranked.join(offsets, ["item", "stretch"]).withColumn("number", F.col("before") + F.col("rank") - 1)
    return (
        numbered.select("doc_id", "size", "text_crc32", "item", "number", F.expr("((number + 1) * pieces - 1) div rows").alias("piece"))
        .join(F.broadcast(plan.select("item", "piece", "first_row", "shard", "first_slot")), ["item", "piece"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("number") - F.col("first_row")).cast("long").alias("slot"))
    )
