"""Sharding by vector bin packing: bytes, tokens and rows balanced together, equal texts kept together.

Equal texts are a group. Groups are bundled by hash into a fixed number of items; a group that is a large
share of a shard is its own item, and one too large to balance is cut by row into several. Items, a
bounded number, are placed largest first in the shard whose remaining capacity has the largest dot product
with the item. The law is ``bytes``: the sizes of the shards come out nearly equal.

Null text counts as empty. A null ``doc_id`` is kept and takes a slot like any other; repeated rows take
one slot each, ties in any order between equal rows. Texts, however long, are measured where they are read and not
moved; other columns, whatever their names, are not read. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ordered, runs, stage

# The law is bytes, so bytes count most where the quantities disagree.
EMPHASIS = (16.0, 1.0, 1.0)
WORDS = r"[^\x20\x09-\x0D]+"


def pack_vectors(items: np.ndarray, shards: int, emphasis: tuple[float, ...]) -> np.ndarray:
    """Shard of each item. ``items`` has a row per item and a column per quantity; every shard has an equal
    share of each column's total as capacity. ``emphasis`` weighs the columns in the dot product."""
    total = items.sum(axis=0).astype(float)
    weight = items / np.where(total > 0, total / shards, 1.0)
    left = np.tile((total > 0).astype(float), (shards, 1))
    chosen = np.zeros(len(items), dtype=int)
    for i in np.argsort(-weight.sum(axis=1), kind="stable"):
        chosen[i] = np.argmax(left @ (weight[i] * emphasis))
        left[chosen[i]] -= weight[i]
    return chosen


def shard(docs: DataFrame, shards: int = 8, bundles: int = 1 << 14, whole: float = 0.25, piece: float = 1 / 16) -> DataFrame:
    """``doc_id, size, text_crc32, tokens, shard, slot`` per row.

    ``bundles``: items that small groups are hashed into. A group of more than ``whole`` of a shard's bytes,
    tokens or rows is cut into items of about ``piece`` of a shard; there are at most
    ``3 * shards / whole`` such groups, whatever the input, so the driver holds a bounded table."""
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.regexp_count(text, F.lit(WORDS)).cast("long").alias("tokens"),
            F.xxhash64(text).alias("_group"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "shard-rows",
    )
    sums = (F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    total = rows.agg(*sums).first()
    groups = rows.groupBy("_group").agg(*sums)
    share = F.greatest(*(F.col(c) / F.lit(float(total[c] or 1)) for c in ("size", "tokens", "rows"))) * shards
    large = [(r["_group"], r["share"]) for r in groups.select("_group", share.alias("share")).filter(F.col("share") > whole).collect()]
    table, first = [], bundles
    for group, part in sorted(large):
        pieces = int(np.ceil(part / piece))
        table.append((group, first, pieces))
        first += pieces
    cut = docs.sparkSession.createDataFrame(table, "_group long, _first int, _pieces int")
    placed = rows.join(F.broadcast(cut), "_group", "left").withColumn(
        "_item",
        F.when(F.col("_first").isNotNull(), F.col("_first") + F.pmod(F.xxhash64("_row"), F.col("_pieces")))
        .otherwise(F.pmod(F.xxhash64("_group"), F.lit(bundles)))
        .cast("int"),
    )
    items = placed.groupBy("_item").agg(*sums).orderBy("_item").collect()
    vectors = np.array([[r["size"], r["tokens"], r["rows"]] for r in items], dtype=float).reshape(-1, 3)
    chosen = pack_vectors(vectors, shards, EMPHASIS)
    used, spots = [0] * shards, []
    for r, s in zip(items, chosen.tolist(), strict=True):
        spots.append((r["_item"], s, used[s]))
        used[s] += r["rows"]
    spot = docs.sparkSession.createDataFrame(spots, "_item int, shard int, _offset long")
    # places in an item are counted over the parts of a sorted table, so a large item is not one task's
    keys = ["_item", "doc_id", "text_crc32", "size", "_row"]
    in_order = ordered(stage(placed.select(*keys, "tokens"), "shard-placed"), keys, "shard-ordered")
    places = runs(in_order, ["_item"]).drop("_rows").join(F.broadcast(spot), "_item")
    at = F.col("_offset") + F.col("_before") + F.col("_seq") - F.col("_first")
    return in_order.join(places, ["_part", "_item"]).select("doc_id", "size", "text_crc32", "tokens", "shard", at.alias("slot"))
