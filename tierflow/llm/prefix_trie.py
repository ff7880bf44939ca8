"""The trie of conversation prefixes, screened by a count-min sketch.

A conversation is a sequence of turns, here rebuilt from the first turns of the conversation its hundred begins with
and its own later ones. A node is a distinct sequence of first turns; its members are the conversations that
begin with it, and its owner is the smallest of them. Who owns a node owns the next one on its own path too.

The digest of a prefix is the exclusive or of a hash of each turn with its place, so a conversation that lies in
several partitions only needs the sum so far of the earlier ones. A count-min sketch of all digests, merged from
sketches of the partitions, never counts too few: an estimate of one proves that a prefix and all that follow it have
one member, and these tails are written where they are read. Only prefixes that may be shared are shuffled: they
are grouped exactly, then what the owners bring (tokens saved, leaves) is added up over their members. The
sketch has at most ``CELLS`` cells a row; beyond that more prefixes may be shared, and the result is the same.

Null role or text is empty. Turns are ordered by number, null first, and where numbers tie by a hash of role and
text; equal turns are turns of their own. Rows without a conv_id belong to no conversation and are left out. Very
long texts are hashed where they are read. An empty table has no root and gives no rows. Other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import mix
from .common import SORTED_ROWS, map_batches, ordered, runs, stage

GROUP, HEADS = 100, 6
# The sketch: three rows of two-bit counters, four cells for each digest up to this many; 12 MB at most.
CELLS, SKETCH_ROWS, PER_DIGEST = 1 << 24, 3, 4
SLICE = 1 << 14
NODE = ("pos", "a", "b")
RESULT = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)


# ---------------------------------------------------------------- rebuilt conversations


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations ``conv_id, h, base, shared, length`` and their own turns with their number ``j``, both stored. The
    first ``shared`` turns are those of ``base``, and its own first ``h`` are left out."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = stage(
        conversations.filter(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"),
            "turn",
            F.unhex(F.sha2(content, 256)).alias("digest"),
            F.char_length(text).cast("long").alias("chars"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "trie-turns",
    )
    own = ordered(turns, ["conv_id", "turn", "digest", "_row"], "trie-own")
    pieces = stage(runs(own, ["conv_id"]), "trie-pieces")
    counts = stage(pieces.groupBy("conv_id").agg(F.sum("_rows").alias("n")), "trie-counts")
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("long")
    convs = stage(
        counts.withColumns({"h": heads, "base": F.col("conv_id") - F.col("conv_id") % GROUP})
        .join(bases, "base", "left")
        .withColumn("shared", F.least("h", F.coalesce("base_n", F.lit(0))))
        .withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv_id", "h", "base", "shared", "length"),
        "trie-convs",
    )
    places = pieces.select("_part", "conv_id", "_first", "_before").join(convs.drop("base"), "conv_id")
    placed = own.join(places, ["_part", "conv_id"]).withColumn("j", F.col("_before") + F.col("_seq") - F.col("_first") + 1)
    return convs, stage(placed.select("conv_id", "j", "digest", "chars", "h", "shared", "length"), "trie-placed")


def rebuilt(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, chars, last``: the turns of the rebuilt conversations, hashed with their place."""
    tails = turns.filter(F.col("j") > F.col("h")).select(
        "conv_id", (F.col("j") - F.col("h") + F.col("shared")).alias("pos"), "digest", "chars", "length"
    )
    # at most HEADS - 1 turns, for at most twice GROUP conversations
    first = turns.filter((F.col("j") < HEADS) & (F.col("conv_id") % GROUP == 0)).select(
        F.col("conv_id").alias("base"), F.col("j").alias("pos"), "digest", "chars"
    )
    heads = convs.join(first, "base").filter(F.col("pos") <= F.col("shared"))
    rows = tails.unionByName(heads.select("conv_id", "pos", "digest", "chars", "length"))
    lane = lambda n: F.xxhash64(F.lit(n), F.col("pos"), F.col("digest"))
    return rows.select("conv_id", "pos", lane(1).alias("a"), lane(2).alias("b"), "chars", (F.col("pos") == F.col("length")).alias("last"))


# ---------------------------------------------------------------- digests of prefixes


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _starts(conv: np.ndarray, pos: np.ndarray, before: tuple[int, int] | None) -> np.ndarray:
    """Where a row does not follow the one before it in its conversation."""
    start = np.ones(len(conv), bool)
    start[1:] = (conv[1:] != conv[:-1]) | (pos[1:] != pos[:-1] + 1)
    start[0] = before is None or (conv[0], pos[0]) != (before[0], before[1] + 1)
    return start


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id, pos, a, b, chars, last``, with the digest of the prefix that ends there."""
    n = convs.agg(F.sum("length")).first()[0] or 0
    parts = max(-(-n // SORTED_ROWS), convs.sparkSession.sparkContext.defaultParallelism)
    order = ("conv_id", "pos")
    rows = rebuilt(convs, turns).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def make():
        part = TaskContext.get().partitionId()
        before, sums = None, [0, 0]

        def step(batch):
            nonlocal before
            if not batch.num_rows:
                return
            conv, pos = _column(batch, "conv_id"), _column(batch, "pos")
            start = _starts(conv, pos, before)
            at = np.maximum.accumulate(np.where(start, np.arange(len(conv)), -1))
            lanes = []
            for i, name in enumerate(("a", "b")):
                total = np.bitwise_xor.accumulate(_column(batch, name))
                # what stands before a run: nothing for one that goes on from the last batch
                skipped = np.where(at > 0, total[np.maximum(at - 1, 0)], 0)
                here = total ^ skipped ^ np.where(at < 0, sums[i], 0)
                sums[i] = int(here[-1])
                lanes.append(here)
            before = (int(conv[-1]), int(pos[-1]))
            columns = [pa.array(np.full(len(conv), part, np.int32)), batch.column("conv_id"), batch.column("pos"), *map(pa.array, lanes)]
            names = ["_part", "conv_id", "pos", "a", "b", "chars", "last"]
            yield pa.record_batch([*columns, batch.column("chars"), batch.column("last")], names=names)

        return step

    local = stage(map_batches(rows, make, "_part int, conv_id long, pos long, a long, b long, chars long, last boolean"), "trie-prefixes")
    # a conversation goes on from part to part only as the last of one and the first of the next
    ends = local.groupBy("_part").agg(
        F.min("conv_id").alias("first"), F.max("conv_id").alias("conv_id"), F.max_by(F.struct("a", "b"), F.struct("conv_id", "pos")).alias("sum")
    )
    closing = ends.select("_part", "conv_id", "sum.a", "sum.b")
    opening = ends.filter("first <> conv_id").select("_part", F.col("first").alias("conv_id"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = closing.unionByName(opening).select(
        "_part", "conv_id", F.bit_xor("a").over(earlier).alias("carry_a"), F.bit_xor("b").over(earlier).alias("carry_b")
    )
    whole = local.join(carried.filter("carry_a IS NOT NULL"), ["_part", "conv_id"], "left")
    add = lambda lane: F.col(lane).bitwiseXOR(F.coalesce(f"carry_{lane}", F.lit(0).cast("long"))).alias(lane)
    return whole.select("conv_id", "pos", add("a"), add("b"), "chars", "last")


# ---------------------------------------------------------------- the sketch


def cells(a: np.ndarray, b: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each digest in every row of the sketch."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    return [(x & np.uint64(width - 1)).astype(np.int64) for x in (mix(a), mix(b), mix(a + mix(b)))]


def _squeeze(counts: np.ndarray) -> bytes:
    """Counts of 0, 1 and 2 or more, four to a byte."""
    quads = counts.reshape(-1, 4)
    return (quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6).astype(np.uint8).tobytes()


def _spread(data: bytes) -> np.ndarray:
    held = np.frombuffer(data, np.uint8)
    return np.stack([held & 3, held >> 2 & 3, held >> 4 & 3, held >> 6], axis=1).ravel()


def sketch(rows: DataFrame, width: int) -> np.ndarray:
    """Count-min sketch of the digests ``a, b``: ``SKETCH_ROWS`` times ``width`` counts of at most two."""
    per_row = width // SLICE

    def make():
        counts = np.zeros((SKETCH_ROWS, width), np.uint8)

        def step(batch):
            if batch is not None:
                for row, cell in enumerate(cells(_column(batch, "a"), _column(batch, "b"), width)):
                    found, n = np.unique(cell, return_counts=True)
                    counts[row, found] = np.minimum(counts[row, found] + np.minimum(n, 2), 2)
                return
            slices = counts.reshape(-1, SLICE)
            used = np.flatnonzero(slices.any(axis=1))
            for at in range(0, len(used), 64):
                part = used[at : at + 64]
                yield pa.record_batch([pa.array(part, pa.int32()), pa.array([_squeeze(slices[i]) for i in part], pa.binary())], names=["slice", "counts"])

        return step

    def merge():
        slice_no, held = None, None

        def step(batch):
            nonlocal slice_no, held
            out = []
            arrivals = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if batch is not None else [(None, b"")]
            for number, data in arrivals:
                if number == slice_no:
                    held = np.minimum(held + _spread(data), 2)
                    continue
                if slice_no is not None:
                    out.append((slice_no, _squeeze(held)))
                slice_no, held = number, _spread(data)
            yield pa.record_batch([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.binary())], names=["slice", "counts"])

        return step

    schema = "slice int, counts binary"
    partial = map_batches(rows.select("a", "b"), make, schema, last=True)
    merged = map_batches(partial.repartition("slice").sortWithinPartitions("slice"), merge, schema, last=True)
    whole = np.zeros((SKETCH_ROWS * per_row, SLICE // 4), np.uint8)
    for row in merged.toLocalIterator():
        whole[row["slice"]] = np.frombuffer(row["counts"], np.uint8)
    return whole.reshape(SKETCH_ROWS, -1)


def screen(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """Adds ``proven``, that a prefix has one member only, and ``opening``, a proven one after one that is not. The
    sketch, of a bounded size, is broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)

    def make():
        table = shared.value
        width = table.shape[1] * 4
        before, open_before = None, False

        def step(batch):
            nonlocal before, open_before
            if not batch.num_rows:
                return
            least = np.full(batch.num_rows, 2, np.uint8)
            for row, cell in enumerate(cells(_column(batch, "a"), _column(batch, "b"), width)):
                least = np.minimum(least, table[row, cell >> 2] >> ((cell & 3) * 2).astype(np.uint8) & 3)
            conv, pos = _column(batch, "conv_id"), _column(batch, "pos")
            start, here = _starts(conv, pos, before), np.arange(batch.num_rows)
            single = np.maximum.accumulate(np.where(least == 1, here, -1))
            begin = np.maximum.accumulate(np.where(start, here, -1))
            proven = (single >= begin) & (single >= 0) | (begin < 0) & open_before
            follows = np.concatenate([[open_before], proven[:-1]]) & ~start
            before, open_before = (int(conv[-1]), int(pos[-1])), bool(proven[-1])
            yield pa.record_batch(
                [*batch.columns, pa.array(proven), pa.array(proven & ~follows)], names=[*batch.schema.names, "proven", "opening"]
            )

        return step

    schema = "conv_id long, pos long, a long, b long, chars long, last boolean, proven boolean, opening boolean"
    return map_batches(rows, make, schema)


# ---------------------------------------------------------------- nodes


def sha256_text(column: Column) -> Column:
    return F.sha2(column.cast("string").cast("binary"), 256)


def end_hashes(ends: DataFrame) -> DataFrame:
    """``pos, a, b, ends_sha256`` of the conversations that end at each node. The ids of a node with very many stand in
    several parts; their text is joined part by part and hashed as a stream."""
    rows = ordered(stage(ends.select(*NODE, "conv_id"), "trie-ends"), [*NODE, "conv_id"], "trie-ends-sorted")
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",")
    texts = stage(rows.groupBy("_part", *NODE).agg(ids.alias("ids")), "trie-end-ids")
    counts = texts.groupBy(*NODE).agg(F.count("*").alias("parts"), F.min("ids").alias("ids"))
    whole = counts.filter("parts = 1").select(*NODE, sha256_text(F.col("ids")).alias("ends_sha256"))

    def make():
        node, running = None, None

        def step(batch):
            nonlocal node, running
            done = []
            arrivals = zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch is not None else [(None,) * 4]
            for pos, a, b, text in arrivals:
                if (pos, a, b) == node:
                    running.update(b"," + text.encode())
                    continue
                if node is not None and running is not None:
                    done.append((*node, running.hexdigest()))
                node, running = ((pos, a, b), hashlib.sha256(text.encode())) if text is not None else (None, None)
            columns = list(zip(*done, strict=True)) if done else [[]] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[*NODE, "ends_sha256"])

        return step

    many = texts.join(counts.filter("parts > 1").select(*NODE), list(NODE))
    in_order = many.repartition(*NODE).sortWithinPartitions(*NODE, "_part").select(*NODE, "ids")
    return whole.unionByName(map_batches(in_order, make, "pos long, a long, b long, ends_sha256 string", last=True))


def trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node."""
    convs, turns = numbered_turns(conversations)
    rows = prefixes(convs, turns)
    n = convs.agg(F.sum("length")).first()[0] or 0
    width = min(CELLS, max(SLICE, 1 << (PER_DIGEST * n - 1).bit_length() if n else 0))
    screened = stage(screen(rows, sketch(rows, width)), "trie-screened")

    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", *(zero.alias(c) for c in NODE), zero.alias("chars"), (F.col("length") == 0).alias("last"))
    members = screened.filter(~F.col("proven")).drop("proven", "opening").unionByName(roots)
    nodes = stage(
        members.groupBy(*NODE).agg(
            F.count("*").alias("n_convs"),
            F.min("conv_id").alias("owner"),
            F.max("chars").alias("chars"),
            F.bool_and("last").alias("childless"),
            F.min_by("last", "conv_id").alias("owner_ends"),
        ).withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")),
        "trie-nodes",
    )
    # what a conversation owns: from which depth on, the tokens saved there, and whether a leaf
    owned = nodes.select(F.col("owner").alias("conv_id"), "pos", "saved", "childless").unionByName(
        screened.filter("opening").select("conv_id", "pos", zero.alias("saved"), F.lit(True).alias("childless"))
    )
    owners = stage(
        owned.groupBy("conv_id").agg(
            F.min("pos").alias("depth_0"), F.sum("saved").alias("brought"), F.max("childless").cast("long").alias("leaf")
        ),
        "trie-owners",
    )
    paths = members.select("conv_id", *NODE).join(owners, "conv_id")
    sums = paths.groupBy(*NODE).agg(
        F.sum("brought").alias("brought"), F.sum("leaf").alias("n_leaves"), F.count_if(F.col("depth_0") == F.col("pos") + 1).alias("others")
    )
    # the node that a conversation's own nodes hang on
    hung = paths.filter(F.col("depth_0") == F.col("pos") + 1).select("conv_id", *NODE)
    above = stage(hung.join(nodes.select(*NODE, F.col("owner").alias("above")), list(NODE)).select("conv_id", "above"), "trie-above")
    deeper = Window.partitionBy("owner").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = owners.select(F.col("conv_id").alias("owner"), "depth_0", F.col("brought").alias("own_brought"))
    nothing = sha256_text(F.lit(""))
    exact = (
        nodes.withColumn("own_below", F.sum("saved").over(deeper))
        .join(sums, list(NODE))
        .join(own, "owner")
        .join(above.withColumnRenamed("conv_id", "owner"), "owner", "left")
        .join(end_hashes(members.filter("last")), list(NODE), "left")
        .select(
            F.col("owner").alias("conv_id"),
            F.col("pos").alias("depth"),
            F.when(F.col("pos") > F.col("depth_0"), F.col("owner")).otherwise(F.col("above")).alias("parent_conv_id"),
            "n_convs",
            (F.col("others") + (~F.col("owner_ends")).cast("long")).alias("n_children"),
            "n_leaves",
            (F.col("own_below") + F.col("brought") - F.col("own_brought")).alias("saved_tokens"),
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )
    tails = screened.filter("proven").select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.lit(1).cast("long").alias("n_convs"),
        (~F.col("last")).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("last"), sha256_text(F.col("conv_id"))).otherwise(nothing).alias("ends_sha256"),
        "opening",
    )
    first = tails.filter("opening").join(owners.select("conv_id", "depth_0"), "conv_id").join(above, "conv_id", "left")
    parent = F.when(F.col("depth") > F.col("depth_0"), F.col("conv_id")).otherwise(F.col("above"))
    return (
        exact.unionByName(first.withColumn("parent_conv_id", parent).select(*RESULT))
        .unionByName(tails.filter(~F.col("opening")).withColumn("parent_conv_id", F.col("conv_id")).select(*RESULT))
    )
