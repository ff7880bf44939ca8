"""Packing documents into sequences by a configuration linear program.

The lengths of all pieces are a histogram of at most ``capacity`` entries. A configuration is a multiset of
lengths that fits one sequence. Multiplicative weights price the lengths; a knapsack dynamic program finds
the configuration of the largest price, which gets a share of the solution and lowers the prices of what it
holds; no length is used more often than it occurs. The solution is rounded down, and what is left over is
packed by best fit. All that depends on the histogram alone and runs on the
driver in bounded time; placing the pieces is a join with its intervals.

A document's tokens end with id 0. Only documents longer than a sequence are cut, into whole sequences and
one rest. Null and empty texts are one token long. Rows are packed one for one, repeated ones too; an empty
table gives an empty one. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import KEPT, SIMPLE, Pieces, by_bytes, cut, library, resolve
from .common import map_batches, part_offsets, stage, text_bytes

CAPACITY = 2048
ROUNDS = 300
RATE = 0.1  # of the multiplicative weights
STEEP = 1.1

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, part int, nth long"

Configuration = tuple[tuple[int, int], ...]  # (length, how many), longest first


# ---------------------------------------------------------------- the plan, from a histogram


def best_configuration(price: np.ndarray, most: np.ndarray, capacity: int) -> Configuration:
    """Knapsack: the multiset of lengths within ``capacity`` of the largest price, none more often than
    ``most``. The dynamic program is unbounded; a length used too often is thinned out and the gap filled
    anew by the lengths that remain."""
    left = most.copy()
    taken: dict[int, int] = defaultdict(int)
    room = capacity
    while room > 0:
        lengths = np.flatnonzero(left[: room + 1] > 0)
        lengths = lengths[lengths > 0]
        if not len(lengths):
            break
        value = np.zeros(room + 1)
        choice = np.zeros(room + 1, dtype=np.int64)
        prices = price[lengths]
        for c in range(int(lengths[0]), room + 1):
            n = int(np.searchsorted(lengths, c, side="right"))
            gains = value[c - lengths[:n]] + prices[:n]
            k = int(gains.argmax())
            if gains[k] > value[c - 1]:
                value[c], choice[c] = gains[k], lengths[k]
            else:
                value[c] = value[c - 1]
        c, count = room, defaultdict(int)
        while c > 0:
            if choice[c]:
                count[int(choice[c])] += 1
                c -= int(choice[c])
            else:
                c -= 1
        over = False
        for length, n in count.items():
            n_kept = min(n, int(left[length]))
            over |= n_kept < n
            taken[length] += n_kept
            left[length] -= n_kept
            room -= n_kept * length
        if not over:
            break
    return tuple(sorted(((length, n) for length, n in taken.items() if n), reverse=True))


def solve(histogram: np.ndarray, capacity: int) -> dict[Configuration, float]:
    """Weights of configurations by multiplicative weights, never using a length more often than it occurs.

    Prices start a little steeper than length, so that long pieces go first and short ones fill what they
    leave, and fall exponentially with the share of a length that is used. Each round gives one share of the
    sequences to the configuration that costs most."""
    lengths = np.arange(capacity + 1)
    start = (lengths / capacity) ** STEEP
    left, used = histogram.astype(float), np.zeros(capacity + 1)
    solution: dict[Configuration, float] = defaultdict(float)
    share = float((histogram * lengths).sum()) / capacity / ROUNDS
    for _ in range(ROUNDS):
        most = np.floor(left).astype(np.int64)
        price = start * np.exp(-RATE * used / np.maximum(histogram, 1))
        found = best_configuration(np.where(most > 0, price, 0.0), most, capacity)
        if not found:
            break
        at = np.array([length for length, _ in found])
        n = np.array([k for _, k in found])
        weight = max(1.0, min(share, float((left[at] / n).min())))
        solution[found] += weight
        used[at] += weight * n
        left[at] -= weight * n
    return dict(solution)


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[Configuration, int]]:
    """Configurations and how often each is used; together they hold every length as often as it occurs."""
    left = histogram.copy()
    out: list[tuple[Configuration, int]] = []
    if left[capacity]:
        out.append((((capacity, 1),), int(left[capacity])))
        left[capacity] = 0
    if not left.any():
        return out
    solution = solve(left, capacity)
    fill = lambda c: sum(length * n for length, n in c)
    for config, weight in sorted(solution.items(), key=lambda x: (-fill(x[0]), -x[1], x[0])):
        times = min(int(weight), min(int(left[length]) // n for length, n in config))
        if times:
            out.append((config, times))
            for length, n in config:
                left[length] -= times * n
    # rounding leaves a rest: each of its longest pieces with what fits it best, as often as the lengths last
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        rest = best_fill(left, capacity - longest) if longest < capacity else ()
        left[longest] += 1
        count = defaultdict(int, rest)
        count[longest] += 1
        config = tuple(sorted(count.items(), reverse=True))
        times = max(1, min(int(left[length]) // n for length, n in config))
        out.append((config, times))
        for length, n in config:
            left[length] -= times * n
    return out


def best_fill(left: np.ndarray, room: int) -> Configuration:
    """Fullest choice of lengths within ``room``: the longest that fits, again and again, unless a pair of
    lengths fills the rest exactly."""
    taken: dict[int, int] = defaultdict(int)
    left = left[: room + 1].copy()
    while room > 0:
        lengths = np.flatnonzero(left[: room + 1])
        if not len(lengths):
            break
        if left[room]:
            pick = [room]
        else:
            others = room - lengths
            exact = lengths[(others > 0) & (left[np.maximum(others, 0)] > (others == lengths))]
            pick = [int(exact[-1]), room - int(exact[-1])] if len(exact) else [int(lengths[-1])]
        for length in pick:
            taken[length] += 1
            left[length] -= 1
            room -= length
    return tuple(taken.items())


def intervals(chosen: list[tuple[Configuration, int]]) -> list[tuple]:
    """Rows ``(length, first, last, per, sequence, offset)``: pieces of a length numbered first to last go, ``per``
    to a sequence, to the sequences from ``sequence`` on, from ``offset`` on."""
    rows, seen, sequence = [], defaultdict(int), 0
    for config, times in chosen:
        offset = 0
        for length, per in config:
            first = seen[length]
            seen[length] += per * times
            rows.append((length, first, seen[length] - 1, per, sequence, offset))
            offset += per * length
        sequence += times
    return rows


# ---------------------------------------------------------------- pieces and places


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Token pieces of all documents, numbered within each task and length."""

    def make():
        tokenizer = library(resolve(path))

        def ids_of(piece: str) -> bytes:
            if piece.isalpha() and piece.islower() and SIMPLE.fullmatch(piece):
                ids = [t.id for t in tokenizer.model.tokenize(by_bytes(piece))]  # nothing to normalise or cut
            else:
                ids = tokenizer.encode(piece, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)

        known = Pieces(ids_of)
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        end = b"\0\0\0\0"

        def step(batch):
            if len(known) > KEPT:
                known.clear()
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = b"".join([known[p] for p in cut(text.as_py())]) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    length = len(piece) // 4
                    rows.append((doc, k, at // 4, length, zlib.crc32(piece), part, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

        return step

    return map_batches(docs.select("doc_id", text_bytes().alias("text")), make, PIECES)


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece."""
    spark = docs.sparkSession
    cuts = stage(pieces(docs, capacity, path), "pieces")
    counts = stage(cuts.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    # a piece's number among all of its length: those of earlier tasks, then its place in its own
    before = part_offsets(counts, "length", "part", "n")
    numbered = cuts.join(before, ["length", "part"]).withColumn("_rank", F.col("before") + F.col("nth"))
    # at most a row for each length of each configuration: bounded by the capacity, not by the documents
    rows = intervals(plan(histogram, capacity))
    table = spark.createDataFrame(rows, "length int, first long, last long, per long, sequence long, at long")
    slots = table.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("first", "last", "per", "sequence", "at"))).alias("slots")
    )
    inside = F.col("_rank") - F.col("slot.first")
    return (
        numbered.join(F.broadcast(slots), "length")
        .withColumn("slot", F.filter("slots", lambda s: (s["first"] <= F.col("_rank")) & (F.col("_rank") <= s["last"]))[0])
        .select(
            "doc_id",
            "piece",
            "start",
            F.col("length").cast("long").alias("length"),
            "ids_crc32",
            (F.col("slot.sequence") + F.floor(inside / F.col("slot.per"))).cast("long").alias("sequence_id"),
            (F.col("slot.at") + F.pmod(inside, F.col("slot.per")) * F.col("length")).cast("long").alias("offset"),
        )
    )
