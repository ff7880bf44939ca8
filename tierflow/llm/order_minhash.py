"""Order MinHash fingerprints: signatures that follow edit distance, not only shared content.

A text's k-mers are numbered by occurrence, so that all are different, and hashed. The hash space is cut into
one range per component. In each, the smallest few k-mers are taken, put back into text order, and the tuple
is hashed. A range with too few k-mers takes the smallest of all k-mers under a hash of its own. Likeness is
the share of equal components; moving a passage changes the order within tuples and so lowers it.

Null text is empty. An empty text has a fixed fingerprint, unlike any other's. Rows are kept one for one. The
next document is by descending doc_id, null last, ties by the digest of the text; after the last comes the
first, so a single document is followed by itself. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, odd
from .common import map_batches, text_bytes

K, COMPONENTS, TUPLE = 8, 64, 2
PLACE = 24  # bits of a place in the text; the rest of 64 are the hash
FACTORS = odd(K, 17)
SEEDS = odd(COMPONENTS, 19)
STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed: golden ratio in 64 bits

SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _ordered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """40-bit hashes in ascending order, with their places; ties by place."""
    n = len(hashes)
    if n <= 1 << PLACE:
        packed = np.sort((hashes & ~np.uint64((1 << PLACE) - 1)) | np.arange(n, dtype=np.uint64))
        return packed >> np.uint64(PLACE), (packed & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    short = hashes >> np.uint64(PLACE)
    place = np.argsort(short, kind="stable")
    return short[place], place


def fingerprint(points: np.ndarray) -> np.ndarray:
    """Signature of a text given as code points: ``COMPONENTS`` numbers of 16 bits."""
    n = len(points)
    if not n:
        return np.zeros(COMPONENTS, dtype=np.uint16)
    size = min(K, n)
    total = np.zeros(n - size + 1, dtype=np.uint64)
    wide = points.astype(np.uint64)
    for j in range(size):
        total += wide[j : n - size + 1 + j] * FACTORS[j]
    # number the occurrences of each k-mer in text order
    value, place = _ordered(mix(total + np.uint64(size)))
    index = np.arange(len(value))
    start = np.where(np.concatenate(([True], value[1:] != value[:-1])), index, 0)
    occurrence = (index - np.maximum.accumulate(start)).astype(np.uint64)
    numbered = np.empty(len(value), dtype=np.uint64)
    numbered[place] = mix(value + occurrence * STEP)
    value, place = _ordered(numbered)
    width = np.uint64((1 << (64 - PLACE)) // COMPONENTS)
    first = np.searchsorted(value, np.arange(COMPONENTS + 1, dtype=np.uint64) * width)
    full = np.diff(first) >= TUPLE
    picks = first[:-1, None] + np.arange(TUPLE)
    picks[~full] = 0
    values, places = value[picks], place[picks]
    for c in np.flatnonzero(~full):
        own = mix(value ^ SEEDS[c])
        if len(own) > TUPLE:
            least = np.argpartition(own, TUPLE - 1)[:TUPLE]
        else:
            least = np.resize(np.arange(len(own)), TUPLE)
        values[c], places[c] = value[least], place[least]
    values = np.take_along_axis(values, np.argsort(places, axis=1, kind="stable"), axis=1)
    tuples = np.zeros(COMPONENTS, dtype=np.uint64)
    for j in range(TUPLE):
        tuples = mix(tuples * STEP + values[:, j] + np.uint64(1))
    # zero is left to the empty text
    return np.maximum((tuples & np.uint64(0xFFFF)).astype(np.uint16), 1)


def text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def points_of(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode().encode("utf-32-le"), dtype="<u4")


def in_ranges(docs: DataFrame) -> DataFrame:
    """Rows dealt into ranges of doc_id, each sorted descending and followed by the first row (``tail``) of the
    range below, the lowest by that of the highest. Four ranges for each shuffle partition; the driver holds
    a number for each range."""
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    keyed = docs.select("doc_id", text_bytes().alias("text"), key.alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * parts
    cuts = keyed.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 20 * n).alias("q")).first()["q"] or []
    cuts = sorted({int(c) for c in cuts})
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    keyed = keyed.withColumn("range", F.size(F.filter(bounds, lambda b: b < F.col("key"))))
    tops = {r["range"]: r["top"] for r in keyed.groupBy("range").agg(F.max("key").alias("top")).collect()}
    filled = sorted(tops)
    after = [(tops[low], high) for low, high in zip(filled, filled[1:] + filled[:1], strict=True)]
    tails = spark.createDataFrame(after, "key long, tail_of int")
    spread = keyed.join(F.broadcast(tails), "key", "left").select(
        "doc_id",
        "text",
        "key",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.col("range"), F.lit(0).alias("tail")),
                    F.when(F.col("tail_of").isNotNull(), F.struct(F.col("tail_of").alias("range"), F.lit(1).alias("tail"))),
                )
            )
        ).alias("to"),
    )
    dealt = spread.select("doc_id", "text", "key", "to.range", "to.tail").repartition(parts, "range")
    return dealt.sortWithinPartitions("range", "tail", F.desc("key"), F.md5("text")).select("doc_id", "text", "range", "tail")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and how alike these and the next document's are."""

    def make():
        previous = None  # doc, points, signature, range
        ended = None  # range whose tail has been seen

        def step(batch):
            nonlocal previous, ended
            out = []
            for doc, text, number, tail in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if tail and ended == number:
                    continue
                points = points_of(text.as_py())
                signature = fingerprint(points)
                if previous is not None and previous[3] == number:
                    out.append(_row(previous, points, signature))
                if tail:
                    previous, ended = None, number
                else:
                    previous = (doc, points, signature, number)
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names)

        return step

    return map_batches(in_ranges(docs), make, SCHEMA)


def _row(document, following: np.ndarray, following_signature: np.ndarray) -> tuple:
    doc, points, signature, _ = document
    half = len(points) // 2
    edited = np.concatenate([points[: len(points) - half], following[:half]])
    edited_signature = fingerprint(edited)
    digest = hashlib.sha256(edited.astype("<u4").tobytes().decode("utf-32-le").encode()).hexdigest()
    return (
        doc,
        len(points),
        digest,
        text_of(signature),
        text_of(edited_signature),
        likeness(signature, edited_signature),
        likeness(signature, following_signature),
    )
