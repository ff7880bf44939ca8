"""Near duplicates by SetSketch registers, banding, joint likelihood and verification.

A document is its set of distinct word shingles. Equal sets are one node. A node's sketch holds, for each
register, the exponentially spaced and truncated level of a minimum over its shingles; sketches of parts
merge by maximum. Nodes that agree on a band of registers share a bucket. Within a bucket only pairs with its
centre, the node that shares most buckets with others, are proposed; then, once what is linked has been
joined, pairs of nodes that are still in different components. For those it is first counted how many of a
node's shingles any other such node has: a node can share no more than that, which rules out, without looking
at pairs, nodes with too much of their own. Of the rest only nodes are paired that share one of the rarest fifth of
each other's shingles, as every pair of that similarity does: pages of one template, alike but not enough, do not meet
by the template. So a group of thousands of near copies costs a star and not its square, and every pair that shares
a bucket is verified, ruled out or already connected. Proposed pairs are weighed by the likelihood of their
registers; the likely ones are verified on their full shingle sets. What stays quadratic are nodes made of more than
four fifths of shingles that many others of different components have too.

Null and empty texts have no shingles and stay alone; a text is hashed whole, however long, one at a time; an empty
table gives no rows. Documents without an id link to nothing and are kept.
Rows that share a ``doc_id`` are one node of the graph, whatever their texts. Components are by the smallest
doc_id. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import mix, odd, press, steps, unpress
from .common import map_batches, ordered, ready, stage, text_bytes

REGISTERS, BAND = 112, 4
BASE = 1.02  # spacing of the levels
LEVELS = 65_000
# A pair is dropped unverified when its registers are e^-LIKELY times less likely at the threshold and above
# than at their best; 16 is 5.6 standard deviations.
LIKELY = 16.0
WORDS_KEPT = 400_000
# Shingles of one range of hashes, about, when shingles are counted.
RANGE = 1 << 22
# Components of fewer nodes are compared node by node; larger ones in pieces of about so many nodes.
SMALL, PIECE = 32, 512

class Shingles:
    """Distinct shingle hashes of texts; words are hashed once per worker."""

    def __init__(self, k: int) -> None:
        self.k, self.words, self.factors = k, {}, odd(k, 7)

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted hashes of the distinct runs of ``k`` words, or of the whole text if it has fewer."""
        if len(self.words) > WORDS_KEPT:
            self.words.clear()
        known = self.words
        hashes = []
        for word in text.lower().split():  # of bytes: A-Z only, and ASCII white space
            h = known.get(word)
            if h is None:
                h = known[word] = xxhash.xxh3_64_intdigest(word)
            hashes.append(h)
        n = len(hashes)
        if not n:
            return np.empty(0, dtype=np.uint64)
        w = np.array(hashes, dtype=np.uint64)
        size = min(self.k, n)
        total = np.zeros(n - size + 1, dtype=np.uint64)
        for j in range(size):
            total += w[j : n - size + 1 + j] * self.factors[j]
        return np.unique(mix(total + np.uint64(size)))


class Sketcher:
    """SetSketch: per register the level of the smallest of exponential variables, one per element."""

    def __init__(self, registers: int = REGISTERS) -> None:
        self.a, self.c = odd(registers, 11), odd(registers, 13)

    def __call__(self, elements: np.ndarray) -> np.ndarray:
        least = np.full(len(self.a), np.uint64(0xFFFFFFFFFFFFFFFF))
        for start in range(0, len(elements), 1024):
            part = elements[start : start + 1024]
            for i in range(0, len(self.a), 16):
                rows = slice(i, i + 16)
                np.minimum(least[rows], (self.a[rows, None] * part + self.c[rows, None]).min(axis=1), out=least[rows])
        # exponential from uniform; the level grows as the minimum shrinks and is cut off at both ends
        minimum = -np.log1p(-np.minimum((least.astype(np.float64) + 0.5) / 2.0**64, 1 - 1e-12))
        return np.clip(np.floor(1 - np.log(minimum) / math.log(BASE)), 0, LEVELS).astype("<u2")


def log_likelihood(bigger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, jaccard: np.ndarray, m: int) -> np.ndarray:
    """Log likelihood of the similarity given in how many of ``m`` registers the first sketch is bigger and
    smaller, and the set sizes. Arrays broadcast against each other."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1.0) * (BASE - 1) / BASE) / math.log(BASE)
    above, below = p(u - v * jaccard), p(v - u * jaccard)
    return bigger * np.log(above) + smaller * np.log(below) + (m - bigger - smaller) * np.log(np.maximum(1 - above - below, 1e-9))


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sketches (rows) may reach the threshold: joint likelihood over similarity."""
    bigger, smaller = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    n_a, n_b = n_a[:, None].astype(float), n_b[:, None].astype(float)
    grid = np.linspace(0.0, 1.0, 101)[None, :]
    possible = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    value = log_likelihood(bigger, smaller, n_a, n_b, np.minimum(grid, possible), a.shape[1])
    reach = np.where(grid >= threshold - 1e-9, value, -np.inf).max(axis=1)
    return (reach >= value.max(axis=1) - LIKELY) & (possible[:, 0] >= threshold - 1e-9)



def sketches(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, md5, n, same, registers, bands``; ``same`` is a 128-bit digest of the whole shingle set."""

    def make():
        shingles, sketch = Shingles(k), Sketcher()
        rows_per_band = REGISTERS // BAND

        def step(batch):
            n, same, registers, bands = [], [], [], []
            for text in batch.column(2):
                found = shingles(text.as_py())
                n.append(len(found))
                if not len(found):
                    same.append(None), registers.append(None), bands.append(None)
                    continue
                levels = sketch(found)
                same.append(xxhash.xxh3_128_digest(found.tobytes()))
                registers.append(levels.tobytes())
                keys = levels.reshape(rows_per_band, BAND)
                bands.append([xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(keys)])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(registers, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "md5", "n", "same", "registers", "bands"],
            )

        return step

    texts = docs.select("doc_id", F.md5(text_bytes()).alias("md5"), text_bytes().alias("text"))
    return map_batches(texts, make, "doc_id long, md5 string, n long, same binary, registers binary, bands array<long>")


def likely_pairs(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` whose sketches make the threshold plausible."""
    left = nodes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    right = nodes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))

    def make():
        def step(batch):
            if not batch.num_rows:
                return
            table = lambda name: np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1)
            size = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            keep = plausible(table("r_a"), table("r_b"), size("n_a"), size("n_b"), threshold)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

        return step

    both = pairs.join(right, "b").join(left, "a").select("a", "b", "n_a", "n_b", "r_a", "r_b")
    return map_batches(both, make, "a long, b long").distinct()


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold, compared in whole numbers."""
    percent = round(threshold * 100)
    texts = docs.select(F.col("doc_id").alias("id"), F.md5(text_bytes()).alias("md5"), text_bytes().alias("text"))
    ids = nodes.select("id", "md5")

    def make():
        shingles, last = Shingles(k), [None, None]

        def step(batch):
            a, b = [], []
            for left, right, text_a, text_b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if last[0] != left:
                    last[:] = [left, shingles(text_a.as_py())]
                other = shingles(text_b.as_py())
                shared = len(np.intersect1d(last[1], other, assume_unique=True))
                if 100 * shared >= percent * (len(last[1]) + len(other) - shared):
                    a.append(left), b.append(right)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        return step

    with_b = pairs.join(ids.withColumnRenamed("id", "b"), "b").join(texts.withColumnRenamed("id", "b"), ["b", "md5"])
    with_b = with_b.select("a", "b", F.col("text").alias("text_b"))
    with_a = with_b.join(ids.withColumnRenamed("id", "a"), "a").join(texts.withColumnRenamed("id", "a"), ["a", "md5"])
    return map_batches(with_a.select("a", "b", F.col("text").alias("text_a"), "text_b"), make, "a long, b long").distinct()


def packed_shingles(texts: DataFrame, k: int, shingles: int) -> DataFrame:
    """Shingles of ``id, text``, packed for each batch of documents and each range of hashes. ``sizes``, the shingles of
    each document, are in the first row of a batch. The ranges are as many as ``shingles``, about that of all
    documents, need so that one has ``RANGE`` of them."""
    ready(texts.sparkSession)
    ranges = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-shingles // RANGE))

    def make():
        of = Shingles(k)
        edges = (np.arange(1, ranges, dtype=np.float64) * (2.0**64 / ranges)).astype(np.uint64)

        def step(batch):
            if not batch.num_rows:
                return
            found = [of(text.as_py()) for text in batch.column(1)]
            sizes = np.array([len(f) for f in found], dtype="<u4")
            keys = np.concatenate(found)
            owner = np.repeat(np.arange(len(found), dtype="<u2"), sizes)
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            at = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
            parts = [(b, lo, hi) for b, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True)) if hi > lo]
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            yield pa.record_batch(
                [
                    pa.array([b for b, _, _ in parts], pa.int32()),
                    pa.array([ids] * len(parts), pa.binary()),
                    pa.array([press(sizes) if i == 0 else b"" for i in range(len(parts))], pa.binary()),
                    pa.array([press(owner[lo:hi]) for _, lo, hi in parts], pa.binary()),
                    pa.array([press(steps(keys[lo:hi])) for _, lo, hi in parts], pa.binary()),
                ],
                names=["range", "ids", "sizes", "owners", "keys"],
            )

        return step

    schema = "range int, ids binary, sizes binary, owners binary, keys binary"
    return map_batches(texts.select("id", text_bytes().alias("text")), make, schema)


def counted(table: pa.Table) -> tuple[list[dict], list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Of a range: its rows, and for each row owners, hashes and how many documents have each."""
    rows = table.to_pylist()
    owners = [unpress(r["owners"], "<u2") for r in rows]
    keys = [np.cumsum(unpress(r["keys"], "<u8"), dtype=np.uint64) for r in rows]
    _, inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    return rows, owners, keys, np.split(n[inverse], np.cumsum([len(x) for x in keys])[:-1])


def batch_keys(rows: list[dict]) -> pa.Array:
    return pa.array([xxhash.xxh3_64_intdigest(r["ids"]) - (1 << 63) for r in rows], pa.int64())


def shared_sizes(texts: DataFrame, k: int, shingles: int = 0) -> DataFrame:
    """``id, common`` of ``id, text``: how many of a document's shingles at least one other has too.

    A shingle that all have is one entry per document in the task of its range, like any other."""

    def count(table: pa.Table) -> pa.Table:
        rows, owners, _, n = counted(table)
        sums = [press(np.bincount(own[of > 1], minlength=len(row["ids"]) // 8).astype("<u4")) for row, own, of in zip(rows, owners, n, strict=True)]
        return pa.table({"batch": batch_keys(rows), "ids": pa.array([r["ids"] for r in rows], pa.binary()), "sums": pa.array(sums, pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        ids = table.column("ids")[0].as_py()
        common = sum(unpress(x, "<u4").astype(np.int64) for x in table.column("sums").to_pylist())
        return pa.table({"id": pa.array(np.frombuffer(ids, dtype="<i8"), pa.int64()), "common": pa.array(common, pa.int64())})

    # a row for each batch and range here, and one for each document only when they are summed
    found = packed_shingles(texts, k, shingles).groupBy("range").applyInArrow(count, "batch long, ids binary, sums binary")
    found = found.groupBy("batch").applyInArrow(add, "id long, common long")
    return found.groupBy("id").agg(F.max("common").alias("common"))


def rare_shingles(texts: DataFrame, k: int, threshold: float, shingles: int = 0) -> DataFrame:
    """``id, key`` of ``id, text``: those of a document's rarest shingles that another has too.

    All documents order their shingles alike, by how many have them and then by hash. Two that share the threshold of
    their union share the threshold of either, so a shingle is in both when the first n - ceil(threshold * n) + 1 of
    each are held against each other. What only one document has comes first in that order and meets nobody."""
    percent = round(threshold * 100)

    def count(table: pa.Table) -> pa.Table:
        rows, owners, keys, n = counted(table)
        several = [of > 1 for of in n]
        packed = lambda values, kind=None: pa.array([press(v if kind is None else v.astype(kind)) for v in values], pa.binary())
        return pa.table(
            {
                "batch": batch_keys(rows),
                "ids": pa.array([r["ids"] for r in rows], pa.binary()),
                "sizes": pa.array([r["sizes"] for r in rows], pa.binary()),
                "owners": packed([x[m] for x, m in zip(owners, several, strict=True)]),
                "keys": packed([steps(x[m]) for x, m in zip(keys, several, strict=True)]),
                "n": packed([x[m] for x, m in zip(n, several, strict=True)], "<u8"),
            }
        )

    def choose(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        ids = np.frombuffer(rows[0]["ids"], dtype="<i8")
        sizes = next(unpress(r["sizes"], "<u4") for r in rows if r["sizes"]).astype(np.int64)
        owner = np.concatenate([unpress(r["owners"], "<u2") for r in rows]).astype(np.int64)
        keys = np.concatenate([np.cumsum(unpress(r["keys"], "<u8"), dtype=np.uint64) for r in rows])
        n = np.concatenate([unpress(r["n"], "<u8") for r in rows])
        order = np.lexsort((keys, n, owner))
        owner, keys = owner[order], keys[order]
        several = np.bincount(owner, minlength=len(ids))
        first = sizes + (-percent * sizes) // 100 + 1  # n - ceil(threshold * n) + 1
        place = np.arange(len(owner)) - (np.cumsum(several) - several)[owner]
        take = place < (first - (sizes - several))[owner]
        return pa.table({"id": pa.array(ids[owner[take]], pa.int64()), "key": pa.array(keys[take].view("<i8"), pa.int64())})

    found = packed_shingles(texts, k, shingles)
    found = found.groupBy("range").applyInArrow(count, "batch long, ids binary, sizes binary, owners binary, keys binary, n binary")
    return found.groupBy("batch").applyInArrow(choose, "id long, key long")


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` of every node with an edge: the smallest id that can be reached.

    Labels spread along edges and jump to the labels of labels. Every round is a written table, so a lost
    executor costs one round, and both sides of each join are plain exchanges that can be split."""
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    before = None
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").select(F.col("a").alias("id"), "component")
        spread = stage(near.union(labels).groupBy("id").agg(F.min("component").alias("component")), "labels")
        jump = spread.select(F.col("id").alias("component"), F.col("component").alias("further"))
        labels = stage(spread.join(jump, "component", "left").select("id", F.least("component", "further").alias("component")), "labels")
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if now == before:
            return labels
        before = now


def across(placed: DataFrame, tested: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """Links between nodes of different components that share a key.

    ``placed`` has ``key, id, n, component, common``. A node is held against each component it meets that is
    larger than its own (ties: of smaller id): against single nodes of a small one, against all nodes of a
    large one at once, in pieces of bounded size. So the rows grow with nodes times components, not with the
    square of a group."""
    slack, most = 1e-6, 1 + threshold
    of = stage(placed.select("id", "n", "component", "common").distinct(), "placed")
    sizes = stage(
        of.groupBy("component").agg(
            F.count("*").alias("size"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("common").alias("most")
        ),
        "component-sizes",
    )
    ranked = placed.join(sizes.select("component", "size"), "component")
    here = ranked.select("key", F.col("component").alias("target"), F.col("size").alias("target_size")).distinct()
    here = stage(here.join(sizes.select(F.col("component").alias("target"), "low", "high", "most"), "target"), "key-components")
    before = (F.col("target_size") > F.col("size")) | ((F.col("target_size") == F.col("size")) & (F.col("target") < F.col("component")))
    # no member of the target could reach the threshold, by sizes and by what others have too
    fits = (F.col("n") >= threshold * F.col("low") - slack) & (F.col("high") >= threshold * F.col("n") - slack)
    can = most * F.least("common", "most") >= threshold * (F.col("n") + F.greatest("low", threshold * F.col("n"))) - slack
    ranked = stage(ranked, "ranked-members")
    meets = ranked.join(here, "key").filter(before & fits & can).select("id", "n", "common", "target", "target_size").distinct()
    meets = stage(meets, "meetings")
    small = meets.filter(F.col("target_size") < SMALL).join(
        of.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("target"), F.col("common").alias("common_b")),
        "target",
    )
    small = small.filter(
        (F.least("n", "n_b") >= threshold * F.greatest("n", "n_b") - slack)
        & (most * F.least("common", "common_b") >= threshold * (F.col("n") + F.col("n_b")) - slack)
    ).select(F.col("id").alias("a"), "b")
    done = tested.select("a", "b").union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = stage(small.distinct().join(done, ["a", "b"], "left_anti"), "open")
    single = verified(stage(likely_pairs(pairs, nodes, threshold), "likely"), nodes, texts.withColumnRenamed("id", "doc_id"), k, threshold)
    # large components: pieces of at most about PIECE nodes against at most about PIECE visitors
    large = meets.filter(F.col("target_size") >= SMALL).select("id", "target", "target_size")
    visitors = stage(large.groupBy("target").agg(F.count("*").alias("visitors"), F.max("target_size").alias("size")), "visited")
    cuts = visitors.select("target", F.ceil(F.col("size") / PIECE).alias("cut"), F.ceil(F.col("visitors") / PIECE).alias("among"))
    piece = lambda n: F.pmod(F.xxhash64("id"), n)
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    inside = of.select("id", F.col("component").alias("target")).join(cuts, "target")
    inside = inside.select("target", "id", piece(F.col("cut")).alias("part"), each(F.col("among")).alias("group"))
    outside = large.select("target", "id").join(cuts, "target")
    outside = outside.select("target", "id", each(F.col("cut")).alias("part"), piece(F.col("among")).alias("group"))
    percent = round(threshold * 100)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            shingles = Shingles(k)
            ids = left.column("id").to_pylist()
            sets = [shingles(t.as_py()) for t in left.column("own_text")]
            sizes = np.array([len(x) for x in sets])
            keys, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(keys, kind="stable")
            keys, owner = keys[order], owner[order]
            for id_, t in zip(right.column("id").to_pylist(), right.column("other_text"), strict=True):
                own = shingles(t.as_py())
                lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
                n = hi - lo
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                shared = np.bincount(owner[at], minlength=len(sets))
                for i in np.flatnonzero(100 * shared >= percent * (sizes + len(own) - shared)):
                    a.append(id_), b.append(ids[i])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    keys = ["target", "part", "group"]
    own_texts = texts.select("id", text_bytes().alias("own_text"))
    other_texts = texts.select("id", text_bytes().alias("other_text"))
    grouped = inside.join(own_texts, "id").groupBy(*keys).cogroup(outside.join(other_texts, "id").groupBy(*keys))
    return single.union(grouped.applyInArrow(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    all_rows = stage(sketches(docs, k), "sketches")
    rows = all_rows.filter("n > 0 AND doc_id IS NOT NULL")
    # one node per distinct set, named by its smallest doc_id
    sets = stage(rows.groupBy("same").agg(F.min(F.struct("doc_id", "md5")).alias("first")), "sets")
    named = sets.select("same", F.col("first.doc_id").alias("id"))
    of = stage(rows.select("same", "doc_id").join(named, "same").select("doc_id", "id").distinct(), "members")
    nodes = (
        rows.join(sets.select("first.doc_id", "first.md5", F.col("first.doc_id").alias("id")), ["doc_id", "md5"])
        .dropDuplicates(["same"])
        .select("id", "md5", "n", "registers", "bands")
    )
    nodes = stage(nodes, "nodes")
    buckets = nodes.select("id", "n", F.explode("bands").alias("band"))
    sizes = stage(buckets.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1"), "buckets")
    members = stage(buckets.join(sizes, "band"), "bucket-members")
    weights = members.groupBy("id").agg(F.sum("size").alias("weight"))
    weighed = stage(members.join(weights, "id").select("band", "id", "n", "weight"), "bucket-weights")
    centres = weighed.groupBy("band").agg(F.max(F.struct("weight", F.negative("id").alias("minus"), "n")).alias("c"))
    centres = stage(centres.select("band", F.negative("c.minus").alias("a"), F.col("c.n").alias("n_a")), "centres")
    near = F.least("n", "n_a") >= threshold * F.greatest("n", "n_a") - 1e-6
    stars = weighed.join(centres, "band").filter(near & (F.col("a") != F.col("id"))).select("a", F.col("id").alias("b"))
    stars = stage(stars.distinct(), "stars")
    first = stage(verified(stage(likely_pairs(stars, nodes, threshold), "likely"), nodes, docs, k, threshold), "links")
    # rows that share an id join the nodes of their texts
    shared = of.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a <> b").select("a", "b")
    links = stage(first.union(shared), "links")
    labels = components(links)
    # what shares a bucket and is not connected yet
    label = F.coalesce("component", "id")
    placed = weighed.join(labels, "id", "left").select("band", "id", "n", label.alias("component"))
    mixed = stage(
        placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band"),
        "mixed",
    )
    placed = stage(placed.join(mixed, "band"), "mixed-members")
    asked = nodes.select("id", "md5").join(placed.select("id").distinct(), "id", "left_semi")
    texts = docs.select(F.col("doc_id").alias("id"), F.md5(text_bytes()).alias("md5"), "text").join(asked, ["id", "md5"], "left_semi")
    texts = stage(texts.select("id", "text"), "mixed-texts")
    # of n shingles of their own, a and b share at most what others have too
    shingled = lambda of: of.agg(F.sum("n")).first()[0] or 0
    left = placed.select("id", "n", "component").distinct()
    common = stage(shared_sizes(texts, k, shingled(left)), "common")
    left = stage(left.join(common, "id").filter(F.col("common") >= threshold * F.col("n") - 1e-6), "open-nodes")
    # and one of their rarest
    texts = stage(texts.join(left.select("id"), "id", "left_semi"), "open-texts")
    rare = stage(left.join(rare_shingles(texts, k, threshold, shingled(left)), "id"), "rare")
    met = rare.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    placed = stage(rare.join(met, "key"), "rare-members")
    more = stage(across(placed, stars, nodes, texts, k, threshold), "links")
    if more.limit(1).count():
        labels = components(links.union(more))
    # every row gets the component of its set
    smallest = of.join(labels, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component_id"))
    smallest = stage(smallest.groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "classes")
    linked = all_rows.select("doc_id", F.col("n").alias("n_shingles")).join(smallest, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return linked.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with its own columns. Rows that repeat an id and
    a text are one document; those that repeat an id with other texts are documents of their own, the first by text
    the smallest. Documents without an id stay."""
    if not docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        gone = stage(near_duplicates(docs, k, threshold).filter(~F.col("kept")).select("doc_id").distinct(), "copies")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    once = stage(docs.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]), "documents-once")
    # their places in the order of id and text stand for the ids
    places = ordered(once.select("doc_id", "text"), ["doc_id", "text"], "documents-ordered").select("doc_id", "text", F.col("_seq").alias("at"))
    nearest = near_duplicates(places.select(F.col("at").alias("doc_id"), "text"), k, threshold)
    copies = nearest.filter(~F.col("kept")).select(F.col("doc_id").alias("at"))
    gone = stage(places.join(copies, "at").select("doc_id", "text"), "copies")
    left = once.join(gone, ["doc_id", "text"], "left_anti").select(*docs.columns)
    return left.unionByName(docs.filter("doc_id IS NULL"))
