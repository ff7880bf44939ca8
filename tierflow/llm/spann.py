"""Nearest neighbours by balanced posting lists.

Centroids of a bounded sample are kept about equally loaded and joined into a neighbour graph, which is
searched best-first. A vector is posted to its nearest centroid and, near a boundary, to others about as
close. A query reads the lists whose centroids are within a ratio of its nearest one's distance, or a number
of nearest lists: what is read is set by comparing some queries with all vectors, so that the lists hold the
share ``RECALL`` of their neighbours. Posting
lists are split by a hash when many vectors or queries share one, and their pieces are compared as matrices.
Products are taken in double precision and the nearest are exact for the lists read; near copies that differ by
less than double rounding are ties.

Equal vectors are one entry, with its smallest ids; so a group of copies does not fill lists, and its members
are found together. Vectors that are null, zero, or hold a null or a number that is not finite take no part,
nor do those of another length than most. Floats are kept as they are, other numbers as doubles. Ties go to the smaller id. A repeated row of the same id counts
once. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, ready, stage

SAMPLE = 20_000  # vectors the centroids are fitted on, at most
LIST = 256  # vectors a list should have, where the sample allows so many lists
FEWEST = 8  # sample vectors for a centroid, at least
NEIGHBOURS, BEAM, STRIDE = 24, 64, 8  # of the centroid graph; of its search: best found, at least, and visits a step
COPIES, COPY_RATIO = 4, 1.08  # a vector's lists: how many at most, and how much farther than the nearest
READ_LEAST = 8  # a query's lists, at least
PROBES, RECALL = 200, 0.98  # queries compared with all vectors, and the share of their neighbours that lists must hold
PIECE = 4096  # vectors or queries of a list compared in one task
NEAREST = 5


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means on unit vectors; a full cluster looks farther away the more it exceeds its share."""
    rng = np.random.default_rng(5)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    penalty = np.zeros(k)
    for _ in range(rounds):
        near = np.empty(len(x), dtype=int)
        for start in range(0, len(x), 4096):
            near[start : start + 4096] = (x[start : start + 4096] @ centres.T - penalty).argmax(axis=1)
        count = np.bincount(near, minlength=k)
        penalty = np.maximum(0, penalty + 0.02 * (count * k / len(x) - 1))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        empty = count == 0
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


def graph_of(centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of each centroid, and the places searches start from."""
    k = len(centres)
    degree = min(NEIGHBOURS, k - 1)
    if degree <= 0:
        return np.zeros((k, 1), dtype=int), np.arange(k)
    close = centres @ centres.T
    np.fill_diagonal(close, -np.inf)
    near = np.argpartition(-close, degree - 1, axis=1)[:, :degree]
    # long links keep distant regions reachable
    far = np.random.default_rng(7).integers(0, k, (k, max(2, degree // 4)))
    # and a ring all centroids
    ring = (np.arange(k)[:, None] + 1) % k
    return np.concatenate([near, far, ring], axis=1), np.linspace(0, k - 1, min(k, 16)).astype(int)


def distances(score: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * score.astype(np.float64)))


def search_graph(x: np.ndarray, centres: np.ndarray, links: np.ndarray, starts: np.ndarray, ratio: float, least: int) -> np.ndarray:
    """Best-first search for a batch: similarities of the centroids found, -inf elsewhere. It goes on while a
    centroid waits that is within ``ratio`` of the nearest one's distance or among the best found."""
    n, k = len(x), len(centres)
    rows, width, beam = np.arange(n)[:, None], min(STRIDE, k), min(max(BEAM, least), k)
    score = np.full((n, k), -np.inf, dtype=np.float32)
    score[:, starts] = x @ centres[starts].T
    waiting = score.copy()
    while True:
        best = np.argpartition(-waiting, width - 1, axis=1)[:, :width]
        value = waiting[rows, best]
        floor = np.partition(score, k - beam, axis=1)[:, k - beam]
        # both bounds only tighten: what is not worth a visit now never is
        worth = (value > floor[:, None]) | (distances(value) <= ratio * distances(score.max(axis=1))[:, None] + 1e-9)
        row, at = np.nonzero(worth & np.isfinite(value))
        if not len(row):
            return score
        waiting[rows, best] = -np.inf
        fresh = np.zeros((n, k), dtype=bool)
        fresh[row[:, None], links[best[row, at]]] = True
        row, at = np.nonzero(fresh & ~np.isfinite(score))
        score[row, at] = waiting[row, at] = np.einsum("nd,nd->n", x[row], centres[at])


def unit(values: list) -> np.ndarray:
    x = np.array(values, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def lists_of(vectors: DataFrame, centres: np.ndarray, ratio: float, least: int, most: int | None) -> DataFrame:
    """``list, gid, embedding``: each vector with the lists within ``ratio`` of its nearest centroid's distance."""

    def make():
        links, starts = graph_of(centres)

        def step(batch):
            if not batch.num_rows:
                return
            x = unit(batch.column(1).to_pylist()).astype(np.float32)
            score = search_graph(x, centres, links, starts, 1.0 if most else ratio, least)
            ids = np.argsort(-score, axis=1, kind="stable")[:, :most]
            score = np.take_along_axis(score, ids, axis=1)
            distance = distances(score)
            chosen = (distance <= ratio * distance[:, :1] + 1e-9) | (np.arange(ids.shape[1]) < least)
            chosen &= np.isfinite(score)
            row, at = np.nonzero(chosen)
            yield pa.record_batch(
                [pa.array(ids[row, at], pa.int32()), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row))],
                names=["list", "gid", "embedding"],
            )

        return step

    kind = vectors.schema["embedding"].dataType.simpleString()
    return map_batches(vectors.select("gid", "embedding"), make, f"list int, gid long, embedding {kind}")


def brute_force(vectors: DataFrame, probes: list, k: int) -> DataFrame:
    """``probe, gid``: the ``k`` nearest other vectors of each of a bounded number of ``probes`` (gid, embedding)."""
    own = np.array([r["gid"] for r in probes])
    asked = unit([r["embedding"] for r in probes])

    def make():
        ids, score = np.zeros((len(own), 0), dtype=np.int64), np.zeros((len(own), 0))

        def step(batch):
            nonlocal ids, score
            if batch is None:
                row, at = np.nonzero(np.isfinite(score))
                yield pa.record_batch([pa.array(own[row]), pa.array(ids[row, at]), pa.array(score[row, at])], names=["probe", "gid", "product"])
            elif batch.num_rows:
                gid = batch.column(0).to_numpy()
                value = asked @ unit(batch.column(1).to_pylist()).T
                value[own[:, None] == gid] = -np.inf
                ids, score = np.concatenate([ids, np.tile(gid, (len(own), 1))], axis=1), np.concatenate([score, value], axis=1)
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]
                ids, score = np.take_along_axis(ids, best, axis=1), np.take_along_axis(score, best, axis=1)

        return step

    found = map_batches(vectors.select("gid", "embedding"), make, "probe long, gid long, product double", last=True)
    best = Window.partitionBy("probe").orderBy(F.desc("product"), "gid")
    return found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).select("probe", "gid")


def reading(vectors: DataFrame, queries: DataFrame, posted: DataFrame, centres: np.ndarray, k: int) -> tuple[float, int]:
    """Ratio and least number of lists that find the share ``RECALL`` of the neighbours of some queries; of the
    two ways, by ratio and by number alone, the one that reads fewer lists."""
    some = queries.select("gid").distinct().orderBy(F.xxhash64("gid"), "gid").limit(PROBES)
    probes = vectors.join(F.broadcast(some), "gid").orderBy("gid").collect()
    if not probes or len(centres) <= READ_LEAST:
        return 1.0, READ_LEAST
    true = stage(brute_force(vectors, probes, k), "probe-neighbours")
    # at most PROBES * k * COPIES rows
    held = posted.select("list", "gid").join(F.broadcast(true), "gid").select("probe", "gid", "list").collect()
    if not held:
        return 1.0, READ_LEAST
    score = unit([r["embedding"] for r in probes]).astype(np.float32) @ centres.T
    rank = np.argsort(np.argsort(-score, axis=1, kind="stable"), axis=1, kind="stable")
    distance = distances(score)
    farther = distance / np.maximum(distance.min(axis=1, keepdims=True), 1e-9)
    place = {r["gid"]: i for i, r in enumerate(probes)}
    by_rank: dict[tuple[int, int], int] = {}
    by_ratio: dict[tuple[int, int], float] = {}
    for r in held:
        key, at = (r["probe"], r["gid"]), (place[r["probe"]], r["list"])
        by_rank[key] = min(by_rank.get(key, len(centres)), int(rank[at]) + 1)
        by_ratio[key] = min(by_ratio.get(key, np.inf), 1.0 if rank[at] < READ_LEAST else float(farther[at]))
    needed = lambda values: sorted(values)[min(len(values) - 1, int(np.ceil(RECALL * len(values))))]
    least, ratio = max(READ_LEAST, needed(by_rank.values())), needed(by_ratio.values())
    read = np.maximum((farther <= ratio).sum(axis=1), READ_LEAST).mean()
    return (ratio * (1 + 1e-6), READ_LEAST) if read < least else (1.0, least)


def nearest(table: DataFrame, every: int = 50, k: int = NEAREST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id ``every`` divides."""
    spark = table.sparkSession
    ready(spark)
    e = F.col("embedding")
    # other numbers than floats keep their precision
    kind = table.schema["embedding"].dataType.elementType.typeName()
    usable = table.select("vec_id", (e if kind == "float" else e.cast("array<double>")).alias("embedding")).filter(
        F.col("vec_id").isNotNull()
        & e.isNotNull()
        & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        & F.exists(e, lambda v: v != 0)
    )
    size = usable.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.filter(F.size("embedding") == size["d"])
    if kind != "float":
        # by a power of two, which changes no cosine, so that squares neither overflow nor vanish
        largest = F.array_max(F.transform(e, lambda v: F.abs(v)))
        usable = usable.withColumn("largest", F.pow(F.lit(2.0), F.floor(F.log2(largest))))
        usable = usable.select("vec_id", F.transform(e, lambda v: v / F.col("largest")).alias("embedding"))
    # two hashes of 64 and 32 bits name a vector; equal ones are one entry
    keyed = stage(usable.withColumns({"h": F.xxhash64("embedding"), "g": F.hash("embedding")}).dropDuplicates(["vec_id", "h", "g"]), "vectors")
    groups = stage(keyed.groupBy("h", "g").agg(F.min_by("embedding", "vec_id").alias("embedding"), F.min("vec_id").alias("gid")), "groups")
    first = Window.partitionBy("h", "g").orderBy("vec_id")
    members = (
        keyed.select("h", "g", "vec_id").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
        .groupBy("h", "g").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    members = stage(groups.select("h", "g", "gid").join(members, ["h", "g"]).select("gid", "ids"), "copies")
    asked = stage(keyed.filter(F.col("vec_id") % every == 0).select("vec_id", "h", "g"), "asked")
    queries = stage(asked.select("vec_id", "h", "g").join(groups.select("h", "g", "gid"), ["h", "g"]).select("vec_id", "gid"), "queries")
    vectors = groups.select("gid", "embedding")
    sample = vectors.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).collect()
    total = groups.count()
    x = unit([r["embedding"] for r in sample]).astype(np.float32)
    centres = balanced_centroids(x, max(1, min(total // LIST, len(x) // FEWEST)))
    posted = stage(lists_of(vectors, centres, COPY_RATIO, 1, COPIES), "postings")
    wanted = vectors.join(queries.select("gid").distinct(), "gid", "left_semi")
    read = stage(lists_of(wanted, centres, *reading(vectors, queries, posted, centres, k), None), "reads")
    # how many pieces each list has on either side: a row per list, bounded by the sample
    parts = posted.groupBy("list").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("v"))
    parts = parts.join(read.groupBy("list").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("q")), "list")
    parts = F.broadcast(spark.createDataFrame([tuple(r) for r in parts.select("list", "v", "q").collect()], "list int, v int, q int"))
    left = posted.join(parts, "list").select(
        "list", F.pmod(F.xxhash64("gid"), "v").alias("part"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qpart"), "gid", "embedding"
    )
    right = read.join(parts, "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("v").cast("long") - 1)).alias("part"), F.pmod(F.xxhash64("gid"), "q").cast("int").alias("qpart"), "gid", "embedding"
    )

    def compare(vectors, queries):
        if not len(vectors) or not len(queries):
            return found([], [], [])
        a, b = unit(queries["embedding"].tolist()), unit(vectors["embedding"].tolist())
        ids = vectors["gid"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, b = ids[order], b[order]
        # the query's own group and the k nearest others, by score, then id
        keep = min(k + 1, len(ids))
        query, near, score = [], [], []
        for start in range(0, len(a), 512):
            value = a[start : start + 512] @ b.T
            least = np.partition(value, len(ids) - keep, axis=1)[:, len(ids) - keep]
            row, at = np.nonzero(value >= least[:, None])
            order = np.lexsort((at, -value[row, at], row))
            row, at = row[order], at[order]
            # rows are in order, so a row's candidates start where the row is first found
            best = np.arange(len(row)) - np.searchsorted(row, row) < keep
            row, at = row[best], at[best]
            query.append(queries["gid"].to_numpy()[start + row])
            near.append(ids[at])
            score.append(value[row, at])
        return found(np.concatenate(query), np.concatenate(near), np.concatenate(score))

    def found(query, near, score):
        import pandas as pd

        return pd.DataFrame({"query": np.asarray(query, "int64"), "gid": np.asarray(near, "int64"), "product": np.asarray(score, "float64")})

    keys = ["list", "part", "qpart"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, "query long, gid long, product double")
    hits = hits.groupBy("query", "gid").agg(F.max("product").alias("product"))
    best = Window.partitionBy("query").orderBy(F.desc("product"), "gid")
    top = stage(hits.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1).select("query", "gid"), "hits")

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    scored = (
        top.join(vectors, "gid").join(vectors.select(F.col("gid").alias("query"), F.col("embedding").alias("asked")), "query")
        .select("query", "gid", (dot("asked", "embedding") / (F.sqrt(dot("asked", "asked")) * F.sqrt(dot("embedding", "embedding")))).alias("score"))
    )
    lists = scored.join(members, "gid").select("query", F.explode("ids").alias("vec_id"), "score")
    # at most (k + 1) groups of k + 1 ids each
    lists = stage(lists.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("near")), "lists")
    own = queries.select(F.col("vec_id").alias("query_id"), F.col("gid").alias("query")).distinct()
    return (
        own.join(lists, "query")
        .withColumn("near", F.slice(F.filter("near", lambda s: s["vec_id"] != F.col("query_id")), 1, k))
        .select("query_id", F.posexplode("near").alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", F.negative("hit.minus").alias("score"))
    )
