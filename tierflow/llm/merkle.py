"""Merkle manifest of a table of documents, with proofs from one multiproof per partition.

A row's leaf is the SHA-256 of its fields. The leaves of a source, by doc_id, are a tree: three neighbours become
their parent until one node, the subroot, is left; the subroots, by source, are a tree likewise, whose top is the
root. ``grow`` builds all trees at once, some levels to an exchange, in blocks of leaves that are whole subtrees.

To prove its leaves a partition, a stretch of the sorted leaves, needs the nodes beside the stretch at every level
and no others: all else it derives itself. It works out these coordinates from the ends of the stretch alone,
fetches each once, derives the interiors that its leaves share, and expands the proof of every leaf from them.
Folding a leaf with its proof must give the root of the manifest; a leaf that was changed does not.

Null fields are a field of their own, a null source is a source and the first one, and a null doc_id comes first
and is not tampered with. Rows of one doc_id stand in the order of their leaves; equal rows are leaves of their
own, which may be spread over partitions, as a source may. Very long texts are hashed where they are read and
not moved. An empty table has no tree and no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ordered, ready, runs, stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
# Levels that one exchange builds: blocks of 3 ** 8 leaves.
STEP = 8
TOP = -1  # the tree of the subroots
RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf(text: Column | None = None) -> Column:
    """Hash of a row, ``text`` in place of its own."""

    def field(name: str) -> Column:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.unhex(F.sha2(F.concat(*(field(f) for f in FIELDS)), 256))


def with_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """A stored table of ``doc_id, source, leaf, altered``: the hash of each row and, where ``tampered``, of the row
    without the line ends of its text."""
    altered = F.when(F.coalesce(tampered, F.lit(False)), leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    rows = docs.select(*FIELDS).select("doc_id", "source", leaf().alias("leaf"), altered.alias("altered"))
    return stage(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")


def hash_text(column: Column) -> Column:
    return F.lower(F.hex(column))


def _width(level: Column | str) -> Column:
    """Leaves below a node of a level."""
    return F.pow(F.lit(ARITY), level).cast("long")


def _parents(level: str) -> Column:
    """The next level above an array of nodes that starts at a multiple of three."""

    def parent(i: Column) -> Column:
        run = F.slice(F.col(level), i * ARITY + 1, F.lit(ARITY))
        return F.unhex(F.sha2(F.array_join(F.transform(run, hash_text), ""), 256))

    return F.transform(F.sequence(F.lit(0), F.expr(f"cast((size({level}) - 1) div {ARITY} as int)")), parent)


def grow(leaves: DataFrame, label: str, step: int = STEP) -> DataFrame:
    """All nodes ``tree, size, level, idx, hash`` above and with the leaves ``tree, size, idx, hash`` of any number of
    trees; ``size`` is the number of leaves of the tree. A tree stops where one node is left."""
    span, level = ARITY**step, 0
    below, nodes = leaves, leaves.withColumn("level", F.lit(0))
    largest = leaves.agg(F.max("size")).first()[0] or 0
    while largest > ARITY**level:
        block = below.groupBy("tree", "size", F.expr(f"idx div {span}").alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "hash"))).getField("hash").alias("_0")
        )
        for k in range(1, step + 1):
            block = block.withColumn(f"_{k}", _parents(f"_{k - 1}"))
        levels = block.select("tree", "size", "block", F.posexplode(F.array(*(f"_{k}" for k in range(1, step + 1)))).alias("k", "_nodes"))
        found = levels.select("tree", "size", "block", (F.col("k") + level + 1).alias("level"), F.posexplode("_nodes").alias("at", "hash"))
        first = F.col("block") * _width(F.lit(level + step) - F.col("level"))
        exists = F.col("size") > _width(F.col("level") - 1)
        grown = stage(found.filter(exists).select("tree", "size", "level", (first + F.col("at")).alias("idx"), "hash"), label)
        nodes = nodes.unionByName(grown)
        level += step
        below = grown.filter(F.col("level") == level).drop("level")
    return nodes


def tops(nodes: DataFrame) -> DataFrame:
    """The last node of every tree."""
    return nodes.filter(_width("level") >= F.col("size"))


def missing(stretches: DataFrame) -> DataFrame:
    """``_part, tree, level, idx`` of the nodes that proofs of all leaves ``lo`` to ``hi`` of a tree of ``size`` leaves
    need and cannot derive: at each level the rest of the runs that the two ends are in."""
    levels = stretches.withColumn("level", F.explode(F.expr(f"sequence(0, cast(ceil(log({ARITY}, size)) as int))")))
    here = levels.withColumn("w", _width("level")).filter("w < size").selectExpr(
        "_part", "tree", "level", "lo div w AS a", "hi div w AS b", "(size - 1) div w AS last"
    )
    runs_of_ends = here.selectExpr("*", f"a - a % {ARITY} AS start", f"least(b - b % {ARITY} + {ARITY - 1}, last) AS end")
    beside = F.expr("filter(concat(sequence(start, a), sequence(b, end)), i -> i < a OR i > b)")
    return runs_of_ends.select("_part", "tree", "level", F.explode(beside).alias("idx"))


# ---------------------------------------------------------------- in one partition


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


class Stretch:
    """The nodes above consecutive leaves of a tree, level by level, each level filled up to whole runs."""

    def __init__(self, lo: int, leaves: list[str], size: int, fetched: dict[tuple[int, int], str]) -> None:
        self.levels: list[tuple[int, list[str]]] = []
        nodes, level = leaves, 0
        while size > 1:
            start, hi = lo - lo % ARITY, lo + len(nodes) - 1
            end = min(hi - hi % ARITY + ARITY - 1, size - 1)
            nodes = [fetched[level, i] for i in range(start, lo)] + nodes + [fetched[level, i] for i in range(hi + 1, end + 1)]
            self.levels.append((start, nodes))
            nodes = [digest(nodes[i : i + ARITY]) for i in range(0, len(nodes), ARITY)]
            lo, size, level = start // ARITY, -(-size // ARITY), level + 1
        self.top = nodes[0]

    def proofs(self, lo: int, n: int, above: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
        """Of ``n`` leaves from ``lo`` on, what stands left and right of the node at every level, leaf to top, then
        ``above``. Leaves of one parent share all but the first."""
        tails, first = [above], 0
        for level in range(len(self.levels) - 1, -1, -1):
            start, nodes = self.levels[level]
            here = []
            a, b = lo // ARITY**level, (lo + n - 1) // ARITY**level
            for i in range(a, b + 1):
                run = i - i % ARITY - start
                left, right = "".join(nodes[run : i - start]), "".join(nodes[i - start + 1 : run + ARITY])
                here.append([(left, right), *tails[i // ARITY - first]])
            tails, first = here, a
        return tails if self.levels else [above] * n


def fold(node: str, proof: list[tuple[str, str]]) -> str:
    for left, right in proof:
        node = hashlib.sha256(f"{left}{node}{right}".encode()).hexdigest()
    return node


def prove(leaves: pa.Table, nodes: pa.Table, n_trees: int, root: str) -> pa.Table:
    """The result rows of one partition from its leaves and the nodes fetched for it."""
    columns = [leaves[name].to_pylist() for name in ("tree", "idx", "size", "doc_id", "leaf", "altered")]
    rows = sorted(zip(*columns, strict=True), key=lambda r: r[:2])
    fetched: dict[int, dict[tuple[int, int], str]] = {}
    for tree, level, idx, value in zip(*(nodes[c].to_pylist() for c in ("tree", "level", "idx", "hash")), strict=True):
        fetched.setdefault(tree, {})[level, idx] = value.hex()
    groups: dict[int, list[tuple]] = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    built = {
        tree: Stretch(g[0][1], [r[4].hex() for r in g], g[0][2], fetched.get(tree, {})) for tree, g in groups.items()
    }
    first = rows[0][0]
    over = Stretch(first, [s.top for s in built.values()], n_trees, fetched.get(TOP, {}))
    out = []
    for (tree, group), above in zip(groups.items(), over.proofs(first, len(groups), []), strict=True):
        proofs = built[tree].proofs(group[0][1], len(group), above)
        for row, proof in zip(group, proofs, strict=True):
            own = row[4].hex()
            folded = fold(own if row[5] is None else row[5].hex(), proof)
            # a level without siblings adds nothing
            siblings = digest([part for pair in proof for part in pair])
            out.append((row[3], own, built[tree].top, root, siblings, folded, folded == root))
    names = [c.split()[0] for c in RESULT.split(", ")]
    types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


# ---------------------------------------------------------------- jobs


def verify(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per row. ``tampered`` says which rows are
    folded without the line ends of their text, by default those whose doc_id has an even crc32."""
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    sorted_leaves = ordered(with_leaves(docs, tampered), ["source", "doc_id", "leaf", "_row"], "merkle-sorted")
    parts = stage(runs(sorted_leaves, ["source"]), "merkle-runs")
    sources = stage(parts.groupBy("source").agg(F.sum("_rows").alias("size")), "merkle-sources")
    trees = ordered(sources, ["source"], "merkle-trees")
    n_trees = trees.count()
    numbered = trees.join(runs(trees, []), "_part").select(
        F.col("source").alias("_s"), "size", (F.col("_before") + F.col("_seq") - F.col("_first")).alias("tree")
    )
    spots = stage(parts.join(numbered, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "merkle-spots")
    here = spots.select(F.col("_part").alias("_p"), F.col("source").alias("_s"), "_first", "_before", "tree", "size")
    leaves = stage(
        sorted_leaves.join(here, (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_s"))).select(
            "_part", "tree", "size", (F.col("_before") + F.col("_seq") - F.col("_first")).alias("idx"), "doc_id", "leaf", "altered"
        ),
        "merkle-placed",
    )
    nodes = grow(leaves.select("tree", "size", "idx", F.col("leaf").alias("hash")), "merkle-nodes")
    top, trees_below = F.lit(TOP).cast("long"), F.lit(n_trees).cast("long")
    subroots = tops(nodes).select(top.alias("tree"), trees_below.alias("size"), F.col("tree").alias("idx"), "hash")
    over = grow(stage(subroots, "merkle-subroots"), "merkle-top")
    stretches = spots.select("_part", "tree", "size", F.col("_before").alias("lo"), (F.col("_before") + F.col("_rows") - 1).alias("hi"))
    across = spots.groupBy("_part").agg(top.alias("tree"), trees_below.alias("size"), F.min("tree").alias("lo"), F.max("tree").alias("hi"))
    beside = missing(stretches.unionByName(across)).join(nodes.unionByName(over).drop("size"), ["tree", "level", "idx"])
    # what proofs are held against: the root, one hash
    root = tops(over).select(hash_text(F.col("hash")).alias("hash")).first()
    value = root["hash"] if root else ""
    ready(docs.sparkSession)
    proven = leaves.groupBy("_part").cogroup(beside.groupBy("_part"))
    return proven.applyInArrow(lambda own, nodes: prove(own, nodes, n_trees, value), RESULT)
