"""The queries of the operators, by name, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    merkle,
    minhash,
    order_minhash,
    packing,
    prefix_trie,
    secret_scan,
    sharding,
    spann,
    suffix_tree,
    token_file,
    toxicity,
    warc,
)
from .common import table


def op1_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"), k=4)


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.report(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op3_order_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return order_minhash.fingerprints(table(spark, sf, "documents"))


def op4_suffix_tree(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf, "documents"))


def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(table(spark, sf, "documents"))


def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(table(spark, sf, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_spann(spark: SparkSession, sf: str) -> DataFrame:
    return spann.nearest(table(spark, sf, "embeddings"))


def op10_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.report(table(spark, sf, "documents"))


def op11_token_bits(spark: SparkSession, sf: str) -> DataFrame:
    return token_file.round_trip(table(spark, sf, "documents"))


def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.verify(table(spark, sf, "documents"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf, "conversations"))


QUERIES = {f.__name__: f for f in (
        op1_minhash,
        op2_toxicity,
        op3_order_minhash,
        op4_suffix_tree,
        op5_warc,
        op6_packing,
        op7_bpe,
        op8_sharding,
        op9_spann,
        op10_secrets,
        op11_token_bits,
        op12_merkle,
        op13_prefix_trie,
    )}

# Eight groups of five hex digits, each four base32 digits.
_GROUPS = ", ".join(
    " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * g + 1}, 5))::BIGINT >> {s}) & 31)::INT + 1, 1)"
        for s in (15, 10, 5, 0)
    )
    for g in range(8)
)


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the bytes of a decimal number: a byte, then a bit at a time."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    digits = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: {bits}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({f})::VARCHAR || ':' || {f}, '-')" for f in fields) + ")"


_PARENTS = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1 : i + 3], '')))"


def _siblings(table: str, order: int, at: str, on: str) -> str:
    """Of every row and level of a tree, what stands left and right of the row's node in its run."""
    return f"""
  SELECT r, {order} AS part, level, array_to_string(nodes[j - j % 3 + 1 : j], '') || '|'
    || array_to_string(nodes[j + 2 : j - j % 3 + 3], '') AS pair
  FROM (SELECT d.r, t.level, t.nodes, ({at} // (3 ** t.level)::BIGINT) AS j FROM placed d JOIN {table} t ON {on} WHERE len(t.nodes) > 1)"""


SQL = {
    "op12_merkle": f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
    {_leaf("replace(text, chr(10), '')")} AS bare, doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 2 = 0 AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s
  FROM hashed),
trees AS (
  SELECT s, 0 AS level, list(leaf ORDER BY i) AS nodes FROM placed GROUP BY s
  UNION ALL SELECT s, level + 1, {_PARENTS} FROM trees WHERE len(nodes) > 1),
subroots AS (SELECT s, nodes[1] AS subroot FROM trees WHERE len(nodes) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY s) AS nodes FROM subroots
  UNION ALL SELECT level + 1, {_PARENTS} FROM top WHERE len(nodes) > 1),
pairs AS ({_siblings("trees", 0, "d.i", "d.s = t.s")} UNION ALL {_siblings("top", 1, "d.s", "true")}),
proofs AS (SELECT r, list(pair ORDER BY part, level) AS pairs FROM pairs GROUP BY r),
folded AS (
  SELECT p.*, subroot, coalesce(pairs, []) AS pairs,
    list_reduce(list_prepend(CASE WHEN tampered THEN bare ELSE leaf END, coalesce(pairs, [])),
      lambda n, p: sha256(split_part(p, '|', 1) || n || split_part(p, '|', 2))) AS folded_root,
    (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root
  FROM placed p JOIN subroots USING (s) LEFT JOIN proofs USING (r))
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(pairs, ''), '|', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folded""",
    "op13_prefix_trie": f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(
      strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS j,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM own GROUP BY conv_id),
turns AS (
  SELECT c.conv_id, o.j, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.j <= c.h
  UNION ALL SELECT c.conv_id, 1000000000 + o.j, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.j > c.h),
whole AS (
  SELECT c.conv_id, coalesce(list(md5(strlen(role) || ':' || role || text) ORDER BY t.j) FILTER (t.j IS NOT NULL), []) AS marks,
    coalesce(list(length(t.text) ORDER BY t.j) FILTER (t.j IS NOT NULL), []) AS chars
  FROM convs c LEFT JOIN turns t USING (conv_id) GROUP BY c.conv_id),
paths AS (
  SELECT conv_id, d, md5(array_to_string(marks[1 : d], '')) AS k, coalesce(chars[d], 0) AS chars, len(marks) = d AS last
  FROM (SELECT *, unnest(range(0, len(marks) + 1)) AS d FROM whole)),
nodes AS (
  SELECT d, k, min(conv_id) AS owner, count(*) AS n, (count(*) - 1) * max(chars) AS saved,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM paths GROUP BY d, k),
linked AS (
  SELECT n.*, p.k AS parent_k, u.owner AS parent
  FROM nodes n LEFT JOIN paths p ON p.conv_id = n.owner AND p.d = n.d - 1 LEFT JOIN nodes u ON u.d = p.d AND u.k = p.k),
children AS (SELECT d - 1 AS d, parent_k AS k, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
below AS (
  SELECT p.d, p.k, sum(v.saved) AS saved, count(*) FILTER (c.n_children IS NULL) AS n_leaves
  FROM paths p JOIN nodes v ON v.owner = p.conv_id AND v.d >= p.d LEFT JOIN children c ON c.d = v.d AND c.k = v.k
  GROUP BY p.d, p.k)
SELECT l.owner AS conv_id, l.d::BIGINT AS depth, l.parent AS parent_conv_id, l.n AS n_convs,
  coalesce(c.n_children, 0) AS n_children, b.n_leaves, b.saved::BIGINT AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN below b USING (d, k) LEFT JOIN children c USING (d, k)""",
    "op5_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, concat({_GROUPS}) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d""",
}
