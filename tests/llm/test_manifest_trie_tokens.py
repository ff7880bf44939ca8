"""Token files, the Merkle manifest and the prefix trie against brute force, in one part and in many."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests import oracle
from tierflow.llm import common, merkle, prefix_trie, token_file
from tierflow.llm.common import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row int, _part int, _seq int, tree int, idx int"
CONVS = "conv_id long, turn long, role string, text string, pos int, a int, _part int, last string"
LONG = "so long a text\n" * 20000
PLAIN = Tokenizer.from_file(public_tokenizers.path(token_file.TOKENIZER))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with names used inside."""
    rows = [
        (1, "one\ntwo three", "en", "a", 33),
        (1, "one\ntwo three", "en", "a", 33),
        (1, "another text of the same id", "en", "a", 33),
        (2, "One two", None, None, None),
        (3, None, None, None, None),
        (4, "", "", "", 0),
        (None, "token = abcdefgh12345 éß\U0001f600 <|endoftext|>", None, None, 5),
        (None, "a  b\t \nc\x1c d", None, "ß", 5),
        (5, LONG, "en", "a", len(LONG)),
        (6, " \t\n", None, "b", 3),
    ]
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], DOCS)


@pytest.fixture(scope="module")
def hot(spark):
    """A source and an id, or none, with a third of all rows each, many of them equal."""
    rows = [(i, f"text {i}\nend", "en", f"s{i % 7}" if i % 3 else "hot", i) for i in range(400)]
    rows += [(7, "the same\n", None, "hot", 1)] * 150 + [(None, "without", "de", None, None)] * 150
    random.Random(3).shuffle(rows)
    return spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], DOCS).repartition(5)


def small_parts(monkeypatch):
    """Parts of a few rows, so that keys and conversations lie in many."""
    monkeypatch.setattr(common.ordered, "__defaults__", (16,))
    monkeypatch.setattr(prefix_trie, "SORTED_ROWS", 16)


# ---------------------------------------------------------------- token files


def _expected_ids(rows):
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"])
    at, out = 0, []
    for r in sorted(rows, key=order):
        ids = [*PLAIN.encode(r["text"], add_special_tokens=False).ids, token_file.END]
        out.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def _with_hash(docs):
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h")).collect()


def _sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])


def test_token_files_hold_what_the_library_gives(spark, odd, hot):
    for docs in (table(spark, SF, "documents"), odd, hot):
        assert _sorted(token_file.round_trip(docs).collect()) == _sorted(_expected_ids(_with_hash(docs)))
    assert token_file.round_trip(odd.filter("false")).collect() == []


def test_files_are_in_order_and_read_at_random(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "BLOCK", 64)
    docs = table(spark, SF, "documents")
    files = token_file.write(docs, f"file:{tmp_path}/ids", file_bytes=50_000).orderBy("part").collect()
    assert len(files) > 4
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    seen = []
    for row in files:
        file = token_file.Reader(row["path"])
        assert file.bits == 16 and len(file.offsets) == -(-file.n_ids // file.block) + 1
        seen += file.doc_ids.tolist()
        for n in random.Random(1).sample(range(file.n_docs), 3):
            ids = PLAIN.encode(texts[int(file.doc_ids[n])], add_special_tokens=False).ids
            assert file.document(n).tolist() == [*ids, token_file.END]
    assert seen == sorted(texts)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_ids_of_any_width_come_back(bits, ids):
    values = np.array(ids, np.uint32) & np.uint32((1 << bits) - 1)
    data = token_file.pack(values, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert token_file.unpack(data, bits, len(ids)).tolist() == values.tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Z9é'sß日\n\t\x0b\x1c\x85\xa0 ​.,!<|>²ÿ́"), max_size=40), st.integers(1, 9))
def test_pieces_encode_as_whole_texts(text, stretch):
    coder = token_file.encoder(public_tokenizers.path(token_file.TOKENIZER))
    before, token_file.STRETCH = token_file.STRETCH, stretch
    try:
        ids = [i for part in coder.ids(text) for i in part.tolist()]
    finally:
        token_file.STRETCH = before
    assert ids == PLAIN.encode(text, add_special_tokens=False).ids


def test_what_an_encoder_keeps_is_bounded(monkeypatch):
    coder = token_file.Encoder(public_tokenizers.path(token_file.TOKENIZER))
    monkeypatch.setattr(token_file, "KEPT", 2000)
    for i in range(60):
        text = " ".join(f"w{i}x{j}" for j in range(40)) + " " + "y" * 500 + " end"
        assert [n for part in coder.ids(text) for n in part.tolist()] == PLAIN.encode(text, add_special_tokens=False).ids
        assert sum(map(len, coder.known)) < 4000 and max(map(len, coder.known)) <= token_file.LONGEST


def test_no_token_file(tmp_path):
    (tmp_path / "x").write_bytes(b"TIDBITS1 but nothing else that such a file has, though it is long enough to")
    with pytest.raises(ValueError, match="no file of token ids"):
        token_file.Reader(str(tmp_path / "x"))


# ---------------------------------------------------------------- Merkle manifest


def _h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: _h([field(v) for v in (*r[:4], text)])

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([_h(levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, i):
        out = []
        for level in levels[:-1]:
            run = i - i % 3
            out.append((level[run:i], level[i + 1 : run + 3]))
            i //= 3
        return out

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    by_source = {s: sorted(((r[0] is not None, r[0] or 0, leaf(r, r[4])), r) for r in rows if r[1] == s) for s in sources}
    trees = {s: tree([key[2] for key, _ in by_source[s]]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for n, s in enumerate(sources):
        for i, (key, r) in enumerate(by_source[s]):
            proof = path(trees[s], i) + path(top, n)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for left, right in proof:
                node = _h([*left, node, *right])
            siblings = _h([x for left, right in proof for x in (*left, *right)])
            out.append((r[0], key[2], trees[s][-1][0], top[-1][0], siblings, node, node == top[-1][0]))
    return out


@pytest.mark.parametrize("parts", ["large", "small"])
def test_manifest_and_proofs_equal_brute_force(spark, odd, hot, monkeypatch, parts):
    if parts == "small":
        small_parts(monkeypatch)
        monkeypatch.setattr(merkle.grow, "__defaults__", (2,))
    for docs in (odd, hot):
        rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
        assert _sorted(merkle.verify(docs).collect()) == _sorted(_manifest(rows))


def test_manifest_of_nothing_and_of_one_row(spark, odd):
    assert merkle.verify(odd.filter("false")).collect() == []
    (row,) = merkle.verify(odd.filter("doc_id = 2")).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_partition_fetches_only_nodes_it_cannot_derive(spark):
    """Against the same by sets: all siblings on the paths of leaves lo to hi, less what can be derived."""
    cases = [(lo, hi, size) for size in (1, 2, 3, 4, 27, 28, 100) for lo in range(0, size, 7) for hi in range(lo, size, 5)]
    frame = spark.createDataFrame([(i, 0, size, lo, hi) for i, (lo, hi, size) in enumerate(cases)], "_part int, tree long, size long, lo long, hi long")
    got = {(r["_part"], r["level"], r["idx"]) for r in merkle.missing(frame).collect()}
    want = set()
    for part, (lo, hi, size) in enumerate(cases):
        known, level = set(range(lo, hi + 1)), 0
        while size > 1:
            runs = {j for i in known for j in range(i - i % 3, i - i % 3 + 3) if j < size}
            want |= {(part, level, j) for j in runs - known}
            known, size, level = {i // 3 for i in known}, -(-size // 3), level + 1
    assert got == want


def test_manifest_equals_sql(spark):
    assert oracle.compare(spark, oracle.connect(SF), SF, "op12_merkle") is None


# ---------------------------------------------------------------- prefix trie


def _trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + ts[h:])
    members, children = {}, {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    saved = {n: (len(m) - 1) * (len(n[-1][1]) if n else 0) for n, m in members.items()}
    leaves = {n: int(n not in children) for n in members}
    for n in sorted(members, key=len, reverse=True):
        if n:
            saved[n[:-1]] += saved[n]
            leaves[n[:-1]] += leaves[n]
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(n))
        up = min(members[n[:-1]]) if n else None
        out.append((min(m), len(n), up, len(m), len(children.get(n, [])), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.fixture(scope="module")
def talks(spark):
    """Copies by the dozen, common first turns, one conversation with a third of all turns and a copy of it, ids below
    zero, conversations without turns after the rebuild, nulls, ties and repeated rows."""
    pick, rows = random.Random(5), []
    for c in [*range(-130, -90), *range(0, 60), *range(200, 330)]:
        kind = pick.randrange(4)
        for t in range(pick.randrange(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else None, "hello" if t == 0 else f"turn {t} of {kind if kind else c}"))
    for c in range(400, 470):
        rows += [(c, t, "user", f"copied {t}") for t in range(7)]
    for c in (501, 502):
        rows += [(c, t, "user", f"endless {t}") for t in range(300)]
    rows += [(600, None, None, None), (600, None, None, "x"), (600, 3, "r", "a"), (600, 3, "r", "b"), (600, 3, "r", "b")]
    rows += [(None, 1, "user", "nobody's"), (700, 1, "user", LONG), (701, 1, "user", "")]
    pick.shuffle(rows)
    return spark.createDataFrame([(*r, 1, 1, 1, "x") for r in rows], CONVS).repartition(4)


@pytest.mark.parametrize("parts", ["large", "small", "full"])
def test_trie_equals_brute_force(spark, talks, monkeypatch, parts):
    """With conversations whole, with conversations in many parts, and with a sketch that proves hardly anything."""
    if parts != "large":
        small_parts(monkeypatch)
    if parts == "full":
        monkeypatch.setattr(prefix_trie, "SLICE", 64)
        monkeypatch.setattr(prefix_trie, "CELLS", 64)
    rows = [tuple(r) for r in talks.select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in prefix_trie.trie(talks).collect()]
    assert _sorted(got) == _sorted(_trie(rows))


def test_trie_of_nothing(talks):
    assert prefix_trie.trie(talks.filter("false")).collect() == []
    assert prefix_trie.trie(talks.filter("conv_id IS NULL")).collect() == []


def test_the_sketch_never_counts_too_few_and_proves_most_tails(spark, talks):
    convs, turns = prefix_trie.numbered_turns(talks)
    rows = common.stage(prefix_trie.prefixes(convs, turns), "test-prefixes")
    members = {(r["a"], r["b"]): r["count"] for r in rows.groupBy("a", "b").count().collect()}
    screened = prefix_trie.screen(rows, prefix_trie.sketch(rows, 1 << 14)).collect()
    proven = [members[r["a"], r["b"]] for r in screened if r["proven"]]
    assert set(proven) == {1} and len(proven) > 0.9 * sum(n == 1 for n in members.values())


def test_trie_equals_sql(spark):
    assert oracle.compare(spark, oracle.connect(SF), SF, "op13_prefix_trie") is None
