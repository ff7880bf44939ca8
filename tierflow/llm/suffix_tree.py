"""Language-model scores by a probabilistic suffix tree over words.

States are contexts of any number of words: those of one and two are all tried, a longer one where the context
one word shorter is retained, until none is. A context is retained when it occurs often enough and the
divergence of its next-word distribution from that of the context one word shorter, summed over its
occurrences and estimated leaving each of them out, passes a test. Distributions are smoothed by absolute
discounting towards the shorter context, down to single words and one symbol for all unknown words. A token
is scored in the state of the longest retained suffix of what stands before it; texts end with an end token.

The corpus is cut into blocks of about a million tokens, each coded by its own word list. Counts are summed
by exchanging, between blocks and hash buckets, what a block holds and the totals it needs back: every
distinct word and word sequence of a block crosses the network once each way, however often it occurs, so a
frequent word costs a bucket one entry per block. Blocks lie in a table bucketed by block and are not shuffled
again. Words are counted exactly and hashed once; longer sequences are counted by 64-bit hashes. From three words
on a block says at once which places are left and what it asks of them; a context has the total of the sequence
that ends one place before, and is asked for only where that was not counted.

Null text is empty: one end token. A null ``doc_id`` is learnt from. Rows are kept one for one; without
training rows all scores are 0. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow import session

from .arrays import mix, press, steps, unpress
from .common import held_out, map_batches, ready, stage, text_bytes

MODULUS = 7
BLOCK_TOKENS = 1 << 20
SUPPORT = 4  # occurrences of a context, at least
GAIN = 4.0  # summed divergence (natural logarithm) that retains a context
DISCOUNT = 0.75  # of sequence counts

BLOCK = "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, words binary, hashes binary, ids binary"
REQUEST = "round int, bucket int, block long, keys binary, payload binary"
REPLY = "block long, round int, bucket int, totals binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
# Rounds: totals of words, of pairs, of contexts of one word, of triples, of contexts of two words.
WORDS, PAIRS, ONE, TRIPLES, TWO = range(5)
# From three words on, per length: totals of contexts, of sequences, of contexts again with what the test needs.
# What a block hands on: of its tokens in the longest contexts the steps between places, chances, and one more than
# the total of the context one word longer or 0 where it is not known; steps between places where that context is
# known to be too rare; figures of its documents.
RARE, PLACES, CHANCE, BEFORE, KNOWN, BASE, MODEL = range(-7, 0)
FLOATS = (CHANCE, BASE, MODEL)
KINDS = {RARE: "<u4", PLACES: "<u4", KNOWN: "<u4"} | dict.fromkeys(FLOATS, "<f8")
TOTAL = "<u8"  # of the whole corpus; the bytes that are zero take no room


def deeper(depth: int) -> tuple[int, int, int]:
    """Rounds of contexts of ``depth`` words."""
    first = TWO + 1 + 3 * (depth - 3)
    return first, first + 1, first + 2



# Types of what a block says of a context: divergence, distinct next words, those seen once, occurrences.
CONTEXT = ("<f4", "<f4", "<u4", "<u4")

_START = np.uint64(0x2545F4914F6CDD1D)  # stands for the place before the first word
_FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # fixed odd numbers


def press_columns(columns: list[np.ndarray]) -> bytes:
    """Compressed arrays one after the other, each with its length in front."""
    return b"".join(len(part).to_bytes(4, "little") + part for part in map(press, columns))


def unpress_columns(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(unpress(data[at + 4 : at + 4 + size], kind))
        at += 4 + size
    return out


# ---------------------------------------------------------------- blocks


class Numbers(dict):
    """Numbers of words in the order they first come."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def blocks(docs: DataFrame) -> DataFrame:
    """Rows of ``BLOCK``: token ids of some documents and the words they stand for; word 0, empty, is the end."""

    def make():
        part, number = TaskContext.get().partitionId(), 0
        known = Numbers({b"": 0})
        ids, doc_ids, held, sizes, total = [], [], [], [], 0

        def close():
            nonlocal number, known, ids, doc_ids, held, sizes, total
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), np.uint64, count=len(known))
            row = [
                [(part << 32) + number], [doc_ids], [held], [sizes],
                [zstandard.ZstdCompressor(level=3).compress(b"\n".join(known))], [hashes.tobytes()], [press(np.concatenate(ids))],
            ]
            types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())
            number += 1
            known, ids, doc_ids, held, sizes, total = Numbers({b"": 0}), [], [], [], [], 0
            return pa.record_batch([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=[c.split()[0] for c in BLOCK.split(", ")])

        def step(batch):
            nonlocal total
            if batch is None:
                if sizes:
                    yield close()
                return
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                found = text.as_py().lower().split()  # of bytes: A-Z only, and ASCII white space
                found.append(b"")
                ids.append(np.fromiter(map(known.__getitem__, found), "<u4", count=len(found)))
                doc_ids.append(doc), held.append(out), sizes.append(len(found))
                total += len(found)
                if total >= BLOCK_TOKENS:
                    yield close()

        return step

    texts = docs.select("doc_id", held_out(MODULUS).alias("held"), text_bytes().alias("text"))
    return map_batches(texts, make, BLOCK, last=True)


@dataclass
class Corpus:
    """What the whole corpus has: training tokens, distinct words, words seen once and twice, documents."""

    tokens: int
    words: int
    once: int
    twice: int
    documents: int

    @property
    def discount(self) -> float:
        return min(0.95, max(0.05, self.once / (self.once + 2 * self.twice))) if self.once else 0.5


# Distinct keys, ascending, and for each place the number of its key among them.
Keys = tuple[np.ndarray, np.ndarray]


def numbered(keys: np.ndarray) -> Keys:
    """As ``np.unique`` with ``return_inverse``: keys are sorted by their upper bits with their places in the lower."""
    bits = np.uint64(max(len(keys) - 1, 1).bit_length())
    packed = keys >> bits << bits
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    order = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ranked = keys[order]
    if (ranked[1:] < ranked[:-1]).any():  # keys that differ in the lower bits only
        return np.unique(keys, return_inverse=True)
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number


def some(distinct: np.ndarray, number: np.ndarray, asked: np.ndarray) -> Keys:
    """The keys of the places that are ``asked``, numbered anew without sorting them again."""
    number = number[asked]
    used = np.zeros(len(distinct), dtype=bool)
    used[number] = True
    return distinct[used], (np.cumsum(used) - 1)[number]


class Block:
    """A block's tokens with the totals received so far, by round."""

    def __init__(self, row: dict, totals: dict[int, np.ndarray], corpus: Corpus | None) -> None:
        self.number, self.corpus, self.totals = row["block"], corpus, totals
        self.doc_ids, self.held = row["doc_ids"], np.array(row["held"], dtype=bool)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.ids = unpress(row["ids"], "<u4").astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.train = ~self.held[self.doc]
        starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.first = np.zeros(len(self.ids), dtype=bool)
        self.first[starts] = True
        self.hashes = np.frombuffer(row["hashes"], np.uint64)

    def word_order(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Local words by bucket, and where each bucket starts among them."""
        bucket = (self.hashes % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(buckets + 1))

    def count(self, buckets: int) -> None:
        """Fill in totals per position: of the word, of contexts and of sequences."""
        order, _ = self.word_order(buckets)
        per_word = np.zeros(len(self.hashes), dtype=np.int64)
        per_word[order] = self.totals[WORDS]
        self.c = per_word[self.ids]
        before = np.concatenate(([0], self.ids[:-1]))
        symbol = self.hashes[self.ids]
        # contexts of one word are numbered by the word, the place before the first as one more; only words are sorted
        key_word = mix(np.append(self.hashes, _START) * _FACTORS[0])
        context = np.where(self.first, len(self.hashes), before)
        self.key_pair = mix(key_word[context] + symbol * _FACTORS[1])
        self.n_one = np.where(self.first, self.corpus.documents, per_word[before])
        # asking also says what is here: what training has once is asked for too, for held-out texts that have it
        self.ask_pair = (self.n_one >= SUPPORT) & (self.c >= 1)
        distinct, number = numbered(self.key_pair)
        self.asked_pair = some(distinct, number, self.ask_pair)
        if PAIRS not in self.totals:
            return
        self.n_pair = self._spread(PAIRS, self.asked_pair, self.ask_pair)
        self.ask_one = self.n_one >= SUPPORT
        distinct_one, number_one = numbered(key_word)
        self.asked_one = some(distinct_one, number_one[context], self.ask_one)
        # the context of two words is the pair that ends one place before
        key_two = np.concatenate(([np.uint64(0)], self.key_pair[:-1]))
        self.n_two = np.where(self.first, 0, np.concatenate(([0], self.n_pair[:-1])))
        self.ask_two = self.n_two >= SUPPORT  # not at the first place, so every one is a pair
        self.asked_two = some(distinct, np.concatenate(([0], number[:-1])), self.ask_two)
        self.ask_triple = self.ask_two & (self.n_pair >= 1)
        key_triple = mix(key_two[self.ask_triple] * _FACTORS[0] + symbol[self.ask_triple] * _FACTORS[1] + np.uint64(1))
        self.asked_triple = numbered(key_triple)
        if ONE in self.totals:
            self.types_one = self._contexts(ONE, self.asked_one, self.ask_one)
            self.n_triple = self._spread(TRIPLES, self.asked_triple, self.ask_triple)
            if TWO in self.totals:
                self.types_two = self._contexts(TWO, self.asked_two, self.ask_two)

    def _spread(self, number: int, keys: Keys, asked: np.ndarray) -> np.ndarray:
        """Totals of sequences per position; those not asked for do not occur, or follow too rare a context."""
        out = self.train.astype(np.int64)
        out[asked] = self.totals[number][keys[1]]
        return out

    def _contexts(self, number: int, keys: Keys, asked: np.ndarray) -> np.ndarray:
        """Distinct next words of each position's context where it is retained, else 0."""
        out = np.zeros(len(asked), dtype=np.int64)
        out[asked] = self.totals[number][keys[1]]
        return out

    def chance_word(self) -> np.ndarray:
        corpus = self.corpus
        unknown = corpus.discount * corpus.words / corpus.tokens
        return np.where(self.c > 0, (self.c - corpus.discount) / corpus.tokens, unknown)

    @staticmethod
    def smoothed(shorter: np.ndarray, n: np.ndarray, context: np.ndarray, types: np.ndarray) -> np.ndarray:
        total = np.maximum(context, 1)
        return np.where(types > 0, (np.maximum(n - DISCOUNT, 0) + DISCOUNT * types * shorter) / total, shorter)

    def chance_one(self) -> np.ndarray:
        return self.smoothed(self.chance_word(), self.n_pair, self.n_one, self.types_one)

    def chance_two(self) -> np.ndarray:
        return self.smoothed(self.chance_one(), self.n_triple, self.n_two, self.types_two)

    # requests

    def ask_words(self, packed: bytes, buckets: int) -> list[tuple]:
        words = zstandard.ZstdDecompressor().decompress(packed).split(b"\n")
        order, at = self.word_order(buckets)
        counts = np.bincount(self.ids[self.train], minlength=len(words)).astype("<u4")[order]
        words = [words[i] for i in order.tolist()]
        compress = zstandard.ZstdCompressor(level=1).compress
        return [
            (WORDS, b, self.number, compress(b"\n".join(words[lo:hi])), press(counts[lo:hi]))
            for b, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True))
            if hi > lo
        ]

    def _ask(self, number: int, keys: Keys, parts: list[tuple[np.ndarray, np.ndarray | None]], buckets: int) -> list[tuple]:
        """Distinct keys by bucket with the sums of ``parts``: (which positions count, their values)."""
        distinct, inverse = keys
        sums = [np.bincount(inverse[which], None if value is None else value[which], minlength=len(distinct)) for which, value in parts]
        columns = [x.astype(kind) for x, kind in zip(sums, ("<u4",) if len(parts) == 1 else CONTEXT, strict=True)]
        edges = (np.arange(1, buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(np.uint64)
        at = np.concatenate(([0], np.searchsorted(distinct, edges), [len(distinct)]))
        return [
            (number, b, self.number, press(steps(distinct[lo:hi])), press_columns([c[lo:hi] for c in columns]))
            for b, (lo, hi) in enumerate(zip(at[:-1], at[1:], strict=True))
            if hi > lo
        ]

    def ask_sequences(self, number: int, buckets: int) -> list[tuple]:
        keys, asked = (self.asked_pair, self.ask_pair) if number == PAIRS else (self.asked_triple, self.ask_triple)
        return self._ask(number, keys, [(self.train[asked], None)], buckets)

    def ask_contexts(self, number: int, buckets: int) -> list[tuple]:
        """Per context: summed divergence of what it has seen twice or more, distinct next words, what it has seen
        once, and its own count (divided over its training occurrences)."""
        if number == ONE:
            keys, asked, n, context, shorter = self.asked_one, self.ask_one, self.n_pair, self.n_one, self.chance_word()
        else:
            keys, asked, n, context, shorter = self.asked_two, self.ask_two, self.n_triple, self.n_two, self.chance_one()
        return self._ask_test(number, keys, self.train[asked], n[asked], context[asked], shorter[asked], buckets)

    def _ask_test(self, number: int, keys: Keys, train, n, context, shorter, buckets: int) -> list[tuple]:
        context = context.astype(float)
        seen = train & (n >= 1)
        without = np.maximum(n - 1 - DISCOUNT, 1e-3) / np.maximum(context - 1, 1)
        gain = np.log(without / np.maximum(shorter, 1e-300))
        ones = np.ones(len(n))
        parts = [
            (seen & (n >= 2), gain),
            (seen, 1.0 / np.maximum(n, 1)),
            (seen & (n == 1), ones),
            (seen, ones),
        ]
        return self._ask(number, keys, parts, buckets)

    # contexts of three words and more, at the places where the context one word shorter is retained

    def lengthen(self, depth: int, at: np.ndarray, chance: np.ndarray, before: np.ndarray, rare: np.ndarray) -> None:
        """Contexts of ``depth`` words at some places and the sequences that end there."""
        self.at, self.chance, self.before, self.rare = at, chance, before, rare
        starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        offset = at - starts[self.doc[at]]
        key = np.full(len(at), depth, dtype=np.uint64)
        for back in range(1, depth + 1):
            symbol = np.where(offset == back - 1, _START, self.hashes[self.ids[at - back]])
            key = mix(key * _FACTORS[0] + symbol * _FACTORS[1])
        self.unknown = before == 0
        self.key_context = key
        self.asked_context = numbered(key[self.unknown])
        self.asked_next = numbered(mix(key * _FACTORS[0] + self.hashes[self.ids[at]] * _FACTORS[1] + np.uint64(1)))

    def resume(self, depth: int) -> None:
        """Take up what was handed on, with the totals as far as received."""
        at, rare = (np.cumsum(self.totals[number]) for number in (PLACES, RARE))
        self.lengthen(depth, at, self.totals[CHANCE], self.totals[BEFORE], rare)
        contexts, sequences, test = deeper(depth)
        self.n_context = self.before - 1
        self.n_context[self.unknown] = self.totals[contexts][self.asked_context[1]]
        self.n_next = self.totals[sequences][self.asked_next[1]]
        self.supported = self.n_context >= SUPPORT
        self.asked_test = numbered(self.key_context[self.supported])
        if test in self.totals:
            self.types = self._contexts(test, self.asked_test, self.supported)

    def ask_longer(self, depth: int, buckets: int) -> list[tuple]:
        contexts, sequences, _ = deeper(depth)
        train = self.train[self.at]
        asked = self._ask(contexts, self.asked_context, [(train[self.unknown], None)], buckets)
        return asked + self._ask(sequences, self.asked_next, [(train, None)], buckets)

    def ask_test(self, depth: int, buckets: int) -> list[tuple]:
        ok = self.supported
        n, context, train = self.n_next[ok], self.n_context[ok], self.train[self.at][ok]
        return self._ask_test(deeper(depth)[2], self.asked_test, train, n, context, self.chance[ok], buckets)

    def _hand_on(self, depth: int, at: np.ndarray, chance: np.ndarray, known: np.ndarray, buckets: int) -> list[tuple]:
        """The places of ``at`` that contexts of ``depth`` words fit before, and what is asked of these. ``known``: of
        the sequence that ends at each place 1 and its total, or 0.

        The total of a context is that of the sequence that ends one place before. Where that was counted, it is not
        asked for again, and nothing is asked of contexts it shows to be too rare."""
        starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        long = at - starts[self.doc[at]] >= depth - 1
        at, chance = at[long], chance[long]
        before = known[at - 1]
        rare = (before > 0) & (before <= SUPPORT)
        if rare.all():
            return []
        self.lengthen(depth, at[~rare], chance[~rare], before[~rare], at[rare])
        parts = ((RARE, np.diff(self.rare, prepend=0)), (PLACES, np.diff(self.at, prepend=0)), (CHANCE, self.chance), (BEFORE, self.before))
        return self._figures(depth, parts) + self.ask_longer(depth, buckets)

    def _figures(self, depth: int, parts: tuple) -> list[tuple]:
        return [(number, depth, self.number, b"", press(values.astype(KINDS.get(number, TOTAL)))) for number, values in parts]

    def _per_doc(self, values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values, minlength=len(self.sizes))

    def settle(self, buckets: int) -> list[tuple]:
        """Scores by contexts of up to two words, the places whose context of two words is retained, and requests."""
        corpus, zero = self.corpus, np.zeros(len(self.sizes))
        if not corpus.tokens:
            known, base, model, places = zero, zero, zero, []
        else:
            chance = self.chance_two()
            base = self._per_doc(np.log10((self.c + 1) / (corpus.tokens + corpus.words + 1)), self.doc)
            model = self._per_doc(np.log10(chance), self.doc)
            known = self._per_doc((self.c > 0).astype(float), self.doc)
            # a triple that was not asked for is too rare, whatever stands for its total
            at = np.flatnonzero(self.types_two > 0)
            places = self._hand_on(3, at, chance[at], self.n_triple + 1, buckets)
        return self._figures(0, ((KNOWN, known), (BASE, base), (MODEL, model))) + places

    def advance(self, depth: int, buckets: int) -> list[tuple]:
        """What contexts of ``depth`` words add to the scores, the places where they are retained, and requests."""
        chance = self.smoothed(self.chance, self.n_next, self.n_context, self.types)
        more = self._per_doc(np.log10(chance) - np.log10(self.chance), self.doc[self.at])
        known = np.zeros(len(self.ids), dtype=np.int64)
        known[self.rare], known[self.at] = 1, self.n_next + 1
        kept = self.types > 0
        figures = self._figures(depth, ((MODEL, more),)) if kept.any() else []
        return figures + self._hand_on(depth + 1, self.at[kept], chance[kept], known, buckets)

    def scores(self) -> list[list]:
        docs = len(self.sizes)
        model = self.totals[MODEL].reshape(-1, docs).sum(axis=0)
        known, base = self.totals[KNOWN].tolist(), self.totals[BASE].tolist()
        return [self.doc_ids, self.held.tolist(), self.sizes.tolist(), known, [self.corpus.tokens] * docs, base, model.tolist()]


# ---------------------------------------------------------------- totals in buckets


def _rows(rows: list[tuple], schema: str, types: tuple) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in schema.split(", ")])


REQUEST_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
REPLY_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.binary())


def total_words(table: pa.Table) -> pa.Table:
    """Totals of a bucket's words, for every block that asked; and, as block -1, how many words occur in
    training at all, once and twice."""
    rows = table.to_pylist()
    words, sums = [], []
    for row in rows:
        text = zstandard.ZstdDecompressor().decompress(row["keys"]) + b"\n"
        ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == ord("\n")) + 1  # words with the line feed behind them
        offsets = np.concatenate(([0], ends)).astype("<i8")
        words.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(text)]))
        sums.append(unpress(row["payload"], "<u4"))
    # one dictionary for all chunks, whose distinct words are numbered as they come
    numbers = [chunk.indices.to_numpy() for chunk in pa.chunked_array(words).dictionary_encode().chunks]
    counts = np.bincount(np.concatenate(numbers), np.concatenate(sums)).astype(TOTAL)  # exact below 2 ** 53
    out = [(r["block"], WORDS, r["bucket"], press(counts[own])) for r, own in zip(rows, numbers, strict=True)]
    out.append((-1, WORDS, rows[0]["bucket"], press(np.array([(counts > 0).sum(), (counts == 1).sum(), (counts == 2).sum()], dtype=TOTAL))))
    return _rows(out, REPLY, REPLY_TYPES)


def total_keys(table: pa.Table) -> pa.Table:
    """Totals of a bucket's sequences; of contexts, the number of next words if the test retains them, else 0."""
    rows = table.to_pylist()
    number = rows[0]["round"]
    keys = [np.cumsum(unpress(r["keys"], "<u8"), dtype=np.uint64) for r in rows]
    distinct, inverse = numbered(np.concatenate(keys))
    if number in (PAIRS, TRIPLES) or (number > TWO and (number - TWO) % 3):
        counts = np.concatenate([unpress_columns(r["payload"], ("<u4",))[0] for r in rows])
        totals = np.bincount(inverse, counts, minlength=len(distinct))  # exact below 2 ** 53
    else:
        parts = zip(*(unpress_columns(r["payload"], CONTEXT) for r in rows), strict=True)
        gain, types, single, n = (np.bincount(inverse, np.concatenate(part), minlength=len(distinct)) for part in parts)
        types = np.round(types)
        shorter = np.log(np.minimum(1.0, DISCOUNT * np.maximum(types, 1) / np.maximum(n - 1, 1)))
        totals = np.where((gain + single * shorter > GAIN) & (n >= SUPPORT), types, 0)
    totals = totals.astype(TOTAL)
    out, at = [], 0
    for row, own in zip(rows, keys, strict=True):
        out.append((row["block"], number, row["bucket"], press(totals[inverse[at : at + len(own)]])))
        at += len(own)
    return _rows(out, REPLY, REPLY_TYPES)


# ---------------------------------------------------------------- the rounds


def score(docs: DataFrame) -> DataFrame:
    """Rows of ``SCORES``, one for each of ``docs``."""
    with session.freed_shuffles(docs.sparkSession):
        return _score(docs)


def _score(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    ready(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"blocks_{uuid.uuid4().hex}"
    (
        blocks(docs).write.bucketBy(buckets, "block").sortBy("block")
        .option("path", session.scratch(spark, "blocks")).saveAsTable(name)
    )
    table = spark.table(name)
    size = F.aggregate(F.zip_with("sizes", "held", lambda n, h: F.when(h, 0).otherwise(n)), F.lit(0).cast("long"), lambda a, n: a + n)
    train = F.size(F.filter("held", lambda h: ~h))
    totals = table.agg(F.sum(size).alias("tokens"), F.sum(train).alias("documents")).first()

    def ask_all():
        def step(batch):
            for row in batch.to_pylist():
                yield from _rows(Block(row, {}, None).ask_words(row["words"], buckets), REQUEST, REQUEST_TYPES).to_batches()

        return step

    asked = map_batches(table, ask_all, REQUEST)
    replies = stage(asked.groupBy("bucket").applyInArrow(total_words, REPLY), "word-totals")
    kinds = [unpress(bytes(r["totals"]), TOTAL) for r in replies.filter("block = -1").select("totals").collect()]
    kinds = np.sum(kinds, axis=0) if kinds else np.zeros(3, dtype=int)
    corpus = Corpus(int(totals["tokens"] or 0), *map(int, kinds), int(totals["documents"] or 0))
    replies = replies.filter("block >= 0")
    coded = table.drop("words")  # from here on words are their hashes

    def each(make: Callable[[Block], list], schema: str, types: tuple, right: DataFrame, done: list[int], ready: Callable[[Block], None], columns: bool = False) -> DataFrame:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            got: dict[int, list] = {}
            for r in right.sort_by([("round", "ascending"), ("bucket", "ascending")]).to_pylist():
                got.setdefault(r["round"], []).append(unpress(r["totals"], KINDS.get(r["round"], TOTAL)))
            sums = {number: np.concatenate(parts).astype(float if number in FLOATS else np.int64) for number, parts in got.items()}
            # a block without places is through; a round in which a block had nothing to ask has no reply
            for number in done:
                sums.setdefault(number, np.empty(0, dtype=np.int64))
            out = []
            for row in left.to_pylist() if got else ():
                block = Block(row, sums, corpus)
                ready(block)
                out.append(make(block))
            rows = [r for part in out for r in (zip(*part, strict=True) if columns else part)]
            return _rows(rows, schema, types)

        return coded.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)

    def exchange(asked: DataFrame, label: str) -> DataFrame:
        return stage(asked.groupBy("round", "bucket").applyInArrow(total_keys, REPLY), label)

    def count(make: Callable[[Block], list]) -> DataFrame:
        return each(make, REQUEST, REQUEST_TYPES, replies, list(rounds), lambda b: b.count(buckets))

    rounds = [WORDS]
    if corpus.tokens:
        replies = replies.union(exchange(count(lambda b: b.ask_sequences(PAIRS, buckets)), "pair-totals"))
        rounds.append(PAIRS)
        asked = count(lambda b: b.ask_contexts(ONE, buckets) + b.ask_sequences(TRIPLES, buckets))
        replies = replies.union(exchange(asked, "triple-totals"))
        rounds += [ONE, TRIPLES]
        replies = replies.union(exchange(count(lambda b: b.ask_contexts(TWO, buckets)), "context-totals"))
        rounds.append(TWO)

    def parted(mixed: DataFrame) -> list[DataFrame]:
        """Figures of documents, places, and requests, of what blocks said at once."""
        kept = mixed.filter("round < 0").select("block", "round", "bucket", F.col("payload").alias("totals"))
        figure = F.col("round").isin(KNOWN, BASE, MODEL)
        return [kept.filter(figure), kept.filter(~figure), mixed.filter("round >= 0")]

    figures, places, asked = parted(stage(count(lambda b: b.settle(buckets)), "states"))
    depth = 3
    while not places.isEmpty():

        def extend(make, right, done, depth=depth):
            # blocks without places have nothing more to ask
            return each(lambda b: make(b, depth), REQUEST, REQUEST_TYPES, right, done, lambda b: b.resume(depth))

        *counts, test = deeper(depth)
        known = places.union(exchange(asked, "longer-totals"))
        known = known.union(exchange(extend(lambda b, d: b.ask_test(d, buckets), known, counts), "longer-contexts"))
        # what is left of most blocks is little: some files for all, not one for each bucket
        mixed = extend(lambda b, d: b.advance(d, buckets), known, [*counts, test]).hint("rebalance")
        more, places, asked = parted(stage(mixed, "states"))
        figures = figures.union(more)
        depth += 1
    types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    return each(lambda b: b.scores(), SCORES, types, figures, [], lambda b: None, columns=True)
