"""BPE encoding by longest matches with backtracking, decoding by an offset table.

A token stands for the symbols it was merged from. Two tokens can be neighbours in an encoding when no merge
across their border comes before the merges that made them; a sequence in which all neighbours can be is the
one that merging gives. The encoder takes the longest token at each place, from one Aho-Corasick scan, and
goes back to shorter ones where the pair cannot be. Places with no way on are marked, so each is tried once.

Texts are cut at ASCII white space, which no token spans; what a piece encodes to is kept for the next time.
Normalisation, special tokens and the cut into words are those of the tokenizer file. Null text is empty and
has no tokens. Rows are kept one for one; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import map_batches, text_bytes

TOKENIZER = "word_bpe_49k.json"
# Pieces a worker keeps; emptied when full, so its memory is bounded.
KEPT = 600_000
NONE = -1
LATE = 1 << 60
# Marks a symbol that ends a word: the code point of its character moved up by this.
SHIFT = 0x20000
# Texts that lower case and cut alike in every library: ASCII and the letters of Latin-1 and Latin Extended-A
# but for the dotted capital I, whose lower case is two characters. All are in normal form C.
LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
SIMPLE = re.compile(f"[\x00-\x7f{LATIN}]*")
# Words of such texts as the tokenizer file cuts them.
SIMPLE_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{LATIN}]+|[0-9]|[^\x09-\x0d\x20a-z0-9{LATIN}]+")
# Fixed: the character that stands for each byte in a byte-level vocabulary.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = [chr(b) if b in _SHOWN else "" for b in range(256)]
for _n, _b in enumerate(b for b in range(256) if b not in _SHOWN):
    BYTE_CHARACTERS[_b] = chr(256 + _n)


class Merges:
    """Vocabulary of symbol strings in the order of their merges, with the tables of the encoder."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], ending: str) -> None:
        self.ending = ending
        made = {}  # string -> rank; symbols that no merge makes come first
        whole = {left + right for left, right in merges}
        for text in sorted((t for t in vocab if t not in whole), key=vocab.get):
            made[text] = len(made)
        self.base = len(made)
        self.left, self.right = list(range(self.base)), list(range(self.base))
        self.joined: dict[tuple[int, int], int] = {}
        for a, b in merges:
            pair = (made[a], made[b])
            if a + b not in made:
                made[a + b] = len(made)
                self.left.append(pair[0])
                self.right.append(pair[1])
            self.joined.setdefault(pair, made[a + b])
        self.ids = [vocab[t] for t in made]
        self.symbols = [self._symbols(t) for t in made]
        self.fits: dict[tuple[int, int], bool] = {}
        # a token that merging its own symbols does not give is never in an encoding
        self.lengths = [len(s) for s in self.symbols]
        rank = {}
        self.match = ahocorasick.Automaton()
        for t, symbols in enumerate(self.symbols):
            if t < self.base or self.neighbours(self.left[t], self.right[t], below=t):
                rank[symbols] = t
                self.match.add_word(symbols, t)
        self.match.make_automaton()
        # longest shorter token that each token starts with
        self.shorter = []
        for symbols in self.symbols:
            n = len(symbols) - 1
            while n and symbols[:n] not in rank:
                n -= 1
            self.shorter.append(rank[symbols[:n]] if n else NONE)

    def _symbols(self, text: str) -> str:
        if self.ending and text.endswith(self.ending) and text != self.ending:
            body = text.removesuffix(self.ending)
            return body[:-1] + chr(ord(body[-1]) + SHIFT)
        return text

    def neighbours(self, a: int, b: int, below: int = LATE) -> bool:
        """Whether ``a`` then ``b`` stay apart while only merges before ``below`` are done.

        Undoes the merges at the border from the latest on. At each point the two symbols then at the border
        must not have a merge that comes before the later one, which is about to be undone."""
        key = (a, b)
        if below == LATE and key in self.fits:
            return self.fits[key]
        left, right, until, good = a, b, below, True
        while True:
            across = self.joined.get((left, right), LATE)
            # of equal merges the one further left is done first
            if across < until:
                good = False
                break
            inner_left = left if left >= self.base else NONE
            inner_right = right if right >= self.base else NONE
            if inner_left == NONE and inner_right == NONE:
                break
            if inner_left > inner_right:
                until, left = left, self.right[left]
            else:
                # the border symbol is taken by this merge from the right, so an equal one from the left wins
                until, right = right + 1, self.left[right]
        if below == LATE:
            self.fits[key] = good
        return good

    def encode(self, symbols: str) -> list[int]:
        """Ranks of the tokens of one word, given as symbols."""
        n = len(symbols)
        longest = [NONE] * n
        for end, t in self.match.iter(symbols):
            longest[end + 1 - self.lengths[t]] = t  # ends come in order: the last is the longest
        out: list[int] = []
        dead = bytearray(n + 1)
        at, t = 0, longest[0] if n else NONE
        while at < n:
            last = out[-1] if out else NONE
            while t != NONE:
                end = at + self.lengths[t]
                if not dead[end] and (last == NONE or self.neighbours(last, t)):
                    break
                t = self.shorter[t]
            if t != NONE:
                out.append(t)
                at = end
                t = longest[at] if at < n else NONE
            else:
                if not out:
                    raise ValueError("symbols outside the vocabulary")
                dead[at] = 1
                t = out.pop()
                at -= self.lengths[t]
        return out


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if spec["decoder"] is not None or model["type"] != "BPE" or model["unk_token"] is not None:
            raise ValueError("a BPE model without decoder and unknown token is asked for")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs, model["end_of_word_suffix"] or "")
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.cut = library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # decoding: all token strings end to end, and where each starts
        strings: dict[int, str] = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.offsets, at, parts = [0], 0, []
        for i in range(max(strings) + 1):
            parts.append(strings.get(i, ""))
            at += len(parts[-1])
            self.offsets.append(at)
        self.strings = "".join(parts)

    def encode(self, piece: str) -> list[int]:
        """Ids of a text."""
        if piece.isalpha() and piece.islower() and SIMPLE.fullmatch(piece):
            return self.word(by_bytes(piece))  # nothing to normalise or cut
        out: list[int] = []
        for segment in self.split_special.split(piece) if self.split_special else [piece]:
            if segment in self.special:
                out.append(self.special[segment])
            elif segment:
                for word, _ in self.cut(self.normalize(segment)):
                    out.extend(self.word(word))
        return out

    def word(self, word: str) -> list[int]:
        symbols = word[:-1] + chr(ord(word[-1]) + SHIFT) if self.merges.ending else word
        return [self.merges.ids[t] for t in self.merges.encode(symbols)]

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by spaces, as the library does without a decoder."""
        return " ".join([self.strings[self.offsets[i] : self.offsets[i + 1]] for i in ids])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def resolve(path: str | None) -> str:
    return path or public_tokenizers.path(TOKENIZER)


def by_bytes(word: str) -> str:
    """A word in the characters of a byte-level vocabulary."""
    return word if word.isascii() else "".join([BYTE_CHARACTERS[b] for b in word.encode()])


class Pieces(dict):
    """What each piece of text maps to, worked out once per worker."""

    def __init__(self, make: Callable[[str], object]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, piece: str):
        self[piece] = value = self.make(piece)
        return value


def cut(raw: bytes) -> list[str]:
    """Pieces of a text that encode independently: words where that is simple, else runs without white space."""
    text = raw.decode()
    if "<|" not in text and (text.isascii() or SIMPLE.fullmatch(text)):
        return SIMPLE_WORD.findall(text.lower())
    return [piece.decode() for piece in raw.split()]


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text."""

    def make():
        tokenizer = codec(resolve(path))

        def both(piece: str) -> tuple[str, str]:
            ids = tokenizer.encode(piece)
            # a leading space each, so that pieces without tokens leave no gap
            return "".join([f" {i}" for i in ids]), " " + tokenizer.decode(ids) if ids else ""

        known = Pieces(both)

        def step(batch):
            counts, id_hashes, text_hashes = [], [], []
            for text in batch.column(1):
                if len(known) > KEPT:
                    known.clear()
                found = [known[p] for p in cut(text.as_py())]
                ids = "".join([f[0] for f in found])
                counts.append(ids.count(" "))
                id_hashes.append(hashlib.sha256(ids[1:].encode()).hexdigest())
                text_hashes.append(hashlib.sha256("".join([f[1] for f in found])[1:].encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    texts = docs.select("doc_id", text_bytes().alias("text"))
    return map_batches(texts, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
