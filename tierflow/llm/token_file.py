"""Token ids in binary files of fixed bit width.

Every id takes the fewest bits that hold the vocabulary. Ids are stored in blocks of ``BLOCK`` ids that start at
whole bytes; eight ids fill exactly as many bytes as one has bits, so numpy packs and unpacks a block by columns.
A file of documents in ascending doc_id order is

    magic, blocks, first id of each document and the end, doc_ids, flags of null doc_ids, block offsets, tail

and the tail tells where the tables start. A reader finds any document through the table of first ids and
the block offsets, and reads only the blocks that hold it.

Texts are range-partitioned by doc_id, encoded and written by the same task, block by block. A task names its
file after its attempt and reports it; only files of committed tasks are in the manifest, a written table.

Null text is empty and has the end id alone. Null doc_ids come first. Rows of one doc_id stand in the order of
a hash of their text; equal rows are documents of their own, and many of them are spread over partitions. Very
long texts are encoded in pieces and written and read a block at a time. An empty table gives no file and no
rows. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tierflow import session

from .bpe import BYTE_CHARACTERS, LATIN
from .common import map_batches, stage

TOKENIZER = "byte_bpe_50k.json"
END = 2
BLOCK = 1 << 16
# Text of one file, about; it is sorted by one task.
FILE_BYTES = 64 << 20
MAGIC = b"TIDBITS1"
# bits, ids per block, documents, ids; then where each table starts
TAIL = struct.Struct("<IIQQQQQQ8s")
MANIFEST = "part int, path string, bits int, n_docs long, n_ids long"
# Characters of a text that are cut into pieces at a time.
STRETCH = 1 << 20
# Characters and bytes of ids of the pieces a worker remembers; longer pieces are not remembered.
KEPT, LONGEST = 32 << 20, 64
# A new piece starts where white space follows anything else: no pattern of the tokenizer matches across that.
PIECE = re.compile(r"\s*\S+|\s+")
CUT = re.compile(r"(?<=\S)\s")
# White space in Python, but not in the tokenizer.
SEPARATORS = re.compile("[\x1c-\x1f]")
# Pieces whose characters every library puts in the same class, and the words the tokenizer file cuts them into.
SIMPLE = re.compile(f"[\x09-\x0d\x20-\x7e{LATIN}]*")
WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z{LATIN}]+| ?[0-9]+| ?[^\\sA-Za-z0-9{LATIN}]+|\\s+(?!\\S)|\\s+"
)
BYTES = dict(enumerate(BYTE_CHARACTERS))
SPACE = BYTES[32]


# ---------------------------------------------------------------- bits


def width(vocabulary: int) -> int:
    """Bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another, ``bits`` each, lowest bit first; filled up with zero bits to a whole byte."""
    rows = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    rows.ravel()[: len(ids)] = ids
    out = np.zeros((len(rows), bits), np.uint8)
    for column in range(8):
        at = column * bits
        for byte in range(at // 8, (at + bits - 1) // 8 + 1):
            shift = np.uint64(abs(byte * 8 - at))
            out[:, byte] |= (rows[:, column] >> shift if byte * 8 >= at else rows[:, column] << shift).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    rows = -(-n // 8)
    held = np.zeros(rows * bits, np.uint8)
    held[: len(data)] = np.frombuffer(data, np.uint8)
    held = held.reshape(rows, bits)
    out = np.zeros((rows, 8), np.uint64)
    for column in range(8):
        at = column * bits
        for byte in range(at // 8, (at + bits - 1) // 8 + 1):
            shift = np.uint64(abs(byte * 8 - at))
            value = held[:, byte].astype(np.uint64)
            out[:, column] |= value << shift if byte * 8 >= at else value >> shift
    return (out.ravel()[:n] & np.uint64((1 << bits) - 1)).astype(np.uint32)


# ---------------------------------------------------------------- encoding


class Encoder:
    """The ids of whole texts, as the library gives them for a byte-level vocabulary. What a short piece of text
    encodes to is remembered; pieces of plain characters are cut into words here and go to the library's model,
    the others go through the whole library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.cuts_words = spec["normalizer"] is None and spec["pre_tokenizer"] == byte_level
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
        self.model = self.library.model
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.known: dict[str, bytes] = {}
        self.kept = 0

    def encode(self, piece: str) -> bytes:
        """Ids of a piece, four bytes each."""
        word = piece[1:] if piece[:1] == " " else piece
        if self.cuts_words and word.isascii() and word.isalpha():
            return array("I", [t.id for t in self.model.tokenize(word if word is piece else SPACE + word)]).tobytes()
        if not self.cuts_words or not SIMPLE.fullmatch(piece) or self.special.search(piece):
            return array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        shown = [word.encode().decode("latin-1").translate(BYTES) for word in WORD.findall(piece)]
        return array("I", [t.id for word in shown for t in self.model.tokenize(word)]).tobytes()

    def stretches(self, text: str) -> Iterator[str]:
        """The text, cut where pieces start."""
        start = 0
        while len(text) - start > STRETCH:
            cut = CUT.search(text, start + STRETCH)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:] if start else text

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text, a stretch at a time."""
        if not self.cuts_words or SEPARATORS.search(text):
            yield np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
            return
        for stretch in self.stretches(text):
            yield np.frombuffer(self.by_spaces(stretch) or self.by_pieces(stretch), "<u4")

    def by_spaces(self, text: str) -> bytes | None:
        """Ids of a text in which no white space but a line end follows white space; None for other texts. Its pieces
        start at every space and line end; a space in front is left out of what is remembered."""
        first, *pieces = text.replace("\n", " \n").split(" ")
        if not pieces or not first or first[-1].isspace():
            return None
        if self.kept > KEPT:
            self.known.clear()
            self.kept = 0
        known, long = self.known, []
        try:
            for piece in set(pieces).difference(known):
                if not piece or piece[-1].isspace():
                    return None
                known[piece] = ids = self.encode(piece if piece[0] == "\n" else " " + piece)
                self.kept += len(piece) + len(ids)
                if len(piece) > LONGEST:
                    long.append(piece)
            return self.encode(first) + b"".join(map(known.__getitem__, pieces))
        finally:
            for piece in long:
                self.kept -= len(piece) + len(known.pop(piece))

    def by_pieces(self, text: str) -> bytes:
        """Ids of any text."""
        out = []
        for piece in PIECE.findall(text):
            word = piece[1:] if piece[:1] == " " and piece[1:2] != "\n" else None
            out.append(self.known[word] if word in self.known else self.encode(piece))
        return b"".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each tokenizer file and worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- files


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file name, with or without a scheme."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    return (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)


class Writer:
    """Writes one file; holds one block of ids and the table of its documents."""

    def __init__(self, path: str, bits: int) -> None:
        system, name = place(path)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self.file = system.open_output_stream(name)
        self.bits, self.n_ids = bits, 0
        self.starts, self.doc_ids, self.nulls, self.offsets = [], [], bytearray(), []
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.file.write(MAGIC)

    def document(self, doc_id: int | None) -> None:
        """What is added from now on belongs to this document."""
        self.starts.append(self.n_ids)
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_ids += len(ids)
        if self.held >= BLOCK:
            self._flush(self.held - self.held % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for start in range(0, n, BLOCK):
            self.offsets.append(self.file.tell())
            self.file.write(pack(ids[start : min(start + BLOCK, n)], self.bits))
        self.waiting, self.held = [ids[n:]], self.held - n

    def close(self) -> None:
        self._flush(self.held)
        tables = (
            np.array([*self.starts, self.n_ids], "<u8"),
            np.array(self.doc_ids, "<i8"),
            np.frombuffer(bytes(self.nulls), np.uint8),
            np.array([*self.offsets, self.file.tell()], "<u8"),
        )
        spots = []
        for table in tables:
            spots.append(self.file.tell())
            self.file.write(table.tobytes())
        self.file.write(TAIL.pack(self.bits, BLOCK, len(self.doc_ids), self.n_ids, *spots, MAGIC))
        self.file.close()


class Reader:
    """Random access to one file."""

    def __init__(self, path: str) -> None:
        system, name = place(path)
        self.file = system.open_input_file(name)
        end = self.file.size() - TAIL.size
        fields = TAIL.unpack(self._read(end, TAIL.size)) if end >= len(MAGIC) else (None,)
        if fields[-1] != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        self.bits, self.block, self.n_docs, self.n_ids, starts, doc_ids, nulls, offsets, _ = fields
        self.starts = np.frombuffer(self._read(starts, 8 * (self.n_docs + 1)), "<u8").astype(np.int64)
        self.doc_ids = np.frombuffer(self._read(doc_ids, 8 * self.n_docs), "<i8")
        self.nulls = np.frombuffer(self._read(nulls, self.n_docs), np.uint8).astype(bool)
        self.offsets = np.frombuffer(self._read(offsets, end - offsets), "<u8").astype(np.int64)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def blocks(self, first: int, last: int) -> Iterator[np.ndarray]:
        """Ids ``first`` to before ``last`` of the file, in pieces of at most a block."""
        for b in range(first // self.block, -(-last // self.block)):
            at = b * self.block
            data = self._read(int(self.offsets[b]), int(self.offsets[b + 1] - self.offsets[b]))
            ids = unpack(data, self.bits, min(self.block, self.n_ids - at))
            yield ids[max(first - at, 0) : last - at]

    def document(self, number: int) -> np.ndarray:
        """The ids of one document, found through the tables."""
        parts = list(self.blocks(int(self.starts[number]), int(self.starts[number + 1])))
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)


# ---------------------------------------------------------------- jobs


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = END, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode the texts and write their ids below ``folder``; returns the manifest ``part, path, bits, n_docs,
    n_ids, first_id``, a stored row per file."""
    text = F.coalesce("text", F.lit(""))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(-(-total // file_bytes), docs.sparkSession.sparkContext.defaultParallelism)
    keys = ("doc_id", "_hash", "_row")
    keyed = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_hash"), F.monotonically_increasing_id().alias("_row"))
    ordered = keyed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def make():
        tokenizer = encoder(path or public_tokenizers.path(TOKENIZER))
        bits = width(max(tokenizer.vocabulary, end + 1))
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids"
        last = np.array([end], np.uint32)
        file: Writer | None = None

        def step(batch):
            nonlocal file
            if batch is None:
                if file is not None:
                    file.close()
                    row = [[part], [name], [bits], [len(file.doc_ids)], [file.n_ids]]
                    types = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
                    yield pa.record_batch([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=["part", "path", "bits", "n_docs", "n_ids"])
                return
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = file or Writer(name, bits)
                file.document(doc_id)
                for ids in tokenizer.ids(text.as_py()):
                    file.add(ids)
                file.add(last)

        return step

    files = stage(map_batches(ordered, make, MANIFEST, last=True), "token-manifest")
    # one row per file of ``file_bytes`` of text
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files, a block at a time."""
    files = manifest.select("path", "first_id")

    def make():
        def step(batch):
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = Reader(path)
                crcs = np.zeros(file.n_docs, np.int64)
                doc, at = 0, 0
                for ids in file.blocks(0, file.n_ids):
                    data, begin = memoryview(ids.astype("<u4").tobytes()), 0
                    while begin < len(ids):
                        stop = min(int(file.starts[doc + 1]) - at, len(ids))
                        crcs[doc] = zlib.crc32(data[4 * begin : 4 * stop], int(crcs[doc]))
                        begin = stop
                        doc += file.starts[doc + 1] == at + stop
                    at += len(ids)
                for a in range(0, file.n_docs, 1 << 16):
                    z = slice(a, min(a + (1 << 16), file.n_docs))
                    columns = [
                        pa.array(file.doc_ids[z], pa.int64(), mask=file.nulls[z]),
                        pa.array(file.starts[:-1][z] + first, pa.int64()),
                        pa.array(np.diff(file.starts)[z], pa.int64()),
                        pa.array(crcs[z], pa.int64()),
                    ]
                    yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

        return step

    n = manifest.sparkSession.sparkContext.defaultParallelism
    return map_batches(files.repartition(max(n, files.count()), "path"), make, "doc_id long, start long, n_tokens long, ids_crc32 long")


def folder(spark: SparkSession) -> str:
    """A new folder for files, below the shared scratch folder."""
    return session.scratch(spark, "token-ids")


def round_trip(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """Write the ids of all texts and read the files back."""
    return read(write(docs, folder(docs.sparkSession), path, end))
