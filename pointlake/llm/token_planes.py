"""Token ids in bit-plane shuffled binary files.

File: magic, then chunks of ``CHUNK`` ids, then a chunk index, a document
table and a footer. A chunk's ids (fixed width, little-endian) are transposed into
planes, all bits (or bytes) of equal significance together; each plane is
a zstandard frame of its own, so the nearly constant high planes shrink to almost
nothing. The chunk index holds the offset and length of every plane:
any chunk, or just the high planes of all, can be read alone. The document table
holds id and number of ids per document, in order; documents span chunks, never files.

Documents are ordered by a range partitioning on the id (ties by text hash), tokenised inside
the range partition and written by its task; one row per file (the manifest) gives each file
the number of ids before it. Files go to the shared folder under a temporary
name first and are moved when whole, so a task that runs again writes the same file.

Edge cases: a null or empty text holds the end id only; a null doc_id sorts first and is
kept as null; rows that repeat an id follow each other; an empty table writes no
file and gives no rows; a text of any length is encoded whole; extra columns are ignored.
"""

from __future__ import annotations

import json
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import open_store, read_table, shared_folder, store, writing

MAGIC = b"BPLANES1"
CHUNK = 1 << 16
FILE_IDS = 1 << 24
LEVEL = 3
END_ID = 2
#: Runs and cores that a worker keeps, cores and texts that it encodes together.
WORD_CACHE = 300_000
CORE_CACHE = 700_000
JOINED = 200
TEXTS = 256


def to_planes(ids: np.ndarray, mode: str) -> list[bytes]:
    """The planes of an id block, most significant first."""
    if mode == "byte":
        raw = ids[:, None].view(np.uint8)[:, ::-1]  # big-endian bytes per id
        return [np.ascontiguousarray(raw[:, b]).tobytes() for b in range(raw.shape[1])]
    return [np.packbits((ids >> k & 1).astype(np.uint8)).tobytes() for k in reversed(range(8 * ids.dtype.itemsize))]


def from_planes(planes: list[bytes], n: int, dtype: np.dtype, mode: str) -> np.ndarray:
    if mode == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
        return np.ascontiguousarray(raw[:, ::-1]).view(dtype).reshape(-1)
    ids = np.zeros(n, dtype)
    for plane in planes:
        ids <<= 1
        ids |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n)
    return ids


@dataclass
class PlaneWriter:
    """Appends documents to one open stream."""

    out: object
    dtype: np.dtype
    mode: str = "bit"
    level: int = LEVEL
    at: int = 0
    held: list[np.ndarray] = field(default_factory=list)
    n_held: int = 0
    n_ids: int = 0
    index: list[list[int]] = field(default_factory=list)
    docs: list[tuple[int | None, int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=self.level)
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= CHUNK:
            flat = np.concatenate(self.held)
            whole = self.n_held // CHUNK * CHUNK
            for lo in range(0, whole, CHUNK):
                self._chunk(flat[lo:lo + CHUNK])
            self.held, self.n_held = [flat[whole:]], self.n_held - whole

    def _chunk(self, ids: np.ndarray) -> None:
        entry = [len(ids), self.at]
        for plane in to_planes(ids.astype(self.dtype), self.mode):
            packed = self.packer.compress(plane)
            self._put(packed)
            entry.append(len(packed))
        self.index.append(entry)

    def close(self) -> None:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        footer = {"width": self.dtype.itemsize, "mode": self.mode, "chunks": len(self.index), "docs": len(self.docs), "ids": self.n_ids}
        ids = np.array([0 if d is None else d for d, _ in self.docs], "<i8")
        null = np.packbits(np.array([d is None for d, _ in self.docs], bool))
        parts = {"index": np.array(self.index, "<i8").tobytes(), "doc_ids": ids.tobytes(), "nulls": null.tobytes(),
                 "lengths": np.array([n for _, n in self.docs], "<i8").tobytes()}
        for name, data in parts.items():
            packed = self.packer.compress(data)
            footer[name] = [self.at, len(packed)]
            self._put(packed)
        tail = json.dumps(footer).encode()
        self._put(tail + len(tail).to_bytes(8, "little") + MAGIC)


class PlaneReader:
    """Random access to the chunks of one file."""

    def __init__(self, uri: str):
        fs, path = open_store(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        end = self.file.read_at(16, size - 16)
        if end[8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{uri} is not a bit-plane file")
        n = int.from_bytes(end[:8], "little")
        self.footer = json.loads(self.file.read_at(n, size - 16 - n))
        self.unpacker = zstandard.ZstdDecompressor()
        self.dtype = np.dtype(f"<u{self.footer['width']}")
        self.index = self._part("index", "<i8").reshape(self.footer["chunks"], -1)
        self.lengths = self._part("lengths", "<i8")
        null = np.unpackbits(self._part("nulls", "u1"), count=self.footer["docs"])
        self.doc_ids = [None if x else int(d) for d, x in zip(self._part("doc_ids", "<i8"), null, strict=True)]

    def _part(self, name: str, dtype: str) -> np.ndarray:
        at, n = self.footer[name]
        return np.frombuffer(self.unpacker.decompress(self.file.read_at(n, at)), dtype)

    def chunk(self, k: int) -> np.ndarray:
        n, at, *sizes = self.index[k].tolist()
        data = self.file.read_at(sum(sizes), at)
        cuts = np.cumsum([0, *sizes])
        planes = [self.unpacker.decompress(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return from_planes(planes, n, self.dtype, self.footer["mode"])

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) in order, one chunk in memory at a time beside the document."""
        chunks, have = iter(range(len(self.index))), np.empty(0, self.dtype)
        for doc_id, n in zip(self.doc_ids, self.lengths.tolist(), strict=True):
            parts, size = [have], len(have)
            while size < n:
                parts.append(self.chunk(next(chunks)))
                size += len(parts[-1])
            flat = np.concatenate(parts) if len(parts) > 1 else have
            yield doc_id, flat[:n]
            have = flat[n:]
        self.file.close()


def byte_letters() -> dict[int, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable Latin-1
    characters stand for themselves, the other bytes follow in order from code point 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


BYTE_LETTERS = byte_letters()


def simple_letters(word: str) -> bool:
    """Latin letters that stay letters, one for one, in lower case (U+0130 gains a mark)."""
    return word.isalpha() and max(word) < "\u0250" and "\u0130" not in word


class WordIds(dict):
    """Ids (little-endian bytes of one width) of runs of non-blank bytes, each encoded once.

    The vocabulary's pre-tokeniser drops white space and splits there, so a text's ids are
    those of its runs in order. It also splits between letters and marks and lowers
    case, so runs that differ in ASCII case or in closing marks share their core. New
    cores of letters go straight to the vocabulary's model, others are encoded many at a time, joined
    by a digit that tells them apart again. A vocabulary that does otherwise has
    every run encoded by itself."""

    #: ASCII punctuation but "<", which special tokens begin with.
    MARKS = b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
    #: Joins cores without this digit: the vocabulary makes it a token of its own.
    DIGIT = "0"

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 and end < 1 << 16 else "<u4")
        self.end = np.array([end], self.dtype).tobytes()
        self.model = self.tokenizer.model
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.cores: dict[bytes, bytes] = {b"": b""}
        # the short cuts hold for a vocabulary that lowers case and splits at marks and digits, over bytes
        probe = [self._ids(x) for x in ("Ab!*", "ab", "!*", f"ab {self.DIGIT} cd", self.DIGIT, "cd")]
        self.mark_id = probe[4][0]
        self.folds = (probe[0] == probe[1] + probe[2] and probe[3] == probe[1] + probe[4] + probe[5] and len(probe[4]) == 1
                      and all(self._letters(x) == self._bytes(self._ids(x)) for x in ("ab", "zebra", "stra\u00dfe", "d\u00e9j\u00e0", "\u0142\u0101")))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self.kind, ids).tobytes() if sys.byteorder == "little" else np.array(ids, self.dtype).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of one run of lower-case letters, straight from the model: it needs no other step."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self._bytes([t.id for t in self.model.tokenize(word)])

    def learn(self, runs: list[list[bytes]]) -> None:
        """Make sure that every run of the texts is known."""
        new = {r for text in runs for r in text if r not in self}
        if len(self) + len(new) > WORD_CACHE:
            self.clear()
            new = {r for text in runs for r in text}
        if len(self.cores) + len(new) > CORE_CACHE:
            self.cores = {b"": b""}
        marks, folds, cores, waiting = self.MARKS, self.folds, self.cores, []
        tokenize, as_bytes = self.model.tokenize, self._bytes
        for run in new:
            core, tail = run, b""
            if folds and b"<" not in run:
                if run[-1] in marks:
                    core = run.rstrip(marks)
                    tail = run[len(core):]
                    if not (core[-1:].isalnum() or core and core[-1] > 127 and simple_letters(core.decode()[-1])):
                        core, tail = run, b""  # the marks may be part of a longer run of marks
                core = core.lower()
            ids = cores.get(core)
            if ids is None and folds:
                word = core.decode()
                if core.isalpha():  # of bytes: A-Z and a-z only
                    ids = cores[core] = as_bytes([t.id for t in tokenize(word)])
                elif simple_letters(word):
                    ids = cores[core] = self._letters(word.lower())
            if ids is None or tail and tail not in cores:
                waiting.append((run, core, tail))
            else:
                self[run] = ids + cores[tail] if tail else ids
        self._learn_cores({c for _, *pair in waiting for c in pair if c not in cores})
        for run, core, tail in waiting:
            self[run] = cores[core] + cores[tail]

    def _learn_cores(self, new: set[bytes]) -> None:
        digit, width = self.DIGIT.encode(), self.dtype.itemsize
        alone = [c for c in new if not self.folds or b"<" in c or digit in c]
        for c in alone:
            self.cores[c] = self._bytes(self._ids(c.decode()))
        together = list(new.difference(alone))
        for lo in range(0, len(together), JOINED):
            some = together[lo:lo + JOINED]
            joined = (b" " + digit + b" ").join(some).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
            stops = [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
            flat, start = ids.astype(self.dtype).tobytes(), 0
            for c, stop in zip(some, stops, strict=True):
                self.cores[c] = flat[start * width:stop * width]
                start = stop + 1

    def encode(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """Ids of each text, with the end id."""
        split = [t.split() if t else [] for t in texts]
        self.learn(split)
        for runs in split:
            yield np.frombuffer(b"".join(map(self.__getitem__, runs)) + self.end, self.dtype)


@lru_cache(maxsize=1)
def word_ids(path: str, end: int) -> WordIds:
    """One cache per Python worker, kept over its tasks."""
    return WordIds(path, end)


def _writer(folder: str, vocabulary: str | None, end: int, mode: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = word_ids(vocabulary or _default_vocabulary(), end), TaskContext.get().partitionId()
        rows = _encoded(batches, words)
        done, row = [], next(rows, None)
        while row is not None:
            uri = f"{folder}/part-{part:06d}-{len(done):05d}.planes"
            with writing(uri) as out:
                planes = PlaneWriter(out, words.dtype, mode)
                while row is not None and planes.n_ids < FILE_IDS:
                    planes.add(*row)
                    row = next(rows, None)
                planes.close()
            done.append((part, len(done), uri, len(planes.docs), planes.n_ids, planes.at))
        yield _as_batch(done, MANIFEST)

    return run


def _encoded(batches: Iterator[pa.RecordBatch], words: WordIds) -> Iterator[tuple[int | None, np.ndarray]]:
    for batch in batches:
        for lo in range(0, len(batch), TEXTS):
            part = batch.slice(lo, TEXTS)
            yield from zip(part.column(0).to_pylist(), words.encode(part.column(1).to_pylist()), strict=True)


MANIFEST = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("uri", pa.string()),
                      ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())])


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("uri", pa.string())])


def _as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


def _default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def write_planes(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END_ID, mode: str = "bit") -> DataFrame:
    """Encode and write ``docs`` (doc_id, text) in ascending doc_id order; returns the manifest,
    one row per file: part, seq, uri, n_docs, n_ids, n_bytes."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), "tie", "place"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return store(rows.mapInArrow(_writer(folder, vocabulary, end, mode), "part int, seq int, uri string, n_docs long, n_ids long, n_bytes long"),
                 "planes-manifest")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = []
            for doc_id, ids in PlaneReader(uri).documents():
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), uri))
                start += len(ids)
                if len(rows) == 10_000:
                    yield _as_batch(rows, READ)
                    rows = []
            if rows:
                yield _as_batch(rows, READ)


def read_planes(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, uri) per document, from the files.

    The running sum is over files, a row each."""
    before = F.sum("n_ids").over(W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))
    files = manifest.select("uri", F.coalesce(before, F.lit(0)).cast("long").alias("start"))
    # a partition per file, given as a number: else the few small rows would be coalesced into one task
    return files.repartition(max(1, manifest.count())).mapInArrow(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long, uri string")


def tokenised(docs: DataFrame, vocabulary: str | None = None, mode: str = "bit") -> DataFrame:
    """Write ``docs`` into a fresh shared folder and read the files back."""
    spark = docs.sparkSession
    return read_planes(spark, write_planes(docs, shared_folder(spark, "planes"), vocabulary, mode=mode))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenised(read_table(spark, sf_dir, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")
