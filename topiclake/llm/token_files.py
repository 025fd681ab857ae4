"""Operator 7: token-id files with Elias-Fano document boundaries.

``write_token_files`` encodes whole texts, appends an end id and writes the ids of all
documents in ascending ``doc_id`` order as one concatenated array, cut into files. The
boundaries of a file's documents are an Elias-Fano sequence (about ``2 + log2(ids per
document)`` bits each) with a sampled select structure, and so are its document ids;
there is no table of 64-bit offsets. ``read_token_files`` reads everything back in blocks of
documents: select finds a block's first and last boundary, and only the bits between are decoded.

File layout (little endian)::

    ids               n_ids * uint16
    boundaries        Elias-Fano of n_docs + 1 values, the first 0, the last n_ids
    document ids      Elias-Fano of the non-null ids, less the first of them
    footer            struct _FOOTER: section offsets, counts, first document id, magic

Defined results: a null text counts as empty and has only the end id; null ``doc_id``
rows come first and are counted in the footer; equal ``doc_id`` rows are ordered by a hash
of their text (equal texts in any order, which their ids don't show); a very long text is encoded
and read whole; an empty table gives no files and no rows; extra columns are ignored.

Scale: rows are dealt by ranges of ``(doc_id, text hash, random number)``, so no key, not even equal
rows, must fit one task; a task streams its ids to files of at most ``max_ids`` ids; the only global
step is a prefix sum over files.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from .common import broadcast_checked, materialise, prepare, scratch_path, table
from .tokens import encoder, vocabulary

END_ID = 2
MAX_IDS_PER_FILE = 1 << 26
_MAGIC = b"TLEFIDS1"
# offsets of boundaries and document ids, documents, documents with null id, ids, first id
_FOOTER = struct.Struct("<QQQQQq8s")
_SAMPLE = 256  # one select sample for so many values
READ_DOCS = 2000  # documents whose boundaries are decoded at once
READ_IDS = 1 << 20  # ids read at once, unless one document has more


class EliasFano:
    """A non-decreasing sequence of ``n`` values in ``[0, universe]``.

    The low bits of each value are packed; the high parts are unary in a bit vector whose
    one-bits are found by select: a sample every ``_SAMPLE`` ones, then a scan of few bytes.
    """

    _HEAD = struct.Struct("<QQBQQ")  # n, universe, low bits, bytes of low part, of high part

    def __init__(self, n: int, universe: int, low: int, lows: np.ndarray, highs: np.ndarray):
        self.n, self.universe, self.low = n, universe, low
        self._lows, self._highs = lows, highs
        self._samples: np.ndarray | None = None

    @classmethod
    def encode(cls, values) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        universe = int(v[-1]) if n else 0
        low = max(0, (universe // n).bit_length() - 1) if n else 0
        bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if low else \
            np.zeros((n, 0), np.uint8)
        lows = np.packbits(bits.reshape(-1), bitorder="little")
        high = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(high[-1]) + 1 if n else 0, np.uint8)
        marks[high] = 1
        return cls(n, universe, low, lows, np.packbits(marks, bitorder="little"))

    def to_bytes(self) -> bytes:
        ones = np.flatnonzero(np.unpackbits(self._highs, bitorder="little"))[::_SAMPLE].astype("<u4")
        return (self._HEAD.pack(self.n, self.universe, self.low, len(self._lows), len(self._highs))
                + self._lows.tobytes() + self._highs.tobytes() + ones.tobytes())

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, universe, low, a, b = cls._HEAD.unpack_from(data)
        at = cls._HEAD.size
        out = cls(n, universe, low, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a))
        out._samples = np.frombuffer(data, "<u4", -(-n // _SAMPLE), at + a + b)
        return out

    def select(self, i: int) -> int:
        """Value ``i`` without decoding the sequence."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        if self._samples is None:
            self._samples = EliasFano.from_bytes(self.to_bytes())._samples
        bit, left = int(self._samples[i // _SAMPLE]), i % _SAMPLE
        at = bit // 8
        byte = int(self._highs[at]) >> (bit % 8) << (bit % 8)
        while (k := byte.bit_count()) <= left:
            left -= k
            at += 1
            byte = int(self._highs[at])
        for _ in range(left):
            byte &= byte - 1
        high = at * 8 + (byte & -byte).bit_length() - 1 - i
        first = i * self.low
        chunk = int.from_bytes(self._lows[first // 8:(first + self.low + 7) // 8].tobytes(), "little")
        return high << self.low | (chunk >> (first % 8)) & ((1 << self.low) - 1)

    def slice(self, i: int, j: int) -> np.ndarray:
        """Values ``i`` to ``j - 1``: select finds the first, and only the bits between the select
        samples around them are decoded."""
        if not 0 <= i <= j <= self.n:
            raise IndexError((i, j))
        if i == j:
            return np.zeros(0, np.int64)
        first = (self.select(i) >> self.low) + i  # the one-bits of values i and j - 1
        last = (self.select(j - 1) >> self.low) + j - 1
        ones = np.unpackbits(self._highs[first // 8:last // 8 + 1], bitorder="little")
        high = np.flatnonzero(ones[first % 8:first % 8 + last - first + 1]) + first - np.arange(i, j)
        v = high.astype(np.uint64) << np.uint64(self.low)
        if self.low:
            bit, size = i * self.low, (j - i) * self.low
            bits = np.unpackbits(self._lows[bit // 8:(bit + size + 7) // 8], bitorder="little")
            bits = bits[bit % 8:bit % 8 + size].reshape(j - i, self.low)
            for k in range(self.low):
                v |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return v.astype(np.int64)

    def values(self) -> np.ndarray:
        return self.slice(0, self.n)


class _Writer:
    def __init__(self, folder: str, partition: int):
        self._fs, self._root = files.filesystem(folder)
        self._fs.create_dir(self._root, recursive=True)
        self._partition, self._seq, self._out = partition, 0, None

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self._out is None:
            self._name = files.unique_name(self._partition, self._seq, ".efids")
            self._out = self._fs.open_output_stream(f"{self._root}/{self._name}", compression=None)
            self._ends, self._doc_ids, self._nulls = [0], [], 0
        self._out.write(ids)
        self._ends.append(self._ends[-1] + len(ids) // 2)
        if doc_id is None:
            self._nulls += 1
        else:
            self._doc_ids.append(doc_id)

    @property
    def n_ids(self) -> int:
        return self._ends[-1] if self._out else 0

    def close(self):
        """Finish the open file; its manifest row, or None."""
        if self._out is None:
            return None
        n, docs = self._ends[-1], len(self._ends) - 1
        bounds = EliasFano.encode(self._ends).to_bytes()
        first = self._doc_ids[0] if self._doc_ids else 0
        ids = EliasFano.encode([d - first for d in self._doc_ids]).to_bytes()
        self._out.write(bounds + ids + _FOOTER.pack(2 * n, 2 * n + len(bounds), docs, self._nulls, n, first, _MAGIC))
        self._out.close()
        self._out = None
        row = (self._name, self._partition, self._seq, docs, n)
        self._seq += 1
        return row


class TokenFile:
    """Random and sequential access to one file; only the two small sequences are loaded."""

    def __init__(self, folder: str, name: str):
        fs, root = files.filesystem(folder)
        self._f = fs.open_input_file(f"{root}/{name}")
        size = self._f.size()
        foot = self._f.read_at(_FOOTER.size, size - _FOOTER.size)
        b, d, self.n_docs, self.n_null, self.n_ids, self._first, magic = _FOOTER.unpack(foot)
        if magic != _MAGIC:
            raise ValueError(f"{name}: not a token-id file")
        self.bounds = EliasFano.from_bytes(self._f.read_at(d - b, b))
        self._doc_ids = EliasFano.from_bytes(self._f.read_at(size - _FOOTER.size - d, d))

    def starts(self, i: int, j: int) -> np.ndarray:
        """Places of the first ids of documents ``i`` to ``j`` (the last one's end, for all documents)."""
        return self.bounds.slice(i, j + 1)

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        """Ids of documents ``i`` to ``j - 1``; those with null ids come first."""
        nulls = min(max(self.n_null - i, 0), j - i)
        known = self._doc_ids.slice(i + nulls - self.n_null, j - self.n_null) if j - i > nulls else np.zeros(0, np.int64)
        return [None] * nulls + (known + self._first).tolist()

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds.select(i), self.bounds.select(i + 1)
        return np.frombuffer(self._f.read_at(2 * (end - start), 2 * start), "<u2")

    def documents(self, starts: np.ndarray):
        """The ids of neighbouring documents one by one, read in pieces of about ``READ_IDS`` ids."""
        k = 0
        while k + 1 < len(starts):
            to = max(k + 1, int(np.searchsorted(starts, starts[k] + READ_IDS, "right")) - 1)
            lo = int(starts[k])
            data = np.frombuffer(self._f.read_at(2 * (int(starts[to]) - lo), 2 * lo), "<u2")
            for s, e in zip((starts[k:to] - lo).tolist(), (starts[k + 1:to + 1] - lo).tolist()):
                yield data[s:e]
            k = to

    def close(self) -> None:
        self._f.close()


_MANIFEST = "name string, part int, seq int, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, folder: str, vocab_path: str, kind: str = "word", end_id: int = END_ID,
                      max_ids: int = MAX_IDS_PER_FILE) -> DataFrame:
    """Write ``docs(doc_id, text)`` as token-id files under ``folder``; returns the manifest."""
    prepare(docs.sparkSession)

    def write(batches):
        writer = _Writer(folder, TaskContext.get().partitionId())
        enc, end = encoder(vocab_path, kind), struct.pack("<H", end_id)
        done = []
        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                writer.add(doc_id, ids + end)
                if writer.n_ids >= max_ids:
                    done.append(writer.close())
        done = [r for r in [*done, writer.close()] if r]
        if done:
            cols = list(zip(*done))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0]), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["name", "part", "seq", "n_docs", "n_ids"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumn("_h", F.xxhash64("text")).withColumn("_r", F.rand(7))
            .repartitionByRange("doc_id", "_h", "_r").sortWithinPartitions("doc_id", "_h", "_r")
            .select("doc_id", "text"))
    return materialise(rows.mapInArrow(write, _MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts
    the ids of all documents before it over all files."""

    def read(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                f = TokenFile(folder, name)
                for i in range(0, f.n_docs, READ_DOCS):
                    j = min(i + READ_DOCS, f.n_docs)
                    starts = f.starts(i, j)
                    crc = [zlib.crc32(ids.astype("<u4")) for ids in f.documents(starts)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * (j - i)), pa.array(f.doc_ids(i, j), pa.int64()), pa.array(starts[:-1]),
                         pa.array(np.diff(starts)), pa.array(crc, pa.int64())],
                        names=["name", "doc_id", "local", "n_tokens", "ids_crc32"])
                f.close()

    n_files = manifest.count()
    rows = manifest.select("name").repartition(max(1, n_files)).mapInArrow(
        read, "name string, doc_id long, local long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    base = manifest.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("_base"))
    return (rows.join(broadcast_checked(base), "name")
            .select("doc_id", (F.col("_base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"))
    return read_token_files(manifest, folder)
