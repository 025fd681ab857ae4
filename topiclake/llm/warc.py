"""Operator 4: WARC records in seekable Zstandard bundles.

``write_bundles`` writes one WARC/1.1 record per page. Records are grouped into
independent Zstandard frames of about ``frame_bytes``; a bundle ends with a skippable
frame that holds the seek table (compressed and plain size of every frame, the public
seekable format) and is preceded by another with the record index: record id -> (frame,
offset inside the plain frame). Either is skipped by an ordinary Zstandard reader, so
the bundle is also a plain ``.warc.zst``. ``read_record`` fetches one record by
decompressing one frame; ``read_bundles`` reads all.

Of records with equal payloads of at least ``min_revisit`` bytes, the one with the
smallest id is the ``response``, the others are ``revisit`` records without payload that
name it. Smaller payloads are all responses.

Defined results: a null html is an empty payload; null ids come first in the order (the
response of a group may then be the null id); rows repeated with one id: all but one of
them are revisits of that id; an empty table gives no bundle; extra columns are ignored.

Scale: digests are grouped with map-side partial aggregation (only id and digest move);
pages move once, by their row number, so no host, id or payload is a hot key; a task holds
one frame.
"""

from __future__ import annotations

import hashlib
import json
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import materialise, prepare, scratch_path, table

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
MIN_REVISIT = 100
LEVEL = 6
_SKIPPABLE = 0x184D2A5E
_SEEK_MAGIC = 0x8F92EAB1
_INDEX_MAGIC = b"WIDX"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``row, payload_bytes, payload_digest, record_type, refers_to`` for the rows of
    ``pages(row, page_id, html)`` (``row`` unique): who is the response of each payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    d = materialise(pages.select("row", "page_id", F.sha2(payload, 256).alias("payload_digest"),
                                 F.octet_length(payload).cast("long").alias("payload_bytes")), "digests")
    big = d.where(F.col("payload_bytes") >= min_revisit)
    # smallest id first, nulls after all; then the row number, so exactly one row is chosen
    first = big.groupBy("payload_digest").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "row")).alias("first"))
    # only groups of two or more need the second look
    groups = first.where("n > 1").select("payload_digest", "first")
    j = d.join(groups, "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= min_revisit) & F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    return j.select("row", "payload_bytes", "payload_digest",
                    F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("first.page_id")).alias("refers_to"))


def _clean(s: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in s)


def _record(page_id, url, payload: bytes, n: int, digest: str, kind: str, refers) -> bytes:
    name = "null" if page_id is None else str(page_id)
    body = payload if kind == "response" else b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n}",
            "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT_PROFILE}",
                 f"WARC-Refers-To: <urn:page:{'null' if refers is None else refers}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, position behind the record) of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    head = dict(x.split(": ", 1) for x in lines[1:])
    start = end + 4
    stop = start + int(head["Content-Length"])
    return head, data[start:stop], stop + 4


class _Bundle:
    def __init__(self, fs, path: str):
        import zstandard
        self._z = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self._out = fs.open_output_stream(path, compression=None)
        self._frames, self._index, self._open, self._size, self.written = [], [], [], 0, 0

    def add(self, name: str, record: bytes, frame_bytes: int) -> None:
        self._index.append((name, len(self._frames), self._size))
        self._open.append(record)
        self._size += len(record)
        if self._size >= frame_bytes:
            self._flush()

    def _flush(self) -> None:
        if self._open:
            z = self._z.compress(b"".join(self._open))
            self._out.write(z)
            self._frames.append((len(z), self._size))
            self.written += len(z)
            self._open, self._size = [], 0

    def close(self) -> int:
        self._flush()
        index = self._z.compress(json.dumps(self._index, separators=(",", ":")).encode())
        body = _INDEX_MAGIC + index
        self._out.write(struct.pack("<II", _SKIPPABLE, len(body)) + body)
        self._frames.append((len(body) + 8, 0))  # the seek table covers every frame before it
        table = b"".join(struct.pack("<II", *f) for f in self._frames)
        self._out.write(struct.pack("<II", _SKIPPABLE, len(table) + 9) + table
                        + struct.pack("<IBI", len(self._frames), 0, _SEEK_MAGIC))
        self._out.close()
        return len(self._index)


class BundleReader:
    """Seek table and index of one bundle; frames are fetched and decompressed one by one."""

    def __init__(self, folder: str, name: str):
        import zstandard
        self._z = zstandard.ZstdDecompressor()
        fs, root = files.filesystem(folder)
        self._f = fs.open_input_file(f"{root}/{name}")
        size = self._f.size()
        n, _, magic = struct.unpack("<IBI", self._f.read_at(9, size - 9))
        if magic != _SEEK_MAGIC:
            raise ValueError(f"{name}: no seek table")
        raw = self._f.read_at(8 * n, size - 9 - 8 * n)
        self.frames, at = [], 0
        for i in range(n):
            z, plain = struct.unpack_from("<II", raw, 8 * i)
            self.frames.append((at, z, plain))
            at += z
        at, z, _ = self.frames.pop()
        self.index = json.loads(self._z.decompress(self._f.read_at(z - 12, at + 12)))

    def frame(self, i: int) -> bytes:
        at, z, plain = self.frames[i]
        return self._z.decompress(self._f.read_at(z, at), max_output_size=plain)

    def record(self, name: str) -> tuple[dict[str, str], bytes]:
        _, frame, offset = next(x for x in self.index if x[0] == name)
        return parse_record(self.frame(frame), offset)[:2]

    def close(self) -> None:
        self._f.close()


def write_bundles(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES,
                  bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as bundles; returns the manifest ``name, records``."""
    prepare(pages.sparkSession)

    def write(batches):
        fs, root = files.filesystem(folder)
        fs.create_dir(root, recursive=True)
        part, seq, bundle, done = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(7)]
            for page_id, url, html, n, digest, kind, refers in zip(*cols):
                if bundle is None:
                    name = files.unique_name(part, seq, ".warc.zst")
                    bundle = _Bundle(fs, f"{root}/{name}")
                payload = (html or "").encode()
                bundle.add("null" if page_id is None else str(page_id),
                           _record(page_id, url, payload, n, digest, kind, refers), frame_bytes)
                if bundle.written >= bundle_bytes:
                    done.append((name, bundle.close()))
                    bundle, seq = None, seq + 1
        if bundle is not None:
            done.append((name, bundle.close()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())],
                                             names=["name", "records"])

    # The row number is fixed by the written copy, so both scans below give it alike.
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "pages-numbered")
    plan = plan_records(rows)
    ready = (rows.join(plan, "row").select("page_id", "url", "html", "payload_bytes", "payload_digest", "record_type",
                                           "refers_to"))
    return materialise(ready.mapInArrow(write, "name string, records long"), "warc-manifest")


def read_bundles(manifest: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles: ``page_id, url, payload (null for revisits), payload_bytes,
    payload_digest, record_type, refers_to``; a response's digest is taken from its payload."""

    def number(x: str | None):
        x = x and x.removeprefix("<urn:page:").removesuffix(">")
        return None if x in (None, "null") else int(x)

    def read(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                f = BundleReader(folder, name)
                for i in range(len(f.frames)):
                    data, at, rows = f.frame(i), 0, []
                    while at < len(data):
                        h, payload, at = parse_record(data, at)
                        digest = h["WARC-Payload-Digest"].removeprefix("sha256:")
                        n, kind = int(h["X-Payload-Length"]), h["WARC-Type"]
                        if kind == "response":
                            if (len(payload), hashlib.sha256(payload).hexdigest()) != (n, digest):
                                raise ValueError(f"{name}: damaged record {h['WARC-Record-ID']}")
                        rows.append((number(h["WARC-Record-ID"]), h.get("WARC-Target-URI"),
                                     payload if kind == "response" else None, n, digest, kind,
                                     number(h.get("WARC-Refers-To"))))
                    c = list(zip(*rows))
                    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(c, types)],
                        names=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                f.close()

    n = manifest.count()
    return manifest.select("name").repartition(max(1, n)).mapInArrow(
        read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long")


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    manifest = write_bundles(table(spark, sf_dir, "pages"), folder)
    return read_bundles(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
g AS (SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS rn,
        first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND rn > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND rn > 1 THEN first_id END AS refers_to
FROM g
"""
