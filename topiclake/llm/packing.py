"""Operator 8: best-fit packing with certified bin counts.

Documents are encoded whole, an end id is appended, only longer ones are cut into pieces
of ``capacity`` tokens (the first may be shorter). Pieces are then packed:

1. pieces are dealt over partitions of bounded size by a hash of their key; each partition
   runs best-fit decreasing over a table of residual capacities;
2. each partition gets a lower bound from dual feasible functions (the volume bound, and
   ``f_e``: items over ``capacity - e`` count as full, items under ``e`` as nothing, for
   every ``e``, with the pairwise bound on items over half a bin); a partition whose bins equal its bound is certified and final;
3. the other partitions keep their full bins and exchange the documents of their gappy
   bins: these are pooled, dealt over fewer partitions and packed again by best-fit
   decreasing, until all are certified, one partition held the pool, a round saves
   nothing (its result is then dropped, the one before it stays), or ``MAX_ROUNDS`` rounds
   are done (a stop rule of cost: every piece is packed all the same).

Defined results: null and empty texts are one piece, the end id alone; repeated rows and
null ids are packed like any other row; no rows give no pieces; extra columns are ignored.

Scale: only piece lengths travel (no ids); a partition holds at most about
``pieces_per_partition`` pieces whatever the input; the driver sees counts only.
"""

from __future__ import annotations

import bisect
import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table
from .tokens import encoder, vocabulary

CAPACITY = 2048
PIECES_PER_PARTITION = 40_000
MAX_ROUNDS = 4
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def pieces(docs: DataFrame, vocab_path: str, kind: str = "byte", end_id: int = 0, capacity: int = CAPACITY,
           with_ids: bool = True) -> DataFrame:
    """One row per piece of at most ``capacity`` ids: ``doc_id, piece, start, length,
    ids_crc32`` and, with ``with_ids``, the ids as little-endian unsigned 16-bit bytes."""
    prepare(docs.sparkSession)

    def cut(batches):
        enc, end = encoder(vocab_path, kind), struct.pack("<H", end_id)
        for b in batches:
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist())):
                a = np.frombuffer(ids + end, "<u2")
                first = len(a) % capacity or capacity
                for p, s in enumerate([0, *range(first, len(a), capacity)]):
                    part = a[s:first if p == 0 else s + capacity]
                    rows.append((doc_id, p, s, len(part), zlib.crc32(part.astype("<u4")),
                                 part.tobytes() if with_ids else None))
            if rows:
                c = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, types)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, _PIECES)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best, over every ``e`` up to half the capacity, of: items over ``capacity - e``
    take a bin each, and the others of at least ``e`` take as many more bins as their volume
    or the number of them over half the capacity demands."""
    count = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1].astype(np.int64)
    volume = count * np.arange(capacity + 1)
    n_upto, v_upto = np.cumsum(count), np.cumsum(volume)
    e = np.arange(0, capacity // 2 + 1)
    full = n_upto[capacity] - n_upto[capacity - e]
    middle = v_upto[capacity - e] - np.where(e > 0, v_upto[np.maximum(e - 1, 0)], 0)
    over_half = n_upto[capacity - e] - n_upto[capacity // 2]
    return int((full + np.maximum(-(-middle // capacity), over_half)).max()) if len(lengths) else 0


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item. Open bins are kept by residual capacity; the smallest
    residual that still fits is taken."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    residuals: list[int] = []  # sorted residuals that have open bins
    n = 0
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        at = bisect.bisect_left(residuals, size)
        if at == len(residuals):
            room, b = capacity, n
            n += 1
        else:
            room = residuals[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                del residuals[at]
        bins[i], offsets[i] = b, capacity - room
        left = room - size
        if left:
            if not open_bins[left]:
                bisect.insort(residuals, left)
            open_bins[left].append(b)
    return bins, offsets


_PACKED = ("key long, length long, part int, bin long, offset long, used long, bins long, bound long")


def _pack(items: DataFrame, n_parts: int, seed: int, capacity: int) -> DataFrame:
    """Deal ``items(key, length)`` over ``n_parts`` and pack each part by best-fit decreasing."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "key"], ascending=[False, True], kind="stable")
        lengths = pdf["length"].to_numpy()
        b, off = best_fit_decreasing(lengths, capacity)
        used = np.bincount(b, weights=lengths).astype(np.int64)
        return pdf.assign(bin=b, offset=off, used=used[b], bins=len(used), bound=lower_bound(lengths, capacity))[
            ["key", "length", "part", "bin", "offset", "used", "bins", "bound"]]

    dealt = items.withColumn("part", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(n_parts)).cast("int"))
    return dealt.groupBy("part").applyInPandas(run, _PACKED)


def pack(items: DataFrame, capacity: int = CAPACITY, pieces_per_partition: int = PIECES_PER_PARTITION,
         max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """Pack ``items(key, length)`` (unique keys): ``key, sequence_id, offset, round,
    certified``."""
    pool, n = items.select("key", "length"), items.count()
    n_parts = max(1, -(-n // pieces_per_partition))
    packed = _round(pool, n_parts, 0, capacity)
    open_bin = ~F.col("certified") & (F.col("used") < capacity)
    out = packed.where(~open_bin).select(_OUT)
    for r in range(1, max_rounds + 1):
        left = packed.where(open_bin)
        had, n = _bins(left)
        if n_parts == 1 or n == 0:
            return out.unionByName(left.select(_OUT))
        n_parts = max(1, -(-n // pieces_per_partition))
        again = _round(left.select("key", "length"), n_parts, r, capacity)
        if _bins(again)[0] >= had:
            return out.unionByName(left.select(_OUT))
        packed = again
        out = out.unionByName(packed.where(~open_bin).select(_OUT))
    return out.unionByName(packed.where(open_bin).select(_OUT))


_OUT = ["key", "sequence_id", "offset", "round", "certified"]


def _round(items: DataFrame, n_parts: int, r: int, capacity: int) -> DataFrame:
    """One written round: pieces with their bin, and whether their part met its bound."""
    number = (F.shiftleft(F.lit(r).cast("long"), 58).bitwiseOR(F.shiftleft(F.col("part").cast("long"), 32))
              .bitwiseOR(F.col("bin")))
    return (materialise(_pack(items, n_parts, r, capacity), f"packed-{r}")
            .withColumns({"sequence_id": number, "round": F.lit(r), "certified": F.col("bins") == F.col("bound")}))


def _bins(packed: DataFrame) -> tuple[int, int]:
    """Bins and pieces; every bin has exactly one piece at offset 0."""
    s = packed.agg(F.count(F.when(F.col("offset") == 0, 1)).alias("bins"), F.count(F.lit(1)).alias("items")).first()
    return s.bins, s.items


def pack_documents(docs: DataFrame, vocab_path: str, kind: str = "byte", end_id: int = 0, capacity: int = CAPACITY,
                   with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their ``sequence_id`` and ``offset``."""
    cut = pieces(docs, vocab_path, kind, end_id, capacity, with_ids)
    cut = cut if with_ids else cut.drop("ids")
    # ids fixed by the write: row order within a file and the file's task
    cut = materialise(cut.withColumn("key", F.monotonically_increasing_id()), "pieces")
    placed = pack(cut.select("key", "length"), capacity)
    return cut.join(placed, "key").drop("key")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (``with_ids`` pieces): ``sequence_id, n_tokens, ids``.
    A sequence holds at most ``capacity`` ids, so a group is bounded."""
    g = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    hexes = F.transform("p", lambda x: F.hex(x["ids"]))
    return g.select("sequence_id", "n_tokens", F.unhex(F.concat_ws("", hexes)).alias("ids"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "round", "certified")
