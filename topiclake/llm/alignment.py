"""Operator 13: alignment of two tokenizations of the same text, by interval coalescing.

Both tokenizers read the same bytes, so every token is an interval of byte offsets. Per block
of documents:

1. the intervals of all A and B tokens are lexsorted by start;
2. ``maximum.accumulate`` over the ends gives the furthest offset covered so far; a group
   breaks where a start reaches that running maximum;
3. inside the groups overlapping A-B pairs (links) are expanded: for an A token the B tokens
   that end after its start and start before its end.

A pass over the documents writes the groups' digest and the links of every document, and
counts id pairs inside each task. The counts are summed by pair, the highest of every B id is
joined back, and a second pass looks the links' counts up: the ``FREQUENT`` commonest pairs in
a table that every task holds, all rarer ones by a join on the pair.

Defined results: a text is aligned when the joined bytes of A's and of B's tokens both equal a
space and the text; null and empty texts, and texts that either tokenizer changes (such as those
with U+2581), have no tokens: zeros and an empty digest. Special tokens inside texts are plain
text. Repeated rows and null ids are rows like any other; an empty table gives no rows; other
columns are ignored.

Scale: documents are never gathered; a very long text is one block of its own. Pair counts have
at most ``|A| * |B|`` rows and combine before the shuffle. A pair that stands in most documents is
among the frequent ones, so no join key is hot; the frequent table is bounded by ``FREQUENT``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import materialise, prepare, table
from .tokens import encoder, vocabulary

BLOCK_CHARS = 400_000
FREQUENT = 1_000_000
_HELD_PAIRS = 2_000_000  # pairs that a task counts before it hands them on
_MEMO = 250_000
_CALL = 2000  # segments of one call of the library
_SPACE = "▁"
_SEGMENT = re.compile(" +[^ \n]*|\n+|[^ \n]+")


class PieceEncoder:
    """Ids of a sentencepiece BPE model, memoised by segment.

    No piece holds a space mark after another character, and none holds a line end (both are
    checked), so no merge crosses the start of a run of spaces or a line end: the ids of a text are
    those of its segments. Texts that hold the space mark itself go to the library whole.
    """

    def __init__(self, path: str):
        import sentencepiece
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self._model.get_piece_size()
        pieces = [self._model.id_to_piece(i) for i in range(n)]
        if any("\n" in p or _SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("this model has pieces over several segments")
        if n > 1 << 16:
            raise ValueError("this encoder holds ids in 16 bits")
        self.token_bytes = [self._bytes(i, p) for i, p in enumerate(pieces)]
        first = self._model.encode("\n")  # the added space and a line end
        if len(first) != 2 or self.token_bytes[first[1]] != b"\n":
            raise ValueError("this model has no token of its own for a line end")
        self._line_end = first[1]
        self._memo: dict[str, bytes] = {}
        self._changed: set[str] = set()  # segments whose tokens are not their bytes

    def _bytes(self, i: int, piece: str) -> bytes:
        if self._model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self._model.is_control(i) or self._model.is_unknown(i):
            return b""
        return piece.replace(_SPACE, " ").encode()

    def _same(self, ids, text: str) -> bool:
        return b"".join(map(self.token_bytes.__getitem__, ids)) == text.encode()

    def _learn(self, segments: list[str]) -> None:
        """Ids of new segments, many in one call, with line ends between them."""
        for s in segments:
            if s[0] == "\n":
                self._memo[s] = np.full(len(s), self._line_end, "<u2").tobytes()
        segments = [s for s in segments if s[0] != "\n"]
        for at in range(0, len(segments), _CALL):
            part = segments[at:at + _CALL]
            text = "\n".join(["", *part, ""])
            ids = self._model.encode(text)
            a = np.array(ids, "<u2")
            cuts = np.flatnonzero(a == self._line_end).tolist()
            if len(cuts) != len(part) + 1:
                raise ValueError("line end met inside a segment")
            same = self._same(ids, " " + text)
            for s, i, j in zip(part, cuts, cuts[1:]):
                self._memo[s] = a[i + 1:j].tobytes()
                if not same and not self._same(ids[i + 1:j], s):
                    self._changed.add(s)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids of every text as little-endian unsigned 16-bit bytes (an empty text has none), and
        whether the tokens' bytes are a space and the text."""
        segments = [_SEGMENT.findall(" " + t) if t and _SPACE not in t else [] for t in texts]
        met = set().union(*segments)
        if len(self._memo) > _MEMO:
            self._memo.clear()
            self._changed.clear()
        self._learn(list(met.difference(self._memo)))
        ids, same = [], []
        for t, parts in zip(texts, segments):
            if t and _SPACE in t:
                whole = self._model.encode(t)
                ids.append(np.array(whole, "<u2").tobytes())
                same.append(self._same(whole, " " + t))
            else:
                ids.append(b"".join(map(self._memo.__getitem__, parts)))
                same.append(not self._changed or self._changed.isdisjoint(parts))
        return ids, same


def byte_tokens(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level vocabulary (none for special tokens)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["id"] for t in spec.get("added_tokens", [])}
    byte = tokens._byte_of_char()
    vocab = spec["model"]["vocab"]
    out = [b""] * (max([*vocab.values(), *special], default=-1) + 1)
    for token, i in vocab.items():
        if i not in special:
            out[i] = bytes(byte[c] for c in token)
    return out


def _segments_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ``counts`` of items per owner: the owner of every item, and its place there."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner]


def coalesce(a_start, a_end, b_start, b_end):
    """Groups and links of two token sequences over the same bytes.

    Returns the group of every A token and of every B token, and the links as indexes of A and B
    tokens, in order.
    """
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    kind = np.repeat(np.array([0, 1], np.int8), [len(a_start), len(b_start)])
    order = np.lexsort((kind, start))
    covered = np.maximum.accumulate(end[order]) if len(order) else end
    breaks = np.ones(len(order), np.int64)
    breaks[1:] = start[order][1:] >= covered[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # overlaps lie inside a group: its B tokens that end after an A token's start, to those that start before its end
    first = np.searchsorted(b_end, a_start, "right")
    count = np.maximum(np.searchsorted(b_start, a_end, "left") - first, 0)
    link_a, place = _segments_of(count)
    return group[:len(a_start)], group[len(a_start):], link_a, first[link_a] + place


class Aligner:
    """Both tokenizers with their tables, once per worker process."""

    def __init__(self, a_path: str, b_path: str):
        tokens.release()
        self.a = encoder(a_path, "byte")
        self.b = PieceEncoder(b_path)
        self.a_bytes, self.b_bytes = byte_tokens(a_path), self.b.token_bytes
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.b_size = len(self.b_bytes)
        n = len(self.a_bytes)
        if n * self.b_size > 1 << 32:
            raise ValueError("pairs of these ids need more than 32 bits")
        self._b_at = 2 * n
        words = [f"{i}".encode() for i in range(max(n, self.b_size))]
        self._text = np.array([w + b"," for w in words[:n]] + [w + b"|" for w in words[:n]]
                              + [w + b"," for w in words[:self.b_size]] + [w + b";" for w in words[:self.b_size]], object)

    def align(self, texts: list[str | None]):
        """Per text ``n_a, n_b, n_groups, digest`` and, for all, the links' pair codes with the
        number of links of each text."""
        full = [" " + t if t else "" for t in texts]
        a_ids = [np.frombuffer(x, "<u2") for x in self.a.encode(full)]
        b_ids, same = self.b.encode([t or "" for t in texts])
        b_ids = [np.frombuffer(x, "<u2") for x in b_ids]
        for k, t in enumerate(full):  # byte-level tokens are the text's bytes, so their number tells
            if t and (not same[k] or int(self.a_len[a_ids[k]].sum()) != len(t.encode())):
                a_ids[k] = b_ids[k] = a_ids[k][:0]
        n_a, n_b = np.array([len(x) for x in a_ids], np.int64), np.array([len(x) for x in b_ids], np.int64)
        a = np.concatenate([*a_ids, np.zeros(0, "<u2")]).astype(np.int64)
        b = np.concatenate([*b_ids, np.zeros(0, "<u2")]).astype(np.int64)
        # the texts of a block follow each other without a gap; a text's end ends both tokens there
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        ga, gb, la, lb = coalesce(a_end - self.a_len[a], a_end, b_end - self.b_len[b], b_end)
        doc_a = np.repeat(np.arange(len(texts)), n_a)
        n_links = np.bincount(doc_a[la], minlength=len(texts))
        first_group = np.ones(len(ga), bool)
        first_group[1:] = ga[1:] != ga[:-1]
        n_groups = np.bincount(doc_a[first_group], minlength=len(texts))
        return n_a, n_b, n_groups, self._digests(a, b, ga, gb, n_a, n_b), a[la] * self.b_size + b[lb], n_links

    def _digests(self, a, b, ga, gb, n_a, n_b) -> list[str]:
        """Every text's groups as ``a1,a2|b1;a3|b2``, hashed."""
        last_a, last_b = np.ones(len(a), bool), np.ones(len(b), bool)
        last_a[:-1] = ga[1:] != ga[:-1]
        last_b[:-1] = gb[1:] != gb[:-1]
        code = np.concatenate([a + last_a * (self._b_at // 2), b + last_b * self.b_size + self._b_at])
        parts = self._text[code[np.argsort(np.concatenate([ga, gb]), kind="stable")]].tolist()
        out, at = [], 0
        for n in (n_a + n_b).tolist():
            out.append(hashlib.sha256(b"".join(parts[at:at + n])[:-1]).hexdigest() if n else "")
            at += n
        return out


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(a_path, b_path)
    return _ALIGNERS[key]


class _PairCounts:
    """Counts of pair codes, kept sorted and of bounded size."""

    def __init__(self):
        self.codes, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._new: list[np.ndarray] = []
        self._n = 0

    def add(self, codes: np.ndarray) -> None:
        self._new.append(codes)
        self._n += len(codes)
        if self._n > _HELD_PAIRS:
            self.fold()

    def fold(self) -> None:
        parts = [np.unique(x, return_counts=True) for x in [np.concatenate(self._new)]] if self._new else []
        codes = np.concatenate([self.codes, *[p[0] for p in parts]])
        counts = np.concatenate([self.counts, *[p[1] for p in parts]])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, int)
        self.codes, self.counts = codes[first], np.add.reduceat(counts, first) if len(first) else counts
        self._new, self._n = [], 0


_ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, "
            "pairs binary, counts binary")
_TYPES = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = [c.split()[0] for c in _ALIGNED.split(", ")]


def _blocks(ids: list, texts: list):
    """Runs of rows of about ``BLOCK_CHARS`` characters; a longer text is alone."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if k > at and size + n > BLOCK_CHARS:
            yield ids[at:k], texts[at:k]
            at, size = k, 0
        size += n
    if texts:
        yield ids[at:], texts[at:]


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document with its digest and links (32-bit pair codes ``a * |B| + b``), and rows
    without ``n_a`` that hold a task's counts of pairs."""
    prepare(docs.sparkSession)

    def run(batches):
        aligner, counts = _aligner(a_path, b_path), _PairCounts()

        def handed():
            counts.fold()
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, t) for t in _TYPES[:-2]]
                + [pa.array([counts.codes.astype("<i8").tobytes()], pa.binary()),
                   pa.array([counts.counts.astype("<i8").tobytes()], pa.binary())], names=_NAMES)

        for b in batches:
            for ids, texts in _blocks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n_a, n_b, n_groups, digests, codes, n_links = aligner.align(texts)
                counts.add(codes)
                ends = np.cumsum(n_links).tolist()
                packed = codes.astype("<u4")
                links = [packed[e - n:e].tobytes() for e, n in zip(ends, n_links.tolist())]
                cols = [ids, n_a, n_b, n_groups, n_links, digests, links, [None] * len(ids), [None] * len(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=_NAMES)
                if len(counts.codes) > _HELD_PAIRS:
                    yield handed()
                    counts = _PairCounts()
        yield handed()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, _ALIGNED)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """``pair, links, best``: the links of every id pair, and whether no pair of its B id has more."""
    def unpack(batches):
        for b in batches:
            for codes, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(codes, "<i8")),
                                                  pa.array(np.frombuffer(counts, "<i8"))], names=["pair", "n"])

    pairs = (aligned.where("pairs IS NOT NULL").select("pairs", "counts").mapInArrow(unpack, "pair long, n long")
             .groupBy("pair").agg(F.sum("n").alias("links")).withColumn("b", F.col("pair") % b_size))
    pairs = materialise(pairs, "pairs")
    top = pairs.groupBy("b").agg(F.max("links").alias("top"))  # at most one row per B id
    return materialise(pairs.join(F.broadcast(top), "b").select("pair", "links", (F.col("links") == F.col("top")).alias("best")),
                       "pair-counts")


def link_counts(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``aligned``'s documents with ``n_best`` and ``count_sum``."""
    spark = aligned.sparkSession
    least = 0
    if counts.count() > frequent:  # the pairs above some count, at most ``frequent`` of them
        by = counts.groupBy("links").count().withColumnRenamed("count", "n")
        at = by.select("links", "n").orderBy(F.col("links").desc()).limit(frequent).collect()
        held = np.cumsum([r.n for r in at])
        least = at[int(np.searchsorted(held, frequent, "right")) - 1].links if held[0] <= frequent else at[0].links + 1
    common = counts.where(F.col("links") >= least).toArrow().sort_by("pair")
    lookup = spark.sparkContext.broadcast((common["pair"].to_numpy(), common["links"].to_numpy(),
                                           common["best"].to_numpy(zero_copy_only=False)
                                           if common.num_rows else np.zeros(0, bool)))

    def look_up(batches):
        pair, links, best = lookup.value
        for b in batches:
            data = [x or b"" for x in b.column(1).to_pylist()]
            n = np.array([len(x) // 4 for x in data], np.int64)
            codes = np.frombuffer(b"".join(data), "<u4").astype(np.int64)
            owner = np.repeat(np.arange(len(n)), n)
            at = np.minimum(np.searchsorted(pair, codes), max(len(pair) - 1, 0))
            known = pair[at] == codes if len(pair) else np.zeros(len(codes), bool)
            o, at = owner[known], at[known]
            n_best = np.bincount(o[best[at]], minlength=len(n)) if len(at) else np.zeros(len(n), np.int64)
            total = np.zeros(len(n), np.int64)
            np.add.at(total, o, links[at])
            ends = np.cumsum(np.bincount(owner[~known], minlength=len(n)))[:-1] if len(n) else []
            rare = [x.tolist() for x in np.split(codes[~known], ends)] if len(n) else []
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_best.astype(np.int64)), pa.array(total), pa.array(rare, pa.list_(pa.int64()))],
                names=["row", "n_best", "count_sum", "rare"])

    documents = aligned.where("pairs IS NULL")
    looked = documents.select(F.struct("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").alias("row"), "links")
    looked = looked.mapInArrow(look_up, "row struct<doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                        "groups_sha256 string>, n_best long, count_sum long, rare array<long>")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if not least:
        return looked.select("row.*", "n_best", "count_sum").select(*columns)
    looked = materialise(looked.withColumn("at", F.monotonically_increasing_id()), "looked-up")
    rare = (looked.select("at", F.explode("rare").alias("pair")).groupBy("at", "pair").agg(F.count(F.lit(1)).alias("m"))
            .join(counts.where(F.col("links") < least), "pair")
            .groupBy("at").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("rare_best"),
                               F.sum(F.col("m") * F.col("links")).alias("rare_sum")))
    return looked.join(rare, "at", "left").select(
        "row.*", (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum")).select(*columns)


def align(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """The whole operator: groups, links and corpus-wide counts of every document."""
    aligned = materialise(align_documents(docs, a_path, b_path), "aligned")
    import sentencepiece
    size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    return link_counts(aligned, pair_counts(aligned, size), frequent)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return align(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
