"""Operator 12: all periodic runs of a word sequence, by internal pattern matching.

A run is a stretch of words with smallest period ``q`` and length of at least
``max(MIN_LENGTH, 2 q)`` that no neighbouring word extends. The sequences of a block of texts are
joined to one array (words of different texts get different symbols), then:

1. **Suffix array.** Prefix doubling sorts the suffixes; the ranks of every level ``k`` name the
   substrings of ``2^k`` words, so equal substrings are found, and common extensions to both
   sides are measured, in ``O(log n)`` gathers.
2. **Dyadic blocks.** A run of period ``q`` holds an aligned block of ``b = 2^k`` words, for
   ``2b - 1 <= q <= 4b - 2``, among the words that repeat ``q`` later, so that block occurs again
   exactly ``q`` words on. (For ``q <= 5`` blocks of 4 words serve, for ``q = 6`` those of 2,
   because at least ``MIN_LENGTH`` words are needed.) Blocks that occur once are skipped.
3. **Range successor.** A wavelet tree over the suffix array answers "the first occurrence of this
   block from position x on": the least value of at least ``x`` in the block's suffix interval.
   It walks the occurrences within the neighbouring window of each block.
4. **Progressions.** Three occurrences at one distance of at most ``b / 2`` start a progression; its
   end follows from one common extension, and its terms are taken at once. The differences between
   a block and its later occurrences are the candidate periods.
5. **Extension.** Each candidate is extended to both sides by common extensions; stretches long
   enough are runs, and of equal stretches the smallest period counts.

Before this, texts in which no six words stand twice are set aside: a run of at least 12 words and
two periods repeats at least six words, so these have none.

Defined results: null, empty and white texts have no words and no runs, their collapsed text is
empty; ties for the longest run go to the smallest start, then the smallest period; repeated rows
and null ids are rows like any other; an empty table gives no rows; other columns are ignored.

Scale: rows are independent, so nothing is shuffled and no key matters. A block holds about
``BLOCK_WORDS`` words; a very long text is one block of its own, with memory in proportion to
``n log n`` of its words.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, table

MIN_LENGTH = 12
BLOCK_WORDS = 150_000
_SHARED = 6  # words that a run of MIN_LENGTH repeats at least
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_NONE = np.zeros(0, np.int64)


class Ranks:
    """Suffix array by prefix doubling, with the ranks of every level kept.

    ``levels[k][i]`` is the first place, in the order of suffixes by their first ``2^k`` symbols,
    of the class of suffix ``i``: equal numbers mean equal substrings of ``2^k`` symbols. A suffix
    shorter than ``2^k`` equals none but itself.
    """

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        self.levels = [self._ranked(symbols[order], order)]
        self.order = order
        step = 1
        while n:
            rank = self.levels[-1]
            size = np.bincount(rank, minlength=n)
            open_ = np.flatnonzero(size[rank] > 1)  # suffixes alone in their class stay where they are
            if not len(open_):
                break
            after = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
            key = rank[open_] * (n + 1) + after
            place = np.argsort(key, kind="stable")
            key = key[place]
            members = open_[place]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            cls = key // (n + 1)
            first_cls = np.concatenate([[True], cls[1:] != cls[:-1]])
            at = np.arange(len(members))
            slot = cls + at - np.maximum.accumulate(np.where(first_cls, at, 0))  # their places in the whole order
            nxt = rank.copy()
            nxt[members] = np.maximum.accumulate(np.where(new, slot, 0))
            self.order = self.order.copy()
            self.order[slot] = members
            self.levels.append(nxt)
            step *= 2

    @staticmethod
    def _ranked(ordered: np.ndarray, order: np.ndarray) -> np.ndarray:
        rank = np.empty(len(order), np.int64)
        if len(order):
            new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        return rank

    def intervals(self, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix-array intervals of the substrings of ``2^k`` symbols that start at ``at``."""
        if k >= len(self.levels):  # all are unique
            lo = self.levels[-1][at]
            return lo, lo + 1
        rank = self.levels[k]
        return rank[at], rank[at] + np.bincount(rank, minlength=self.n)[rank[at]]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` on equal those from ``j`` on (``i < j``)."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, width = self.levels[k], 1 << k
            same = j + width <= self.n
            same[same] = rank[i[same]] == rank[j[same]]
            i[same] += width
            j[same] += width
            total[same] += width
        return total

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols just before ``i`` equal those just before ``j`` (``i < j``)."""
        i, j, total = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            rank, width = self.levels[k], 1 << k
            same = i >= width
            same[same] = rank[i[same] - width] == rank[j[same] - width]
            i[same] -= width
            j[same] -= width
            total[same] += width
        return total


class WaveletTree:
    """Levelwise wavelet tree of an array of numbers under ``2^bits``, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros, self.before = [], []
        v = values
        for b in range(self.bits - 1, -1, -1):
            one = (v >> b) & 1
            # before[i]: zeros among the first i
            self.before.append(np.concatenate([[0], np.cumsum(1 - one)]).astype(np.int32))
            self.zeros.append(int(self.before[-1][-1]))
            v = np.concatenate([v[one == 0], v[one == 1]])

    def less(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at ``[lo, hi)`` are less than ``x``."""
        lo, hi = lo.astype(np.int64), hi.astype(np.int64)
        count = np.zeros(len(lo), np.int64)
        over = x >= 1 << self.bits
        count[over] = (hi - lo)[over]
        for d, b in enumerate(range(self.bits - 1, -1, -1)):
            before, zeros = self.before[d], self.zeros[d]
            l0, h0 = before[lo].astype(np.int64), before[hi].astype(np.int64)
            one = ((x >> b) & 1) == 1
            count += np.where(one & ~over, h0 - l0, 0)
            lo, hi = np.where(one, zeros + lo - l0, l0), np.where(one, zeros + hi - h0, h0)
        return count

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest value (from 0) at ``[lo, hi)``; ``k < hi - lo``."""
        lo, hi, k = lo.astype(np.int64), hi.astype(np.int64), k.copy()
        value = np.zeros(len(lo), np.int64)
        for d, b in enumerate(range(self.bits - 1, -1, -1)):
            before, zeros = self.before[d], self.zeros[d]
            l0, h0 = before[lo].astype(np.int64), before[hi].astype(np.int64)
            one = k >= h0 - l0
            k = np.where(one, k - (h0 - l0), k)
            value |= one.astype(np.int64) << b
            lo, hi = np.where(one, zeros + lo - l0, l0), np.where(one, zeros + hi - h0, h0)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The least value of at least ``x`` at ``[lo, hi)``, or -1."""
        k = self.less(lo, hi, x)
        out = np.full(len(lo), -1, np.int64)
        there = k < hi - lo
        out[there] = self.smallest(lo[there], hi[there], k[there])
        return out


def _expand(first: np.ndarray, step: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owners and terms of arithmetic progressions."""
    owner = np.repeat(np.arange(len(first)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return owner, first[owner] + place * step[owner]


def candidate_periods(ranks: Ranks, tree: WaveletTree) -> tuple[np.ndarray, np.ndarray]:
    """``(position, period)`` pairs such that every run is extended from one of them at least."""
    n = ranks.n
    plan = [(1, 6, 6), (2, 1, 5), (2, 7, 14)]
    k = 3
    while (2 << k) - 1 <= n // 2 and k < len(ranks.levels):
        plan.append((k, (2 << k) - 1, (4 << k) - 2))
        k += 1
    found_p, found_q = [], []
    for k, least, most in plan:
        b = 1 << k
        p = np.arange(0, max(0, n - b + 1), b)
        if not len(p):
            continue
        lo, hi = ranks.intervals(k, p)
        again = hi - lo > 1
        p, lo, hi = p[again], lo[again], hi[again]
        x = p + least
        last = np.full(len(p), -1, np.int64)  # the occurrence before, and the one before that
        older = np.full(len(p), -1, np.int64)
        while len(p):
            nxt = tree.successor(lo, hi, x)
            on = (nxt >= 0) & (nxt <= p + most)
            p, lo, hi, nxt, last, older = p[on], lo[on], hi[on], nxt[on], last[on], older[on]
            found_p.append(p)
            found_q.append(nxt - p)
            x = nxt + 1
            step = nxt - last
            row = np.flatnonzero((older >= 0) & (step == last - older) & (2 * step <= b))
            if len(row):  # a progression: its terms follow from one common extension
                d = step[row]
                reach = ranks.forward(nxt[row] - d, nxt[row]) - b
                terms = np.minimum(np.maximum(reach, 0) // d, (p[row] + most - nxt[row]) // d)
                owner, term = _expand(nxt[row] + d, d, terms)
                found_p.append(p[row][owner])
                found_q.append(term - p[row][owner])
                older, last = last, nxt.copy()
                last[row] += terms * d
                older[row] = -1
                x[row] = last[row] + 1
            else:
                older, last = last, nxt
    return (np.concatenate([*found_p, _NONE]), np.concatenate([*found_q, _NONE]))


def find_runs(symbols: np.ndarray, min_length: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, period`` of all runs of a sequence, by start, then period."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs of under {MIN_LENGTH} words are not sought")
    ranks = Ranks(symbols)
    p, q = candidate_periods(ranks, WaveletTree(ranks.order))
    start = p - ranks.backward(p, p + q)
    end = p + q + ranks.forward(p, p + q)
    long = end - start >= np.maximum(min_length, 2 * q)
    start, end, q = start[long], end[long], q[long]
    order = np.lexsort((q, end, start))  # of equal stretches the smallest period counts
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _repeats(symbols: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Per text, whether six words stand in it twice (hashes: some may be kept for nothing)."""
    n = len(symbols) - _SHARED + 1
    out = np.zeros(docs, bool)
    if n < 2:
        return out
    h = np.zeros(n, np.uint64)
    for k in range(_SHARED):
        h = (h ^ symbols[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    h ^= doc[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(h)
    twice = order[1:][h[order[1:]] == h[order[:-1]]]
    out[doc[twice]] = True
    return out


def runs_of(texts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of every word list, positions from 0 in each."""
    known: dict[str, int] = {}
    number = known.setdefault
    size = np.array([len(w) for w in texts], np.int64)
    symbols = np.array([number(w, len(known)) for words in texts for w in words], np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    keep = _repeats(symbols, doc, len(texts))
    first = np.cumsum(np.where(keep, size, 0)) - np.where(keep, size, 0)
    inside = keep[doc]
    start, end, q = find_runs(symbols[inside] + doc[inside] * len(known)) if inside.any() else (_NONE, _NONE, _NONE)
    owner = doc[inside][start] if len(start) else _NONE
    start, end = start - first[owner], end - first[owner]
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [(start[a:b], end[a:b], q[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def repeated_tail(words: list[str], doc_id: int | None) -> list[str]:
    """The words that the query scans: for every tenth crc32 of an id, the words from some place on
    repeat a stretch of at most a third of what follows it."""
    if doc_id is None or not words:
        return words
    g, m = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if m:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


_RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
           "collapsed_sha256 string")


def _report(words: list[str], runs) -> tuple:
    start, end, q = runs
    lines = "".join(f"{s},{e - s},{p}\n" for s, e, p in zip(start.tolist(), end.tolist(), q.tolist()))
    best = (None,) * 4
    if len(start):
        k = int(np.lexsort((q, start, start - end))[0])
        s, n, p = int(start[k]), int(end[k] - start[k]), int(q[k])
        best = (s, n, p, 1000 * n // p)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, start + q, 1)
        np.add.at(edge, end, -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return (len(start), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(words).encode()).hexdigest())


def periodic_runs(docs: DataFrame, rewrite=None) -> DataFrame:
    """One row per document: its number of runs, the longest one, and digests of all runs and of the
    text without their repeats. ``rewrite(words, doc_id)`` may change the words first."""
    prepare(docs.sparkSession)

    def blocks(ids, texts):
        held, size = [], 0
        for i, t in zip(ids, texts):
            words = _WORD.findall(t) if t else []
            if rewrite is not None:
                words = rewrite(words, i)
            if held and size + len(words) > BLOCK_WORDS:
                yield held
                held, size = [], 0
            held.append((i, words))
            size += len(words)
        if held:
            yield held

    def run(batches):
        fields = [c.split() for c in _RESULT.split(", ")]
        types = [pa.int64() if t == "long" else pa.string() for _, t in fields]
        for b in batches:
            for block in blocks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = runs_of([words for _, words in block])
                rows = [(i, *_report(words, runs)) for (i, words), runs in zip(block, found)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=[c for c, _ in fields])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, _RESULT)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), repeated_tail)
