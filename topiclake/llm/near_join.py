"""Operator 5: n-gram Jaccard join by vertical partitioning, and its components.

Documents are sets of word shingles (64-bit hashes); two link when their Jaccard
similarity reaches 0.8. Equal sets form a class; links are sought between classes.

1. *Candidate lists.* With shingles in the global (hash) order, two linked sets share at
   least ``k`` of their first ``n - ceil(0.8 n) + k`` shingles. Those prefixes are dealt by
   shingle, each shingle's number of classes is counted, and every class keeps the rarest
   of its shared prefix shingles that it cannot do without (a second prefix filter over
   the first prefix); a class with too many unshared shingles is out. Classes that keep
   the same shingle, and are of like size, form a list: linked classes share a list.
2. *Hubs.* Each list is compared with one member only, the one with the fewest unshared
   shingles. For these pairs the global order is cut into ``FRAGMENTS`` ranges; each
   range's partial overlap is counted separately, and summed per pair.
3. *Other pairs.* A hub's members are known by their differences from the hub, and the
   overlap of any two of them follows exactly from those. Members that don't link with
   the hub are compared with all members, in blocks bounded in members and bytes, on the
   differences that both sides have. Of a block's links a spanning forest comes out: never
   the pairs of a group. ``link_counts`` compares all members so, and counts.
4. Components by alternating large-star and small-star steps.

No candidate is capped, dropped or sampled. Shingles and classes are identified by 64-bit
hashes; list shingles by 48 bits, where a collision only adds a comparison.

Defined results: null, empty and wordless texts have no shingles, link with nothing and
are their own component; null ids take part, and a component's id is its smallest
non-null id; repeated rows form one class; an empty table gives no rows; extra columns
are ignored; a very long text is one set, its differences travel in one row.

Scale: a shingle that many documents of one task hold travels as one marker, so its
bucket grows with tasks, not documents; bucket counts follow the data; the hub comparison
is a join that Spark may split; blocks hold about ``BLOCK`` members or ``BLOCK_BYTES`` each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_checked, fresh_name, materialise, prepare, table, without
from .tokens import release

SHINGLE = 5
FRAGMENTS = 4
BLOCK = 512
BLOCK_BYTES = 32 << 20
COLUMNS = 8192
TOKENS_PER_BUCKET = 1_000_000
MIN_BUCKETS = 64
_FLUSH_TOKENS = 1_500_000
_FLUSH_CLASSES = 60_000
_LOCAL_HOT = 32  # so many classes of one flush: the shingle is hot everywhere
_HOT = 65_535
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text; ASCII letters are lower-cased, words
    end at ASCII white space."""
    import xxhash
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    size = min(k, len(h))
    n = len(h) - size + 1
    acc = np.full(n, size, np.uint64)
    for j in range(size):
        acc = _mix(acc + h[j:j + n] * _ODD[j % len(_ODD)])
    return np.unique(acc)


def _class_key(s: np.ndarray) -> int:
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _prefix_size(n):
    return n - (4 * n + 4) // 5 + (n + 4) // 5


def _must_share(n):
    """Shared prefix shingles with any set of at least 0.8 n shingles."""
    return ((4 * n + 4) // 5 + 4) // 5


def class_table(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``doc_id, th, n, cls`` per row; ``th`` is the text's hash, ``cls`` is null for empty sets."""

    def run(batches):
        release()
        for b in batches:
            n, cls = [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, k)
                n.append(len(s))
                cls.append(_class_key(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(cls, pa.int64())],
                                             names=["doc_id", "th", "n", "cls"])

    rows = _texts(docs, F.xxhash64(F.col("text").cast("string")).alias("th"))
    return materialise(rows.mapInArrow(run, "doc_id long, th long, n long, cls long"), "classes")


def _texts(docs: DataFrame, *more) -> DataFrame:
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"), *more)


_BLOB = "bucket int, lo binary, hi binary, at binary, cls binary, n binary, df binary"


def _blob(bucket: int, tok: np.ndarray, at: np.ndarray, cls: np.ndarray, n: np.ndarray, df: np.ndarray | None):
    """One packed row: shingles (48 bits), the class index of each (65535: a marker), the
    classes used with their set sizes, and counts where known."""
    used, local = np.unique(at[at != _HOT], return_inverse=True)
    index = np.full(len(at), _HOT, np.uint16)
    index[at != _HOT] = local
    return (bucket, (tok & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (tok >> np.uint64(32)).astype("<u2").tobytes(),
            index.astype("<u2").tobytes(), cls[used].astype("<i8").tobytes(), n[used].astype("<i4").tobytes(),
            b"" if df is None else df.astype("<u2").tobytes())


def _unblob(t: pa.Table):
    """All entries of the packed rows of one bucket: shingle, class, set size, count, marker."""
    toks, cls, ns, dfs, marks = [], [], [], [], []
    for lo, hi, at, c, n, df in zip(*[t.column(i).to_pylist() for i in range(1, 7)]):
        tok = np.frombuffer(lo, "<u4").astype(np.uint64) | np.frombuffer(hi, "<u2").astype(np.uint64) << np.uint64(32)
        at = np.frombuffer(at, "<u2")
        mark = at == _HOT
        c, n = np.append(np.frombuffer(c, "<i8"), 0), np.append(np.frombuffer(n, "<i4"), 0)
        at = np.where(mark, len(c) - 1, at).astype(np.int64)
        toks.append(tok)
        marks.append(mark)
        cls.append(c[at])
        ns.append(n[at])
        dfs.append(np.frombuffer(df, "<u2") if df else np.zeros(len(tok), np.uint16))
    return [np.concatenate(x) for x in (toks, cls, ns, dfs, marks)]


def _rows(rows) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                      names=["bucket", "lo", "hi", "at", "cls", "n", "df"])


def _split(bucket: np.ndarray, arrays: list[np.ndarray]):
    """The arrays by bucket number."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    cuts = np.flatnonzero(np.diff(b)) + 1
    starts, ends = np.append(0, cuts), np.append(cuts, len(b))
    arrays = [a[order] for a in arrays]
    for s, e in zip(starts.tolist(), ends.tolist()):
        if e > s:
            yield int(b[s]), [a[s:e] for a in arrays]


def _class_bucket(cls: np.ndarray, n_buckets: int) -> np.ndarray:
    return (_mix(cls.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)


def _prefix_blobs(docs: DataFrame, n_buckets: int, k: int) -> DataFrame:
    """Prefix shingles of all classes, packed by shingle bucket; what is hot within a flush
    goes to the class buckets (numbered behind the shingle buckets) at once."""

    def flush(sets, cls, n):
        tok = np.concatenate(sets)
        at = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
        cls, n = np.array(cls, np.int64), np.array(n, np.int64)
        order = np.argsort(tok, kind="stable")
        tok, at = tok[order], at[order]
        first = np.flatnonzero(np.append(True, tok[1:] != tok[:-1]))
        count = np.diff(np.append(first, len(tok)))
        hot = np.repeat(count >= _LOCAL_HOT, count)
        marker = tok[first[count >= _LOCAL_HOT]]
        t = np.concatenate([tok[~hot], marker])
        a = np.concatenate([at[~hot], np.full(len(marker), _HOT)])
        bucket = (t * np.uint64(n_buckets) >> np.uint64(48)).astype(np.int64)
        for b, (x, y) in _split(bucket, [t, a]):
            yield _blob(b, x, y, cls, n, None)
        if hot.any():
            x, y = tok[hot], at[hot]
            for b, (p, q) in _split(_class_bucket(cls[y], n_buckets), [x, y]):
                yield _blob(n_buckets + b, p, q, cls, n, np.full(len(p), _HOT))

    def run(batches):
        release()
        seen, sets, cls, n, size = set(), [], [], [], 0
        for b in batches:
            for t in b.column(1).to_pylist():
                s = shingle_set(t, k)
                key = _class_key(s) if len(s) else None
                if key is None or key in seen:
                    continue
                seen.add(key)
                head = np.unique(s[:_prefix_size(len(s))] >> np.uint64(16))
                sets.append(head)
                cls.append(key)
                n.append(len(s))
                size += len(head)
                if size >= _FLUSH_TOKENS or len(sets) >= _FLUSH_CLASSES:
                    yield _rows(list(flush(sets, cls, n)))
                    seen, sets, cls, n, size = set(), [], [], [], 0
        if sets:
            yield _rows(list(flush(sets, cls, n)))

    return _texts(docs).mapInArrow(run, _BLOB)


def _count_shared(blobs: DataFrame, n_buckets: int) -> DataFrame:
    """Shingle buckets -> class buckets: the shingles of two or more classes with their count."""

    def run(t: pa.Table) -> pa.Table:
        tok, cls, n, df, mark = _unblob(t)
        if t.column(0)[0].as_py() >= n_buckets:  # hot shingles: counted already
            out = [tok, cls, n, df.astype(np.int64)]
        else:
            order = np.lexsort((cls, mark, tok))
            tok, cls, n, mark = tok[order], cls[order], n[order], mark[order]
            one = np.append(True, (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1]) | (mark[1:] != mark[:-1]))
            tok, cls, n, mark = tok[one], cls[one], n[one], mark[one]
            first = np.flatnonzero(np.append(True, tok[1:] != tok[:-1])) if len(tok) else np.zeros(0, np.int64)
            size = np.diff(np.append(first, len(tok)))
            hot = np.add.reduceat(mark, first) > 0 if len(tok) else np.zeros(0, bool)
            count = np.repeat(np.where(hot, _HOT, np.minimum(size, _HOT - 1)), size)
            keep = (count >= 2) & ~mark
            out = [tok[keep], cls[keep], n[keep], count[keep]]
        tok, cls, n, df = out
        keys, at, = np.unique(cls, return_inverse=True)
        sizes = np.zeros(len(keys), np.int64)
        sizes[at] = n
        rows = []
        for b, (x, y, d) in _split(_class_bucket(cls, n_buckets), [tok, at, df]):
            for i in range(0, len(x), 1 << 20):  # class indexes of a row stay below 65535
                xs, ys, ds = x[i:i + (1 << 20)], y[i:i + (1 << 20)], d[i:i + (1 << 20)]
                for j in range(0, int(ys.max()) + 1, _FLUSH_CLASSES):
                    m = (ys >= j) & (ys < j + _FLUSH_CLASSES)
                    if m.any():
                        rows.append(_blob(b, xs[m], ys[m] - j, keys[j:], sizes[j:], ds[m]))
        if not rows:
            return pa.Table.from_batches([], schema=_SCHEMA)
        return pa.Table.from_batches([_rows(rows)])

    return blobs.groupBy("bucket").applyInArrow(run, _BLOB)


_SCHEMA = pa.schema([("bucket", pa.int32())] + [(c, pa.binary()) for c in ("lo", "hi", "at", "cls", "n", "df")])
_ENTRY = pa.schema([("tok", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("alone", pa.int64())])


def _list_entries(shared: DataFrame) -> DataFrame:
    """Per class, the rarest shared prefix shingles that it cannot do without: ``tok, cls, n,
    alone`` (``alone``: its unshared prefix shingles)."""

    def run(t: pa.Table) -> pa.Table:
        tok, cls, n, df, _ = _unblob(t)
        order = np.lexsort((tok, df, cls))
        tok, cls, n, df = tok[order], cls[order], n[order], df[order]
        one = np.append(True, (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])) if len(tok) else np.zeros(0, bool)
        tok, cls, n = tok[one], cls[one], n[one].astype(np.int64)
        first = np.flatnonzero(np.append(True, cls[1:] != cls[:-1])) if len(tok) else np.zeros(0, np.int64)
        got = np.diff(np.append(first, len(tok)))
        m, must = _prefix_size(n[first]), _must_share(n[first])
        alone = np.maximum(m - got, 0)
        quota = np.where(got >= must, m - must + 1 - alone, 0)
        place = np.arange(len(tok)) - np.repeat(first, got)
        keep = place < np.repeat(quota, got)
        return pa.Table.from_arrays([pa.array(tok[keep].astype(np.int64)), pa.array(cls[keep]), pa.array(n[keep]),
                                     pa.array(np.repeat(alone, got)[keep])], schema=_ENTRY)

    return shared.groupBy("bucket").applyInArrow(run, "tok long, cls long, n long, alone long")


def hub_pairs(docs: DataFrame, classes: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``cls, hub``: every list member with the hub of its list. Sizes that can link differ
    by a factor of 1.25 at most, so lists are cut into pairs of neighbouring size bands."""
    total = classes.agg(F.sum(F.floor(F.col("n") * 2 / 5) + 1)).first()[0] or 0
    n_buckets = max(MIN_BUCKETS, -(-int(total) // TOKENS_PER_BUCKET))
    entries = _list_entries(_count_shared(_prefix_blobs(docs, n_buckets, k), n_buckets))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25))).cast("int")
    entries = materialise(entries.select("tok", "cls", "n", "alone", band.alias("band")), "list-entries")
    # a band holds sizes within a factor of 1.25 (less rounding): linked sizes lie in the same or the next
    listed = entries.select(F.explode(F.array("band", F.col("band") - 1)).alias("band"), "tok", "cls", "alone")
    hubs = listed.groupBy("tok", "band").agg(F.min(F.struct("alone", "cls")).alias("h"), F.count(F.lit(1)).alias("m"))
    hubs = hubs.where("m > 1").select("tok", "band", F.col("h.cls").alias("hub"))
    pairs = listed.join(hubs, ["tok", "band"]).where(F.col("cls") != F.col("hub")).select("cls", "hub").distinct()
    return materialise(pairs, "hub-pairs")


def _segments(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """``cls, frag, n, seg``: the sets of all classes in ``pairs``, cut at fixed places of the
    global order. One document stands for each class; only those texts are read in full."""
    wanted = pairs.select("cls").union(pairs.select("hub")).distinct()
    reps = materialise(classes.join(wanted, "cls").groupBy("cls").agg(F.first("doc_id").alias("doc_id"))
                       .select("doc_id").distinct(), "class-documents")
    texts = _texts(docs)
    reps = broadcast_checked(reps.withColumnRenamed("doc_id", "_rep"))
    texts = texts.join(reps, texts["doc_id"].eqNullSafe(reps["_rep"]), "left_semi")

    def run(batches):
        cuts = [np.uint64((1 << 64) * i // FRAGMENTS) for i in range(1, FRAGMENTS)]
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, k)
                if len(s):
                    key = _class_key(s)
                    for f, part in enumerate(np.split(s, np.searchsorted(s, np.array(cuts, np.uint64)))):
                        rows.append((key, f, len(s), part.tobytes()))
            if rows:
                c = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()),
                                                  pa.array(c[2], pa.int64()), pa.array(c[3], pa.binary())],
                                                 names=["cls", "frag", "n", "seg"])

    segs = texts.mapInArrow(run, "cls long, frag int, n long, seg binary")
    return materialise(segs.dropDuplicates(["cls", "frag"]), "segments")


def partial_overlaps(pairs: DataFrame, segs: DataFrame) -> DataFrame:
    """Per pair and fragment: ``cls, hub, frag, n, hub_n, overlap``, the places of the hub's
    shingles that the class lacks (``lack``) and the class's own shingles (``own``)."""
    a = pairs.join(segs, "cls")
    h = segs.select(F.col("cls").alias("hub"), "frag", F.col("n").alias("hub_n"), F.col("seg").alias("hub_seg"))
    both = a.join(h, ["hub", "frag"]).select("cls", "hub", "frag", "n", "hub_n", "seg", "hub_seg")

    def run(batches):
        for b in batches:
            over, lack, own = [], [], []
            for x, y in zip(b.column(5).to_pylist(), b.column(6).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                at = np.searchsorted(y, x)
                hit = at < len(y)
                hit[hit] = y[at[hit]] == x[hit]
                missing = np.ones(len(y), bool)
                missing[at[hit]] = False
                over.append(int(hit.sum()))
                lack.append(np.flatnonzero(missing).astype("<u4").tobytes())
                own.append(x[~hit].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(5)] + [pa.array(over, pa.int64()), pa.array(lack, pa.binary()),
                                                   pa.array(own, pa.binary())],
                names=["cls", "hub", "frag", "n", "hub_n", "overlap", "lack", "own"])

    return both.mapInArrow(run, "cls long, hub long, frag int, n long, hub_n long, overlap long, lack binary, own binary")


def _linked(overlap, n, m):
    return 9 * overlap >= 4 * (n + m)


def _differences(t: pa.Table):
    """Of the members in ``t``: set sizes, overlaps with the hub, and as (key, member's index) the
    hub shingles that they lack (by fragment and place) and their own shingles."""
    lack, lack_at, own, own_at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for i, parts in enumerate(t.column("parts").to_pylist()):
        for p in parts or []:
            x, y = np.frombuffer(p["lack"], "<u4"), np.frombuffer(p["own"], np.uint64)
            lack.append(x.astype(np.uint64) | np.uint64(p["frag"] << 32))
            lack_at.append(np.full(len(x), i))
            own.append(y)
            own_at.append(np.full(len(y), i))
    return (t.column("n").to_numpy(), t.column("overlap").to_numpy(),
            (np.concatenate(lack), np.concatenate(lack_at)), (np.concatenate(own), np.concatenate(own_at)))


def _common(a, b, shape: tuple[int, int]) -> np.ndarray:
    """How many keys each row of ``a`` shares with each of ``b`` (both ``(keys, rows)``, a row's keys
    distinct). Only keys that both sides have take part, ``COLUMNS`` of them at a time."""
    out = np.zeros(shape, np.int64)
    shared = np.intersect1d(a[0], b[0])
    if not len(shared):
        return out
    sides = []
    for (keys, at), n in zip((a, b), shape):
        place = np.minimum(np.searchsorted(shared, keys), len(shared) - 1)
        hit = shared[place] == keys
        place, at = place[hit], at[hit]
        order = np.argsort(place, kind="stable")
        sides.append((place[order], at[order], n))
    for c in range(0, len(shared), COLUMNS):
        width, dense = min(COLUMNS, len(shared) - c), []
        for place, at, n in sides:
            s, e = np.searchsorted(place, [c, c + width])
            m = np.zeros((n, width), np.float32)
            m[at[s:e], place[s:e] - c] = 1
            dense.append(m)
        out += np.rint(dense[0] @ dense[1].T).astype(np.int64)
    return out


def _spanning(link: np.ndarray):
    """``i, j`` of a spanning forest of the linked rows and columns: what is joined stays joined,
    with at most rows + columns pairs."""
    rows, cols, out = np.ones(link.shape[0], bool), np.ones(link.shape[1], bool), []
    for seed in range(link.shape[0]):
        if not rows[seed]:
            continue
        rows[seed] = False
        front = np.array([seed])
        while len(front):
            free = np.flatnonzero(cols)
            part = link[np.ix_(front, free)]
            met = np.flatnonzero(part.any(0))
            new = free[met]
            out.append((front[part[:, met].argmax(0)], new))
            cols[new] = False
            left = np.flatnonzero(rows)
            part = link[np.ix_(left, new)]
            met = np.flatnonzero(part.any(1)) if len(new) else np.zeros(0, np.int64)
            front = left[met]
            out.append((front, new[part[met].argmax(1)] if len(met) else front))
            rows[front] = False
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (list(zip(*out)) or [[], []]))


def _block(t: pa.Table):
    """The two sides of a pair of blocks of one hub, and which of their members link."""
    side = t.column("far").to_numpy(zero_copy_only=False)
    a, b = t.filter(pa.array(side)), t.filter(pa.array(~side))
    na, oa, lack_a, own_a = _differences(a)
    nb, ob, lack_b, own_b = _differences(b)
    hub_n = t.column("hub_n")[0].as_py()
    shape = (a.num_rows, b.num_rows)
    # |A & B| = |hub| - |lack(A) | lack(B)| + |own(A) & own(B)|
    over = (hub_n - ((hub_n - oa)[:, None] + (hub_n - ob)[None, :] - _common(lack_a, lack_b, shape))
            + _common(own_a, own_b, shape))
    return a, b, _linked(over, na[:, None], nb[None, :])


def _block_links(t: pa.Table) -> pa.Table:
    """Links that join up all linked members of one pair of blocks of one hub."""
    a, b, link = _block(t)
    i, j = _spanning(link)
    src, dst = a.column("cls").to_numpy()[i], b.column("cls").to_numpy()[j]
    keep = src != dst
    return pa.table({"src": pa.array(src[keep], pa.int64()), "dst": pa.array(dst[keep], pa.int64())})


def _block_counts(t: pa.Table) -> pa.Table:
    """Per member of the first side, the rows of the members it links with on the other; a pair
    counts at the least hub that both have."""
    a, b, link = _block(t)
    hub = t.column("hub")[0].as_py()
    lower = []
    for side in (a, b):
        keys = [[h for h in hubs if h < hub] for hubs in side.column("hubs").to_pylist()]
        lower.append((np.array([h for x in keys for h in x], np.int64), np.repeat(np.arange(len(keys)), [len(x) for x in keys])))
    ca, cb = a.column("cls").to_numpy(), b.column("cls").to_numpy()
    link &= (_common(*lower, link.shape) == 0) & (ca[:, None] != cb[None, :])
    return pa.table({"cls": pa.array(ca, pa.int64()), "linked": pa.array(link @ b.column("times").to_numpy(), pa.int64())})


def _difference_bytes():
    return F.octet_length("lack") + F.octet_length("own")


def _cuts(count, size, block: int):
    """Into how many blocks members are dealt: at most about ``block`` members and ``BLOCK_BYTES`` each."""
    return F.greatest(F.ceil(count / block), F.ceil(size / F.lit(BLOCK_BYTES))).cast("int")


def _pair_up(first: DataFrame, other: DataFrame, side: list[str]) -> DataFrame:
    """Blocks of ``first`` against blocks of ``other``, of each hub; ``far`` marks the first side."""
    def deal(n):
        return F.pmod(F.xxhash64("cls"), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    rows = first.select(*side, deal("rows").alias("i"), every("cols").alias("j"), F.lit(True).alias("far"))
    cols = other.select(*side, every("rows").alias("i"), deal("cols").alias("j"), F.lit(False).alias("far"))
    return rows.unionByName(cols)


def class_links(docs: DataFrame, classes: DataFrame, k: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """``src, dst`` of links that join up all linked classes (links within a hub's linked members,
    or within a block, add nothing to a component and are left out; ``link_counts`` counts them)."""
    pairs = hub_pairs(docs, classes, k)
    segs = _segments(docs, classes, pairs, k)
    parts = materialise(partial_overlaps(pairs, segs), "partial-overlaps")
    scored = parts.groupBy("cls", "hub", "n", "hub_n").agg(F.sum("overlap").alias("overlap"), F.sum(_difference_bytes()).alias("size"))
    scored = materialise(scored.withColumn("far", ~_linked(F.col("overlap"), F.col("n"), F.col("hub_n"))), "hub-overlaps")
    near = scored.where(~F.col("far")).select(F.col("cls").alias("src"), F.col("hub").alias("dst"))
    # groups with far members: blocks of far members against blocks of all members
    groups = scored.groupBy("hub").agg(
        F.count(F.when(F.col("far"), 1)).alias("n_far"), F.count(F.lit(1)).alias("n_all"),
        F.sum(F.when(F.col("far"), F.col("size"))).alias("b_far"), F.sum("size").alias("b_all"))
    groups = materialise(groups.where("n_far > 0 and n_all > 1").select(
        "hub", _cuts(F.col("n_far"), F.col("b_far"), block).alias("rows"),
        _cuts(F.col("n_all"), F.col("b_all"), block).alias("cols")), "hub-groups")
    members = parts.join(broadcast_checked(groups), "hub").groupBy("cls", "hub", "n", "hub_n", "rows", "cols").agg(
        F.sum("overlap").alias("overlap"), F.collect_list(F.struct("frag", "lack", "own")).alias("parts"))
    members = members.withColumn("is_far", ~_linked(F.col("overlap"), F.col("n"), F.col("hub_n")))
    members = materialise(members, "hub-members")
    side = ["cls", "hub", "n", "hub_n", "overlap", "parts"]
    far = _pair_up(members.where("is_far"), members, side).groupBy("hub", "i", "j").applyInArrow(
        _block_links, "src long, dst long")
    return materialise(near.unionByName(far), "class-links")


def link_counts(docs: DataFrame, k: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: ``doc_id, class_id, n_links``, the number of other rows that it links with.

    Every pair of members of a hub is compared, in blocks and on their differences from it, so the
    work grows with the squares of group sizes; no pair leaves its block. Rows with equal sets link;
    rows without shingles have no links.
    """
    classes = class_table(docs, k)
    pairs = hub_pairs(docs, classes, k)
    parts = materialise(partial_overlaps(pairs, _segments(docs, classes, pairs, k)), "partial-overlaps")
    members = parts.groupBy("cls", "hub", "n", "hub_n").agg(
        F.sum("overlap").alias("overlap"), F.sum(_difference_bytes()).alias("size"),
        F.collect_list(F.struct("frag", "lack", "own")).alias("parts"))
    hub = members.groupBy("hub").agg(F.first("hub_n").alias("n"))
    members = materialise(members.unionByName(hub.select(
        F.col("hub").alias("cls"), "hub", "n", F.col("n").alias("hub_n"), F.col("n").alias("overlap"),
        F.lit(0).cast("long").alias("size")), allowMissingColumns=True), "hub-members")
    groups = members.groupBy("hub").agg(_cuts(F.count(F.lit(1)), F.sum("size"), block).alias("rows"))
    groups = materialise(groups.withColumn("cols", F.col("rows")), "hub-groups")
    of_class = classes.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("times"))
    of_class = materialise(of_class, "class-rows")
    hubs = members.groupBy("cls").agg(F.sort_array(F.collect_set("hub")).alias("hubs"))  # bounded by a class's list entries
    full = members.join(broadcast_checked(groups), "hub").join(hubs, "cls").join(of_class, "cls")
    full = materialise(full, "counted-members")
    side = ["cls", "hub", "n", "hub_n", "overlap", "parts", "hubs", "times"]
    linked = _pair_up(full, full, side).groupBy("hub", "i", "j").applyInArrow(_block_counts, "cls long, linked long")
    linked = linked.groupBy("cls").agg(F.sum("linked").alias("linked"))
    per_class = materialise(of_class.join(linked, "cls", "left").select(
        "cls", "class_id", (F.col("times") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "link-counts")
    return classes.select("doc_id", "cls").join(per_class, "cls", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` (the smallest node reachable) by large-star and small-star steps."""
    def both(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def large(e: DataFrame) -> DataFrame:
        b = both(e)
        least = b.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return b.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        j = down.join(least, "u")
        return (j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(least.select("u", F.col("m").alias("v"))))

    def fingerprint(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialise(links.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                        .where("u <> v").distinct(), "edges")
    before = fingerprint(edges)
    for _ in range(max_rounds):
        edges = materialise(small(large(edges).where("u <> v").distinct()).where("u <> v").distinct(), "edges")
        now = fingerprint(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_components(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, class_id`` (smallest id with an equal set)
    and ``component_id`` (smallest id reachable by links)."""
    classes = class_table(docs, k)
    roots = components(class_links(docs, classes, k))
    per_class = classes.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("class_id"))
    per_class = materialise(per_class.join(roots, F.col("cls") == F.col("node"), "left").select(
        "cls", "class_id", F.coalesce("root", "cls").alias("root")), "class-roots")
    ids = per_class.groupBy("root").agg(F.min("class_id").alias("component_id"))
    per_class = per_class.join(ids, "root").select("cls", "class_id", "component_id")
    return (classes.join(per_class, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id")))


def one_per_component(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component: the smallest id's (nulls last; ties by the text's
    hash; of equal rows any one). Rows without shingles all stay."""
    classes = class_table(docs, k)
    roots = components(class_links(docs, classes, k))
    rows = classes.where("cls is not null").join(roots, F.col("cls") == F.col("node"), "left").select(
        "doc_id", "th", F.coalesce("root", "cls").alias("root"))
    rows = materialise(rows.groupBy("root", "doc_id", "th").agg(F.count(F.lit(1)).alias("times")), "component-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "th")
    first = rows.groupBy("root").agg(F.min(order).alias("f"))
    stay = F.col("f.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("f.th") == F.col("th"))
    judged = rows.join(first, "root").select("doc_id", "th", "times", stay.alias("stay"))
    kept = without(docs, judged.where("not stay"))
    twice = materialise(judged.where("stay and times > 1").select("doc_id", "th"), "equal-rows")
    if twice.isEmpty():
        return kept
    row_id, row_th = fresh_name(docs, "_row_id"), fresh_name(docs, "_row_th")
    key = {row_id: F.col("doc_id").cast("long"), row_th: F.xxhash64(F.col("text").cast("string"))}
    keyed, same = docs.withColumns(key), broadcast_checked(twice.toDF("_eq_id", "_eq_th"))
    equal = keyed.join(same, keyed[row_id].eqNullSafe(same["_eq_id"]) & (keyed[row_th] == same["_eq_th"]), "left_semi")
    equal = equal.dropDuplicates([row_id, row_th]).drop(row_id, row_th)
    return without(kept, twice).unionByName(equal)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))
