"""Operator 11: exact top-k by inner product, best-first over paged M-trees.

Vectors become integers ``floor(scale * x)``; a score is their integer inner product. The
metric of the trees is the Euclidean distance ``d`` of the integer vectors, which bounds a
score both ways: ``2 <q, z> = |q|^2 + |z|^2 - d(q, z)^2``, so a lower bound on a distance is
an upper bound on a score, and objects of a node that cannot reach a query's k-th best score
are never computed.

1. **Index.** Routing objects are chosen from a bounded sample (``PIVOT_SAMPLE`` rows expected;
   every row is indexed). Rows are dealt by ranges of (nearest routing object, distance to it,
   id), and each task cuts its sorted rows into trees of at most ``TREE_ROWS``. A tree has one
   root page of leaf nodes; a node keeps its routing object, its covering radius and the
   distance to its parent, a leaf entry keeps the distance to its leaf's routing object.
2. **Thresholds.** A query is itself an indexed row; its k-th best score inside its own tree
   bounds its answer from below before it travels.
3. **Routing.** Blocks of queries meet the directory (root objects and radii of a group of
   trees); a query goes only to groups with a tree whose bound reaches its threshold.
4. **Search.** A task holds one group of trees and one block of queries. Trees, then leaves,
   are visited best bound first; bounds use the stored parent distance, then the computed
   distance to the routing object; the entries of a leaf are sorted by parent distance, and
   only the window of them that the triangle inequality leaves open is scored. The k best of
   every group are merged at the end.

Defined results: a row whose vector is null or holds a null or a non-finite component takes no
part; an empty vector scores 0; vectors of different lengths are compared as if the shorter
went on with zeros; a null id is never a query, and as a candidate ranks after all ids of its
score; of repeated rows each is a candidate of its own, and a query row misses only itself;
an empty table gives no rows; other columns are ignored. Components over 2^52 after scaling and
scores beyond 64 bits raise an error. Arithmetic is exact: 32-bit floats where every partial sum
stays under 2^24, 64-bit floats under 2^53, else 64-bit integers.

Scale: a copied vector that holds a third of all rows is dealt by id like any range; groups of
trees and blocks of queries have bounded bytes (``GROUP_BYTES``, ``BLOCK_BYTES``), and work is
a grid of both. The number of pairs grows with queries times rows where no bound excludes
them: near-isotropic vectors leave little to prune, and then the search is a blocked scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import broadcast_checked, materialise, prepare, table

K = 5
SCALE = 256
TREE_ROWS = 4096
LEAF_ROWS = 128
PIVOT_SAMPLE = 4096
MAX_PIVOTS = 256
GROUP_BYTES = 64 << 20
BLOCK_BYTES = 32 << 20
_NO_ID = (1 << 63) - 1  # stands for a null id inside tasks
_LOWEST = -(1 << 63)
_VECTORS = "row long, vec_id long, is_query boolean, z binary, wide boolean, norm2 double"
_TREES = ("tree long, grp int, n int, wide boolean, z binary, ids binary, rows binary, entry_pd binary, "
          "leaf_end binary, leaf_at binary, leaf_radius binary, leaf_pd binary, root_z binary, radius double, "
          "norm2 double, q_n int, q_z binary, q_ids binary, q_rows binary, q_floor binary")
_BLOCKS = "grp int, part int, wide boolean, q_n int, q_z binary, q_ids binary, q_rows binary, q_floor binary"
_FOUND = "query_row long, query_id long, vec_id long, score long, row long"


def _pack(z: np.ndarray, wide: bool) -> bytes:
    return np.ascontiguousarray(z, dtype="<i8" if wide else "<i2").tobytes()


def _unpack(data: bytes, wide: bool, n: int) -> np.ndarray:
    """``n`` vectors of equal length as float64 (wide components as int64)."""
    a = np.frombuffer(data, "<i8" if wide else "<i2").reshape(n, -1 if n else 0)
    return a if wide else a.astype(np.float64)


def _stack(parts, wides, dim: int) -> np.ndarray:
    """Single vectors of any lengths as rows of one matrix, padded with zeros."""
    out = np.zeros((len(parts), dim), np.int64 if any(wides) else np.float64)
    for k, (p, w) in enumerate(zip(parts, wides)):
        v = np.frombuffer(p, "<i8" if w else "<i2")
        out[k, :len(v)] = v
    return out


def _norm2(z: np.ndarray) -> np.ndarray:
    f = z.astype(np.float64)
    return np.einsum("ij,ij->i", f, f)


def _product(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Exact inner products of rows, given ``limit >= |a_i| * |b_j|``."""
    if limit < 1 << 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if limit < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if limit >= 2.0 ** 63:
        raise ValueError("inner products exceed 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows (float64)."""
    fa, fb = a.astype(np.float64), b.astype(np.float64)
    d2 = _norm2(fa)[:, None] + _norm2(fb)[None, :] - 2 * (fa @ fb.T)
    return np.sqrt(np.maximum(d2, 0))


def _ceiling(q_norm2, norm2, least):
    """The highest score at a distance of at least ``least``, with room for rounding."""
    top = (q_norm2 + norm2 - np.maximum(least, 0) ** 2) / 2
    top = np.minimum(top, np.sqrt(q_norm2 * norm2))
    return top + 1e-7 * (q_norm2 + norm2) + 0.25


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
                    query_step: int = 50) -> DataFrame:
    """``row, vec_id, is_query, z, wide, norm2`` of the rows that take part."""
    prepare(df.sparkSession)

    def convert(batches):
        for b in batches:
            row, ids, vec = b.column(0), b.column(1), b.column(2)
            present = np.flatnonzero(~np.asarray(vec.is_null()))
            vec = vec.take(pa.array(present))
            n = np.asarray(vec.value_lengths(), dtype=np.int64)
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            end = np.cumsum(n)
            start = end - n
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            z = np.floor(scale * np.where(np.isfinite(flat), flat, 0))
            if np.abs(z).max(initial=0) > 1 << 52:
                raise ValueError("components exceed 52 bits")
            out = []
            for k in np.flatnonzero(bad[end] == bad[start]).tolist():
                v, at = z[start[k]:end[k]], int(present[k])
                vec_id = ids[at].as_py()
                if vec_id == _NO_ID:
                    raise ValueError("the largest 64-bit id is taken")
                wide = bool(np.abs(v).max(initial=0) > 32767)
                out.append((row[at].as_py(), vec_id, vec_id is not None and vec_id % query_step == 0,
                            _pack(v, wide), wide, float(v @ v)))
            if out:
                types = [pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.bool_(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["row", "vec_id", "is_query", "z", "wide", "norm2"])

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                     F.col(vector_col).alias("embedding"))
    return rows.mapInArrow(convert, _VECTORS)


def routing_objects(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of the sample, each drawn with odds of its squared distance to those before."""
    rng = np.random.default_rng(11)
    if not len(sample):
        return sample
    chosen = [int(rng.integers(len(sample)))]
    best = _distance(sample, sample[chosen])[:, 0] ** 2
    while len(chosen) < count and best.max() > 0:
        k = int(rng.choice(len(sample), p=best / best.sum()))
        chosen.append(k)
        best = np.minimum(best, _distance(sample, sample[[k]])[:, 0] ** 2)
    return sample[chosen]


def _leaves(z: np.ndarray, cap: int) -> list[np.ndarray]:
    """Parts of at most ``cap`` rows: a part is split between two of its far objects, each row to
    the nearer; rows that do not tell apart are cut in their order."""
    todo, done = [np.arange(len(z))], []
    while todo:
        part = todo.pop()
        if len(part) <= cap:
            done.append(part)
            continue
        p = z[part]
        a = int(np.argmax(_distance(p, p[:1])[:, 0]))
        from_a = _distance(p, p[a:a + 1])[:, 0]
        from_b = _distance(p, p[int(np.argmax(from_a))][None])[:, 0]
        near = from_a - from_b
        if from_a.max() == 0:
            left = np.arange(len(part)) < len(part) // 2
        else:  # the halves are balanced, so pages are well filled
            order = np.argsort(near, kind="stable")
            left = np.zeros(len(part), bool)
            left[order[:len(part) // 2]] = True
        todo += [part[~left], part[left]]
    return done


def build_tree(z: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict:
    """The pages of one tree as arrays; entries are ordered by leaf, then by parent distance."""
    root = z[int(np.argmin(_distance(z, z.astype(np.float64).mean(axis=0)[None])[:, 0]))]
    order, entry_pd, ends, at, radius, leaf_pd = [], [], [], [], [], []
    n = 0
    for part in _leaves(z, leaf_rows):
        p = z[part]
        center = int(np.argmin(_distance(p, p.astype(np.float64).mean(axis=0)[None])[:, 0]))
        d = _distance(p, p[center:center + 1])[:, 0]
        d[center] = 0.0
        inner = np.lexsort((ids[part], d))
        order.append(part[inner])
        entry_pd.append(d[inner])
        at.append(n + int(np.flatnonzero(inner == center)[0]))
        n += len(part)
        ends.append(n)
        radius.append(d.max())
        leaf_pd.append(_distance(p[center:center + 1], root[None])[0, 0])
    order = np.concatenate(order)
    return {"z": z[order], "ids": ids[order], "rows": rows[order], "order": order,
            "entry_pd": np.concatenate(entry_pd), "leaf_end": np.array(ends, np.int32),
            "leaf_at": np.array(at, np.int32), "leaf_radius": np.array(radius), "leaf_pd": np.array(leaf_pd),
            "root_z": root, "radius": float(_distance(z, root[None]).max()), "norm2": float(_norm2(z).max())}


def build_index(vectors: DataFrame, k: int = K, tree_rows: int = TREE_ROWS) -> tuple[DataFrame, int] | None:
    """The written trees over ``integer_vectors`` (materialised) and the vectors' length; None
    without rows. Queries of a tree ride along with the floor of their k-th best score."""
    spark = vectors.sparkSession
    s = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("z") / F.when(F.col("wide"), 8).otherwise(2))
                    .cast("int").alias("dim"), F.max("wide").alias("wide")).first()
    if not s.n:
        return None
    dim, n, width = s.dim, s.n, (8 if s.wide else 2) * s.dim + 24
    share = min(1.0, PIVOT_SAMPLE / n)
    drawn = vectors.where(F.pmod(F.xxhash64("row"), F.lit(1 << 32)) < int(share * (1 << 32))).select("z", "wide").collect()
    pivots = routing_objects(_stack([r.z for r in drawn], [r.wide for r in drawn], dim),
                             max(1, min(MAX_PIVOTS, n // tree_rows)))

    def nearest(batches):
        for b in batches:
            if not b.num_rows:
                continue
            z = _stack(b.column(3).to_pylist(), b.column(4).to_pylist(), dim)
            d = _distance(z, pivots) if len(pivots) else np.zeros((len(z), 1))
            cell = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(z)), cell])],
                names=[*b.schema.names, "cell", "dist"])

    def build(batches):
        grp, seq, held, count, cell = TaskContext.get().partitionId(), 0, [], 0, None

        def tree(parts):
            nonlocal seq
            b = pa.Table.from_batches(parts).combine_chunks()
            z = _stack(b["z"].to_pylist(), b["wide"].to_pylist(), dim)
            wide = z.dtype == np.int64
            ids = b["vec_id"].fill_null(_NO_ID).to_numpy()
            t = build_tree(z, ids, b["row"].to_numpy())
            q = np.flatnonzero(b["is_query"].to_numpy(zero_copy_only=False)[t["order"]])
            floor = np.full(len(q), _LOWEST, np.int64)
            if len(q) and len(z) > k:
                scores = _product(t["z"][q], t["z"], t["norm2"])
                if scores.dtype != np.int64:  # whole numbers under 2^53
                    scores = scores.astype(np.int64)
                scores[np.arange(len(q)), q] = _LOWEST
                floor = np.partition(scores, len(z) - k, axis=1)[:, len(z) - k]
            row = [grp << 32 | seq, grp, len(z), wide, _pack(t["z"], wide), t["ids"].tobytes(), t["rows"].tobytes(),
                   t["entry_pd"].tobytes(), t["leaf_end"].tobytes(), t["leaf_at"].tobytes(),
                   t["leaf_radius"].tobytes(), t["leaf_pd"].tobytes(), _pack(t["root_z"], wide), t["radius"],
                   t["norm2"], len(q), _pack(t["z"][q], wide), t["ids"][q].tobytes(), t["rows"][q].tobytes(),
                   floor.tobytes()]
            seq += 1
            return pa.RecordBatch.from_arrays([pa.array([v], ty) for v, ty in zip(row, types)], names=names)

        names = [c.split()[0] for c in _TREES.split(", ")]
        of = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
        types = [of[c.split()[1]] for c in _TREES.split(", ")]
        for b in batches:
            at = 0
            cells = b.column(b.schema.get_field_index("cell")).to_numpy()
            while at < b.num_rows:
                if cell is not None and cells[at] != cell and count >= tree_rows // 4:
                    yield tree(held)
                    held, count = [], 0
                cell = cells[at]
                change = np.flatnonzero(cells[at:] != cell)
                take = min(tree_rows - count, int(change[0]) if len(change) else b.num_rows - at)
                held.append(b.slice(at, take))
                count, at = count + take, at + take
                if count >= tree_rows:
                    yield tree(held)
                    held, count, cell = [], 0, None
        if held:
            yield tree(held)

    cores = spark.sparkContext.defaultParallelism
    parts = max(min(-(-n // tree_rows), 3 * cores), -(-n * width // GROUP_BYTES))
    dealt = (vectors.mapInArrow(nearest, _VECTORS + ", cell int, dist double")
             .repartitionByRange(parts, "cell", "dist", "vec_id", "row")
             .sortWithinPartitions("cell", "dist", "vec_id", "row"))
    return materialise(dealt.mapInArrow(build, _TREES), "mtree"), dim


class _Best:
    """The ``k`` best (score, id, row) of every query so far, ties to smaller ids."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k = k
        self.score = np.full((n, k), _LOWEST, np.int64)
        self.id = np.full((n, k), _NO_ID, np.int64)
        self.row = np.full((n, k), -1, np.int64)
        self.floor = floor.copy()

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        touched = np.unique(q)
        place = np.searchsorted(touched, q)
        k = self.k
        own = np.repeat(np.arange(len(touched)), k)
        q2 = np.concatenate([own, place])
        s2 = np.concatenate([self.score[touched].ravel(), score])
        i2 = np.concatenate([self.id[touched].ravel(), ids])
        r2 = np.concatenate([self.row[touched].ravel(), rows])
        order = np.lexsort((r2, i2, -np.maximum(s2, _LOWEST + 1), q2))
        q2 = q2[order]
        first = np.searchsorted(q2, np.arange(len(touched)))
        keep = order[(first[:, None] + np.arange(k)).ravel()]
        self.score[touched] = s2[keep].reshape(-1, k)
        self.id[touched] = i2[keep].reshape(-1, k)
        self.row[touched] = r2[keep].reshape(-1, k)
        self.floor[touched] = np.maximum(self.floor[touched], self.score[touched, k - 1])


def _visit(tree: dict, q: np.ndarray, q2: np.ndarray, q_rows: np.ndarray, active: np.ndarray, root_d: np.ndarray,
           best: _Best, spent: dict) -> None:
    """Best-first over the leaves of one tree for the queries ``active``."""
    z, end, norm2 = tree["z"], tree["leaf_end"], tree["norm2"]
    start = np.concatenate([[0], end[:-1]])
    # bounds from the stored parent distances alone
    least = np.abs(root_d[active][:, None] - tree["leaf_pd"][None, :]) - tree["leaf_radius"][None, :]
    reach = _ceiling(q2[active][:, None], norm2, least) >= best.floor[active][:, None]
    leaves = np.flatnonzero(reach.any(axis=0))
    spent["nodes"] += reach.size
    spent["routing"] += int(reach[:, leaves].shape[0] * len(leaves))
    if not len(leaves):
        return
    d = _distance(q[active], z[tree["leaf_at"][leaves]])
    top = np.where(reach[:, leaves], _ceiling(q2[active][:, None], norm2, d - tree["leaf_radius"][leaves][None, :]), -np.inf)
    for j in np.argsort(-top.max(axis=0), kind="stable").tolist():
        floor = best.floor[active]
        on = np.flatnonzero(top[:, j] >= floor)
        if not len(on):
            continue
        a, b = int(start[leaves[j]]), int(end[leaves[j]])
        who = active[on]
        # an entry can reach the floor only within this distance of the query
        far = np.sqrt(np.maximum(q2[who] + norm2 - 2 * np.maximum(floor[on].astype(np.float64), -norm2 - q2[who]), 0)) + 1e-6
        far += 1e-7 * np.sqrt(q2[who] + norm2)
        lo = a + int(np.searchsorted(tree["entry_pd"][a:b], (d[on, j] - far).min(), "left"))
        hi = a + int(np.searchsorted(tree["entry_pd"][a:b], (d[on, j] + far).max(), "right"))
        if lo >= hi:
            continue
        spent["scored"] += len(who) * (hi - lo)
        scores = _product(q[who], z[lo:hi], float(np.sqrt(q2[who].max(initial=0) * norm2)) + 1)
        if scores.dtype == np.float32:  # floors above are whole and small, or lower than any score
            hit = scores >= np.maximum(floor[on], -(1 << 24)).astype(np.float32)[:, None]
        else:
            hit = scores >= floor[on].astype(scores.dtype)[:, None]
        if hit.sum() > 4 * len(who):  # many ties: only smaller ids than the k-th best matter
            full = best.score[who, -1] == floor[on]
            tied = scores.astype(np.int64) == floor[on][:, None]
            hit &= ~(tied & full[:, None] & (tree["ids"][lo:hi][None, :] > best.id[who, -1][:, None]))
        x, y = np.nonzero(hit)
        other = tree["rows"][lo + y] != q_rows[who[x]]
        x, y = x[other], y[other]
        if len(x):
            best.add(who[x], scores[x, y].astype(np.int64), tree["ids"][lo + y], tree["rows"][lo + y])


def _read_tree(r: dict) -> dict:
    return {"z": _unpack(r["z"], r["wide"], r["n"]), "ids": np.frombuffer(r["ids"], "<i8"),
            "rows": np.frombuffer(r["rows"], "<i8"), "entry_pd": np.frombuffer(r["entry_pd"]),
            "leaf_end": np.frombuffer(r["leaf_end"], "<i4"), "leaf_at": np.frombuffer(r["leaf_at"], "<i4"),
            "leaf_radius": np.frombuffer(r["leaf_radius"]), "leaf_pd": np.frombuffer(r["leaf_pd"]),
            "norm2": r["norm2"]}


def search_trees(trees: list[dict], q: np.ndarray, q_ids: np.ndarray, q_rows: np.ndarray, floor: np.ndarray,
                 k: int = K, spent: dict | None = None) -> _Best:
    """Best-first over trees (rows of the index) for one block of queries."""
    spent = spent if spent is not None else {}
    for name in ("nodes", "routing", "scored"):
        spent.setdefault(name, 0)
    best = _Best(len(q), k, floor)
    q2 = _norm2(q)
    roots = _stack([t["root_z"] for t in trees], [t["wide"] for t in trees], q.shape[1])
    d = _distance(q, roots)
    radius, norm2 = np.array([t["radius"] for t in trees]), np.array([t["norm2"] for t in trees])
    top = _ceiling(q2[:, None], norm2[None, :], d - radius[None, :])
    for t in np.argsort(-top.max(axis=0, initial=0), kind="stable").tolist():
        active = np.flatnonzero(top[:, t] >= best.floor)
        if len(active):
            _visit(_read_tree(trees[t]), q, q2, q_rows, active, d[:, t], best, spent)
    return best


def top_k(index: DataFrame, dim: int, k: int = K) -> DataFrame:
    """``query_row, query_id, rank, vec_id, score`` of every indexed query row."""
    spark = index.sparkSession
    size = index.agg(F.max("grp").alias("g"), F.sum("q_n").alias("q")).first()
    blocks = max(1, -(-size.q * (8 * dim + 32) // BLOCK_BYTES))
    pages = materialise(index.groupBy("grp").agg(F.collect_list(F.struct("root_z", "wide", "radius", "norm2")).alias("roots")),
                        "mtree-directory")
    asked = (index.where("q_n > 0").select(
        F.explode(F.sequence(F.lit(0), F.lit(size.g))).alias("grp"),
        F.pmod(F.xxhash64("tree"), F.lit(blocks)).cast("int").alias("part"), F.col("wide").alias("q_wide"),
        "q_n", "q_z", "q_ids", "q_rows", "q_floor").join(broadcast_checked(pages), "grp"))

    def route(batches):
        for b in batches:
            out = []
            for r in b.to_pylist():
                q = _unpack(r["q_z"], r["q_wide"], r["q_n"])
                floor = np.frombuffer(r["q_floor"], "<i8")
                roots = r["roots"]
                d = _distance(q, _stack([x["root_z"] for x in roots], [x["wide"] for x in roots], q.shape[1]))
                top = _ceiling(_norm2(q)[:, None], np.array([x["norm2"] for x in roots])[None, :],
                               d - np.array([x["radius"] for x in roots])[None, :])
                on = np.flatnonzero((top >= floor[:, None]).any(axis=1))
                if len(on):
                    out.append((r["grp"], r["part"], r["q_wide"], len(on), _pack(q[on], r["q_wide"]),
                                np.frombuffer(r["q_ids"], "<i8")[on].tobytes(),
                                np.frombuffer(r["q_rows"], "<i8")[on].tobytes(), floor[on].tobytes()))
            if out:
                types = [pa.int32(), pa.int32(), pa.bool_(), pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["grp", "part", "wide", "q_n", "q_z", "q_ids", "q_rows", "q_floor"])

    def search(queries: pa.Table, trees: pa.Table) -> pa.Table:
        rows = queries.to_pylist()
        names = ["query_row", "query_id", "vec_id", "score", "row"]
        if not rows or not trees.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        q = np.concatenate([_unpack(r["q_z"], r["wide"], r["q_n"]) for r in rows])
        ids, at, floor = (np.concatenate([np.frombuffer(r[c], "<i8") for r in rows]) for c in ("q_ids", "q_rows", "q_floor"))
        best = search_trees(trees.to_pylist(), q, ids, at, floor, k)
        x, y = np.nonzero(best.row >= 0)
        found = best.id[x, y]
        return pa.table({"query_row": at[x], "query_id": ids[x], "vec_id": pa.array(found, mask=found == _NO_ID),
                         "score": best.score[x, y], "row": best.row[x, y]})

    held = index.select(*[c.split()[0] for c in _TREES.split(", ") if not c.startswith("q_")],
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part"))
    found = (asked.mapInArrow(route, _BLOCKS).groupBy("grp", "part")
             .cogroup(held.groupBy("grp", "part")).applyInArrow(search, _FOUND))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    return (found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_row", "query_id", "rank", "vec_id", "score"))


_RESULT = "query_id long, rank int, vec_id long, score long"


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialise(integer_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    built = build_index(vectors)
    if built is None:
        return spark.createDataFrame([], _RESULT)
    return top_k(*built).select("query_id", "rank", "vec_id", "score")


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rn, vec_id,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rn, q.vec_id AS query_id, c.vec_id, c.rn AS c_rn,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(q.z), len(c.z)) + 1), lambda i: q.z[i] * c.z[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON c.rn <> q.rn
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id ASC NULLS LAST, c_rn) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
