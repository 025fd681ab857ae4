"""Operator 11 against brute force and SQL."""
import math

import numpy as np
import pytest
from conftest import SF_SMALL

from topiclake.llm import mtree
from topiclake.llm.common import materialise

from .helpers import rows_of

SCHEMA = "vec_id long, embedding array<double>, label int, score long, z string, row long"


def brute(rows, k=5, step=50):
    z = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
         if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, qz) in enumerate(z):
        if q is None or q % step:
            continue
        found = sorted((-sum(x * y for x, y in zip(qz, cz)), c is None, c or 0) for b, (c, cz) in enumerate(z) if b != a)
        out += [(q, r + 1, None if null else c, -s) for r, (s, null, c) in enumerate(found[:k])]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v if v is None else [x if x is None else float(x) for x in v], 1, 7, "x", 3) for i, v in rows], SCHEMA).repartition(3)
    built = mtree.build_index(materialise(mtree.integer_vectors(df), "vectors"), **kw)
    return sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in mtree.top_k(*built).collect()], key=str)


def clustered(rng, n, dim=8, groups=12):
    centers = rng.normal(0, 1, (groups, dim))
    return (centers[rng.integers(0, groups, n)] + rng.normal(0, 0.03, (n, dim))).tolist()


def test_clusters_copies_and_ties(spark):
    rng = np.random.default_rng(5)
    v = clustered(rng, 900)
    v[300:600] = [v[300]] * 300  # a third of all rows are copies
    rows = list(enumerate(v))
    assert run(spark, rows, tree_rows=200) == brute(rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(0, 1, 4).tolist()) for k in range(60)]
    rows += [(100, None), (150, [1.0, None, 2.0, 0.0]), (200, [1.0, math.nan, 0.0, 0.0]), (250, [math.inf, 0, 0, 0.0]),
             (300, []), (350, [0.5]), (400, [0.1, -0.2, 0.3, 0.4, 9.0, -9.0]), (None, [3.0, 3.0, 3.0, 3.0]),
             (None, [3.0, 3.0, 3.0, 3.0]), (450, [1.0, 1.0, 1.0, 1.0]), (450, [1.0, 1.0, 1.0, 1.0]),
             (500, [2000.0, -3000.0, 1e6, 5.0]), (-50, [0.0, 0.0, 0.0, 0.0])]
    assert run(spark, rows, tree_rows=16) == brute(rows)
    few = [(0, [1.0, 2.0]), (50, [0.0, 1.0]), (7, [5.0, -1.0])]
    assert run(spark, few) == brute(few)
    assert run(spark, [(0, [1.0])]) == []


def test_wide_components_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(k * 25, [float(x) for x in rng.integers(-2**20, 2**20, 3)]) for k in range(40)]
    assert run(spark, rows, tree_rows=10) == brute(rows)
    with pytest.raises(Exception, match="52 bits"):
        run(spark, [(0, [1e200]), (1, [1.0])])


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mtree.build_index(materialise(mtree.integer_vectors(df), "vectors")) is None


def test_bounds_avoid_computations():
    rng = np.random.default_rng(7)
    z = np.floor(256 * np.array(clustered(rng, 4000, groups=40))).astype(np.float64)
    ids = np.arange(len(z))
    trees = []
    cell = mtree._distance(z, z[:40]).argmin(axis=1)
    for c in range(40):
        part = np.flatnonzero(cell == c)
        if len(part):
            t = mtree.build_tree(z[part], ids[part], ids[part], leaf_rows=16)
            trees.append({"z": mtree._pack(t["z"], False), "wide": False, "n": len(part), "root_z": mtree._pack(t["root_z"], False),
                          **{c: t[c].tobytes() for c in ("ids", "rows", "entry_pd", "leaf_end", "leaf_at", "leaf_radius", "leaf_pd")},
                          "radius": t["radius"], "norm2": t["norm2"]})
    q = ids[::50]
    spent = {}
    best = mtree.search_trees(trees, z[q], q, q, np.full(len(q), -(1 << 62)), 5, spent)
    s = z[q] @ z.T
    s[np.arange(len(q)), q] = -np.inf
    want = [[(int(-a), int(b)) for a, b in sorted((-x, i) for i, x in enumerate(r))[:5]] for r in s]
    assert [list(zip(a, b)) for a, b in zip(best.score.tolist(), best.id.tolist())] == want
    assert spent["scored"] < 0.25 * len(q) * len(z)


def test_given_table_equals_sql(spark, duck):
    got = mtree.op11_top_k(spark, SF_SMALL).toPandas()
    want = duck(mtree.OP11_SQL, embeddings=f"{SF_SMALL}/embeddings.parquet")
    cols = ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got, cols) == rows_of(want, cols) and len(got) > 0
