"""Operator 5 against a brute-force join of word-shingle sets."""
import itertools

import pytest
from conftest import SF_SMALL

from topiclake.llm import near_join


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """Component id of each row: smallest non-null id reachable by links."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and min(len(x), len(y)) * 5 >= 4 * max(len(x), len(y)) and \
                100 * len(x & y) >= 80 * len(x | y):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), i if not s else least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def ours(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_odd_rows(odd_docs, odd_rows):
    got = ours(near_join.near_components(odd_docs))
    assert got == sorted(brute([r[:2] for r in odd_rows]), key=str)
    assert sum(1 for r in got if r[2] == 7) > 15


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert ours(near_join.near_components(docs)) == sorted(brute(rows), key=str)


@pytest.mark.parametrize("block", [3, 512])
def test_hot_group_in_blocks(spark, block):
    """A group of near copies without its original: links between members only, found in blocks;
    hot shingles travel as markers (more than 32 classes in a flush)."""
    import random
    rng = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(1 + i % 3):
            w[rng.randrange(60)] = f"x{rng.randrange(12)}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = near_join.class_table(docs)
    roots = near_join.components(near_join.class_links(docs, classes, block=block))
    joined = {r.doc_id: r.root or r.cls  # a root has no row of its own
              for r in classes.join(roots, classes["cls"] == roots["node"], "left").collect()}
    want = {i: c for i, _, c in brute(rows)}
    for a, b in itertools.combinations(range(90), 2):
        assert (joined[a] == joined[b]) == (want[a] == want[b])


def brute_counts(rows):
    sets = [shingles(t) for _, t in rows]
    n = [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            n[a] += 1
            n[b] += 1
    return sorted(((i, k) for (i, _), k in zip(rows, n)), key=str)


@pytest.mark.parametrize("block", [4, 512])
def test_link_counts(spark, odd_docs, odd_rows, no_docs, block):
    got = near_join.link_counts(odd_docs, block=block).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == brute_counts([r[:2] for r in odd_rows])
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_join.link_counts(docs, block=block).collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=str) == brute_counts(rows)
    assert near_join.link_counts(no_docs).count() == 0


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    """Long near copies without their original, dealt into blocks by the bytes of their differences."""
    import random
    rng = random.Random(3)
    base, rows = [f"w{k}" for k in range(3000)], []
    for i in range(24):
        w = list(base)
        for k in range(40 + 15 * (i % 4)):
            w[rng.randrange(3000)] = f"x{i}-{k}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows), key=str)
    for size in (1 << 25, 4000):
        monkeypatch.setattr(near_join, "BLOCK_BYTES", size)
        assert ours(near_join.near_components(docs)) == want


def test_shared_keys_and_spanning_forests(monkeypatch):
    import numpy as np
    rng = np.random.default_rng(5)
    monkeypatch.setattr(near_join, "COLUMNS", 7)
    for n, m, share in ((1, 1, 0.5), (9, 14, 0.2), (30, 8, 0.05), (20, 20, 0.9), (6, 5, 0.0)):
        x, y = rng.random((n, 60)) < 0.3, rng.random((m, 60)) < 0.3
        keyed = [(np.nonzero(z)[1].astype(np.uint64) * 5, np.nonzero(z)[0]) for z in (x, y)]
        assert (near_join._common(*keyed, (n, m)) == x.astype(int) @ y.T.astype(int)).all()
        link = rng.random((n, m)) < share
        i, j = near_join._spanning(link)
        assert link[i, j].all() and len(i) < n + m

        def groups(pairs):
            root = list(range(n + m))
            for a, b in pairs:
                ra, rb = root[a], root[n + b]
                root = [ra if r == rb else r for r in root]
            return {frozenset(k for k in range(n + m) if root[k] == r) for r in root}
        assert groups(zip(i.tolist(), j.tolist())) == groups(zip(*map(np.ndarray.tolist, np.nonzero(link))))


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(1, 40)] + [(100, 100 + k) for k in range(1, 50)] + [(-5, 7)]
    out = near_join.components(spark.createDataFrame(chain, "src long, dst long")).collect()
    root = {r.node: r.root for r in out}
    assert all(root[k] == -5 for k in range(1, 41)) and all(root[100 + k] == 100 for k in range(1, 50))


def test_one_row_of_each_component_stays(odd_docs, odd_rows):
    kept = near_join.one_per_component(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert brute(rows) == [(i, n, c) for i, n, c in brute(rows) if not n or c == i or i is None]
    comps = {c for i, n, c in brute([r[:2] for r in odd_rows]) if n}
    assert {i for i, t in rows if shingles(t)} == comps  # smallest id of each
    assert sum(1 for _, t in rows if not shingles(t)) == sum(1 for r in odd_rows if not shingles(r[1]))


def test_empty_table(no_docs):
    assert near_join.near_components(no_docs).count() == 0
    assert near_join.one_per_component(no_docs).count() == 0
