"""Operator 12 against brute force over all periods."""
import hashlib
import random
import zlib

import numpy as np
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from topiclake.llm import periodic_runs as P


def brute_runs(w):
    """Every (start, end, period): maximal stretches of every period, the smallest one counts."""
    n, best = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, q, e) for (s, e), q in best.items())


def brute_row(doc_id, text, rewrite=True):
    words = P._WORD.findall(text) if text else []
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if rewrite and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, q, e in runs for i in range(s + q, e)}
    best = (None,) * 4
    if runs:
        s, q, e = min(runs, key=lambda r: (-(r[2] - r[0]), r[0], r[1]))
        best = (s, e - s, q, 1000 * (e - s) // q)
    lines = "".join(f"{s},{e - s},{q}\n" for s, q, e in runs)
    kept = " ".join(x for i, x in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def check(texts):
    got = [sorted(zip(s.tolist(), q.tolist(), e.tolist())) for s, e, q in P.runs_of(texts)]
    assert got == [brute_runs(w) for w in texts]


pieces = st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 30)), max_size=5)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.one_of(st.text("ab", max_size=90), st.text("abc", max_size=120),
                          pieces.map(lambda x: "".join(a * k for a, k in x)[:200])).map(list), max_size=4))
def test_all_runs(texts):
    check(texts)


def test_long_periods_and_nested_runs():
    rng = random.Random(3)
    texts = []
    for n in (1, 5, 11, 12, 13, 40, 63, 64, 127, 200, 333):
        base = [rng.choice("abcdefgh") for _ in range(n)]
        texts += [base * 3, base * 2 + base[:n // 2], ["x"] + base * 2 + ["y"], (base * 2 + ["z"]) * 2, base * 2 + ["q"] + base]
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    texts += [list(fib[-1]), ["a"] * 500, list("ab" * 200), list("aab" * 70 + "b" * 40)]
    check(texts)


def test_wavelet_successor():
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 100, 257):
        v = rng.permutation(n)
        tree = P.WaveletTree(v)
        lo = rng.integers(0, n + 1, 300)
        hi = np.minimum(n, lo + rng.integers(0, n + 1, 300))
        x = rng.integers(0, 2 * n + 3, 300)
        want = [min((int(a) for a in v[i:j] if a >= k), default=-1) for i, j, k in zip(lo, hi, x)]
        assert tree.successor(lo, hi, x).tolist() == want


def test_ranks_and_extensions():
    rng = np.random.default_rng(4)
    for n, k in ((0, 2), (1, 2), (50, 2), (300, 3), (200, 1)):
        w = rng.integers(0, k, n)
        r = P.Ranks(w)
        s = w.tolist()
        assert r.order.tolist() == sorted(range(n), key=lambda i: s[i:])
        for _ in range(50 if n > 1 else 0):
            i, j = sorted(rng.choice(n, 2, replace=False).tolist())
            fwd = next((t for t in range(n) if j + t >= n or s[i + t] != s[j + t]), n)
            back = next((t for t in range(n) if i - t - 1 < 0 or s[i - t - 1] != s[j - t - 1]), n)
            assert r.forward(np.array([i]), np.array([j])).tolist() == [fwd]
            assert r.backward(np.array([i]), np.array([j])).tolist() == [back]


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_odd_rows(odd_docs, odd_rows):
    got = rows(P.periodic_runs(odd_docs.where("text IS NULL OR length(text) < 10000"), P.repeated_tail))
    assert got == sorted((brute_row(i, t) for i, t, *_ in odd_rows if len(t or "") < 10_000), key=str)
    r = P.periodic_runs(odd_docs.where("doc_id = 12")).first()  # forty equal lines of three words
    assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 120, 3, 40_000)


def test_very_long_text(spark):
    words = [f"w{i % 977}" for i in range(60_000)] + ["end"] + ["x", "y"] * 20_000
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    r = P.periodic_runs(df).first()
    assert (r.n_runs, r.start, r.length, r.period) == (2, 0, 60_000, 977)


def test_empty_table(no_docs):
    assert P.periodic_runs(no_docs).count() == 0


def test_given_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: r for r in rows(P.op12_periodic_runs(spark, SF_SMALL))}
    assert len(got) == len(docs)
    short = [d for d in docs if len(d[1] or "") < 12_000]
    assert len(short) > 100 and [got[i] for i, _ in short] == [brute_row(i, t) for i, t in short]
