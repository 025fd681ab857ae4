"""Operator 3: hashed word n-gram logistic regression for quality, trained with FTRL.

Features of a text are its word n-grams (n = 1, 2, 3) in two spellings, hashed into
``2**BITS`` weights: the words themselves, and their shapes (case, digits, the punctuation
they carry, whether the word, and the pair it forms, was met before in the text or equals
the word before). A feature's value is the square root of its share of the spelling's
n-grams, so long and short texts compare. Weights are learnt by follow-the-regularised-
leader updates (per-coordinate rates, L1 and L2); a score is one sparse dot product.

Training uses at most ``PER_CLASS`` labelled texts of each class, of at most ``MAX_CHARS``
characters, from the training fold only; the loss weighs both classes alike, and an offset
moves the best cut on a held-back part of the sample to ``CUT``. Scoring covers whole texts.

Defined results: null, empty and wordless texts are scored by the bias alone; null ids are
scored and not held out; repeated rows are scored alike; without labels of both classes
every score is the share of good labels; extra columns are ignored.

Scale: one pass, no shuffle; the weight vector (1 MB, fixed) goes to the tasks in a
broadcast; a task holds one batch of texts.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, prepare, table
from .tokens import release

PER_CLASS = 2000
MAX_CHARS = 20_000
BITS = 18
CUT = 0.3
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.05
MEMO_WORDS = 150_000
_MASK = np.uint64((1 << BITS) - 1)
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_BIAS = 0
_LETTERS, _CAPS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"[^\W\d_a-zß-öø-ÿ]{2,}"), re.compile(r"\d+")


def _shape(word: str) -> str:
    """Letters, runs of capitals and digits each as one sign; punctuation as it is, once."""
    s = _CAPS.sub("\x01", word)
    s = _DIGITS.sub("\x02", _LETTERS.sub("\x03", s))
    return re.sub(r"(.)\1+", r"\1\1", s)[:8]


def _codes(words: list[str], memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and of its shape."""
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for w in set(words):
        if w not in memo:
            memo[w] = (zlib.crc32(w.encode()), zlib.crc32(_shape(w).encode()))
    pairs = np.array([memo[w] for w in words], np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _again(codes: np.ndarray) -> np.ndarray:
    """1 where an equal value stands earlier."""
    _, first = np.unique(codes, return_index=True)
    out = np.ones(len(codes), np.uint64)
    out[first] = 0
    return out


def _grams(c: np.ndarray, salt: int) -> np.ndarray:
    one = (c + np.uint64(salt)) * _M1
    two = (one[:-1] ^ (c[1:] * _M2)) * _M3 + np.uint64(1)
    three = (two[:-1] ^ (c[2:] * _M2)) * _M1 + np.uint64(2)
    h = np.concatenate([one, two, three])
    return (h >> np.uint64(64 - BITS)) & _MASK


def features(text: str | None, memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, values) of a text's features; the bias alone where it has no words."""
    words = text.split() if text else []
    if not words:
        return np.array([_BIAS]), np.array([1.0])
    w, s = _codes(words, memo)
    pair = np.append(w[:1], (w[:-1] * _M2) ^ w[1:])
    same = np.append(np.uint64(0), (w[1:] == w[:-1]).astype(np.uint64))
    s = s * np.uint64(8) + _again(w) + np.uint64(2) * _again(pair) + np.uint64(4) * same
    idx, val = [np.array([_BIAS])], [np.array([1.0])]
    for c, salt in ((w, 17), (s, 91)):
        i, n = np.unique(_grams(c, salt), return_counts=True)
        idx.append(i.astype(np.int64))
        val.append(np.sqrt(n / n.sum()))
    return np.concatenate(idx), np.concatenate(val)


class Model:
    def __init__(self, weights: np.ndarray, offset: float = 0.0, prior: float | None = None):
        self.weights, self.offset, self.prior = weights, offset, prior

    def logits(self, texts, memo: dict) -> np.ndarray:
        out = np.empty(len(texts))
        for k, t in enumerate(texts):
            i, x = features(t, memo)
            out[k] = self.weights[i] @ x
        return out

    def score(self, texts, memo: dict) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(texts, memo) + self.offset, -30, 30)))


def train(sample: list[tuple[str, int]], seed: int = 11) -> Model:
    n_pos = sum(y for _, y in sample)
    if n_pos == 0 or n_pos == len(sample):
        return Model(np.zeros(1 << BITS, np.float32), prior=n_pos / len(sample) if sample else 0.0)
    rng = np.random.default_rng(seed)
    memo: dict = {}
    rows = [features(t, memo) for t, _ in sample]
    y = np.array([v for _, v in sample])
    order = rng.permutation(len(rows))
    cal, fit = order[:len(rows) // 5], order[len(rows) // 5:]
    share = y[fit].mean()
    weigh = {1: 0.5 / max(share, 1e-3), 0: 0.5 / max(1 - share, 1e-3)}
    z, n, w = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(EPOCHS):
        for k in rng.permutation(fit):
            i, x = rows[k]
            w[i] = np.where(np.abs(z[i]) <= L1, 0.0,
                            -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(w[i] @ x, -30, 30)))
            g = (p - y[k]) * weigh[int(y[k])] * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w[i]
            n[i] += g * g
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    model = Model(w.astype(np.float32))
    logit = np.array([model.weights[rows[k][0]] @ rows[k][1] for k in cal])
    at = np.log(CUT / (1 - CUT))
    model.offset = float(at - _best_cut(logit, y[cal])) if 0 < y[cal].sum() < len(cal) else float(at)
    return model


def _best_cut(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut with the most right answers, both classes weighing alike, midway in its gap."""
    order = np.argsort(logit)
    x, t = logit[order], y[order]
    right = np.append(0, np.cumsum((1 - t) / (1 - t).sum() - t / t.sum()))
    best = np.flatnonzero(right >= right.max() - 1e-9)
    i = int(best[len(best) // 2])
    return float(((x[i - 1] if i else x[0] - 1) + (x[i] if i < len(x) else x[-1] + 1)) / 2)


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``: every row's score, 0 to 1."""
    prepare(docs.sparkSession)
    weights = docs.sparkSession.sparkContext.broadcast(model)
    memo: dict = {}

    @F.pandas_udf("double")
    def run(text):
        import pandas as pd
        release()
        return pd.Series(weights.value.score(text.tolist(), memo))

    return docs.withColumn(out, run(F.col("text").cast("string")))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return train(labelled_sample(docs, labels, "quality", per_class, MAX_CHARS))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))
