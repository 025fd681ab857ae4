"""Operator 2: a convolutional text classifier for toxicity, trained here in numpy.

A word's vector is the sum of hashed embeddings of the word itself and of its prefixes and
suffixes (so unseen inflections share parts with seen words). Filters of widths 1, 2 and
3 run over the words; max pooling over the whole text; a linear layer gives the logit.
Thresholds are calibrated by language: the language is read from the text's own function
words, never from a column, and each language's threshold is folded into the score, so
that 0.5 is the threshold everywhere.

Training uses at most ``PER_CLASS`` labelled texts of each class, of at most ``MAX_CHARS``
characters, from the training fold only. Scoring covers every whole text, in tasks.

Defined results: null, empty and wordless texts are scored by the bias alone; null ids are
scored and not held out; repeated rows are scored alike; without labels of both classes
every score is the share of toxic labels (0.5 at most, none: 0); extra columns are ignored.

Scale: one pass, no shuffle; the model (a few MB, fixed by its parameters) goes to the
tasks in the closure; a task holds one batch of texts and a bounded memo of words.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, prepare, table
from .tokens import release

PER_CLASS = 1500
MAX_CHARS = 20_000
BUCKETS = 1 << 15
DIM = 16
WIDTHS = (1, 2, 3)
FILTERS = 12  # of each width
EPOCHS = 6
CROSS_FIT_ROWS = 1000
LEARNING_RATE = 0.004
MIN_DOCS = 3  # word parts of fewer training texts get no embedding
MEMO_WORDS = 80_000
BLOCK_WORDS = 60_000  # words scored together (a longer text by itself)
PIECES = 8  # hashed parts of a word
_PAD = 0
_WORD = re.compile(r"\w+")
# Frequent function words that tell these languages apart.
LANGUAGES = {
    "en": "the of and to in that is for with are this from was on be as by at it",
    "de": "der die und das den von mit sich auf für ist im dem nicht ein eine als auch",
    "fr": "le et les des est dans que pour pas sur une du au qui avec ce il",
    "es": "el los las y por del se con para una su lo como más al no",
}
_WORD_LANGUAGE = {w: i + 1 for i, ws in enumerate(LANGUAGES.values()) for w in ws.split()}
N_LANG = len(LANGUAGES) + 1  # 0: unknown


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def word_parts(word: str) -> list[int]:
    """Buckets of the word and of its prefixes and suffixes; bucket 0 is the padding."""
    parts = ["=" + word] + [f"^{word[:k]}" for k in (3, 4, 5, 6) if len(word) > k]
    parts += [f"{word[-k:]}$" for k in (3, 4, 5) if len(word) > k]
    ids = [1 + zlib.crc32(p.encode()) % (BUCKETS - 1) for p in parts]
    return ids + [_PAD] * (PIECES - len(ids))


def _language(counts: np.ndarray) -> np.ndarray:
    """Language of each text from its counts of each language's function words."""
    best = counts[:, 1:].argmax(1) + 1
    return np.where(counts[:, 1:].max(1) > 0, best, 0)


class Model:
    def __init__(self, embed, filters, bias, out, out_bias, thresholds, prior=None):
        self.embed, self.filters, self.bias = embed, filters, bias  # filters[w]: (w, DIM, FILTERS)
        self.out, self.out_bias, self.thresholds, self.prior = out, out_bias, thresholds, prior

    def score(self, texts: list[str | None], memo: dict) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        return self._scores([words(t) for t in texts], memo)

    def _scores(self, docs: list[list[str]], memo: dict) -> np.ndarray:
        out = np.empty(len(docs))
        start = 0
        while start < len(docs):  # BLOCK_WORDS at a time, one text at least
            end, n = start, 0
            while end < len(docs) and (end == start or n + len(docs[end]) <= BLOCK_WORDS):
                n += len(docs[end])
                end += 1
            logit, lang = self._forward(docs[start:end], memo)
            out[start:end] = 1 / (1 + np.exp(-np.clip(logit - self.thresholds[lang], -30, 30)))
            start = end
        return out

    def _projections(self, docs, memo: dict):
        """Rows of the memo's projection table for every word, padded behind each text."""
        index = memo.setdefault("index", {})
        if "rows" not in memo or len(index) > MEMO_WORDS:
            index.clear()
            memo["rows"], memo["lang"] = np.zeros((1, self._columns()), np.float32), np.zeros(1, np.int64)
        fresh = list({w for d in docs for w in d if w not in index})
        if fresh:
            base = len(memo["rows"])
            index.update(zip(fresh, range(base, base + len(fresh))))
            parts = np.array([word_parts(w) for w in fresh])
            rows = [memo["rows"]]
            for i in range(0, len(fresh), 20_000):
                rows.append(self.embed[parts[i:i + 20_000]].sum(1) @ self._wide())
            memo["rows"] = np.concatenate(rows)
            memo["lang"] = np.append(memo["lang"], [_WORD_LANGUAGE.get(w, 0) for w in fresh])
        get = index.__getitem__
        pad = [0] * max(WIDTHS)
        at: list[int] = []
        for d in docs:
            at.extend(map(get, d))
            at += pad
        return np.array(at), memo

    def _columns(self) -> int:
        return sum(WIDTHS) * FILTERS

    def _wide(self) -> np.ndarray:
        return np.concatenate([f[j] for f in self.filters for j in range(len(f))], axis=1)

    def _forward(self, docs, memo):
        at, memo = self._projections(docs, memo)
        lengths = np.array([len(d) + max(WIDTHS) for d in docs])
        first = np.append(0, np.cumsum(lengths)[:-1])
        rows = memo["rows"][at]
        pooled, col = [], 0
        for f, b in zip(self.filters, self.bias):
            w = len(f)
            c = rows[:, col:col + FILTERS].copy()
            for j in range(1, w):
                c[:-j] += rows[j:, col + j * FILTERS:col + (j + 1) * FILTERS]
            col += w * FILTERS
            pooled.append(np.maximum(np.maximum.reduceat(c, first) + b, 0))
        h = np.concatenate(pooled, axis=1)
        lang = np.zeros((len(docs), N_LANG))
        np.add.at(lang, (np.repeat(np.arange(len(docs)), lengths), memo["lang"][at]), 1)
        return h @ self.out + self.out_bias, _language(lang)


def train(sample: list[tuple[str, int]], seed: int = 7) -> Model:
    """Fit on ``(text, label)`` rows: Adam on the logistic loss, then one threshold for each
    language from rows that the fit has not seen."""
    n_pos = sum(y for _, y in sample)
    if n_pos == 0 or n_pos == len(sample):
        share = n_pos / len(sample) if sample else 0.0
        return Model(None, None, None, None, 0.0, None, prior=min(share, 0.5))
    rng = np.random.default_rng(seed)
    docs, y = [words(t) for t, _ in sample], np.array([v for _, v in sample], np.float32)
    order = rng.permutation(len(docs))
    parts = np.array_split(order, 5)
    # Small samples: every row is judged by a fit without it. Larger ones: a fifth suffices.
    held = parts if len(docs) <= CROSS_FIT_ROWS else parts[:1]
    logit, lang, truth = [], [], []
    for cal in held:
        model = _fit(docs, y, np.setdiff1d(order, cal), rng)
        z, k = _in_blocks(model, [docs[i] for i in cal], {})
        logit.append(z)
        lang.append(k)
        truth.append(y[cal])
    if len(held) > 1:
        model = _fit(docs, y, order, rng)
    model.thresholds = _calibrate(*map(np.concatenate, (logit, lang, truth)))
    return model


def _calibrate(logit: np.ndarray, lang: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A threshold for each language with enough rows of both classes; one for the rest."""
    out, rest = np.zeros(N_LANG), np.ones(len(y), bool)
    enough = [k for k in range(N_LANG) if y[lang == k].sum() >= 4 and (1 - y[lang == k]).sum() >= 16]
    for k in enough:
        out[k] = _threshold(logit[lang == k], y[lang == k])
        rest &= lang != k
    if not 0 < y[rest].sum() < rest.sum():
        rest[:] = True
    out[[k for k in range(N_LANG) if k not in enough]] = _threshold(logit[rest], y[rest]) if len(y) else 0.0
    return out


def _in_blocks(model: Model, docs, memo, size: int = 200):
    parts = [model._forward(docs[i:i + size], memo) for i in range(0, len(docs), size)]
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else \
        (np.zeros(0), np.zeros(0, int))


def _threshold(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest wrong answers (a clean text lost counts as two toxic texts kept),
    midway in its gap."""
    order = np.argsort(logit)
    x, t = logit[order], y[order]
    right = np.append(0, np.cumsum(2 * (1 - t) - t))  # of cutting before item i
    best = np.flatnonzero(right >= right.max() - 1e-9)
    i = int(best[len(best) // 2])
    lo = x[i - 1] if i > 0 else x[0] - 1
    hi = x[i] if i < len(x) else x[-1] + 1
    return float(np.clip((lo + hi) / 2, -12, 12))


def _fit(docs, y, fit, rng) -> Model:
    vocab: dict[str, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab) + 1) for w in docs[i]], np.int64) for i in fit]
    parts = np.zeros((len(vocab) + 1, PIECES), np.int64)
    for w, k in vocab.items():
        parts[k] = word_parts(w)
    # Start: the first dimension says how much more often a part occurs in toxic texts than
    # chance has it (in standard deviations), and the first filter of width 1 reads it.
    seen, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for i, x in zip(fit, ids):
        u = np.unique(parts[x])
        seen[u] += 1
        toxic[u] += y[i]
    share = y[fit].mean()
    learnt = seen >= MIN_DOCS
    learnt[_PAD] = False
    embed = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    embed[:, 0] = np.clip((toxic - seen * share) / np.sqrt(seen * share * (1 - share) + 1), -4, 8) / 8
    embed[~learnt] = 0
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    filters[0][0, :, 0] = np.eye(DIM)[0] * 2
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    out = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
    out[0] = 2
    model = Model(embed, filters, bias, out, -2.0, np.zeros(N_LANG))
    weight = np.where(y[fit] == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32)
    dense = [*filters, *bias, out, np.zeros(1, np.float32)]
    m1, m2 = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    e2 = np.zeros(BUCKETS, np.float32)
    step = 0
    for _ in range(EPOCHS):
        turn = rng.permutation(len(fit))
        for s in range(0, len(turn), 32):
            batch = turn[s:s + 32]
            pad = np.zeros(max(WIDTHS), np.int64)
            # words are dropped at random, so that no single rare word can carry a text
            texts = [ids[i][rng.random(len(ids[i])) > 0.25] for i in batch]
            seq = np.concatenate([x for t in texts for x in (t, pad)])
            length = np.array([len(t) + len(pad) for t in texts])
            first = np.append(0, np.cumsum(length)[:-1])
            used, local = np.unique(seq, return_inverse=True)
            vec = model.embed[parts[used]].sum(1)
            hs, where = [], []
            for f, b in zip(model.filters, model.bias):
                c = (vec @ f[0])[local]
                for j in range(1, len(f)):
                    c[:-j] += (vec @ f[j])[local[j:]]
                top = np.maximum.reduceat(c, first)
                # first place of the maximum in each text
                hit = c == np.repeat(top, length, axis=0)
                place = np.where(hit, np.arange(len(seq))[:, None], len(seq))
                where.append(np.minimum.reduceat(place, first))
                hs.append(top + b)
            pre = np.concatenate(hs, axis=1)
            keep = (rng.random(pre.shape) > 0.2) / 0.8
            h = np.maximum(pre, 0) * keep
            p = 1 / (1 + np.exp(-np.clip(h @ model.out + model.out_bias, -30, 30)))
            g = (weight[batch] * (p - y[fit[batch]]) / len(batch)).astype(np.float32)
            d_h = (g[:, None] * model.out[None, :]) * (pre > 0) * keep
            grads_f, grads_b = [], []
            d_vec = np.zeros((len(used), DIM), np.float32)
            for k, f in enumerate(model.filters):
                d = d_h[:, k * FILTERS:(k + 1) * FILTERS].astype(np.float32)
                gf = np.zeros_like(f)
                for j in range(len(f)):
                    at = local[np.minimum(where[k] + j, len(seq) - 1)]
                    gf[j] = np.einsum("bfd,bf->df", vec[at], d)
                    np.add.at(d_vec, at.reshape(-1), (d[:, :, None] * f[j].T[None]).reshape(-1, DIM))
                grads_f.append(gf)
                grads_b.append(d.sum(0))
            touched = np.flatnonzero(np.abs(d_vec).sum(1) > 0)
            step += 1
            rate = LEARNING_RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            dense = [*model.filters, *model.bias, model.out, np.array([model.out_bias], np.float32)]
            for q, (v, gr) in enumerate(zip(dense, [*grads_f, *grads_b, h.T @ g, g.sum(keepdims=True)])):
                m1[q] += 0.1 * (gr - m1[q])
                m2[q] += 0.001 * (gr * gr - m2[q])
                v -= rate * m1[q] / (np.sqrt(m2[q]) + 1e-8) + rate * 0.0005 * v
            model.out_bias = float(dense[-1][0])
            rows = parts[used[touched]].reshape(-1)
            ge = np.repeat(d_vec[touched], PIECES, axis=0)
            u, inv = np.unique(rows, return_inverse=True)
            acc = np.zeros((len(u), DIM), np.float32)
            np.add.at(acc, inv, ge)
            acc[~learnt[u]] = 0
            e2[u] += (acc * acc).mean(1)
            model.embed[u] -= 0.01 * acc / (np.sqrt(e2[u])[:, None] + 1e-6) + 1e-4 * model.embed[u]
    return model


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


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return train(labelled_sample(docs, labels, "toxic", per_class, MAX_CHARS))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
