"""Operators 7 and 8: exact ids, round trips, packing bounds."""
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topiclake.llm import packing, token_files
from topiclake.llm.tokens import Encoder, vocabulary

FILES = {"word": "word_bpe_49k.json", "byte": "byte_bpe_50k.json"}
LIB, OURS = {}, {}


def library(kind):
    if kind not in LIB:
        LIB[kind] = Tokenizer.from_file(vocabulary(FILES[kind]))
        LIB[kind].encode_special_tokens = True
        OURS[kind] = Encoder(vocabulary(FILES[kind]), kind)
    return LIB[kind], OURS[kind]


def ids(kind, text):
    return library(kind)[0].encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", FILES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("ab'sSt re12 \n\t\r\x0b\x0c\x1c\x85　éßÀñİΣς²\x01|<>endoftx"),
                                       st.characters(codec="utf-8")), max_size=60))
def test_ids_equal_the_library(kind, text):
    _, enc = library(kind)
    assert np.frombuffer(enc.encode([text])[0], "<u2").tolist() == ids(kind, text)


@pytest.mark.parametrize("kind", FILES)
def test_ids_of_given_texts(spark, kind):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    _, enc = library(kind)
    assert [np.frombuffer(b, "<u2").tolist() for b in enc.encode(texts)] == [ids(kind, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=700), st.integers(1, 1 << 40))
def test_elias_fano_round_trip(values, scale):
    v = sorted(x * (scale if i % 7 == 0 else 1) for i, x in enumerate(values))
    data = token_files.EliasFano.encode(v).to_bytes()
    ef = token_files.EliasFano.from_bytes(data)
    assert ef.values().tolist() == v
    assert [ef.select(i) for i in range(0, len(v), max(1, len(v) // 50))] == v[::max(1, len(v) // 50)]
    for i in range(0, len(v) + 1, max(1, len(v) // 9)):
        for j in (i, min(i + 1, len(v)), min(i + 257, len(v)), len(v)):
            assert ef.slice(i, j).tolist() == v[i:j]


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(1).integers(1, 1000, 10_000))
    assert len(token_files.EliasFano.encode(bounds).to_bytes()) * 8 < 12.5 * len(bounds)  # log2(500) + 2 + samples


def expected_files(rows):
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t in order:
        a = [*ids("word", t), 2]
        out.append((i, len(a), zlib.crc32(np.array(a, "<u4").tobytes())))
        start += len(a)
    return out, start


@pytest.mark.parametrize("max_ids", [1 << 26, 2000])
def test_token_files_round_trip(odd_docs, odd_rows, scratch, max_ids):
    manifest = token_files.write_token_files(odd_docs, scratch, vocabulary(FILES["word"]), max_ids=max_ids)
    got = token_files.read_token_files(manifest, scratch).orderBy("start").collect()
    want, total = expected_files([r[:2] for r in odd_rows])
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in got[:2])
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert sum(r.n_tokens for r in got) == total
    name = manifest.orderBy("part", "seq").first().name
    f = token_files.TokenFile(scratch, name)
    assert f.document(0).tolist()[-1] == 2 and len(f.doc_ids(0, f.n_docs)) == f.n_docs


def test_files_are_read_in_blocks(spark, scratch, monkeypatch):
    """Blocks of few documents, over nulls, repeated ids and empty texts: what the reader decodes
    at once is a block's boundaries, never a file's."""
    rows = [(None, "a b"), (None, None), (None, "a b"), *[(k // 2 - 50, "word " * (k % 7)) for k in range(400)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    manifest = token_files.write_token_files(docs, scratch, vocabulary(FILES["word"]))
    want = None
    for n_docs, n_ids in ((2000, 1 << 20), (3, 5), (1, 1)):
        monkeypatch.setattr(token_files, "READ_DOCS", n_docs)
        monkeypatch.setattr(token_files, "READ_IDS", n_ids)
        got = []
        for r in manifest.orderBy("part", "seq").collect():
            f = token_files.TokenFile(scratch, r.name)
            for i in range(0, f.n_docs, n_docs):
                j = min(i + n_docs, f.n_docs)
                starts = f.starts(i, j)
                assert len(starts) == j - i + 1
                got += zip(f.doc_ids(i, j), [x.tolist() for x in f.documents(starts)])
            assert [x for _, x in got[-f.n_docs:]] == [f.document(i).tolist() for i in range(f.n_docs)]
            f.close()
        want = want or got
        assert got == want
    assert sorted(map(str, want)) == sorted(str((i, [*ids("word", t), 2])) for i, t in rows)


def test_pieces_and_packing(odd_docs, odd_rows):
    df = packing.pack_documents(odd_docs, vocabulary(FILES["byte"]), with_ids=True)
    got = df.collect()
    want = []
    for i, t in [r[:2] for r in odd_rows]:
        a = np.array([*ids("byte", t), 0], "<u4")
        first = len(a) % 2048 or 2048
        for p, s in enumerate([0, *range(first, len(a), 2048)]):
            part = a[s:first if p == 0 else s + 2048]
            want.append((i, p, s, len(part), zlib.crc32(part.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for parts in seqs.values():
        at = 0
        for off, n, _ in sorted(parts):
            assert off == at
            at += n
        assert at <= 2048
    assert len(seqs) == packing.lower_bound(np.array([r.length for r in got]), 2048)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(df).collect()}
    assert whole == {k: b"".join(x[2] for x in sorted(v)) for k, v in seqs.items()}


def test_exchange_between_partitions_saves_bins(spark):
    """Partitions whose bins don't meet their bound pool their gappy bins."""
    rng = np.random.default_rng(3)
    lengths = rng.integers(520, 1100, 600).tolist()
    items = spark.createDataFrame([(k, n) for k, n in enumerate(lengths)], "key long, length long")
    out = packing.pack(items, pieces_per_partition=60)
    rows = out.join(items, "key").collect()
    assert sorted(r.key for r in rows) == list(range(600))
    use = {}
    for r in rows:
        use.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in use.values():
        at = 0
        for off, n in sorted(v):
            assert off == at
            at += n
        assert at <= 2048
    alone = 0
    for p in range(10):
        part = np.array(lengths[p * 60:(p + 1) * 60])
        alone += packing.best_fit_decreasing(part, 2048)[0].max() + 1
    assert packing.lower_bound(np.array(lengths), 2048) <= len(use) <= alone + 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_lower_bound_never_exceeds_the_best_packing(lengths):
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= 20:
                bins[k] += lengths[i]
                go(i + 1, bins)
                bins[k] -= lengths[i]
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    a = np.array(lengths)
    b, off = packing.best_fit_decreasing(a, 20)
    assert packing.lower_bound(a, 20) <= best <= b.max() + 1


def test_empty_table(no_docs, scratch):
    assert packing.pack_documents(no_docs, vocabulary(FILES["byte"])).count() == 0
    manifest = token_files.write_token_files(no_docs, scratch, vocabulary(FILES["word"]))
    assert manifest.count() == 0 and token_files.read_token_files(manifest, scratch).count() == 0

