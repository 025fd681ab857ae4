"""Operator 13 against the two libraries and a plain double loop."""
import hashlib
from collections import Counter

import numpy as np
import sentencepiece
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from topiclake.llm import alignment
from topiclake.llm.tokens import vocabulary

A_PATH, B_PATH = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_HELD = {}


def libraries():
    if not _HELD:
        _HELD["a"] = Tokenizer.from_file(A_PATH)
        _HELD["a"].encode_special_tokens = True
        _HELD["b"] = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        _HELD["table"] = alignment.byte_tokens(A_PATH)
        _HELD["ours"] = alignment.PieceEncoder(B_PATH)
    return _HELD["a"], _HELD["b"], _HELD["ours"]


def spans(parts):
    at, out = 0, []
    for i, b in parts:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def tokens_of(text):
    """Spans of A and B tokens by the libraries, or two empty lists."""
    a, b, _ = libraries()
    if not text:
        return [], []
    whole = (" " + text).encode()
    table = _HELD["table"]
    ta = [(i, table[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
    tb = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    if b"".join(x for _, x in ta) != whole or b"".join(x for _, x in tb) != whole:
        return [], []
    return spans(ta), spans(tb)


def brute(rows):
    found, count = [], Counter()
    for doc_id, text in rows:
        a, b = tokens_of(text)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        count.update(links)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for c in cuts:
            groups.append([",".join(str(x[0]) for x in t if low <= x[1] < c) for t in (a, b)])
            low = c
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a else ""
        found.append((doc_id, len(a), len(b), len(groups), links, digest))
    top = Counter()
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return sorted(((i, na, nb, g, len(k), sum(count[x] == top[x[1]] for x in k), sum(count[x] for x in k), d)
                   for i, na, nb, g, k, d in found), key=str)


SIGNS = st.text(alphabet=st.one_of(st.sampled_from("ab'sSt re12 \n\t\r\x0b\x85　éßıΣ日本▁<s>/0xA|endoft"),
                                   st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(text=SIGNS)
def test_piece_ids_equal_the_library(text):
    _, b, ours = libraries()
    ids, same = ours.encode([text])
    assert np.frombuffer(ids[0], "<u2").tolist() == b.encode(text)
    assert not text or same[0] == (tokens_of(text) != ([], []))


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), SIGNS), max_size=5))
def test_blocks_equal_brute_force(texts):
    n_a, n_b, n_groups, digests, codes, n_links = alignment._aligner(A_PATH, B_PATH).align(texts)
    want = []
    for t in texts:
        a, b = tokens_of(t)
        links = sorted(x[0] * 32000 + y[0] for x in a for y in b if x[1] < y[2] and y[1] < x[2])
        want.append((len(a), len(b), len({x[2] for x in a} & {y[2] for y in b}), links))
    ends = np.cumsum(n_links)
    got = [(p, q, g, sorted(codes[e - k:e].tolist())) for p, q, g, e, k in
           zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), ends.tolist(), n_links.tolist())]
    assert got == want


def test_special_token_strings_are_plain_text():
    a, b = tokens_of("x <|endoftext|> <s></s> <unk> <0x41> y")
    assert a and b and not {50256, 0, 1, 2} & {x[0] for x in a + b}


def test_odd_rows_and_rare_pairs(odd_docs, odd_rows):
    want = brute([(i, t) for i, t, *_ in odd_rows if len(t or "") < 10_000])
    docs = odd_docs.where("text IS NULL OR length(text) < 10000")
    for frequent in (10**6, 40, 1):  # all pairs looked up, some joined, nearly all joined
        got = alignment.align(docs, A_PATH, B_PATH, frequent)
        assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=str) == want


def test_long_text_is_one_row(odd_docs):
    r = alignment.align(odd_docs.where("doc_id = 6"), A_PATH, B_PATH).first()
    assert r.n_a > 30_000 and r.n_groups > 0 and r.n_links == r.n_a + r.n_b - r.n_groups


def test_empty_table(no_docs):
    assert alignment.align(no_docs, A_PATH, B_PATH).count() == 0


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in alignment.op13_token_alignment(spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        a, b = tokens_of(t)
        assert (got[i].n_a, got[i].n_b) == (len(a), len(b))
        assert got[i].n_links == len({x[1] for x in a} | {x[1] for x in b})
