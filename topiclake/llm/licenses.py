"""Operator 6: licence scan with a trained paragraph classifier and template comparison.

A paragraph is a line of the text. A multinomial logistic regression over hashed word
1- and 2-grams (sparse, trained here in numpy) gives every paragraph a licence family or
``unknown``. It learns from variations of the fixed notices below (words dropped, added
and re-ordered, names and years put in) and, for ``unknown``, from a bounded sample of the
corpus's own paragraphs and from scrambled notices. The probability that a family needs is
calibrated on a held-back part, so that at most ``FALSE_SHARE`` of unknown paragraphs pass.
A prediction is then compared with the family's notices and confirmed when the longest common
run of words, in order, covers ``MIN_COVER`` of a notice (``MIN_COVER_SHORT`` of one of fewer than
``SHORT`` words) within ``SPREAD`` times its words, holds the words that name the licence, and
holds no name of another family and no word of doubt (``DOUBT``) that the notice lacks. A word of
doubt earlier in the sentence (its last ``LOOK_BACK`` words; a phrase such as "unless otherwise
noted" aside) also denies it: "not licensed under ...", "discussed whether ...". A bare name
("MIT License", "License: MIT", an SPDX tag) counts only as a whole paragraph. ``version`` is the
licence's version as the matched words give it.

Notices that are wrapped over lines, or stand inside a long line, are found by windows: the
lines between two lines without words are joined, and overlapping windows of each size in
``WINDOWS`` cover all their words. Where a window is given a family, the words around it are
searched for that family's notices. Blocks that hold none of the words of which every match needs
one (``ANCHORS``, derived from the notices) cannot hold a match, and their windows are not scored.
Matches (the best first) that overlap no confirmed line and no better match are
confirmed spans at the line where they start; ``spans`` of lines that a match of their family
covers and that are not confirmed themselves give way to it.

Training draws at most ``UNKNOWN_ROWS`` paragraphs (of ``UNKNOWN_DOCS`` texts) from the
corpus; scanning covers every paragraph of every whole text.

Defined results: null and empty texts have no paragraphs and no licences; null ids and
repeated rows get a row each; an empty table gives no rows (the model then knows scrambled
notices only); extra columns are ignored. Equal texts get equal spans, texts of any length are
scanned whole, and of two notices that match alike the later one is named.

Scale: one pass, no shuffle; the weights (fixed size) go out in a broadcast; a task holds
one batch of texts; a paragraph of any length is one sparse sum.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, prepare, table

BITS = 16
UNKNOWN_DOCS = 400
UNKNOWN_ROWS = 4000
MAX_CHARS = 20_000
EPOCHS, RATE = 10, 0.5
FALSE_SHARE = 0.001
MIN_COVER, MIN_COVER_SHORT, SHORT = 0.6, 0.75, 9
LOOK_BACK = 12  # words
FAMILY_ROWS = 160  # training rows of a family
MEMO_WORDS = 300_000
WINDOWS = (4, 8, 16, 32)  # words
WINDOW_WORDS = 20_000  # words whose windows are scored at once
SPREAD = 1.5

# The names of licences, by family.
NAMES = {
    "agpl": ["AGPL", "AGPLv3", "AGPL-3.0", "GNU AGPL", "GNU Affero General Public License"],
    "apache-2.0": ["Apache 2.0", "Apache 2", "Apache License 2.0", "Apache License, Version 2.0", "Apache-2.0"],
    "artistic": ["Artistic License 2.0", "Artistic-2.0"],
    "boost": ["Boost Software License 1.0", "BSL-1.0"],
    "bsd": ["BSD", "BSD 2-Clause", "BSD 3-Clause", "New BSD", "Simplified BSD", "BSD-2-Clause", "BSD-3-Clause"],
    "cc-by": ["CC BY 4.0", "CC-BY-4.0", "CC-BY", "Creative Commons Attribution License 4.0",
              "Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC-BY-NC-4.0", "CC-BY-NC", "Creative Commons Attribution-NonCommercial License 4.0",
                 "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-nc-nd": ["CC BY-NC-ND 4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-ND",
                    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"],
    "cc-by-nc-sa": ["CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-SA",
                    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "cc-by-nd": ["CC BY-ND 4.0", "CC-BY-ND-4.0", "CC-BY-ND", "Creative Commons Attribution-NoDerivatives License 4.0",
                 "Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC-BY-SA-4.0", "CC-BY-SA", "Creative Commons Attribution-ShareAlike License 4.0",
                 "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0": ["CC0", "CC0 1.0", "CC0 1.0 Universal", "CC0-1.0", "Creative Commons Zero"],
    "cddl": ["CDDL", "CDDL-1.0", "Common Development and Distribution License"],
    "epl": ["EPL 2.0", "EPL-2.0", "Eclipse Public License 2.0", "Eclipse Public License v1.0"],
    "eupl": ["EUPL", "EUPL-1.2", "European Union Public Licence"],
    "gpl": ["GPL", "GPLv2", "GPLv3", "GNU GPL", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later",
            "GNU General Public License", "GNU General Public License, version 2", "GNU General Public License, version 3"],
    "isc": ["ISC"],
    "lgpl": ["LGPL", "LGPLv2.1", "LGPLv3", "LGPL-2.1-or-later", "LGPL-3.0-only", "GNU LGPL",
             "GNU Lesser General Public License", "GNU Lesser General Public License, version 2.1"],
    "mit": ["MIT", "Expat"],
    "mpl": ["MPL 2.0", "MPL-2.0", "Mozilla Public License 2.0"],
    "ms-pl": ["MS-PL", "Microsoft Public License"],
    "ofl": ["OFL-1.1", "SIL Open Font License 1.1"],
    "postgresql": ["PostgreSQL"],
    "psf": ["Python Software Foundation License", "PSF-2.0"],
    "unlicense": ["Unlicense"],
    "wtfpl": ["WTFPL"],
    "zlib": ["zlib"],
}
# How a text says that it stands under a licence of a name; ``^``: as a whole paragraph.
PHRASES = ["licensed under {}", "licensed under the {} license", "available under the terms of the {} license",
           "^{} license", "^the {} license", "^license {}", "^SPDX-License-Identifier: {}"]
# Longer notices, by family.
GRANTS = {
    "all-rights-reserved": ["All rights reserved.", "Copyright 2020 The Authors. All rights reserved."],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"],
    "boost": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit"],
    "bsd": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at"],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License"],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "ofl": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "postgresql": [
        "Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, "
        "and without a written agreement is hereby granted"],
    "public-domain": ["This work has been placed in the public domain.", "This work is in the public domain."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "zlib": [
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software."],
}
# Words of names that name no licence by themselves.
PLAIN_WORDS = set("the and of license licence version v public general gnu software common creative commons cc by new "
                  "international universal open foundation union development distribution simplified attribution".split())
# Words of doubt or denial, and phrases that look like them.
DOUBT = set("not never no nor neither cannot isn aren wasn weren don doesn didn won whether instead unlike discussed "
            "considered considering hypothetically rather if should would".split())
_NO_DOUBT = re.compile(r"\b(?:unless|except where|except as|if not|where not)\b[^,;]*?\b(?:noted|stated|specified|indicated|"
                       r"mentioned|required|agreed)\b")
_SENTENCE = re.compile(r"[.!?;](?:\s|$)")
FAMILIES = ["unknown", *sorted({*NAMES, *GRANTS})]
_WORD = re.compile(r"\w+(?:[-.]\w+)*")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _grams(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Buckets of all words, then of all pairs (a pair across a paragraph's end: bucket -1)."""
    one = (h * _M1 >> np.uint64(64 - BITS)).astype(np.int64)
    two = ((h[:-1] * _M2 ^ h[1:]) * _M1 >> np.uint64(64 - BITS)).astype(np.int64)
    two[ends[:-1] - 1] = -1
    return np.concatenate([one, two])


def _hashes(ws: list[str], memo: dict) -> np.ndarray:
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for w in set(ws):
        if w not in memo:
            memo[w] = zlib.crc32(w.encode()) + 1
    return np.array([memo[w] for w in ws], np.uint64)


class Model:
    def __init__(self, weights: np.ndarray, bias: np.ndarray, needed: float):
        self.weights, self.bias, self.needed = weights, bias, needed  # weights: (2**BITS + 1, families)

    def probabilities(self, paragraphs: list[list[str]], memo: dict) -> np.ndarray:
        """(paragraphs, families); paragraphs without words are unknown."""
        out = np.zeros((len(paragraphs), len(FAMILIES)))
        out[:, 0] = 1
        full = [i for i, p in enumerate(paragraphs) if p]
        if not full:
            return out
        n = np.array([len(paragraphs[i]) for i in full])
        ends = np.cumsum(n)
        h = _hashes([w for i in full for w in paragraphs[i]], memo)
        g = _grams(h, ends)
        first = ends - n
        total = np.add.reduceat(self.weights[g[:len(h)]], first, axis=0)
        pairs = np.concatenate([self.weights[g[len(h):]], np.zeros((1, len(FAMILIES)), np.float32)])
        total += np.add.reduceat(pairs, first, axis=0)
        z = total / np.sqrt(2 * n - 1)[:, None] + self.bias
        e = np.exp(z - z.max(1, keepdims=True))
        out[full] = e / e.sum(1, keepdims=True)
        return out

    def predict(self, paragraphs: list[list[str]], memo: dict):
        p = self.probabilities(paragraphs, memo)
        best = p[:, 1:].argmax(1) + 1
        return np.where(p[np.arange(len(p)), best] >= self.needed, best, 0), p


    def window_hits(self, ws: list[str], ends: np.ndarray, memo: dict):
        """``start, end, family, probability`` of the windows over ``ws`` that have a family; no
        window reaches over one of ``ends``, the ends of the blocks."""
        h = _hashes(ws, memo)
        g = _grams(h, ends)
        none = np.zeros((1, len(FAMILIES)))
        one = np.concatenate([none, np.cumsum(self.weights[g[:len(h)]], 0, dtype=np.float64)])
        two = np.concatenate([none, np.cumsum(self.weights[g[len(h):]], 0, dtype=np.float64)])
        last = np.repeat(ends, np.diff(ends, prepend=0))
        for size in WINDOWS:
            start = np.union1d(np.arange(0, len(h), size // 2), np.concatenate([[0], ends[:-1]]))
            end = np.minimum(start + size, last[start])
            z = (one[end] - one[start] + two[end - 1] - two[start]) / np.sqrt(2 * (end - start) - 1)[:, None] + self.bias
            best = z[:, 1:].argmax(1) + 1
            some = np.flatnonzero(z[np.arange(len(z)), best] > z[:, 0])
            e = np.exp(z[some] - z[some].max(1, keepdims=True))
            p = e[np.arange(len(some)), best[some]] / e.sum(1)
            for k, q in zip(some[p >= self.needed].tolist(), p[p >= self.needed].tolist()):
                yield int(start[k]), int(end[k]), int(best[k]), q


class Notice(NamedTuple):
    words: list[str]
    named: frozenset  # words that a match must hold
    whole: bool  # matches whole paragraphs only
    need: float  # share of the words


def _notices() -> dict[str, list[Notice]]:
    out: dict[str, list[Notice]] = {f: [] for f in FAMILIES[1:]}
    for family, names in NAMES.items():
        for name in names:
            named = frozenset(w for w in words(name) if w not in PLAIN_WORDS and not w[0].isdigit()) or frozenset(words(name))
            for phrase in PHRASES:
                t = words(phrase.format(name))
                if "license" in words(name) or "licence" in words(name):  # not "License license"
                    t = t[:-1] if t[-2:] == ["license", "license"] or phrase.endswith("{} license") else t
                need = 1.0 if phrase[0] == "^" else MIN_COVER_SHORT if len(t) < SHORT else MIN_COVER
                out[family].append(Notice(t, named, phrase[0] == "^", need))
    for family, texts in GRANTS.items():
        for t in map(words, texts):
            named = frozenset(w for w in t if w.split("-")[0] == family)
            out[family].append(Notice(t, named, False, MIN_COVER_SHORT if len(t) < SHORT else MIN_COVER))
    return out


NOTICES = _notices()
# Names of families as single words; in a match of another family they deny it.
_OWN = {f: {w for n in ns for w in words(n) if w not in PLAIN_WORDS and not w[0].isdigit()} for f, ns in NAMES.items()}
_FOREIGN = {f: set().union(*(ws for g, ws in _OWN.items() if g != f)) - _OWN.get(f, set()) | DOUBT for f in FAMILIES[1:]}


def _anchors() -> frozenset:
    """Words of which every match that windows can find holds one: a word that names the licence, or of
    a notice without a name so many words that the others are fewer than a match needs, long ones first."""
    part = [n for ns in NOTICES.values() for n in ns if not n.whole]
    shared = Counter(w for n in part for w in set(n.words))
    out: set = set()
    for n in part:
        if n.named:
            out.add(max(n.named, key=lambda w: (w not in PLAIN_WORDS and not w[0].isdigit(), w in out, len(w), w)))
            continue
        left = len(n.words)
        for w in sorted(set(n.words), key=lambda w: (len(w) < 6, len(w) < 4, w not in out, shared[w] if len(w) < 6 else -shared[w], w)):
            if left < n.need * len(n.words):
                break
            left -= n.words.count(w)
            out.add(w)
    return frozenset(out)


ANCHORS = _anchors()


def cover(paragraph: list[str], family: str) -> tuple[float, int]:
    """The best share of a notice's words met in order in the paragraph, and that notice."""
    return max((_run(paragraph, n.words)[0] / len(n.words), k) for k, n in enumerate(NOTICES[family]))


def _run(ws: list[str], t: list[str]) -> tuple[int, int]:
    """Length of the longest common run of words, in order, and the place in ``ws`` where it ends."""
    row, best, end = [0] * (len(t) + 1), 0, 0
    for k, w in enumerate(ws, 1):
        before = 0
        for j, v in enumerate(t, 1):
            here = row[j]
            row[j] = before + 1 if v == w else max(here, row[j - 1])
            before = here
        if row[-1] > best:
            best, end = row[-1], k
    return best, end


def matches(ws: list[str], family: str):
    """``start, end, notice, share`` of the family's notices that stand in ``ws``."""
    denied = _FOREIGN[family]
    held = set(ws)
    for which, (t, named, whole, share) in enumerate(NOTICES[family]):
        if whole or not named <= held:
            continue
        need, reach, known = share * len(t), int(SPREAD * len(t)) + 1, set(t)
        if sum(1 for w in t if w in held) < need:
            continue
        against = denied - known
        places = [i for i, w in enumerate(ws) if w in known]
        k = 0
        while k < len(places):
            best = (0, 0, 0)
            first = places[k]
            while k < len(places) and places[k] < first + reach:  # the best start in reach of the first
                i = places[k]
                if len(known.intersection(ws[i:i + reach])) >= share * len(known):
                    n, end = _run(ws[i:i + reach], t)
                    if n >= need and (n, i) > best[:2] and named.issubset(ws[i:i + end]) \
                            and against.isdisjoint(ws[i:i + end]):
                        best = (n, i, i + end)
                elif best[0] == 0:
                    first = i + 1
                k += 1
            if best[0]:
                yield best[1], best[2], which, best[0] / len(t)
                while k > 0 and places[k - 1] >= best[2]:
                    k -= 1


def _denied(lines: list[str], line: int, word: int) -> bool:
    """Whether the sentence doubts or denies, before this word, what is said from there on."""
    text = lines[line].lower()
    start = next(islice(_WORD.finditer(text), word, None)).start()
    before = text[:start]
    if before.strip() or text[start].isalpha() and not lines[line].lstrip()[:1].isupper():  # it may begin on earlier lines
        for x in reversed(lines[max(0, line - 2):line]):
            if not x.strip():
                break
            before = f"{x.lower()} {before}"
    sentence = _NO_DOUBT.sub(" ", _SENTENCE.split(before)[-1])
    return not DOUBT.isdisjoint(words(sentence)[-LOOK_BACK:])


def _known(ws: list[str], family: str) -> bool:
    return any(n.whole and n.words == ws for n in NOTICES[family]) or next(matches(ws, family), None) is not None


_VERSION = re.compile(r"(?:^|[ v-])(\d(?:\.\d)?)(?= |-|$)")


def version(found: list[str], family: str) -> str | None:
    """The version that the matched words give, of families that have versions."""
    if family not in NAMES:
        return None
    got = _VERSION.search(" ".join(found))
    return got[1] if got else None


def line_span(lines: list[str], ls: list[list[str]], k: int, family: str, probability: float) -> dict:
    """The span of line ``k``, confirmed if a notice of its family stands in it."""
    ws = ls[k]
    found = [(share, a, b, which) for a, b, which, share in matches(ws, family) if not _denied(lines, k, a)]
    found += [(1.0, 0, len(ws), which) for which, n in enumerate(NOTICES[family]) if n.whole and n.words == ws]
    if found:
        share, a, b, which = max(found)
        return {"line": k, "family": family, "probability": probability, "confirmed": True, "notice": which, "cover": share,
                "version": version(ws[a:b + 4], family)}
    share, which = cover(ws, family)
    return {"line": k, "family": family, "probability": probability, "confirmed": False, "notice": which, "cover": share,
            "version": None}


def _chunks(texts: list[list[list[str]]]):
    """Words, their (text, line) and block ends, of at most ``WINDOW_WORDS`` words; the pieces of
    longer blocks overlap by more than a match is long."""
    over = 4 * max(WINDOWS[-1], *(len(n.words) for ns in NOTICES.values() for n in ns))
    ws, at, ends = [], [], []
    for d, lines in enumerate(texts):
        k = 0
        while k < len(lines):
            block, where = [], []
            while k < len(lines) and lines[k]:
                block += lines[k]
                where += [(d, k, i) for i in range(len(lines[k]))]
                k += 1
            k += 1
            if ANCHORS.isdisjoint(block):
                continue
            for a in range(0, max(len(block) - over, min(len(block), 1)), WINDOW_WORDS - over):
                piece = block[a:a + WINDOW_WORDS]
                if ws and len(ws) + len(piece) > WINDOW_WORDS:
                    yield ws, at, np.array(ends)
                    ws, at, ends = [], [], []
                ws.extend(piece)
                at.extend(where[a:a + WINDOW_WORDS])
                ends.append(len(ws))
    if ws:
        yield ws, at, np.array(ends)


def window_spans(raw: list[list[str]], texts: list[list[list[str]]], model: "Model", memo: dict) -> list[list[tuple]]:
    """Per text, the notices found by windows: ``share, probability, first, last, family, notice, version``
    with the (line, word) places of the first and last word, the best first."""
    out: list[set] = [set() for _ in texts]
    for ws, at, ends in _chunks(texts):
        regions: dict[tuple, list] = {}
        for a, b, f, p in sorted(model.window_hits(ws, ends, memo)):
            block = int(np.searchsorted(ends, a, side="right"))
            wide = int(SPREAD * max(len(n.words) for n in NOTICES[FAMILIES[f]])) + 1
            a, b = max(a - wide, int(ends[block - 1]) if block else 0), min(b + wide, int(ends[block]))
            found = regions.setdefault((block, f), [])
            if found and a <= found[-1][1]:
                found[-1][1:] = [max(b, found[-1][1]), max(p, found[-1][2])]
            else:
                found.append([a, b, p])
        for (_, f), found in regions.items():
            for a, b, p in found:
                for i, j, notice, share in matches(ws[a:b], FAMILIES[f]):
                    d, *first = at[a + i]
                    if not _denied(raw[d], *first):
                        out[d].add((share, p, tuple(first), at[a + j - 1][1:], FAMILIES[f], notice,
                                    version(ws[a + i:min(a + j + 4, b)], FAMILIES[f]) or ""))
    return [sorted(x, reverse=True) for x in out]


def _with_windows(found: list[dict], ls: list[list[str]], spans: list[tuple]) -> list[dict]:
    """The lines' spans together with the matches that overlap no confirmed one."""
    taken = [((x["line"], 0), (x["line"], len(ls[x["line"]]))) for x in found if x["confirmed"]]
    for share, p, first, last, family, notice, number in spans:
        if all(last < a or first > b for a, b in taken):
            taken.append((first, last))
            found = [x for x in found if x["confirmed"] or x["family"] != family or not first[0] <= x["line"] <= last[0]]
            found.append({"line": first[0], "family": family, "probability": p, "confirmed": True, "notice": notice,
                          "cover": share, "version": number or None})
    return sorted(found, key=lambda x: x["line"])


def _varied(rng, ws: list[str], filler: list[str], named: frozenset) -> list[str]:
    ws = [w for w in ws if w in named or rng.random() > 0.08] or ws[:1]
    if len(ws) > 12 and rng.random() < 0.5:  # a part of a long notice
        a = rng.integers(0, len(ws) // 2)
        ws = ws[a:a + max(8, len(ws) // 2)]
    if rng.random() < 0.4:
        ws = ["copyright", str(rng.integers(1990, 2030)), *rng.choice(filler, 2).tolist(), *ws]
    if rng.random() < 0.3:
        ws = ws + rng.choice(filler, rng.integers(1, 6)).tolist()
    return ws


def train(paragraphs: list[str], seed: int = 5) -> Model:
    """Fit on the notices and on ``paragraphs`` of the corpus (taken as unknown, unless a notice
    covers them)."""
    rng = np.random.default_rng(seed)
    memo: dict = {}
    vocabulary = sorted({w for ns in NOTICES.values() for n in ns for w in n.words})
    plain = [ws for ws in map(words, paragraphs) if ws]
    plain = [ws for ws in plain if len(ws) > 200 or ANCHORS.isdisjoint(ws) and len(ws) > 3
             or not any(_known(ws, f) for f in NOTICES)]
    filler = sorted({w for ws in plain[:500] for w in ws[:50]}) or ["the", "a", "example", "work", "team"]
    rows = [(ws, 0) for ws in plain]
    doubted = []
    for k, f in enumerate(FAMILIES[1:], 1):
        for n in NOTICES[f]:
            rows.append((n.words, k))
        grants = len(GRANTS.get(f, ()))
        for i in rng.permutation(FAMILY_ROWS):  # every second one of its longer notices, which come last
            n = NOTICES[f][-1 - i // 2 % grants] if grants and i % 2 else NOTICES[f][i % len(NOTICES[f])]
            rows.append((n.words if n.whole else _varied(rng, n.words, filler, n.named), k))
        doubted += [["this", "work", "is", "not", *NOTICES[f][1].words] if len(NOTICES[f]) > 1 else ["not", *NOTICES[f][0].words],
                    [*"we discussed whether the project should be".split(), *NOTICES[f][-1].words]] * 3
    n_known = len(rows) - len(plain)
    for _ in range(n_known // 3):  # words of notices in ordinary or scrambled company
        ws = rng.choice(vocabulary, rng.integers(1, 5)).tolist() + rng.choice(filler, rng.integers(6, 25)).tolist()
        rows.append((rng.permutation(ws).tolist(), 0))
    order = rng.permutation(len(rows))
    cal, fit = order[:len(rows) // 5], order[len(rows) // 5:]
    # denials are learnt, but the threshold is that of ordinary paragraphs: _denied tells them apart
    fit = np.concatenate([fit, np.arange(len(rows), len(rows) + len(doubted))])
    rows = rows + [(ws, 0) for ws in doubted]
    feats = []
    for ws, y in rows:
        g = _grams(_hashes(ws, memo), np.array([len(ws)]))
        feats.append((g, 1 / np.sqrt(len(g)), y))
    k = len(FAMILIES)
    w, acc = np.zeros(((1 << BITS) + 1, k), np.float32), np.full(((1 << BITS) + 1, 1), 1e-3, np.float32)
    bias = np.zeros(k)
    for _ in range(EPOCHS):
        for i in rng.permutation(fit):
            g, x, y = feats[i]
            z = w[g].sum(0) * x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            d = (p * x).astype(np.float32)
            acc[g] += float(d @ d)
            w[g] -= RATE * d / np.sqrt(acc[g]) + 1e-4 * w[g]
            bias -= 0.02 * p
    model = Model(w, bias, 0.5)
    model.weights[-1] = 0  # bucket -1: no pair
    unknown = [rows[i][0] for i in cal if rows[i][1] == 0]
    if unknown:
        p = np.sort(model.probabilities(unknown, memo)[:, 1:].max(1))
        model.needed = float(np.clip(p[int((1 - FALSE_SHARE) * (len(p) - 1))] + 0.02, 0.5, 0.9))
    return model


def fit_licenses(docs: DataFrame) -> Model:
    """Train with a bounded, fixed sample of the corpus's paragraphs: those of ``UNKNOWN_DOCS`` texts,
    of each its first ``MAX_CHARS`` characters."""
    texts = docs.where(F.col("text").isNotNull()).select(F.xxhash64("text").alias("_h"), "text")
    # hashes first, then the few texts: no whole text is sorted or sent before it is chosen
    chosen = materialise(texts.select("_h").distinct().orderBy("_h").limit(UNKNOWN_DOCS), "license-sample")
    some = (texts.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.min(F.substring("text", 1, MAX_CHARS)).alias("text"))
            .orderBy("_h").collect())
    lines = sorted({line for r in some for line in r.text.split("\n")}, key=lambda x: zlib.crc32(x.encode()))
    return train(lines[:UNKNOWN_ROWS])


_SPANS = "array<struct<line:int,family:string,probability:double,confirmed:boolean,notice:int,cover:double,version:string>>"


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``doc_id, n_paragraphs`` and ``spans``, the paragraphs of a licence family."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()),
                               ("confirmed", pa.bool_()), ("notice", pa.int32()), ("cover", pa.float64()),
                               ("version", pa.string())]))

    def run(batches):
        memo: dict = {}
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            for s in range(0, len(texts), 100):
                part = texts[s:s + 100]
                raw = [t.split("\n") if t else [] for t in part]
                lines = [[words(x) for x in r] for r in raw]
                flat = [p for ls in lines for p in ls]
                best, prob = m.predict(flat, memo)
                at, n, spans = 0, [], []
                wide = window_spans(raw, lines, m, memo)
                for d, ls in enumerate(lines):
                    found = [line_span(raw[d], ls, k, FAMILIES[f], float(prob[at + k, f]))
                             for k, f in enumerate(best[at:at + len(ls)].tolist()) if f]
                    n.append(sum(1 for p in ls if p))
                    spans.append(_with_windows(found, ls, wide[d]))
                    at += len(ls)
                yield pa.RecordBatch.from_arrays([b.column(0)[s:s + 100], pa.array(n, pa.int64()), pa.array(spans, span)],
                                                 names=["doc_id", "n_paragraphs", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, n_paragraphs long, spans {_SPANS}")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sure = F.filter("spans", lambda x: x["confirmed"])
    names = F.transform(sure, lambda x: F.concat_ws(" ", x["family"], x["version"]))
    return scan(docs, fit_licenses(docs)).select(
        "doc_id", "n_paragraphs", F.size(sure).cast("long").alias("n_licenses"),
        (F.size("spans") - F.size(sure)).cast("long").alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))), ",").alias("families"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("licenses"))
