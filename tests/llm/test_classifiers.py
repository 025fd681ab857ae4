"""Operators 2, 3 and 6: held-out accuracy, odd rows, no labels."""
import random
import textwrap
import zlib

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from topiclake.llm import licenses, quality, toxicity
from topiclake.llm.queries import QUERIES

from .conftest import prose

SF = SF_SMALL.replace("0.001", "0.01")
BOTH = [("op2_toxicity", "toxic", 0.5, toxicity), ("op3_quality", "quality", 0.3, quality)]


@pytest.mark.parametrize("name,label,cut,module", BOTH)
def test_held_out_accuracy(spark, name, label, cut, module):
    out = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    y = [(r.doc_id, r[label]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    test = [(out[i].predicted, v) for i, v in y if out[i].held_out]
    assert sum(p == v for p, v in test) >= 0.95 * len(test)


@pytest.mark.parametrize("name,label,cut,module", BOTH)
def test_odd_rows_and_missing_labels(spark, odd_docs, odd_rows, no_docs, name, label, cut, module):
    fit = getattr(module, f"fit_{label}" if label == "quality" else "fit_toxicity")
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    model = fit(odd_docs, none)
    assert module.score(odd_docs, model, "s").where("s between 0 and 1").count() == len(odd_rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 220)] + [(None, 1), (7, None), (7, 1), (7, 0)],
                                   f"doc_id long, {label} int")
    model = fit(odd_docs, labels)
    rows = module.score(odd_docs, model, "s").select("doc_id", "text", "s").collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.s <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert abs(by_text.setdefault(r.text, r.s) - r.s) < 1e-6  # equal texts score alike
    assert module.score(no_docs, model, "s").count() == 0


def test_toxic_words_of_each_language(spark):
    rng = random.Random(2)
    bad = ["grobulus", "snarfing"]
    sample = []
    for k in range(400):
        w = prose(rng, rng.randrange(10, 120)).split()
        if k % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        sample.append((" ".join(w), int(k % 4 == 0)))
    model = toxicity.train(sample)
    tests = [(prose(rng, 60) + (" " + rng.choice(bad).upper() + ", " if k % 2 else " ") + prose(rng, 2000), k % 2)
             for k in range(40)]
    got = model.score([t for t, _ in tests], {}) >= 0.5
    assert sum(g == bool(y) for g, (_, y) in zip(got, tests)) >= 37


def test_license_scan(spark, odd_docs, odd_rows, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = licenses.fit_licenses(docs)
    known = {"Licensed under CC BY-NC 4.0.": "cc-by-nc", "Released under the MIT License.": "mit",
             "This work is licensed under the GNU General Public License, version 3.": "gpl",
             "Licensed under the Apache License, Version 2.0.": "apache-2.0", "All rights reserved.": "all-rights-reserved"}
    for r in licenses.scan(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        want = [(k, known[x]) for k, x in enumerate(r.text.split("\n")) if x in known]
        assert [(s.line, s.family) for s in r.spans if s.confirmed] == want
    lines = ["Copyright 2024 J. Doe. Released under the MIT License.", "My driver's license expired in the general public",
             "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
             "Licensed under CC BY-SA 4.0.", "ordinary words about a version and a file of the work", ""]
    got = licenses.scan(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string"), model).first()
    assert [(s.line, s.family) for s in got.spans if s.confirmed] == [(0, "mit"), (2, "mpl"), (3, "cc-by-sa")]
    assert got.n_paragraphs == 5
    assert licenses.scan(odd_docs, model).count() == len(odd_rows)
    assert licenses.scan(no_docs, licenses.fit_licenses(no_docs)).count() == 0


def test_wrapped_and_unbroken_notices(spark):
    model = licenses.fit_licenses(spark.read.parquet(f"{SF}/documents.parquet"))
    rng = random.Random(11)
    notices = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
               "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "gpl": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
               "General Public License as published by the Free Software Foundation; either version 2 of the License",
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
               "provided that the following conditions are met:"}
    rows, want = [], {}
    for k, (family, n) in enumerate(notices.items()):
        wrapped = "\n".join(textwrap.wrap(n, 60))
        rows += [(3 * k, f"{prose(rng, 30)}\n\n{wrapped}\n\n{prose(rng, 30)}"),
                 (3 * k + 1, f"{prose(rng, 20)}\n{wrapped}\n{prose(rng, 20)}"),
                 (3 * k + 2, f"{prose(rng, 25_000)} {n} {prose(rng, 3000)}")]
        want |= {3 * k + i: [family] for i in range(3)}
    rows.append((99, prose(rng, 30_000)))
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert {r.doc_id: [s.family for s in r.spans if s.confirmed] for r in out} == {**want, 99: []}


# (paragraph, family, version): phrasings other than the notices the model learns from
HELD_OUT = [
    ("MIT License", "mit", None), ("License: MIT", "mit", None), ("// SPDX-License-Identifier: MIT", "mit", None),
    ("SPDX-License-Identifier: GPL-2.0-only", "gpl", "2.0"), ("Licensed under the GPLv3", "gpl", "3"),
    ("Distributed under the Apache 2.0 license", "apache-2.0", "2.0"),
    ("You may use it, as it is licensed under the Apache License, Version 2.0 by its authors.", "apache-2.0", "2.0"),
    ("Creative Commons Attribution-ShareAlike License 4.0", "cc-by-sa", "4.0"),
    ("Except where otherwise noted, this work is licensed under CC BY 4.0.", "cc-by", "4.0"),
    ("The images are licensed under CC BY-NC-SA 4.0 by the museum.", "cc-by-nc-sa", "4.0"),
    ("Code released under the New BSD license.", "bsd", None),
    ("This library is distributed under the GNU Lesser General Public License, version 3.", "lgpl", "3"),
    ("I did not like it. Released under the MIT License.", "mit", None),
    ("This program is made available under the terms of the Eclipse Public License 2.0 which accompanies it", "epl", "2.0"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event shall the authors be held "
     "liable for any damages arising from use of this software.", "zlib", None),
    ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies.", "isc", None),
    ("The server is available under the terms of the GNU Affero General Public License version 3.", "agpl", "3"),
    ("The fonts are licensed under the SIL Open Font License 1.1", "ofl", "1.1"),
    ("This database is licensed under the PostgreSQL License.", "postgresql", None)]
NO_LICENCE = [
    "This work is NOT licensed under the MIT license", "It isn't available under the terms of the GPL.",
    "We discussed whether the project should be released under the MIT license or not",
    "The old code was never released under the GNU General Public License, version 2.",
    "My driver's license expired in the general public", "We read about the MIT campus and its library",
    "They asked whether it would be licensed\nunder CC BY 4.0 in the next year"]


@pytest.fixture(scope="module")
def license_model(spark):
    return licenses.fit_licenses(spark.read.parquet(f"{SF}/documents.parquet"))


def test_held_out_phrasings_denials_and_versions(spark, license_model):
    rng = random.Random(3)
    texts = [x for x, _, _ in HELD_OUT] + NO_LICENCE
    rows = [(i, f"{prose(rng, 15)}\n{x}\n{prose(rng, 15)}") for i, x in enumerate(texts)]
    rows += [(100 + i, prose(rng, 80)) for i in range(100)]
    out = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), license_model).collect()
    got = {r.doc_id: [(s.family, s.version) for s in r.spans if s.confirmed] for r in out}
    hits = sum(got[i] == [(f, v)] for i, (_, f, v) in enumerate(HELD_OUT))
    assert hits >= 0.9 * len(HELD_OUT)
    assert [i for i in range(len(HELD_OUT), len(texts)) if got[i]] == []
    assert all(not got[100 + i] for i in range(100))


def _best_in_order(ws, t):
    """Longest common subsequence, by the textbook table."""
    table = [[0] * (len(t) + 1) for _ in range(len(ws) + 1)]
    for i, w in enumerate(ws):
        for j, v in enumerate(t):
            table[i + 1][j + 1] = table[i][j] + 1 if w == v else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_notices_by_brute_force_alignment():
    """Every notice in other words' company: matches say what an alignment of every stretch says,
    and every match holds an anchor."""
    rng = random.Random(5)
    for family, notices in licenses.NOTICES.items():
        for which, n in enumerate(notices):
            if n.whole or which % 5:
                continue
            ws = [w for w in n.words if w in n.named or rng.random() > 0.1]
            ws = prose(rng, 6).split() + ws + prose(rng, 6).split()
            reach = int(licenses.SPREAD * len(n.words)) + 1
            best = max((_best_in_order(ws[i:i + reach], n.words) for i in range(len(ws))), default=0)
            got = [share for _, _, k, share in licenses.matches(ws, family) if k == which]
            assert bool(got) == (best >= n.need * len(n.words)), (family, n, ws)
            if got:
                assert max(got) == best / len(n.words)
                assert not licenses.ANCHORS.isdisjoint(ws)


def test_samples_come_from_documents_that_exist(spark):
    """Long texts take part, labels of other documents don't crowd out those of these."""
    from topiclake.llm.common import held_out, labelled_sample
    labels = spark.range(100_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    docs = spark.range(60).select((F.col("id") * 1000 + F.col("id") % 2).alias("doc_id"),
                                  F.repeat(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit(" ")), 5000).alias("text"))
    held = docs.where(held_out(F.col("doc_id"))).count()
    got = labelled_sample(docs.union(docs), labels, "toxic", 100, 20_000)
    assert len(got) == 60 - held and {y for _, y in got} == {0, 1} and {len(t) for t, _ in got} == {20_000}
    assert len(labelled_sample(docs, labels, "toxic", 5, 20_000)) == 10
    with pytest.warns(RuntimeWarning, match="no text here"):
        assert labelled_sample(docs.withColumn("doc_id", F.lit(None).cast("long")), labels, "toxic", 5, 100) == []
    assert labelled_sample(docs, labels.limit(0), "toxic", 5, 100) == []
