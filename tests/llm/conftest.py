import random

import duckdb
import pytest


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row long, items string"
VOCAB = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in ("ra", "to", "lin", "sk", "mo")]


def prose(rng, n):
    return " ".join(rng.choice(VOCAB) + (rng.choice(VOCAB) if rng.random() < 0.7 else "") for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and white texts, a very long text, exact and near copies,
    repeated rows and ids, and columns whose names clash with the operators' own."""
    rng = random.Random(4)
    long = prose(rng, 30_000)
    base = prose(rng, 150)
    words = base.split()
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one two"), (5, "One TWO"), (6, long), (7, base), (8, base),
            (8, base), (8, base + " tail"), (None, base), (None, None), (9, "a b c d"), (10, "a b c d e"),
            (11, "é ß ñ \x85 x y z #*$ 日本 語 ' \" <b>"), (12, "same line here\n" * 40)]
    for k in range(25):  # a group of near copies, from one word changed to many
        w = list(words)
        for _ in range(k % 7):
            w[rng.randrange(len(w))] = rng.choice(VOCAB) + "x"
        rows.append((100 + k, " ".join(w)))
    for k in range(20):
        rows.append((200 + k, prose(rng, rng.randrange(1, 80))))
    return [(i, t, None if i == 4 else "en", None if i in (5, 8) else f"src{(i or 0) % 2}", None, 0.5, 1, "x")
            for i, t in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOC_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def duck():
    def run(sql, **tables):
        con = duckdb.connect()
        for name, t in tables.items():
            if isinstance(t, str):
                con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{t}'")
            else:
                con.register(name, t)
        return con.execute(sql).df()
    return run
