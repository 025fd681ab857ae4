"""Operators 1 and 10 against their SQL twins, on the given tables and on odd rows."""
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from topiclake.llm import decontaminate, line_frequency
from topiclake.llm.queries import ORACLES, QUERIES

from .helpers import rows_of

TABLES = {n: f"{SF_SMALL}/{n}.parquet" for n in ("documents", "benchmark", "pages", "embeddings")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF_SMALL).toPandas(), duck(ORACLES[name], **TABLES)
    assert sorted(ours.columns) == sorted(theirs.columns)
    cols = sorted(ours.columns)
    assert rows_of(ours, cols) == rows_of(theirs, cols) and len(ours)


def test_line_rules_on_odd_rows(odd_docs, odd_rows, duck):
    ours = line_frequency.line_rules(odd_docs).toPandas()
    docs = pd.DataFrame([(r[0], r[1], r[3]) for r in odd_rows], columns=["doc_id", "text", "source"])
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    theirs = duck(line_frequency.OP1_SQL, documents=docs)
    cols = sorted(theirs.columns)
    assert rows_of(ours, cols) == rows_of(theirs, cols)
    assert len(ours) == len(odd_rows)


def test_frequent_lines_are_removed_but_copies_are_one_document(spark):
    menu = "Home | About | Contact 1"
    rows = [(i, f"{menu}\nown words of document number {'abcdefghijklmnopqrstuvwxyz'[i]} " + "w" * i, "h")
            for i in range(20)]
    rows += [(100 + i, menu.replace("1", str(i)) + "\nshort", "h") for i in range(9)]
    rows += [(200 + i, "a copied text of some words\nwith two lines", "h") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in line_frequency.line_rules(docs, with_text=True, min_kept=0.3).collect()}
    assert all(out[i].n_removed_lines == 1 and menu not in out[i].clean_text for i in range(20))
    assert all(out[200 + i].n_removed_lines == 0 for i in range(50))  # one content, 50 copies
    assert all(not out[100 + i].kept for i in range(9))


def same_as_sql(docs, duck):
    """The operator's rows, after comparing them with the registered SQL."""
    got = line_frequency.line_rules(docs).toPandas()
    want = duck(line_frequency.OP1_SQL, documents=docs.toPandas())
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert rows_of(got, cols) == rows_of(want, cols)
    return got.itertuples(index=False)


def test_texts_that_differ_only_in_digits_or_case_are_documents(spark, duck):
    form = "Dear customer, your order number {0:05d} was sent.\nThank you for buying with us, {1}."
    rows = [(i, form.format(i, "Ann" if i % 2 else "ANN"), "h") for i in range(30)]
    rows += [(100 + i, form.format(7, "Bob"), "g") for i in range(30)]  # exact copies: one document
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in same_as_sql(docs, duck)}
    assert all(out[i].n_removed_lines == 2 and not out[i].kept for i in range(30))
    assert all(out[100 + i].n_removed_lines == 0 for i in range(30))


def test_line_limit_does_not_grow_with_the_host(spark, duck):
    planted = [(i, f"read our terms before use\nown words of text number {i}", "h") for i in range(12)]
    docs = spark.createDataFrame(planted, "doc_id long, text string, source string")
    letters = F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")  # digits would be folded
    clean = spark.range(1000, 31_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("clean "), letters).alias("text"),
                                             F.lit("h").alias("source"))
    for d in (docs, docs.union(clean)):
        out = [r for r in same_as_sql(d, duck) if r.n_removed_lines > 0]
        assert sorted((r.doc_id, r.n_removed_lines) for r in out) == [(i, 1) for i in range(12)]


def test_bitmap_follows_the_benchmark():
    assert decontaminate.bloom_bits(0) == decontaminate.MIN_BLOOM_BITS
    for n in (1_000, 100_000, 1_000_000):
        share = (2 * n / 2 ** decontaminate.bloom_bits(n))  # of all bits that are set, at most
        assert share <= 2 / decontaminate.BITS_PER_SHINGLE
    assert decontaminate.bloom_bits(3_000_000) is None


@pytest.mark.parametrize("largest", [24, 0])
def test_decontamination_on_odd_rows(spark, odd_docs, odd_rows, duck, monkeypatch, largest):
    """With a bitmap, and beyond the largest one by the semi-join."""
    monkeypatch.setattr(decontaminate, "MAX_BLOOM_BITS", largest)
    by_id = {r[0]: r[1] for r in odd_rows}
    long = by_id[6].split()
    items = [(1, " ".join(long[100:130])), (2, "ONE two"), (3, "a"), (4, None), (5, ""), (None, "b c"), (6, "é ß"),
             (7, " ".join(long[110:120])), (7, " ".join(long[110:120])), (8, "same line here same line here"),
             (9, "never met words at all in here or there or anywhere")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    ours = decontaminate.contamination(odd_docs, bench).toPandas()
    docs = pd.DataFrame([(r[0], r[1]) for r in odd_rows], columns=["doc_id", "text"])
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    b = pd.DataFrame(items, columns=["item_id", "text"])
    b["item_id"] = b["item_id"].astype("Int64")
    theirs = duck(decontaminate.OP10_SQL, documents=docs, benchmark=b)
    ours["n_items"] = ours["items"].map(len)
    cols = ["doc_id", "n_hit", "n_items", "n_words"]
    assert rows_of(ours, cols) == rows_of(theirs, cols)
    assert (ours["n_hit"] > 0).sum() >= 5


def test_empty_tables(spark, no_docs, odd_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert line_frequency.line_rules(no_docs).count() == 0
    assert decontaminate.contamination(no_docs, bench).count() == 0
    assert decontaminate.contamination(odd_docs, bench).where("n_hit > 0").count() == 0


def test_native_plans_run_no_python(spark):
    for name in ("op1_line_frequency", "op10_decontamination"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
