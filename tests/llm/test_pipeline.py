"""The pipeline's stages against their operators and brute force, on odd and given rows."""
import pytest
from conftest import SF_SMALL

import corpus_pipeline
from topiclake.llm import decontaminate
from topiclake.llm.common import materialise, table

from .test_near_join import brute


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, SF_SMALL), name)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_filter_whole_rows(stages):
    names = [n for n, _, _ in stages]
    assert names == ["toxicity", "quality", "near_duplicates", "decontamination", "packing"]
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert after.exceptAll(before).count() == 0 and 0 < after.count() <= before.count()


def test_near_duplicates_leave_one_of_each_component(stages):
    _, before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
    assert {r.doc_id for r in after.collect()} == {c for _, _, c in brute(rows)}


def test_no_benchmark_window_is_left(spark, stages):
    _, before, after = stages[3]
    bench = table(spark, SF_SMALL, "benchmark")
    hit = {r.doc_id for r in decontaminate.contamination(before, bench).where("n_hit > 0").collect()}
    assert {r.doc_id for r in before.collect()} - hit == {r.doc_id for r in after.collect()}


def test_packing_covers_the_rest(stages):
    _, before, after = stages[4]
    rows = after.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}
    use = {}
    for r in rows:
        use.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for v in use.values():
        assert sum(n for _, n in v) <= 2048 and sorted(v)[0][0] == 0


def test_odd_rows_go_through(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, docs, SF_SMALL), name)
            if name != "packing":
                assert out.columns == docs.columns and out.count() <= n
                docs = out


def test_columns_that_are_named_like_helpers_stay(spark, odd_docs):
    from pyspark.sql import functions as F
    names = ["_toxicity", "_quality", "_row_id", "_row_th", "_gone_id", "root"]
    docs = odd_docs.withColumns({c: F.lit(7.0) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF_SMALL), name)
        assert docs.count() > 0 and docs.where(" OR ".join(f"{c} <> 7.0" for c in names)).count() == 0
