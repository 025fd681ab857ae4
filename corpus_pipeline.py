"""A corpus pipeline over ``documents``: toxicity, quality, near duplicates, benchmark, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. The
first four return the columns of ``documents``; the last returns packed pieces. ``run`` writes
every stage's result as Parquet in the shared folder and reads it back for the next.

A null or empty text is scored by the classifiers' bias, is no near duplicate and holds no
benchmark window; repeated rows are near duplicates of each other, so one of them stays; an
empty table goes through all stages; extra columns stay until packing, whatever their names (helper
columns take names that are free); a very long text is scored, compared and packed whole; of documents
that tie in a group of near duplicates the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topiclake.llm import decontaminate, near_join, packing, quality, toxicity
from topiclake.llm.common import fresh_name, materialise, table
from topiclake.llm.tokens import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic (0.5 or more) go."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    name = fresh_name(docs, "_toxicity")
    return toxicity.score(docs, model, name).where(F.col(name) < 0.5).select(*docs.columns)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored of poor quality (under 0.3) go."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    name = fresh_name(docs, "_quality")
    return quality.score(docs, model, name).where(F.col(name) >= quality.CUT).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked documents stays."""
    return near_join.one_per_component(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# Trained models, tokenizers and packing are not SQL: the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
