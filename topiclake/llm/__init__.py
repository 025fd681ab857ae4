"""Training-data operators on Spark: quality, toxicity, dedup, packing, archives, extraction.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it; the query catalogue
``topiclake.llm.queries`` is added to the entry module only when this package is present.
"""
