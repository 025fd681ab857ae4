"""Operator 10 (native): benchmark decontamination by a prefix-filtered set join.

Every window of ``window`` consecutive item words (a shorter item is one window) is the
set of its word shingles with their places. A document holds the window exactly where it
holds all of them in sequence, so it must hold the window's rarest shingle: that one is
the window's necessary prefix. The join

1. scans the texts once and writes each document's shingles that the benchmark has at all
   (a Bloom bitmap of the benchmark's shingles goes to the scan, sized by their counted number;
   its false hits end at the exact joins below; beyond about a million shingles, where the
   bitmap would be over 2 MB, the scan writes all shingles and a semi-join keeps the known);
2. counts every benchmark shingle over all documents and orders each window's shingles by
   that rarity; windows whose rarest shingle occurs nowhere are gone;
3. joins documents and windows on the prefix shingle alone, with the length bound (the
   window must fit into the document) and the positional bound (the shingle's place in
   the window fixes the start, and the neighbours must be consecutive words);
4. verifies the whole window, shingle by shingle in place, and marks the words hit.

DataFrame functions only; shingles are 64-bit hashes of their words.

Defined results: null or wordless texts have no words, windows or hits; items with a null
id are left out; repeated items count once; very long texts are scanned whole; repeated documents and null ids get a row
each; empty tables give no rows, or rows without hits; extra columns are ignored.

Scale: documents are not shuffled, only their few benchmark shingles; counts combine in
the tasks first; the prefix table is broadcast only when a count proves it small, else a
shuffle join runs, in which Spark may split a hot shingle; marks are grouped per document,
whose number is bounded by its own words.
"""

from __future__ import annotations

import functools
import json
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_checked, let, materialise, table, total, without

WINDOW = 10
SHINGLE = 3
MIN_BLOOM_BITS, MAX_BLOOM_BITS = 12, 24
BITS_PER_SHINGLE = 16  # with two probes, one other shingle in 70 gets through
_SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(low, _SEPARATORS), lambda w: w != "")


def _shingles(h: Column, k) -> Column:
    """Hashes of the ``k``-word shingles of an array of word hashes, in order."""
    if k == 1:
        return h
    return F.when(F.size(h) >= k, F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(
        *[F.get(h, i + j) for j in range(k)]))).otherwise(F.array().cast("array<bigint>"))


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def windows(bench: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Distinct windows: ``wid, len, k, seq`` (shingle hashes in order) and ``items``."""
    w = bench.where(F.col("item_id").isNotNull()).select("item_id", _word_hashes(F.col("text")).alias("h"))
    w = w.where(F.size("h") > 0).withColumn("len", F.least(F.size("h"), F.lit(window)))
    w = w.select("item_id", "len", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("h") - F.col("len") + 1), lambda i: F.slice("h", i, F.col("len")))).alias("h"))
    w = w.withColumn("k", F.least("len", F.lit(shingle)))
    seq = F.col("h")
    for k in range(2, shingle + 1):
        seq = F.when(F.col("k") == k, _shingles(F.col("h"), k)).otherwise(seq)
    w = w.withColumn("seq", seq)
    return w.groupBy("len", "k", "seq").agg(F.collect_set("item_id").alias("items")).withColumn(
        "wid", F.xxhash64("len", "seq"))


def bloom_bits(n_shingles: int) -> int | None:
    """Bitmap size (a power of two) for so many shingles; None where the largest is too small."""
    bits = max(MIN_BLOOM_BITS, (max(n_shingles, 1) * BITS_PER_SHINGLE - 1).bit_length())
    return bits if bits <= MAX_BLOOM_BITS else None


def _probes(h: Column, bits: int) -> tuple[Column, Column]:
    mask = F.lit((1 << bits) - 1).cast("long")
    return h.bitwiseAND(mask), F.shiftrightunsigned(h, 64 - bits)


def _bloom(shingles: DataFrame, bits: int) -> str:
    """The bitmap as JSON text of ``2**bits / 64`` longs, at most ``2**MAX_BLOOM_BITS / 64``."""
    a, b = _probes(F.col("sh"), bits)
    slots = shingles.select(F.explode(F.array(a, b)).alias("p")).groupBy(F.shiftright("p", 6).alias("slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int")))
        .alias("bits"))
    full = [0] * (1 << bits - 6)
    for r in slots.collect():
        full[r.slot] = r.bits
    return json.dumps(full)


def _known_only(found: DataFrame, k: int, shingles: DataFrame) -> DataFrame:
    """``found`` with only those of its ``k``-word shingles that the benchmark has: the way for
    benchmarks beyond the largest bitmap, a join of shingles that are gathered per row again."""
    name = f"s{k}"
    x = found.select("row", F.explode(name).alias("x")).select("row", "x.pos", "x.sh")
    x = x.join(broadcast_checked(shingles), "sh", "left_semi")
    x = x.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "sh"))).alias("_known"))
    return (found.join(x, "row", "left")
            .withColumn(name, F.coalesce("_known", F.slice(name, 1, 0))).drop("_known"))


def _document_shingles(docs: DataFrame, shingles: dict[int, DataFrame], sizes: dict[int, int | None]) -> DataFrame:
    """The one scan: per row ``row, doc_id, n_words`` and, per shingle size, the places and
    hashes of shingles that the size's bitmap lets through, or that the benchmark has."""

    def hits(h: Column, k: int) -> Column:
        placed = F.transform(_shingles(h, k), lambda s, i: F.struct(i.alias("pos"), s.alias("sh")))
        if sizes[k] is None:
            return placed
        bitmap = F.from_json(F.lit(_bloom(shingles[k], sizes[k])), "array<bigint>")

        def known(x: Column) -> Column:
            bits = [F.getbit(F.get(bitmap, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
                    for p in _probes(x["sh"], sizes[k])]
            return bits[0] & bits[1]
        return F.filter(placed, known)

    def scan(h: Column) -> Column:
        return F.struct(F.size(h).cast("long").alias("n_words"), *[hits(h, k).alias(f"s{k}") for k in sizes])

    out = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("th"),
                      let(_word_hashes(F.col("text")), scan).alias("x")).select("doc_id", "th", "x.*")
    found = materialise(out.withColumn("row", F.monotonically_increasing_id()), "bench-shingles")
    large = [k for k in sizes if sizes[k] is None]
    if not large:
        return found
    return materialise(functools.reduce(lambda f, k: _known_only(f, k, shingles[k]), large, found), "known-shingles")


def _with_neighbours(hits: Column, pad: Column, reach: int) -> Column:
    """Every hit with the ``reach`` hits before and behind it (padded at the ends)."""
    return let(F.concat(pad, hits, pad), lambda p: F.transform(hits, lambda x, i: F.struct(
        x["pos"].alias("pos"), x["sh"].alias("sh"), F.slice(p, i + 1, 2 * reach + 1).alias("near"))))


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, th`` (the text's hash), ``n_words, n_hit, spans`` (merged
    ``start, len`` in words) and ``items`` (sorted as strings)."""
    wins = materialise(windows(bench, window, shingle), "bench-windows")
    sizes = sorted(r.k for r in wins.select("k").distinct().collect())  # at most ``shingle`` values
    placed = wins.select("wid", "len", "k", "seq", F.posexplode("seq").alias("o", "sh"))
    shingles = {k: materialise(placed.where(F.col("k") == k).select("sh").distinct(), "bench-known") for k in sizes}
    found = _document_shingles(docs, shingles, {k: bloom_bits(shingles[k].count()) for k in sizes})
    if not sizes:
        return found.select("doc_id", "th", "n_words", F.lit(0).cast("long").alias("n_hit"),
                            F.array().cast("array<struct<start:int,len:int>>").alias("spans"),
                            F.array().cast("array<string>").alias("items"))
    # rarity of every benchmark shingle over all documents
    hits = None
    for k in sizes:
        part = found.select(F.lit(k).alias("k"), F.explode(f"s{k}").alias("x")).select("k", F.col("x.sh").alias("sh"))
        hits = part if hits is None else hits.unionByName(part)
    counts = hits.groupBy("k", "sh").agg(F.count(F.lit(1)).alias("n"))
    rarity = placed.select("k", "sh").distinct().join(counts, ["k", "sh"])
    prefix = (placed.join(rarity, ["k", "sh"], "left")
              .groupBy("wid", "len", "k", "seq")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "sh", "o")).alias("p"))
              .where("p.n > 0").select("wid", "len", "k", "seq", "p.sh", "p.o"))
    prefix = materialise(prefix, "bench-prefixes")
    prefix = broadcast_checked(prefix)
    reach = window  # neighbours on each side that a window can need
    marks = None
    for k in sizes:
        pad = F.array_repeat(F.struct(F.lit(-1).alias("pos"), F.lit(0).cast("long").alias("sh")), reach)
        near = _with_neighbours(F.col(f"s{k}"), pad, reach)
        cand = found.where(F.size(f"s{k}") > 0).select("row", "n_words", F.explode(near).alias("x")).select(
            "row", "n_words", "x.*")
        j = cand.join(prefix.where(F.col("k") == k), "sh")
        m = F.size("seq")
        start = F.col("pos") - F.col("o")
        body = F.slice("near", reach + 1 - F.col("o"), m)
        fits = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
        in_row = (F.get(body, F.lit(0))["pos"] == start) & (F.get(body, m - 1)["pos"] == start + m - 1)
        same = F.transform(body, lambda x: x["sh"]) == F.col("seq")
        part = j.where(fits & in_row & same).select("row", "wid", start.alias("start"), "len")
        marks = part if marks is None else marks.unionByName(part)
    items = marks.join(broadcast_checked(wins.select("wid", "items")), "wid")
    per_row = items.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "len"))).alias("m"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.transform("items", lambda x: x.cast("string"))))))
        .alias("items"))
    # occurrences in order of their start, all of about one length: what each adds behind the last end
    ends = F.transform("m", lambda x: x["start"] + x["len"])
    spans = let(F.struct(F.col("m").alias("m"), ends.alias("e")), lambda s: F.aggregate(
        s["m"], F.array().cast("array<struct<start:int,len:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] <= F.element_at(acc, -1)["start"] + F.element_at(acc, -1)["len"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                (F.greatest(F.element_at(acc, -1)["start"] + F.element_at(acc, -1)["len"], x["start"] + x["len"])
                 - F.element_at(acc, -1)["start"]).alias("len")))))
        .otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["len"].alias("len")))))))
    per_row = per_row.withColumn("spans", spans).select("row", "items", "spans")
    empty_items, empty_spans = F.array().cast("array<string>"), F.array().cast("array<struct<start:int,len:int>>")
    return (found.select("row", "doc_id", "th", "n_words").join(per_row, "row", "left")
            .select("doc_id", "th", "n_words", total(F.transform(F.coalesce("spans", empty_spans),
                                                           lambda x: x["len"].cast("long"))).alias("n_hit"),
                    F.coalesce("spans", empty_spans).alias("spans"), F.coalesce("items", empty_items).alias("items")))


def clean_documents(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    hit = contamination(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bench)
    return without(docs, hit.where("n_hit > 0"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return c.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


_W = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(
    string.ascii_uppercase, string.ascii_lowercase)
OP10_SQL = f"""
WITH b AS (SELECT item_id, {_W} AS ws FROM benchmark WHERE item_id IS NOT NULL),
bl AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS n FROM b WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, n, list_slice(ws, i, i + n - 1) AS g
       FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM bl)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {_W} AS ws FROM documents),
ln AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, list_slice(ws, i, i + n - 1) AS g
       FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, ln WHERE len(ws) >= n)),
hit AS (SELECT dw.rid, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
nh AS (SELECT rid, count(DISTINCT p) AS c FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
it AS (SELECT rid, count(*) AS c, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(nh.c, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(it.c, 0) AS BIGINT) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
  coalesce(nh.c, 0) > 0 AS contaminated
FROM d LEFT JOIN nh USING (rid) LEFT JOIN it USING (rid)
"""
