"""Operator 1 (native): quality rules with cross-document line frequency.

Base rules count words, symbols, repeated lines and words in repeated 8-word windows of
each text. The line rule hashes every normalised line (A-Z lower-cased, digits as 0, white
space runs as one space), counts the distinct documents of a host that hold it, removes the
lines above the limit, and rejects documents that removal depletes. Exact copies (equal raw
texts) are one document in these counts, so a group of them does not deplete itself; texts
that differ anywhere, if only in a digit, in case or in white space, are different documents.

DataFrame functions only. One pass over the texts writes per-row counts and line hashes;
all else reads that small table.

Defined results: a null text has no words and no lines (all counts 0, ``base_failed``); a
null host counts as the empty host; repeated rows and null ids get a row each; an empty
table gives no rows; extra columns are ignored.

Scale: distinct contents are found by partial aggregation on (host, content), lines by
partial aggregation on (host, line): a line or host with a third of all rows is combined
in each task before the shuffle. Only lines above the limit are joined back, by broadcast
when a count proves them small, else by a shuffle join that Spark may split. A row's
windows stay inside its row, as hashes.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_checked, let, materialise, table, total

SPACE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MAX_DOCS = 10  # a line in more distinct documents of its host is removed, however large the host
MIN_KEPT = 0.2  # documents keeping less of their word characters are rejected

_FOLD_FROM = string.ascii_uppercase + "123456789"
_FOLD_TO = string.ascii_lowercase + "0" * 9


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def normal_line(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, _FOLD_FROM, _FOLD_TO), "[\\x20\\x09-\\x0D]+", " "))


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more: sort (hash, place), keep places with
    an equal neighbour, and add up the stretch each adds."""

    def places(e: Column) -> Column:
        def twice(x: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(e, k - 1)["h"] == x["h"])
            return F.coalesce(before, F.lit(False)) | F.coalesce(F.get(e, k + 1)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(e, twice), lambda x: x["i"]))

    def stretch(p: Column) -> Column:
        return total(F.transform(p, lambda x, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))).cast("long")))

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(F.sort_array(pairs), lambda e: let(places(e), stretch))


def repeated_words(hashes: Column) -> Column:
    """Of an array of word hashes: words in windows that the text has twice or more."""
    def of(h: Column) -> Column:
        wins = F.when(F.size(h) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))
        return let(wins, lambda w: F.when(w.isNull() | (F.size(F.array_distinct(w)) == F.size(w)),
                                          F.lit(0).cast("long")).otherwise(_covered(w)))
    return let(hashes, of)


def features(docs: DataFrame, host_col: str = "source", with_text: bool = False) -> DataFrame:
    """The written per-row table: base counts, hash of the raw text and line hashes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def counted(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        repeated_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words"))

    def lined(ls: Column) -> Column:
        return F.struct(
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            F.transform(ls, lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"),
                                               F.length(_without(x, SPACE)).alias("chars"))).alias("lines"))

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_without(x, SPACE)) > 0)
    cols = [F.col("doc_id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
            F.xxhash64(text).alias("content"), let(words(text), counted).alias("w"), let(lines, lined).alias("l"),
            F.length(_without(text, SPACE)).cast("long").alias("word_chars"),
            (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols")]
    if with_text:
        cols.append(F.col("text"))
    f = docs.select(*cols).select("doc_id", "host", "content", "w.*", "l.*", "word_chars", "n_symbols", *(["text"] * with_text))
    f = f.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "row": F.monotonically_increasing_id()})
    return materialise(f, "line-features")


def frequent_lines(feats: DataFrame, max_docs: int = MAX_DOCS, max_share: float | None = None) -> DataFrame:
    """``host, h, n_docs`` of the lines above their host's limit: ``max_docs`` documents, or with
    ``max_share`` that share of the host's documents where it is less."""
    contents = feats.groupBy("host", "content").agg(
        F.first(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("hs"))
    contents = materialise(contents, "line-contents")
    counts = (contents.select("host", F.explode("hs").alias("h")).groupBy("host", "h")
              .agg(F.count(F.lit(1)).alias("n_docs")))
    if max_share is None:
        counts = counts.where(F.col("n_docs") > max_docs)
    else:
        hosts = materialise(contents.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs")), "line-hosts")
        limit = F.least(F.lit(float(max_docs)), F.lit(max_share) * F.col("host_docs"))
        counts = counts.join(broadcast_checked(hosts), "host").where(F.col("n_docs") > limit)
    return materialise(counts.select("host", "h", "n_docs"), "frequent-lines")


def line_rules(docs: DataFrame, host_col: str = "source", max_docs: int = MAX_DOCS, max_share: float | None = None,
               min_kept: float = MIN_KEPT, with_text: bool = False) -> DataFrame:
    """Base counts, removed lines and verdict of every row; with ``with_text`` also the text
    without its removed lines (``clean_text``)."""
    feats = features(docs, host_col, with_text)
    frequent = frequent_lines(feats, max_docs, max_share)
    held = (feats.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.*")
            .join(broadcast_checked(frequent.select("host", "h")), ["host", "h"]))
    gone = held.groupBy("row").agg(F.count(F.lit(1)).alias("n_removed_lines"),
                                   F.sum("chars").cast("long").alias("removed_chars"),
                                   *([F.collect_set("h").alias("removed")] * with_text))
    out = feats.join(gone, "row", "left").withColumns({
        "n_removed_lines": F.coalesce("n_removed_lines", F.lit(0)).cast("long"),
        "removed_chars": F.coalesce("removed_chars", F.lit(0)).cast("long")})
    depleted = (F.col("word_chars") - F.col("removed_chars")) < F.lit(min_kept) * F.col("word_chars")
    out = out.withColumn("kept", ~F.col("base_failed") & ~depleted)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "n_removed_lines", "removed_chars", "kept"]
    if with_text:
        stay = F.filter(F.split("text", "\n"), lambda x: F.col("removed").isNull() | ~F.array_contains(
            F.col("removed"), F.xxhash64(normal_line(x))))
        out = out.withColumn("clean_text", F.array_join(stay, "\n"))
        cols.append("clean_text")
    return out.select(*cols)


def op1_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(table(spark, sf_dir, "documents"))


OP1_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t
           FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM t),
win AS (SELECT rid, i, list_slice(ws, i, i + 7) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c >= 2),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM dup) GROUP BY 1),
ln AS (SELECT rid, host, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
         trim(regexp_replace(translate(line, '{_FOLD_FROM}', '{_FOLD_TO}'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
       FROM (SELECT rid, host, unnest(string_split(t, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dl AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY 1),
freq AS (SELECT host, norm FROM ln JOIN t USING (rid, host)
         GROUP BY host, norm HAVING count(DISTINCT t.t) > {MAX_DOCS}),
gone AS (SELECT rid, count(*) AS n, sum(chars) AS chars FROM ln JOIN freq USING (host, norm) GROUP BY 1),
f AS (SELECT w.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dl.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(gone.n, 0) AS BIGINT) AS n_removed_lines, CAST(coalesce(gone.chars, 0) AS BIGINT) AS removed_chars
      FROM w LEFT JOIN dl USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, n_removed_lines, removed_chars,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND NOT (word_chars - removed_chars < {MIN_KEPT} * word_chars) AS kept
FROM f
"""
