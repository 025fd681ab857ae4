"""JSON Schema validation as data: values joined to schema nodes, level by level.

Every row names its own schema. The distinct schemas are compiled to a table of nodes inside
tasks (:mod:`topiclake.functions.schema_nodes`); neither the plan nor the driver grows with their
number. Then, going down, the pairs (value, node) of a level are joined with the nodes: a pair's own
violations are computed and its edges give the pairs of the next level, until none is left, so
recursive schemas go as deep as the data. Going up, each pair's violations are its own, those of the
pairs it must meet, and those of its combinations (any, one, not, if, contains), by one aggregate a
level.

Each level is checkpointed. A value that is met by many nodes travels once for each of them.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonschema import number_matches, variant_kind
from ..functions.schema_nodes import exact_decimal, schema_nodes
from ..plans.sizing import broadcast_if_small

_HERE = ("must", "any", "one", "not", "if", "then", "else")


def _number_parts(v: Column) -> tuple[Column, Column]:
    """A number exactly (NULL where 12 decimal places don't hold it) and as a double."""
    num = F.try_variant_get(v, "$", "double")
    dec = F.try_variant_get(v, "$", "decimal(38,12)")
    return F.when(dec.cast("double") == num, dec), num


def _own(v: Column) -> Column:
    """The violations of a value's own node, as ``array<string>`` (reads the node's columns)."""
    kind, path, dec, num, text = (F.col(c) for c in ("_kind", "path", "_dec", "_num", "_text"))
    is_num, is_str, is_obj, is_arr = (F.col(c) for c in ("_is_num", "_is_str", "_is_obj", "_is_arr"))
    obj, arr = F.col("_obj"), F.col("_arr")
    names = F.array_compact(F.array(
        F.when(is_obj, F.lit("object")), F.when(is_arr, F.lit("array")), F.when(is_str, F.lit("string")),
        F.when(kind == "BOOLEAN", F.lit("boolean")), F.when(kind == "VOID", F.lit("null")),
        F.when(is_num, F.lit("number")), F.when(is_num & ((dec == F.floor(dec)) | (dec.isNull() & (num == F.floor(num)))),
                                                F.lit("integer"))))

    def compare(side: str, strict, loose) -> Column:
        b = F.col(side)
        d = exact_decimal(b["text"])
        return F.when(b["open"], F.coalesce(strict(dec, d), strict(num, b["number"]))).otherwise(
            F.coalesce(loose(dec, d), loose(num, b["number"])))

    m = F.col("multiple")
    rest = F.coalesce(F.try_mod(dec, exact_decimal(m["text"])) == 0, F.try_mod(num, m["number"]) == 0)
    same = F.array_contains("allowed", F.col("_json")) | (is_num & F.exists(
        "numbers", lambda x: F.coalesce(dec == exact_decimal(x["text"]), num == x["number"])))
    texts = F.transform(arr, lambda x: F.to_json(x))

    none = F.array().cast("array<string>")

    def said(cond: Column, what: str | Column) -> Column:
        text = F.concat(path, F.lit(": "), what if isinstance(what, Column) else F.lit(what))
        return F.when(cond, F.filter(F.array(text), lambda x: x.isNotNull())).otherwise(none)

    found = [
        said(F.col("never"), "no value allowed"),
        said(F.col("types").isNotNull() & ~F.arrays_overlap(F.col("types"), names),
             F.concat(F.lit("expected type "), F.array_join("types", "/"))),
        said(is_num & F.col("low").isNotNull() & compare("low", lambda a, b: a <= b, lambda a, b: a < b), "minimum"),
        said(is_num & F.col("high").isNotNull() & compare("high", lambda a, b: a >= b, lambda a, b: a > b), "maximum"),
        said(is_num & m.isNotNull() & ~rest, "multipleOf"),
        said(is_str & (F.char_length(text) < F.col("min_length")), "minLength"),
        said(is_str & (F.char_length(text) > F.col("max_length")), "maxLength"),
        said(is_str & ~F.regexp_like(text, F.col("pattern")), "pattern"),
        said(F.col("allowed").isNotNull() & ~F.coalesce(same, F.lit(False)), "not in enum"),
        said(is_obj & (F.size(obj) < F.col("min_properties")), "minProperties"),
        said(is_obj & (F.size(obj) > F.col("max_properties")), "maxProperties"),
        said(is_arr & (F.size(arr) < F.col("min_items")), "minItems"),
        said(is_arr & (F.size(arr) > F.col("max_items")), "maxItems"),
        said(is_arr & F.col("distinct_items") & (F.size(F.array_distinct(texts)) < F.size(arr)), "uniqueItems"),
    ]
    lists = found  # arrays of at most one, joined in generated code
    missing = F.filter("required", lambda r: ~F.map_contains_key(obj, r))
    lists.append(F.when(is_obj, F.transform(missing, lambda r: F.concat(path, F.lit(": missing "), r))))
    needed = F.flatten(F.transform(F.filter("needs", lambda d: F.map_contains_key(obj, d["name"])),
                                   lambda d: F.filter(d["names"], lambda r: ~F.map_contains_key(obj, r))))
    lists.append(F.when(is_obj, F.transform(needed, lambda r: F.concat(path, F.lit(": missing "), r))))
    return F.concat(*[F.coalesce(x, none) for x in lists])


def _children() -> Column:
    """The pairs of the next level, as an array."""
    v, path = F.col("value"), F.col("path")
    obj, arr, is_obj, is_arr = (F.col(c) for c in ("_obj", "_arr", "_is_obj", "_is_arr"))

    def pair(kind: Column, e: Column, where: Column, value: Column) -> Column:
        return F.struct(kind.alias("kind"), e["node"].alias("node"), where.alias("path"), value.alias("value"))

    def member(e: Column, x: Column) -> Column:
        return pair(F.lit("must"), e, F.concat(path, F.lit("."), x["key"]), x["value"])

    def item(e: Column, kind: str, x: Column, i: Column) -> Column:
        return pair(F.lit(kind), e, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), x)

    entries = F.map_entries(obj)

    def of_edge(e: Column) -> Column:
        kind, name, at = e["kind"], e["name"], e["at"]
        beyond = F.filter(entries, lambda x: ~F.array_contains("declared", x["key"])
                          & ~F.exists("patterns", lambda p: F.regexp_like(x["key"], p)))
        later = F.slice(arr, at + 1, F.greatest(F.size(arr), F.lit(1)))
        return (F.when(kind.isin(*_HERE), F.array(pair(kind, e, path, v)))
                .when(kind == "dependent", F.when(is_obj & F.map_contains_key(obj, name), F.array(pair(F.lit("must"), e, path, v))))
                .when(kind == "property", F.when(is_obj, F.transform(F.filter(entries, lambda x: x["key"] == name),
                                                                     lambda x: member(e, x))))
                .when(kind == "pattern", F.when(is_obj, F.transform(F.filter(entries, lambda x: F.regexp_like(x["key"], name)),
                                                                    lambda x: member(e, x))))
                .when(kind == "additional", F.when(is_obj, F.transform(beyond, lambda x: member(e, x))))
                .when(kind == "names", F.when(is_obj, F.transform(
                    F.map_keys(obj), lambda k: pair(F.lit("must"), e, F.concat(path, F.lit(" name "), k), k.cast("variant")))))
                .when(kind == "prefix", F.when(is_arr, F.transform(F.slice(arr, at + 1, 1), lambda x: item(e, "must", x, at))))
                .when(kind == "items", F.when(is_arr, F.transform(later, lambda x, i: item(e, "must", x, i + at))))
                .when(kind == "contains", F.when(is_arr, F.transform(arr, lambda x, i: item(e, "contains", x, i)))))

    return F.flatten(F.filter(F.transform("edges", of_edge), lambda x: x.isNotNull()))


def _has(kind: str) -> Column:
    return F.exists("edges", lambda e: e["kind"] == kind)


class _Steps:
    """The expressions of one level, built once: they are the same at every level."""

    def __init__(self, id_col: str):
        v = F.col("value")
        dec, num = _number_parts(v)
        self.containers = {"_obj": F.try_variant_get(v, "$", "map<string,variant>"),
                           "_arr": F.try_variant_get(v, "$", "array<variant>")}
        # the schema of a variant walks through the whole value, so only scalars are asked for it
        self.kind = (F.when(F.col("_obj").isNotNull(), "OBJECT").when(F.col("_arr").isNotNull(), "ARRAY")
                     .otherwise(variant_kind(v)))
        self.tests = {"_is_num": number_matches(F.col("_kind")), "_is_str": F.col("_kind") == "STRING",
                      "_is_obj": F.col("_kind") == "OBJECT", "_is_arr": F.col("_kind") == "ARRAY"}
        self.parts = {
            "_dec": F.when(F.col("_is_num") & F.col("_counts"), dec), "_num": F.when(F.col("_is_num") & F.col("_counts"), num),
            "_text": F.when(F.col("_is_str"), F.try_variant_get(v, "$", "string")),
            "_json": F.when(F.col("allowed").isNotNull(), F.to_json(v))}
        self.none = F.array().cast("array<string>")
        self.out = [
            F.monotonically_increasing_id().alias("id"), F.col("up"), F.col("kind"), F.col("path"), F.col(id_col),
            F.when(F.col("_checks"), _own(v)).otherwise(self.none).alias("own"), _children().alias("children"), _has("any").alias("any"), _has("one").alias("one"),
            _has("if").alias("if"), F.when(F.col("_is_arr") & _has("contains"), F.col("min_contains")).alias("least"),
            F.when(F.col("_is_arr"), F.col("max_contains")).alias("most")]
        ok = F.size("found") == 0
        self.counts = F.when(F.col("kind").isin(*_LISTED), ~ok).otherwise(ok)
        self.counted = [
            *[F.flatten(F.collect_list(F.when(F.col("kind") == k, F.col("found")))).alias(f"_{k}") for k in _LISTED],
            *[F.count_if((F.col("kind") == k) & ok).alias(f"_n_{k}") for k in _COUNTED]]
        self.filled = {**{f"_{k}": F.coalesce(f"_{k}", self.none) for k in _LISTED},
                       **{f"_n_{k}": F.coalesce(f"_n_{k}", F.lit(0)) for k in _COUNTED}}
        self.empty = {**{f"_{k}": self.none for k in _LISTED}, **{f"_n_{k}": F.lit(0).cast("long") for k in _COUNTED}}
        self.found = self._found()

    def _found(self) -> Column:
        """All violations of a pair."""
        def said(cond: Column, what: str) -> Column:
            return F.when(cond, F.concat(F.col("path"), F.lit(f": {what}")))
        n = {k: F.col(f"_n_{k}") for k in _COUNTED}
        combined = F.filter(F.array(
            said(F.col("any") & (n["any"] == 0), "anyOf"), said(F.col("one") & (n["one"] != 1), "oneOf"),
            said(n["not"] > 0, "not"), said(n["contains"] < F.col("least"), "contains"),
            said(n["contains"] > F.col("most"), "contains")), lambda x: x.isNotNull())
        combines = F.col("any") | F.col("one") | (n["not"] > 0) | F.col("least").isNotNull() | F.col("most").isNotNull()
        combined = F.when(combines, combined).otherwise(self.none)
        branch = F.when(F.col("if"), F.when(n["if"] > 0, F.col("_then")).otherwise(F.col("_else"))).otherwise(self.none)
        return F.concat("own", "_must", combined, branch).alias("found")

    def expanded(self, pairs: DataFrame, nodes: DataFrame, id_col: str) -> DataFrame:
        """A level's pairs with their own violations, what they combine, and the next pairs."""
        df = pairs.join(nodes, [id_col, "node"]).withColumns(self.containers).withColumn("_kind", self.kind)
        return df.withColumns(self.tests).withColumns(self.parts).select(*self.out).checkpoint(eager=True)

    def verdicts(self, level: DataFrame, below: DataFrame | None) -> DataFrame:
        """``up, kind, found`` of a level's pairs, from those of the level below."""
        if below is None:
            return level.withColumns(self.empty).select("up", "kind", self.found)
        # violations of what must be met, and matches of what is counted; nothing else changes a verdict
        per = below.where(self.counts).groupBy(F.col("up").alias("id")).agg(*self.counted)
        leaves = level.where(F.size("children") == 0).withColumns(self.empty).select("up", "kind", self.found)
        inner = level.where(F.size("children") > 0).drop("children").join(per, "id", "left").withColumns(self.filled)
        return inner.select("up", "kind", self.found).unionByName(leaves)


def _with_flags(nodes: DataFrame) -> DataFrame:
    """The nodes with ``_checks``, whether they say anything of a value itself, and ``_counts``, whether
    they compare numbers."""
    present = ["types", "low", "high", "multiple", "min_length", "max_length", "pattern", "allowed", "min_properties",
               "max_properties", "min_items", "max_items"]
    checks = functools.reduce(operator.or_, [F.col(c).isNotNull() for c in present]) | F.col("never") \
        | F.col("distinct_items") | (F.size("required") > 0) | (F.size("needs") > 0)
    counts = (F.col("low").isNotNull() | F.col("high").isNotNull() | F.col("multiple").isNotNull()
              | F.col("numbers").isNotNull() | F.array_contains("types", "integer"))
    return nodes.withColumns({"_checks": F.coalesce(checks, F.lit(True)), "_counts": F.coalesce(counts, F.lit(False))})


_BUILT: dict[str, _Steps] = {}


def _steps(spark) -> _Steps:
    """The level expressions, built once per application."""
    key = spark.sparkContext.applicationId
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = _Steps("_sid")
    return _BUILT[key]


_LISTED = ("must", "then", "else")
_COUNTED = ("any", "one", "not", "if", "contains")


def violations(rows: DataFrame, row_col: str, variant_col: str, schema_col: str) -> tuple[DataFrame, DataFrame]:
    """``row_col, violations`` of the rows (unique ``row_col``) that break their schema, and
    ``schema_col, error`` of the schemas that cannot be checked. Rows with a NULL value or
    schema, and rows of such schemas, have no violations."""
    complete = rows.where(F.col(variant_col).isNotNull() & F.col(schema_col).isNotNull())
    schemas = (complete.select(F.col(schema_col).alias("_schema")).distinct()
               .withColumn("_sid", F.monotonically_increasing_id()).checkpoint(eager=True))
    nodes, errors = schema_nodes(schemas, "_schema", "_sid")
    nodes = broadcast_if_small(_with_flags(nodes))
    pairs = (complete.join(broadcast_if_small(schemas), complete[schema_col] == schemas["_schema"])
             .select(F.col(row_col).alias("up"), F.lit("root").alias("kind"), "_sid", F.lit(0).alias("node"),
                     F.lit("$").alias("path"), F.col(variant_col).alias("value")))
    levels, steps = [], _steps(rows.sparkSession)
    while True:
        level = steps.expanded(pairs, nodes, "_sid")
        levels.append(level)
        nxt = level.where(F.size("children") > 0)
        if nxt.isEmpty():
            break
        pairs = nxt.select(F.col("id").alias("up"), "_sid", F.explode("children").alias("c")).select("up", "_sid", "c.*")
    below = None
    for k, level in enumerate(reversed(levels)):
        below = steps.verdicts(level, below)
        if k % 6 == 5:  # deep data: keep the plan short
            below = below.checkpoint(eager=True)
    bad = below.where(F.size("found") > 0).select(F.col("up").alias(row_col), F.col("found").alias("violations"))
    return bad, errors.join(schemas, "_sid").select(F.col("_schema").alias(schema_col), "error")


def validate_rows(df: DataFrame, variant_col: str, schema_col: str, out: str = "violations") -> DataFrame:
    """``df`` with ``out``: every row's violations (``array<string>``) of the schema text in its own
    ``schema_col``, empty where it is valid, NULL where the value or the schema is NULL. A schema
    that cannot be checked (not JSON, an unknown keyword, a remote reference) fails the query."""
    rows = df.withColumn("_vrow", F.monotonically_increasing_id()).checkpoint(eager=True)
    bad, errors = violations(rows, "_vrow", variant_col, schema_col)
    bad = broadcast_if_small(bad.withColumnRenamed("violations", "_vbad").withColumnRenamed("_vrow", "_vat").checkpoint(eager=True))
    errors = broadcast_if_small(errors.select(F.col(schema_col).alias("_verr_schema"), F.col("error").alias("_verr")).checkpoint(eager=True))
    joined = rows.join(bad, rows["_vrow"] == bad["_vat"], "left").join(errors, rows[schema_col] == errors["_verr_schema"], "left")
    checked = F.col(variant_col).isNotNull() & F.col(schema_col).isNotNull()
    found = F.when(checked, F.when(F.col("_verr").isNull(), F.coalesce("_vbad", F.array().cast("array<string>"))).otherwise(
        F.raise_error(F.concat(F.lit("Error: schema cannot be checked ("), F.col("_verr"), F.lit(")"))).cast("array<string>")))
    return joined.withColumn(out, found).drop("_vrow", "_vat", "_vbad", "_verr", "_verr_schema")
