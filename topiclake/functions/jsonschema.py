"""JSON Schema → column structure, Spark types, and validation predicates.

``structure`` maps a JSON Schema to a structure description whose leaves are the
names ``BIGINT``, ``DOUBLE``, ``VARCHAR``, ``BOOLEAN`` or ``JSON`` (anything not
typed precisely), arrays as ``[T]`` and objects as ``{name: T}``. ``structure_text`` is
its compact, key-sorted JSON text. ``spark_type`` turns a structure into a Spark type
for ``from_json``. ``validation_column`` compiles the schema, on the driver, into
Catalyst expressions over a Variant, so validation runs inside codegen.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Primitive JSON Schema types and the leaf names they map to.
PRIMITIVE_LEAVES = {
    "integer": "BIGINT",
    "number": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "null": "JSON",
}
COMBINATORS = ("anyOf", "oneOf", "allOf")
LOOSE = "JSON"


def structure(schema: Any) -> Any:
    """Structure of a parsed JSON Schema (first matching rule wins)."""
    if not isinstance(schema, dict):
        return LOOSE
    if any(k in schema for k in COMBINATORS):
        return LOOSE
    if "type" not in schema:
        return LOOSE
    t = schema["type"]
    if isinstance(t, list):
        names = [x for x in t if isinstance(x, str)]
        if "object" in names or "array" in names:
            return LOOSE
        non_null = [x for x in names if x != "null"]
        if len(non_null) != 1:
            return LOOSE
        return PRIMITIVE_LEAVES.get(non_null[0], LOOSE)
    if not isinstance(t, str):
        return LOOSE
    if t in PRIMITIVE_LEAVES:
        return PRIMITIVE_LEAVES[t]
    if t == "array":
        return [structure(schema["items"])] if "items" in schema else [LOOSE]
    if t == "object":
        props = schema.get("properties")
        if isinstance(props, dict):
            return {k: structure(v) for k, v in props.items()}
        return {}
    return LOOSE


def dumps(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def structure_text(schema_text: str) -> str:
    """Compact, key-sorted structure text of a JSON Schema given as text."""
    try:
        parsed = json.loads(schema_text)
    except (TypeError, ValueError) as e:
        raise ValueError(f"schema text is not JSON: {e}") from e
    return dumps(structure(parsed))


@F.pandas_udf(T.StringType())
def structure_text_udf(schemas: pd.Series) -> pd.Series:
    """Arrow-batched structure text for a column of schema texts (NULL for unparsable)."""
    def one(s):
        if s is None:
            return None
        try:
            return structure_text(s)
        except ValueError:
            return None
    return schemas.map(one)


_LEAF_TYPES = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "VARCHAR": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    LOOSE: T.StringType(),  # kept as JSON text
}


def spark_type(struct_desc: Any) -> T.DataType:
    if isinstance(struct_desc, str):
        return _LEAF_TYPES.get(struct_desc, T.StringType())
    if isinstance(struct_desc, list):
        return T.ArrayType(spark_type(struct_desc[0]) if struct_desc else T.StringType())
    return T.StructType([T.StructField(k, spark_type(v)) for k, v in sorted(struct_desc.items())])


def schema_spark_type(schema_text: str) -> T.DataType:
    return spark_type(structure(json.loads(schema_text)))


def merge_structures(a: Any, b: Any) -> Any:
    """The least structure that holds values of both: objects have the members of either, whole
    numbers widen to ``DOUBLE``, and what differs otherwise is kept as ``JSON`` text."""
    if a == b:
        return a
    if isinstance(a, dict) and isinstance(b, dict):
        return {k: merge_structures(a[k], b[k]) if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}
    if isinstance(a, list) and isinstance(b, list):
        return [merge_structures(a[0], b[0])]
    return "DOUBLE" if {repr(a), repr(b)} == {"'BIGINT'", "'DOUBLE'"} else LOOSE


@F.pandas_udf(T.StringType())
def merge_texts_udf(lists: pd.Series) -> pd.Series:
    """Structure text that holds all of a list of structure texts."""
    return lists.map(lambda texts: dumps(functools.reduce(merge_structures, [json.loads(t) for t in texts]))
                     if texts is not None and len(texts) else None)


# ------------------------------------------------------------------------- validation

SUPPORTED_KEYWORDS = {
    "type", "properties", "required", "enum", "const", "minimum", "maximum",
    "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "items",
    "minItems", "maxItems", "additionalProperties", "prefixItems", "additionalItems", "patternProperties",
    "uniqueItems", "multipleOf", "minProperties", "maxProperties", "anyOf", "oneOf", "allOf", "not", "$ref",
    # holders of referenced schemas
    "$defs", "definitions",
    # annotations without effect on validity
    "title", "description", "$schema", "$id", "default", "examples", "format",
}

# Variant type names (``schema_of_variant``) per JSON Schema type.
_VARIANT_KINDS = {
    "object": ["OBJECT"],
    "array": ["ARRAY"],
    "string": ["STRING"],
    "boolean": ["BOOLEAN"],
    "null": ["VOID"],
    "integer": ["BIGINT", "INT", "SMALLINT", "TINYINT"],
    "number": ["BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"],
}


def variant_kind(v: Column) -> Column:
    """Coarse Variant type name: OBJECT, ARRAY, STRING, DECIMAL, BIGINT, … (NULL if absent)."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


_HELPER_IDS = itertools.count()


def _bind(env: dict | None, expr: Column, level: int) -> Column:
    """Name ``expr`` as a helper column of ``level`` (it may read helpers of lower levels)."""
    if env is None:
        return expr
    name = f"_js{next(_HELPER_IDS)}"
    env.setdefault(level, {})[name] = expr
    return F.col(name)


def _with_helpers(df, env: dict):
    """Add all helper columns, one projection for each level: as many as schemas nest deep,
    however many properties and schemas there are."""
    for level in sorted(env):
        df = df.withColumns(env[level])
    return df


def _is_type(v: Column, t: str, k: Column | None = None) -> Column:
    k = variant_kind(v) if k is None else k
    base = k.isin(_VARIANT_KINDS[t])
    if t == "integer":  # 2.0 is an integer in JSON Schema; decimals with zero fraction count
        dec = F.try_variant_get(v, "$", "decimal(38,10)")
        num = F.try_variant_get(v, "$", "double")
        base = base | ((k == "DECIMAL") & (dec == F.floor(dec))) | (k.isin("DOUBLE", "FLOAT") & (num == F.floor(num)))
    return base


def number_matches(kind: Column) -> Column:
    """Whether a Variant type name is that of a number."""
    return kind.isin(_VARIANT_KINDS["number"])


def _exact(v: Column) -> Column:
    """Number as an exact decimal; NULL where 12 places don't hold it (then the double decides)."""
    dec = F.try_variant_get(v, "$", "decimal(38,12)")
    return F.when(dec.cast("double") == F.try_variant_get(v, "$", "double"), dec)


def _decimal(x) -> Column:
    """A bound as an exact decimal; NULL where 12 places don't hold it."""
    d = Decimal(str(x))
    return (F.lit(d) if has_12_places(d) else F.lit(None)).cast("decimal(38,12)")


def has_12_places(d: Decimal) -> bool:
    """Whether ``decimal(38,12)`` holds the number exactly."""
    return d.is_finite() and abs(d) < 10 ** 26 and d.normalize().as_tuple().exponent >= -12


def _fails(v: Column, schema: Any, path: str, root: Any, refs: tuple) -> Column:
    """Whether ``v`` violates ``schema``."""
    checks = _violations(v, schema, path, None, None, root, refs)
    return F.concat_ws("", *checks) != "" if checks else F.lit(False)


def resolve_ref(ref: Any, root: Any, path: str) -> Any:
    if not isinstance(ref, str) or not (ref == "#" or ref.startswith("#/")):
        raise ValueError(f"unsupported $ref at {path}: {ref!r}")
    node = root
    for part in [p for p in ref[1:].split("/") if p]:
        part = part.replace("~1", "/").replace("~0", "~")
        if isinstance(node, list) and part.isdigit() and int(part) < len(node):
            node = node[int(part)]
        elif isinstance(node, dict) and part in node:
            node = node[part]
        else:
            raise ValueError(f"$ref {ref!r} at {path} names nothing")
    return node


def _violations(v: Column, schema: Any, path: str, env: dict | None = None,
                kind: Column | None = None, root: Any = None, refs: tuple = (), depth: int = 0) -> list[Column]:
    """Expressions yielding a message when violated and NULL when fine.

    With ``env`` (helper columns by level), each object property's sub-variant
    and its type name are bound to helper columns, so they are computed once per row
    however many checks read them (array items, inside lambdas, are not bound)."""
    if schema is True or schema == {}:
        return []
    if schema is False:
        return [F.when(v.isNotNull(), F.lit(f"{path}: no value allowed"))]
    if not isinstance(schema, dict):
        raise ValueError(f"unsupported schema at {path}: {schema!r}")
    unknown = set(schema) - SUPPORTED_KEYWORDS
    if unknown:
        raise ValueError(f"unsupported JSON Schema keyword(s) at {path}: {sorted(unknown)}")
    root = schema if root is None else root
    out: list[Column] = []
    present = v.isNotNull()
    if kind is None:
        kind = _bind(env, variant_kind(v), 2 * depth)
    if "$ref" in schema:
        if schema["$ref"] in refs:
            raise ValueError(f"unsupported recursive $ref at {path}: {schema['$ref']!r}")
        out.extend(_violations(v, resolve_ref(schema["$ref"], root, path), path, None, kind, root, (*refs, schema["$ref"])))
    for sub in schema.get("allOf", []):
        out.extend(_violations(v, sub, path, None, kind, root, refs))
    if "anyOf" in schema or "oneOf" in schema:
        for kw in ("anyOf", "oneOf"):
            if kw in schema:
                fits = [F.when(_fails(v, sub, path, root, refs), 0).otherwise(1) for sub in schema[kw]]
                n = functools.reduce(operator.add, fits, F.lit(0))
                out.append(F.when(present & ((n == 0) if kw == "anyOf" else (n != 1)), F.lit(f"{path}: {kw}")))
    if "not" in schema:
        out.append(F.when(present & ~_fails(v, schema["not"], path, root, refs), F.lit(f"{path}: not")))
    t = schema.get("type")
    if t is not None:
        types = t if isinstance(t, list) else [t]
        ok = F.lit(False)
        for x in types:
            ok = ok | _is_type(v, x, kind)
        out.append(F.when(present & ~ok, F.lit(f"{path}: expected type {'/'.join(types)}")))
    num, dec = F.try_variant_get(v, "$", "double"), _exact(v)
    is_num = kind.isin(_VARIANT_KINDS["number"])
    for kw, bad in (("minimum", operator.lt), ("maximum", operator.gt),
                    ("exclusiveMinimum", operator.le), ("exclusiveMaximum", operator.ge)):
        bound = schema.get(kw)
        if bound is None or (isinstance(bound, bool) and kw.startswith("exclusive")):
            continue
        if schema.get({"minimum": "exclusiveMinimum", "maximum": "exclusiveMaximum"}.get(kw, "")) is True:
            bad = {operator.lt: operator.le, operator.gt: operator.ge}[bad]  # older spelling: a flag beside the bound
        broken = F.coalesce(bad(dec, _decimal(bound)), bad(num, F.lit(float(bound))))
        out.append(F.when(is_num & broken, F.lit(f"{path}: {kw} {bound}")))
    if "multipleOf" in schema:
        rest = F.coalesce(dec % _decimal(schema["multipleOf"]) == 0, num % F.lit(float(schema["multipleOf"])) == 0)
        out.append(F.when(is_num & ~rest, F.lit(f"{path}: multipleOf {schema['multipleOf']}")))
    s = F.try_variant_get(v, "$", "string")
    is_str = kind == "STRING"
    if "minLength" in schema:
        out.append(F.when(is_str & (F.char_length(s) < schema["minLength"]), F.lit(f"{path}: minLength")))
    if "maxLength" in schema:
        out.append(F.when(is_str & (F.char_length(s) > schema["maxLength"]), F.lit(f"{path}: maxLength")))
    if "pattern" in schema:
        out.append(F.when(is_str & ~s.rlike(schema["pattern"]), F.lit(f"{path}: pattern")))
    for kw in ("enum", "const"):
        if kw in schema:
            allowed = schema[kw] if kw == "enum" else [schema[kw]]
            numbers = [x for x in allowed if isinstance(x, (int, float)) and not isinstance(x, bool)]
            same = F.to_json(v).isin([dumps(x) for x in allowed if x not in numbers or isinstance(x, bool)])
            if numbers:  # numbers are equal by value: 1 is 1.0
                equal = F.coalesce(dec.isin([_decimal(x) for x in numbers]), num.isin([float(x) for x in numbers]))
                same = same | (is_num & equal)
            out.append(F.when(present & ~same, F.lit(f"{path}: not in {kw}")))
    is_obj = kind == "OBJECT"
    for r in schema.get("required", []) or []:
        child = F.try_variant_get(v, _path(r), "variant")
        out.append(F.when(is_obj & child.isNull(), F.lit(f"{path}: missing {r}")))
    props = schema.get("properties") or {}
    for name, sub in sorted(props.items()):
        child = _bind(env, F.when(is_obj, F.try_variant_get(v, _path(name), "variant")), 2 * depth + 1)
        out.extend(_violations(child, sub, f"{path}.{name}", env, None, root, refs, depth + 1))
    keys = F.json_object_keys(F.to_json(v))
    for kw, bad in (("minProperties", operator.lt), ("maxProperties", operator.gt)):
        if kw in schema:
            out.append(F.when(is_obj & bad(F.size(keys), F.lit(schema[kw])), F.lit(f"{path}: {kw}")))
    patterns = schema.get("patternProperties") or {}
    entries = F.map_entries(F.from_json(F.to_json(v), "map<string,variant>"))
    for pattern, sub in sorted(patterns.items()):
        def broken(e, pattern=pattern, sub=sub):
            return e["key"].rlike(pattern) & _fails(e["value"], sub, path, root, refs)
        out.append(F.when(is_obj & F.exists(entries, _one(broken)), F.lit(f"{path}: properties like {pattern}")))
    extra = schema.get("additionalProperties", True)
    if extra is not True and extra != {}:
        declared = F.array(*[F.lit(k) for k in props]) if props else F.array().cast("array<string>")

        def beyond(e):
            other = ~F.array_contains(declared, e["key"])
            for pattern in patterns:
                other = other & ~e["key"].rlike(pattern)
            return other if extra is False else other & _fails(e["value"], extra, path, root, refs)
        out.append(F.when(is_obj & F.exists(entries, beyond), F.lit(f"{path}: additional properties")))
    is_arr = kind == "ARRAY"
    arr = F.try_variant_get(v, "$", "array<variant>")
    if "minItems" in schema:
        out.append(F.when(is_arr & (F.size(arr) < schema["minItems"]), F.lit(f"{path}: minItems")))
    if "maxItems" in schema:
        out.append(F.when(is_arr & (F.size(arr) > schema["maxItems"]), F.lit(f"{path}: maxItems")))
    if schema.get("uniqueItems") is True:
        texts = F.transform(arr, lambda x: F.to_json(x))
        out.append(F.when(is_arr & (F.size(F.array_distinct(texts)) < F.size(arr)), F.lit(f"{path}: uniqueItems")))
    first = schema.get("prefixItems")
    items = schema.get("items", True)
    if isinstance(items, list):  # older spelling: a list of schemas, the rest by additionalItems
        first, items = items, schema.get("additionalItems", True)
    for i, sub in enumerate(first or []):
        child = F.when(is_arr, F.try_variant_get(v, f"$[{i}]", "variant"))
        out.extend(_violations(child, sub, f"{path}[{i}]", None, None, root, refs))
    rest = F.slice(arr, len(first) + 1, F.greatest(F.size(arr), F.lit(1))) if first else arr
    if items is False:
        out.append(F.when(is_arr & (F.size(rest) > 0), F.lit(f"{path}: additional items")))
    elif isinstance(items, dict) and items:
        def per_item(x):
            cs = _violations(x, items, f"{path}[]", None, None, root, refs)
            return F.concat_ws("; ", *cs) if cs else F.lit("")
        msgs = F.filter(F.transform(rest, per_item), lambda m: m != "")
        out.append(F.when(is_arr & (F.size(msgs) > 0), F.array_join(msgs, "; ")))
    return out


def _one(fn):
    """A one-argument lambda out of a function with bound defaults."""
    return lambda e: fn(e)


def _path(name: str) -> str:
    q = _quote(name)
    return f"${q}" if q.startswith("[") else f"$.{q}"


def _quote(name: str) -> str:
    if name.isidentifier():
        return name
    if "'" not in name:
        return f"['{name}']"
    if '"' not in name:
        return f'["{name}"]'
    raise ValueError(f"property name with both kinds of quotes: {name!r}")


def validation_column(v: Column, schema_text: str) -> Column:
    """``array<string>`` of violations of ``schema_text`` for the Variant ``v`` (empty =
    valid). Unsupported keywords fail here, while building, never silently."""
    checks = _violations(v, json.loads(schema_text), "$")
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda m: m.isNotNull())


def validate(df, variant_col: str, schema_text: str, out: str = "violations"):
    """Add ``out`` (``array<string>`` of violations, empty = valid) for the Variant column
    ``variant_col``. Sub-variants and type names are materialised as helper columns in
    one projection, so nothing is re-extracted per check; helpers are dropped after."""
    env: dict = {}
    checks = _violations(F.col(variant_col), json.loads(schema_text), "$", env)
    df = _with_helpers(df, env)
    col = F.filter(F.array(*checks), lambda m: m.isNotNull()) if checks else F.array().cast("array<string>")
    return df.withColumn(out, col).drop(*[n for names in env.values() for n in names])


def validate_by_schema(df, variant_col: str, schema_col: str, schema_texts: list[str],
                       out: str = "violations"):
    """Like :func:`validate`, with each row checked against the schema named in its own
    ``schema_col`` (one of ``schema_texts``, the distinct schemas of the frame). Helper
    columns of a schema are guarded by ``schema_col = schema``, so a row pays only for
    the checks of its own schema. Rows whose schema is not listed get NULL."""
    none = F.array().cast("array<string>")
    by_rules: dict[str, list[str]] = {}
    for text in schema_texts:  # schemas that differ in annotations only share one set of checks
        by_rules.setdefault(dumps(_rules(json.loads(text))), []).append(text)
    helpers: dict = {}
    choice = None
    for rules, texts in by_rules.items():
        env: dict = {}
        checks = _violations(F.col(variant_col), json.loads(rules), "$", env)
        mine = F.col(schema_col).isin(texts)
        for level, named in env.items():
            helpers.setdefault(level, {}).update({n: F.when(mine, e) for n, e in named.items()})
        arr = F.filter(F.array(*checks), lambda m: m.isNotNull()) if checks else none
        choice = F.when(mine, arr) if choice is None else choice.when(mine, arr)
    col = choice if choice is not None else F.lit(None).cast("array<string>")
    return _with_helpers(df, helpers).withColumn(out, col).drop(*[n for names in helpers.values() for n in names])


_ANNOTATIONS = {"title", "description", "$schema", "$id", "default", "examples", "format"}


def _rules(schema: Any) -> Any:
    """The schema without the annotations at its top and in its properties."""
    if not isinstance(schema, dict):
        return schema
    out = {k: v for k, v in schema.items() if k not in _ANNOTATIONS}
    if isinstance(out.get("properties"), dict):
        out["properties"] = {k: _rules(v) for k, v in out["properties"].items()}
    return out
