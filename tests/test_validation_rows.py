"""Validation as data against a plain recursive validator."""
import json
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from topiclake.functions.schema_nodes import SchemaError, compile_nodes
from topiclake.operators import messages
from topiclake.operators.validation import validate_rows


def is_num(x):
    return isinstance(x, (int, float)) and not isinstance(x, bool)


def same(a, b):
    if is_num(a) and is_num(b):
        return a == b
    return type(a) is type(b) and json.dumps(a, sort_keys=True) == json.dumps(b, sort_keys=True)


def typed(v, t):
    return {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str),
            "boolean": isinstance(v, bool), "null": v is None, "number": is_num(v),
            "integer": is_num(v) and float(v).is_integer()}[t]


def valid(v, s, root):
    if isinstance(s, bool):
        return s
    ok = lambda x, t: valid(x, t, root)
    if "$ref" in s:
        t = root
        for p in [p for p in s["$ref"][1:].split("/") if p]:
            t = t[int(p)] if isinstance(t, list) else t[p]
        if not ok(v, t):
            return False
    t = s.get("type")
    if t is not None and not any(typed(v, x) for x in ([t] if isinstance(t, str) else t)):
        return False
    if "enum" in s and not any(same(v, x) for x in s["enum"]) or "const" in s and not same(v, s["const"]):
        return False
    if not all(ok(v, x) for x in s.get("allOf", [])) or "anyOf" in s and not any(ok(v, x) for x in s["anyOf"]):
        return False
    if "oneOf" in s and sum(ok(v, x) for x in s["oneOf"]) != 1 or "not" in s and ok(v, s["not"]):
        return False
    if "if" in s and not ok(v, s.get("then" if ok(v, s["if"]) else "else", True)):
        return False
    if is_num(v):
        d = Decimal(str(v))
        if ("minimum" in s and v < s["minimum"] or "maximum" in s and v > s["maximum"]
                or "exclusiveMinimum" in s and v <= s["exclusiveMinimum"] or "exclusiveMaximum" in s and v >= s["exclusiveMaximum"]
                or "multipleOf" in s and d % Decimal(str(s["multipleOf"])) != 0):
            return False
    if isinstance(v, str) and (len(v) < s.get("minLength", 0) or len(v) > s.get("maxLength", 99)
                               or "pattern" in s and not re.search(s["pattern"], v)):
        return False
    if isinstance(v, dict):
        if any(r not in v for r in s.get("required", [])) or not s.get("minProperties", 0) <= len(v) <= s.get("maxProperties", 99):
            return False
        for k, need in s.get("dependentRequired", {}).items():
            if k in v and any(r not in v for r in need):
                return False
        if any(k in v and not ok(v, t) for k, t in s.get("dependentSchemas", {}).items()):
            return False
        for k, x in v.items():
            hit = False
            if k in s.get("properties", {}):
                hit = True
                if not ok(x, s["properties"][k]):
                    return False
            for p, t in s.get("patternProperties", {}).items():
                if re.search(p, k):
                    hit = True
                    if not ok(x, t):
                        return False
            if not hit and not ok(x, s.get("additionalProperties", True)) or not ok(k, s.get("propertyNames", True)):
                return False
    if isinstance(v, list):
        if not s.get("minItems", 0) <= len(v) <= s.get("maxItems", 99):
            return False
        if s.get("uniqueItems") and any(same(a, b) for i, a in enumerate(v) for b in v[:i]):
            return False
        first = s.get("prefixItems", [])
        if any(not ok(x, t) for x, t in zip(v, first)) or any(not ok(x, s.get("items", True)) for x in v[len(first):]):
            return False
        if "contains" in s and not s.get("minContains", 1) <= sum(ok(x, s["contains"]) for x in v) <= s.get("maxContains", 99):
            return False
    return True


def random_schema(rng, depth):
    s, sub = {}, lambda: random_schema(rng, depth - 1) if depth else rng.choice([True, {"type": "integer"}, {"type": "string"}])
    for _ in range(rng.choice([1, 1, 2, 3])):
        kw = rng.choice(["type", "enum", "const", "minimum", "exclusiveMaximum", "multipleOf", "minLength", "pattern", "required",
                         "properties", "patternProperties", "additionalProperties", "propertyNames", "minProperties",
                         "dependentRequired", "dependentSchemas", "items", "prefixItems", "contains", "uniqueItems", "maxItems",
                         "allOf", "anyOf", "oneOf", "not", "if", "$ref"])
        s |= {"type": lambda: {"type": rng.choice(["integer", "string", "object", "array", ["null", "number"], "boolean"])},
              "enum": lambda: {"enum": rng.sample([1, 1.5, "a", None, True, [1], {"a": 1}], 3)},
              "const": lambda: {"const": rng.choice([2, "b", False, {"a": 1}])},
              "minimum": lambda: {"minimum": rng.choice([0, 1.5, 3])}, "exclusiveMaximum": lambda: {"exclusiveMaximum": rng.choice([2, 4.5])},
              "multipleOf": lambda: {"multipleOf": rng.choice([2, 0.5, 0.1])}, "minLength": lambda: {"minLength": 2, "maxLength": 3},
              "pattern": lambda: {"pattern": rng.choice(["^a", "b$", "."])}, "required": lambda: {"required": rng.sample("abc", 2)},
              "properties": lambda: {"properties": {k: sub() for k in rng.sample("abc", 2)}},
              "patternProperties": lambda: {"patternProperties": {rng.choice(["^a", "b|c"]): sub()}},
              "additionalProperties": lambda: {"additionalProperties": rng.choice([False, sub()])},
              "propertyNames": lambda: {"propertyNames": {"pattern": rng.choice(["^[ab]$", "c"])}},
              "minProperties": lambda: {"minProperties": 1, "maxProperties": 2},
              "dependentRequired": lambda: {"dependentRequired": {"a": ["b"]}}, "dependentSchemas": lambda: {"dependentSchemas": {"b": sub()}},
              "items": lambda: {"items": sub()}, "prefixItems": lambda: {"prefixItems": [sub(), sub()]},
              "contains": lambda: {"contains": sub(), "minContains": rng.choice([0, 1, 2]), "maxContains": 2},
              "uniqueItems": lambda: {"uniqueItems": True}, "maxItems": lambda: {"maxItems": 2, "minItems": 1},
              "allOf": lambda: {"allOf": [sub(), sub()]}, "anyOf": lambda: {"anyOf": [sub(), sub()]}, "oneOf": lambda: {"oneOf": [sub(), sub()]},
              "not": lambda: {"not": sub()}, "if": lambda: {"if": sub(), "then": sub(), "else": sub()},
              "$ref": lambda: {"properties": {"c": {"$ref": "#"}}, "items": {"$ref": "#"}}}[kw]()
    return s


def random_value(rng, depth):
    k = rng.random()
    if depth and k < 0.35:
        return {x: random_value(rng, depth - 1) for x in rng.sample("abcd", rng.randrange(4))}
    if depth and k < 0.6:
        return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return rng.choice([0, 1, 2, 3, 1.5, 2.0, 0.3, -1, "", "a", "ab", "abcd", "b", None, True, False])


def check(spark, cases, out=None):
    df = spark.createDataFrame([(i, json.dumps(s), json.dumps(v)) for i, (s, v) in enumerate(cases)], "i int, s string, j string")
    rows = validate_rows(df.withColumn("v", F.parse_json("j")), "v", "s").select("i", "violations").collect()
    got = {r.i: r.violations for r in rows}
    assert len(rows) == len(cases)
    wrong = [(s, v, got[i]) for i, (s, v) in enumerate(cases) if (got[i] == []) != valid(v, s, s)]
    assert not wrong, wrong[:3]
    return got


def test_random_schemas_equal_brute_force(spark):
    rng = random.Random(9)
    cases = []
    for _ in range(700):
        s = random_schema(rng, 2)
        cases += [(s, random_value(rng, 3)) for _ in range(3)]
    got = check(spark, cases)
    assert 300 < sum(not x for x in got.values()) < 1800


TREE = {"$defs": {"n": {"type": "object", "required": ["v"], "properties": {
    "v": {"type": "integer"}, "kids": {"type": "array", "items": {"$ref": "#/$defs/n"}}}}}, "$ref": "#/$defs/n"}


def test_recursive_reference_follows_the_data(spark):
    deep = {"v": 0}
    for i in range(1, 14):
        deep = {"v": i, "kids": [deep, {"v": -i}]}
    bad = json.loads(json.dumps(deep).replace('"v": 0', '"v": "zero"'))
    got = check(spark, [(TREE, deep), (TREE, bad), (TREE, {"kids": []})])
    assert got[1] == ["$" + ".kids[0]" * 13 + ".v: expected type integer"] and got[2] == ["$: missing v"]


def test_messages_name_the_place(spark):
    s = {"properties": {"a": {"minimum": 3}, "b": {"items": {"type": "string"}}}, "additionalProperties": False}
    got = check(spark, [(s, {"a": 1, "b": ["x", 2], "z": 0})])
    assert sorted(got[0]) == ["$.a: minimum", "$.b[1]: expected type string", "$.z: no value allowed"]


def test_tiny_and_huge_numbers(spark):
    cases = [({"exclusiveMinimum": 0}, 1e-13), ({"exclusiveMinimum": 0}, 0), ({"multipleOf": 1e-13}, 3e-13), ({"maximum": 1e-14}, 1e-13),
             ({"minimum": 10**25}, 10**25 - 1), ({"const": 1e30}, 1e30), ({"minimum": 9007199254740993}, 9007199254740992)]
    df = spark.createDataFrame([(i, json.dumps(s), json.dumps(v)) for i, (s, v) in enumerate(cases)], "i int, s string, j string")
    got = {r.i: r.violations == [] for r in validate_rows(df.withColumn("v", F.parse_json("j")), "v", "s").collect()}
    assert [got[i] for i in (0, 1, 3, 4, 5, 6)] == [True, False, False, False, True, False]


@pytest.mark.parametrize("schema", ["{oops", '{"$ref":"http://x/y"}', '{"$ref":"#/nowhere"}', '{"unevaluatedItems":false}', "[1]",
                                    '{"allOf":[{"$ref":"#"}]}', '{"$defs":{"a":{"$ref":"#/$defs/b"},"b":{"$ref":"#/$defs/a"}},"$ref":"#/$defs/a"}'])
def test_schemas_that_cannot_be_checked_fail(spark, schema):
    with pytest.raises((SchemaError, ValueError)):
        compile_nodes(json.loads(schema))
    df = spark.createDataFrame([(schema, "1")], "s string, j string")
    with pytest.raises(Exception) as e:
        validate_rows(df.withColumn("v", F.parse_json("j")), "v", "s").collect()
    assert "schema cannot be checked" in str(e.value)


def test_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(None, "1"), ('{"type":"string"}', None), ('{"type":"string"}', "null"), ("true", "1"), ("false", "1")],
                               "s string, j string")
    got = [r.violations for r in validate_rows(df.withColumn("v", F.parse_json("j")), "v", "s").collect()]
    assert sorted(map(str, got)) == sorted(["None", "None", "['$: expected type string']", "[]", "['$: no value allowed']"])
    assert validate_rows(df.limit(0).withColumn("v", F.parse_json("j")), "v", "s").count() == 0


def test_ten_thousand_schemas_in_one_batch(spark, fx):
    texts = ['{"type":"object","title":"t%d","properties":{"a":{"type":"integer","minimum":%d},"b":{"type":"string"}}}' % (i, i)
             for i in range(10_000)]
    df = spark.createDataFrame([(i, t, '{"a":%d,"b":"x"}' % (5000)) for i, t in enumerate(texts)], "i int, s string, j string")
    out = validate_rows(df.withColumn("v", F.parse_json("j")), "v", "s")
    assert {r.i for r in out.where("size(violations) > 0").collect()} == set(range(5001, 10_000))
    assert len(out._jdf.queryExecution().executedPlan().toString()) < 30_000  # the plan does not grow with the schemas


def test_encode_checks_recursive_schemas(spark, fx):
    good = spark.createDataFrame([("zz", json.dumps(TREE), '{"v":1,"kids":[{"v":2}]}')], "topic string, schema string, data string")
    out, _ = messages.encode_json(spark, fx.registry, good, "topic", "schema", "data")
    assert out.first().message is not None
    bad = good.withColumn("data", F.lit('{"v":1,"kids":[{"w":2}]}'))
    out, _ = messages.encode_json(spark, fx.registry, bad, "topic", "schema", "data")
    with pytest.raises(Exception) as e:
        out.count()
    assert "$.kids[0]: missing v" in str(e.value)


def test_nodes_that_say_nothing_of_a_value_are_not_checked(spark):
    """Own checks run only where a node has some; leaves and combinations still give their verdicts."""
    from topiclake.functions.schema_nodes import schema_nodes
    from topiclake.operators.validation import _with_flags
    plain, own = '{"properties":{"a":{}},"items":{"type":"string"}}', '{"minimum":1}'
    schemas = spark.createDataFrame([(1, plain), (2, own), (3, '{"required":["a"]}'), (4, "false"), (5, '{"enum":["x"]}')], "id long, s string")
    flags = {(r.id, r.node): (r._checks, r._counts) for r in _with_flags(schema_nodes(schemas, "s", "id")[0]).collect()}
    assert flags[1, 0] == (False, False) and flags[2, 0] == (True, True)
    assert flags[3, 0] == flags[4, 0] == (True, False) and flags[5, 0][0]
    cases = [("[]", '{"contains":{}}', 1), ("[1]", '{"contains":{"type":"string"}}', 1), ("{}", '{"contains":{}}', 0), ("{}", "false", 1),
             ('{"a":[{"b":{}},[],null]}', '{"additionalProperties":{"items":{"not":{"type":"array"}}}}', 1),
             ('{"a":{}}', '{"properties":{"a":{"type":"object"}}}', 0), ('{"a":null}', '{"properties":{"a":{"type":"null"}}}', 0),
             ("1", '{"anyOf":[{"type":"string"},{"type":"array"}]}', 1), ("[[]]", '{"oneOf":[{},{"items":{"maxItems":1}}]}', 1)]
    df = spark.createDataFrame([(i, v, s) for i, (v, s, _) in enumerate(cases)], "i int, t string, s string")
    out = validate_rows(df.withColumn("v", F.parse_json("t")), "v", "s")
    got = {r.i: r.n for r in out.select("i", F.size("violations").alias("n")).collect()}
    assert got == {i: n for i, (_, _, n) in enumerate(cases)}
