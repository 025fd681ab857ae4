"""Structure rules (one golden per rule, plus edge shapes) and validation predicates."""
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topiclake.functions import jsonschema as js

GOLDENS = [
    # 1 not an object
    ("true", '"JSON"'),
    ('"string"', '"JSON"'),
    # 2 combinators win over type
    ('{"type":"string","anyOf":[{"type":"string"}]}', '"JSON"'),
    ('{"oneOf":[]}', '"JSON"'),
    ('{"allOf":[],"type":"object"}', '"JSON"'),
    # 3 no type
    ('{"$ref":"#/x"}', '"JSON"'),
    ('{"enum":[1,2]}', '"JSON"'),
    # 4 type array with a complex entry
    ('{"type":["object","null"]}', '"JSON"'),
    ('{"type":["array","string"]}', '"JSON"'),
    # 5 one non-null entry
    ('{"type":["string","null"]}', '"VARCHAR"'),
    ('{"type":["null","integer",5]}', '"BIGINT"'),
    # 6 zero or several non-null entries (duplicates count)
    ('{"type":["null"]}', '"JSON"'),
    ('{"type":["string","string"]}', '"JSON"'),
    ('{"type":["string","integer"]}', '"JSON"'),
    # 7 type neither array nor string
    ('{"type":5}', '"JSON"'),
    # 8 primitives
    ('{"type":"integer"}', '"BIGINT"'),
    ('{"type":"number"}', '"DOUBLE"'),
    ('{"type":"string"}', '"VARCHAR"'),
    ('{"type":"boolean"}', '"BOOLEAN"'),
    ('{"type":"null"}', '"JSON"'),
    # 9 arrays
    ('{"type":"array","items":{"type":"integer"}}', '["BIGINT"]'),
    ('{"type":"array"}', '["JSON"]'),
    ('{"type":"array","items":[{"type":"integer"}]}', '["JSON"]'),
    # 10 objects (keys sorted in the text)
    ('{"type":"object","properties":{"b":{"type":"string"},"a":{"type":"integer"}}}', '{"a":"BIGINT","b":"VARCHAR"}'),
    ('{"type":"object"}', "{}"),
    ('{"type":"object","properties":{"xs":{"type":"array","items":{"type":"object","properties":'
     '{"v":{"type":"number"}}}}}}', '{"xs":[{"v":"DOUBLE"}]}'),
    # 11 unknown type name
    ('{"type":"date"}', '"JSON"'),
    # required / format / additionalProperties ignored
    ('{"type":"object","required":["a"],"additionalProperties":false,"properties":{"a":{"type":"string",'
     '"format":"email"}}}', '{"a":"VARCHAR"}'),
]


@pytest.mark.parametrize("schema,expected", GOLDENS)
def test_structure_golden(schema, expected):
    assert js.structure_text(schema) == expected


def test_unparsable_schema_raises():
    with pytest.raises(ValueError, match="schema text is not JSON"):
        js.structure_text("{nope")


def test_spark_type():
    t = js.schema_spark_type('{"type":"object","properties":{"n":{"type":"integer"},"tags":{"type":"array",'
                             '"items":{"type":"string"}},"any":{"anyOf":[]}}}')
    assert t == T.StructType([T.StructField("any", T.StringType()), T.StructField("n", T.LongType()),
                              T.StructField("tags", T.ArrayType(T.StringType()))])


def test_structure_udf_matches_driver_function(spark):
    rows = [(s,) for s, _ in GOLDENS]
    df = spark.createDataFrame(rows, "s string").select("s", js.structure_text_udf("s").alias("t"))
    for r in df.collect():
        assert r.t == js.structure_text(r.s)


SCHEMA = json.dumps({
    "type": "object", "required": ["id", "name"],
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "name": {"type": "string", "minLength": 2, "pattern": "^[a-z]+$"},
        "kind": {"enum": ["a", "b"]},
        "tags": {"type": "array", "items": {"type": "string", "maxLength": 3}, "maxItems": 3},
        "score": {"type": "number", "exclusiveMaximum": 10},
    },
    "additionalProperties": False,
})


@pytest.mark.parametrize("doc,expected", [
    ('{"id":1,"name":"ab"}', []),
    ('{"id":0,"name":"ab"}', ["$.id: minimum 1"]),
    ('{"id":1.5,"name":"ab"}', ["$.id: expected type integer"]),
    ('{"id":2.0,"name":"ab"}', []),
    ('{"name":"ab"}', ["$: missing id"]),
    ('{"id":1,"name":"A"}', ["$.name: minLength", "$.name: pattern"]),
    ('{"id":1,"name":"ab","kind":"c"}', ["$.kind: not in enum"]),
    ('{"id":1,"name":"ab","tags":["x","long"]}', ["$.tags[]: maxLength"]),
    ('{"id":1,"name":"ab","score":10}', ["$.score: exclusiveMaximum 10"]),
    ('{"id":1,"name":"ab","extra":1}', ["$: additional properties"]),
    ('[1]', ["$: expected type object"]),
])
def test_validation(spark, doc, expected):
    df = spark.createDataFrame([(doc,)], "d string")
    got = df.select(js.validation_column(F.parse_json("d"), SCHEMA).alias("v")).first().v
    assert sorted(got) == sorted(expected)
    framed = js.validate(df.select(F.parse_json("d").alias("p")), "p", SCHEMA).first().violations
    assert sorted(framed) == sorted(expected)


def test_unsupported_keyword_fails_at_build():
    with pytest.raises(ValueError, match="unsupported"):
        js.validation_column(F.lit(None), '{"type":"object","dependentRequired":{}}')
