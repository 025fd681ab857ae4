"""Every validation keyword: accepted and rejected values (expected verdicts by hand)."""
import json

import pytest
from pyspark.sql import functions as F

from topiclake.functions import jsonschema

CASES = [
    ({"enum": [1.0, "a", None]}, ["1", "1.0", '"a"', "null"], ["2", '"b"', "true"]),
    ({"const": 3}, ["3", "3.0"], ["4", '"3"']),
    ({"type": "integer"}, ["1", "1.0", "1e2"], ["1.5", '"1"']),
    ({"maximum": 9007199254740992}, ["9007199254740992"], ["9007199254740993"]),
    ({"minimum": 1, "exclusiveMinimum": True}, ["2"], ["1", "0"]),
    ({"minimum": 1, "exclusiveMinimum": False}, ["1"], ["0"]),
    ({"exclusiveMaximum": 5}, ["4.9", '"x"'], ["5", "6"]),
    ({"multipleOf": 0.1}, ["0.3", "2", '"x"'], ["0.35"]),
    ({"anyOf": [{"type": "string"}, {"minimum": 5, "type": "number"}]}, ['"x"', "6"], ["4", "true"]),
    ({"oneOf": [{"type": "number"}, {"minimum": 5}, {"type": "null"}]}, ["4", "3"], ["6"]),
    ({"oneOf": [{"type": "null"}, {"type": "object", "required": ["a"]}]}, ["null", '{"a":1}'], ["{}", "1"]),
    ({"allOf": [{"type": "integer"}, {"minimum": 2}]}, ["2"], ["1", "2.5"]),
    ({"not": {"type": "string"}}, ["1"], ['"s"']),
    ({"$defs": {"p": {"type": "integer", "minimum": 0}}, "properties": {"a": {"$ref": "#/$defs/p"}}},
     ['{"a":1}', "{}"], ['{"a":-1}', '{"a":"x"}']),
    ({"uniqueItems": True}, ["[1,2]", "[]"], ["[1,1]"]),
    ({"items": [{"type": "integer"}, {"type": "string"}], "additionalItems": False}, ['[1,"a"]', "[1]"],
     ['["a",1]', '[1,"a",2]']),
    ({"prefixItems": [{"type": "integer"}], "items": {"type": "string"}}, ['[1,"a","b"]'], ['[1,"a",2]', '["x"]']),
    ({"items": False}, ["[]"], ["[1]"]),
    ({"properties": {"a": {}}, "additionalProperties": {"type": "integer"}}, ['{"a":"x","b":1}'], ['{"b":"x"}']),
    ({"patternProperties": {"^n_": {"type": "number"}}, "additionalProperties": False}, ['{"n_a":1}', "{}"],
     ['{"n_a":"x"}', '{"other":1}']),
    ({"minProperties": 1, "maxProperties": 2}, ['{"a":1}'], ["{}", '{"a":1,"b":1,"c":1}']),
    ({"properties": {"it's": {"type": "integer"}}, "required": ["it's"]}, ['{"it\'s":1}'], ["{}", '{"it\'s":"x"}']),
]


@pytest.mark.parametrize("schema,good,bad", CASES, ids=[json.dumps(c[0])[:40] for c in CASES])
def test_keyword(spark, schema, good, bad):
    rows = [(t, True) for t in good] + [(t, False) for t in bad]
    df = spark.createDataFrame(rows, "j string, want boolean").withColumn("v", F.parse_json("j"))
    got = jsonschema.validate(df, "v", json.dumps(schema), "checks").select("j", "want", "checks").collect()
    assert {r.j: (not r.checks) for r in got} == {r.j: r.want for r in got}


@pytest.mark.parametrize("schema", [{"if": {}}, {"$ref": "http://x/y"}, {"$ref": "#/nowhere"},
                                    {"properties": {"a": {"$ref": "#"}}}, {"contains": {}}])
def test_unsupported_fails_while_building(schema):
    with pytest.raises(ValueError):
        jsonschema._violations(_Any(), schema, "$")


class _Any:
    """Stands for a column: these schemas fail before any expression is built."""

    def __getattr__(self, name):
        raise ValueError("expression built")
