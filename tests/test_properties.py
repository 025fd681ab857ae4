"""Property tests (hypothesis) for the driver-side helpers and their column twins."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topiclake.functions import jsonschema as js
from topiclake.sources import topiclog as tl

names = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=126), min_size=0, max_size=12)


@settings(max_examples=40, deadline=None)
@given(host=names, topic=names)
def test_uri_roundtrip(host, topic):
    if "/" in host:
        return
    assert tl.parse_topic_uri(f"kafka://{host}/{topic}") == topic


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.just("kafka://h/a/b"), names), min_size=1, max_size=8))
def test_uri_column_matches_driver(spark, uris):
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    got = [r.t for r in df.select(tl.topic_uri_col(F.col("u")).alias("t")).collect()]
    want = []
    for u in uris:
        try:
            want.append(tl.parse_topic_uri(u))
        except ValueError:
            want.append(None)
    assert got == want


schemas = st.recursive(
    st.sampled_from([{"type": t} for t in ("integer", "number", "string", "boolean", "null")]),
    lambda inner: st.one_of(
        st.builds(lambda d: {"type": "object", "properties": d},
                  st.dictionaries(st.text(alphabet="abcxyz", min_size=1, max_size=3), inner, max_size=3)),
        st.builds(lambda i: {"type": "array", "items": i}, inner),
        st.builds(lambda ts: {"type": ts}, st.lists(st.sampled_from(["string", "null", "integer"]), max_size=3)),
    ),
    max_leaves=6)


@settings(max_examples=60, deadline=None)
@given(schemas)
def test_structure_text_is_canonical_and_typed(schema):
    import json
    text = js.structure_text(json.dumps(schema))
    assert text == js.dumps(json.loads(text))       # compact, key-sorted, stable
    js.spark_type(json.loads(text))                   # always maps to a Spark type
