import pytest

from usagelens.functions.json_scalar import json_scalars

DOCUMENTS = {
    "object": ('{"a":{"x":1}}', None),
    "array": ('{"a":[1]}', None),
    "string": ('{"a":"s"}', "s"),
    "string holding json": ('{"a":"{\\"x\\":1}"}', '{"x":1}'),
    "boolean": ('{"a":true}', "true"),
    "number": ('{"a":111}', "111"),
    "large number": ('{"a":11172752661556541681}', "11172752661556541681"),
    "json null": ('{"a":null}', None),
    "missing": ("{}", None),
    "malformed": ('{"a":"s", bad', None),
    "array document": ('[{"a":"s"}]', None),
    "no document": (None, None),
    "other key of unexpected type": ('{"a":"s","b":"text"}', "s"),
}


@pytest.mark.parametrize("case", DOCUMENTS)
def test_only_scalars_have_a_text(spark, case):
    document, expected = DOCUMENTS[case]
    df = spark.createDataFrame([(document,)], "doc string")
    row = json_scalars(df, "doc", {"value": "$.a", "below": "$.b.c"}).first()
    assert row["value"] == expected
    assert row["below"] is None


def test_paths_share_one_parse(spark):
    document = '{"r":{"spec":{"list":[{"id":"7"},{"id":"8"}]}},"userA":"x","usera":"y"}'
    df = spark.createDataFrame([(1, document)], "k int, doc string")
    paths = {
        "spec": "$.r.spec",
        "first": "$.r.spec.list[0].id",
        "second": "$.r.spec.list[1].id",
        "third": "$.r.spec.list[2].id",
        "upper": "$.userA",
        "lower": "$.usera",
    }
    result = json_scalars(df, "doc", paths, keep=["k"]).filter("upper IS NOT NULL AND first = '7'")
    assert tuple(result.first()) == (1, None, "7", "8", None, "x", "y")
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_records_are_read_like_text(spark):
    df = spark.sql("SELECT named_struct('a', 's', 'b', named_struct('c', 5)) AS doc")
    assert tuple(json_scalars(df, "doc", {"a": "$.a", "c": "$.b.c", "b": "$.b"}).first()) == ("s", "5", None)
