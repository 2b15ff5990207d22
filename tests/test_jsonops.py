import json

import pytest
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J


def _one(spark, text, expr):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first().x


def test_mapping_paths(spark):
    doc = {"a": {"type": "text", "fields": {"raw": {}, "kw": {}}}, "bad": 3,
           "o": {"properties": {"x": {"type": "long"}, "y": {"properties": {"z": {"fields": {"k": 1}}}}}}}
    got = _one(spark, json.dumps(doc), lambda t: J.mapping_paths(t))
    assert sorted(got) == ["a", "a.kw", "a.raw", "o", "o.x", "o.y", "o.y.z", "o.y.z.k"]
    assert _one(spark, "{}", lambda t: J.mapping_paths(t)) == []
    assert _one(spark, "[1]", lambda t: J.mapping_paths(t)) == []


def test_descent_has_no_limit(spark):
    doc = {"type": "x"}
    for i in range(40):
        doc = {f"p{i}": {"properties": doc}} if i else {"leaf": doc}
    assert len(_one(spark, json.dumps(doc), J.mapping_paths)) == 40
    body = {"field": "deep"}
    for _ in range(45):
        body = {"aggs": [body]}
    assert _one(spark, json.dumps(body), J.values_of_key) == ["deep"]
    assert _one(spark, json.dumps({"a": ']}\\"}}', "b": [{"c": "{{{["}]}), J.nesting) == 3


def test_values_of_key(spark):
    doc = {"field": "a", "x": [{"field": {"field": "b"}}, {"field": 3}, {"y": {"field": "a"}}], "n": None}
    got = _one(spark, json.dumps(doc), lambda t: J.values_of_key(t))
    assert sorted(got) == ["a", "a", "b"]
    assert _one(spark, "{bad", lambda t: J.values_of_key(t)) == []


def test_stripped_search_source(spark):
    doc = {"query": {"query": "a:1", "language": "kuery"}, "filter": [{"x": 1}], "index": "i"}
    assert json.loads(_one(spark, json.dumps(doc), J.stripped_search_source)) == {
        "query": {"query": "", "language": "kuery"}, "filter": [], "index": "i"}
    assert json.loads(_one(spark, '{"query":"text"}', J.stripped_search_source)) == {"query": "text"}
    for kept in ("{bad", "[1]", ""):
        assert _one(spark, kept, J.stripped_search_source) == kept
    assert _one(spark, None, J.stripped_search_source) is None


def test_stripped_attributes(spark):
    def strip(text):
        return json.loads(_one(spark, text, lambda t: F.to_json(J.stripped_attributes(t))))

    inner = json.dumps({"query": {"query": "x"}, "filter": [1]})
    doc = {"title": "t", "n": 1.5, "kibanaSavedObjectMeta": {"searchSourceJSON": inner, "other": 1}}
    got = strip(json.dumps(doc))
    assert json.loads(got["kibanaSavedObjectMeta"].pop("searchSourceJSON")) == {"query": {"query": ""}, "filter": []}
    assert got == {"title": "t", "n": 1.5, "kibanaSavedObjectMeta": {"other": 1}}
    for kept in ('{"title":"t"}', '{"kibanaSavedObjectMeta":{"searchSourceJSON":"{bad"}}', '{"kibanaSavedObjectMeta":3}',
                 '{"kibanaSavedObjectMeta":{"searchSourceJSON":4}}'):
        assert strip(kept) == json.loads(kept)


def test_settings_policy_and_its_edit(spark):
    dotted, nested = '{"index.plugins.index_state_management.policy_id":"d"}', {
        "index": {"plugins": {"index_state_management": {"policy_id": "n"}}, "codec": "best"}}
    assert _one(spark, dotted, J.settings_policy) == "d"
    assert _one(spark, json.dumps(nested), J.settings_policy) == "n"
    assert _one(spark, "{}", J.settings_policy) is None

    def edit(text, policy):
        return json.loads(_one(spark, text, lambda t: J.with_settings_policy(t, F.lit(policy))))

    assert edit(dotted, "p") == {"index": {"plugins": {"index_state_management": {"policy_id": "p"}}}}
    assert edit(json.dumps(nested), "None") == {"index": {"codec": "best"}}
    assert edit(dotted, "none") == {"index": {}}
    assert edit('{"index":{"plugins":{"index_state_management":{"policy_id":"n","x":1}}},"a":2}', "none") == {
        "index": {"plugins": {"index_state_management": {"x": 1}}}, "a": 2}


def test_apply_conditions(spark):
    row = spark.sql("""SELECT J, U FROM (SELECT
        from_json('{"min_size":"50gb","min_doc_count":5,"keep":1}','map<string,variant>') J,
        from_json('{"min_size":"NONE","min_index_age":"1d","keep":null,"gone":"none"}','map<string,variant>') U)""")
    got = row.select(J.to_text(J.apply_conditions(F.col("J"), F.col("U"))).alias("x"),
                     J.to_text(J.apply_conditions(F.col("J"), F.lit(None).cast("map<string,variant>"))).alias("same"),
                     J.to_text(J.apply_conditions(F.lit(None).cast("map<string,variant>"), F.col("U"))).alias("new")).first()
    assert json.loads(got.x) == {"min_doc_count": 5, "keep": 1, "min_index_age": "1d"}
    assert json.loads(got.same) == {"min_size": "50gb", "min_doc_count": 5, "keep": 1}
    assert json.loads(got.new) == {"min_index_age": "1d"}


@pytest.mark.parametrize("text,count", [(None, 0), ("", 0), ("[1,2]", 2), ('{"a":1}', 1), ("{bad", None), ("3", None),
                                        ('"abc"', 3), ("[]", 0)])
def test_cached_field_count(spark, text, count):
    assert _one(spark, text, J.cached_field_count) == count


@pytest.mark.parametrize("text", ["{}", "[]", "3", '"x"', "null", "{bad", "", " ", '{"a":1,}', "[1] 2", "true", "01"])
def test_validity_agrees_with_python(spark, text):
    try:
        json.loads(text)
        valid = True
    except ValueError:
        valid = False
    assert _one(spark, text, J.is_json) == valid


def test_values_of_a_key_however_deep_and_spelt(spark):
    deep = '{"field":"top","x":' * 9 + '[{"\\u0066ield":"low"}]' + "}" * 9
    texts = ['say "hi"', "back\\slash", '\\"', "tab\t\u0001\u0002", "", '"field":"no"', "é日", "a:b", "x" * 20_000 + '"' * 9_000]
    held = json.dumps({"a": [{"field": t} for t in texts], "b": {"field": {"field": 3}}, "field": ["field", "x"], "c": '{"field":"inside"}', "field2": "y", 'q"field': "z"})
    cases = [(deep, ["low"] + ["top"] * 9), (held, sorted(texts)), ('{"field":1}', []), ("{}", []), (None, []), ("{bad", []), ('"field"', []),
             ('{"a":{"field":"x"},"a":{"field":"last"}, "b" : {"field" : "spaced"}}', ["last", "spaced"])]
    rows = spark.createDataFrame([(k, c[0]) for k, c in enumerate(cases)], "k int, t string").select("k", J.values_of_key(F.col("t")).alias("got"))
    for r in rows.collect():
        assert sorted(r.got) == cases[r.k][1], r.k
