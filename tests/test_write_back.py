"""What is stored after an edit: whole documents, the same winner however rows are dealt out, untouched files left alone."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.operators import edits as E
from fleetaudit.operators import fields as D
from fleetaudit.sinks import tables
from fleetaudit.sources import readers
from fleetaudit.sources import schemas as T

POLICY = {
    "description": "d", "default_state": "hot", "schema_version": 7, "extra": {"deep": [1, {"k": None}]},
    "states": [
        {"name": "hot", "note": "keep me", "actions": [{"retry": {"count": 3}}, {"rollover": {"min_size": "1gb"}, "timeout": "1h"}],
         "transitions": [{"state_name": "cold", "x": 1, "conditions": {"min_index_age": "1d"}}, {"state_name": "cold", "y": 2, "conditions": {"min_size": "5gb"}}]},
        {"name": "cold", "actions": [], "transitions": []}],
    "ism_template": [{"index_patterns": ["a*"], "priority": 1, "owner": "A"}, {"index_patterns": ["b*"], "priority": 2, "owner": "B"}, {"index_patterns": ["c*"], "owner": "C"}]}


@pytest.fixture(scope="module")
def policies(spark):
    bodies = [{"_id": name, "_seq_no": 4, "_primary_term": 1, "policy": POLICY} for name in ("p", "q")]
    return readers.policies(spark.createDataFrame([(json.dumps(b, indent=1),) for b in bodies], "value string"))


def stored(policies, outcome, column):
    rows = {r.policy_id: r for r in E.policy_documents(E.commit(policies, outcome, column)).collect()}
    before = {r.policy_id: r.document for r in policies.collect()}
    assert rows["q"].document == before["q"] and rows["q"].seq_no == 4
    return json.loads(rows["p"].document), rows["p"].seq_no


def test_rollover_keeps_all_other_keys(spark, policies):
    edits = spark.createDataFrame([("p", "hot", '{"min_doc_count":5,"min_size":"none"}')], "policy_id string, state_name string, c string")
    got, seq_no = stored(policies, E.set_rollover(edits.withColumn("conditions", F.from_json("c", T.CONDITIONS)), policies), "states")
    want = json.loads(json.dumps(POLICY))
    want["states"][0]["actions"][1]["rollover"] = {"min_doc_count": 5}
    assert (got, seq_no) == (want, 5)


@pytest.mark.parametrize("to_state,conditions,position,change", [
    ("cold", {"min_index_age": "9d"}, "first", lambda t: t[0]["conditions"].update(min_index_age="9d")),
    ("cold", {"min_index_age": "none"}, "first", lambda t: t.pop(0)),
    ("gone", {"min_size": "1gb"}, "first", lambda t: t.insert(0, {"state_name": "gone", "conditions": {"min_size": "1gb"}})),
    ("gone", {"min_size": "1gb"}, "last", lambda t: t.append({"state_name": "gone", "conditions": {"min_size": "1gb"}})),
])
def test_transition_keeps_all_other_keys(spark, policies, to_state, conditions, position, change):
    edits = spark.createDataFrame([("p", "hot", to_state, json.dumps(conditions), position)], "policy_id string, from_state string, to_state string, c string, position string")
    got, _ = stored(policies, E.set_transition(edits.withColumn("conditions", F.from_json("c", T.CONDITIONS)), policies), "states")
    want = json.loads(json.dumps(POLICY))
    change(want["states"][0]["transitions"])
    assert got == want


def test_claims_keep_all_other_keys(spark, policies):
    edits = spark.createDataFrame([("p", [("c*", "z*")], ["a*"], ["n*"], 1, 9)],
                                  "policy_id string, replace array<struct<old:string,new:string>>, remove array<string>, add array<string>, entry_index int, priority int")
    got, _ = stored(policies, E.edit_ism_template(edits, policies, 99), "ism_template")
    want = json.loads(json.dumps(POLICY))
    want["ism_template"] = [{"index_patterns": ["b*", "n*"], "priority": 9, "owner": "B", "last_updated_time": 99}, {"index_patterns": ["z*"], "owner": "C", "last_updated_time": 99}]
    assert got == want


def test_edits_follow_each_other(spark, policies):
    claims = spark.createDataFrame([("p", None, None, ["n*"], 0, None)],
                                   "policy_id string, replace array<struct<old:string,new:string>>, remove array<string>, add array<string>, entry_index int, priority int")
    first = E.commit(policies, E.edit_ism_template(claims, policies, 99), "ism_template")
    edits = spark.createDataFrame([("p", "hot", '{"min_size":"2gb"}')], "policy_id string, state_name string, c string")
    got, seq_no = stored(first, E.set_rollover(edits.withColumn("conditions", F.from_json("c", T.CONDITIONS)), first), "states")
    assert seq_no == 6 and got["ism_template"][0]["index_patterns"] == ["a*", "n*"] and got["states"][0]["actions"][1] == {"rollover": {"min_size": "2gb"}, "timeout": "1h"}


def test_new_policy_has_a_document(spark, policies):
    requests = spark.createDataFrame([("new", None, None, ["x*"], None)], "policy_id string, description string, state string, patterns array<string>, priority int")
    created, _ = E.create_policies(requests, policies)
    both = policies.unionByName(created, allowMissingColumns=True)
    got = {r.policy_id: json.loads(r.document) for r in E.policy_documents(both).collect()}
    assert got["new"]["states"] == [{"name": "keep", "actions": [], "transitions": []}] and got["new"]["ism_template"] == [{"index_patterns": ["x*"], "priority": 100}]
    assert got["p"] == POLICY


def test_changed_at(spark):
    docs = spark.createDataFrame([('{"a":[{"b":1},{"b":2,"c":[]}],"z":null}',), ("{}",), ("[1]",)], "t string")
    doc = J.parsed(F.col("t"))
    put = J.changed_at(doc, ("a", F.lit(1), "b"), lambda old: (old.cast("int") + 5).cast("variant"))
    gone = J.changed_at(doc, ("a", F.lit(0), "b"), lambda _: F.lit(None).cast("variant"))
    rows = [(json.loads(r[0]), json.loads(r[1])) for r in docs.select(F.to_json(put), F.to_json(gone)).collect()]
    assert rows[0] == ({"a": [{"b": 1}, {"b": 7, "c": []}], "z": None}, {"a": [{}, {"b": 2, "c": []}], "z": None})
    assert rows[1] == ({"a": []}, {"a": []}) and rows[2] == ({"a": []}, {"a": []})


def test_template_bodies(spark):
    index = {"index_patterns": ["l*"], "priority": 5, "_meta": {"o": 1}, "template": {"mappings": {"dynamic": False}, "settings": {"index": {"codec": "best"}, J.POLICY_KEY: "old"}}}
    bare = {"index_patterns": ["b*"]}
    body = {"index_templates": [{"name": "t", "index_template": index}, {"name": "b", "index_template": bare}]}
    templates = readers.index_templates(spark.createDataFrame([(json.dumps(body),)], "value string"))
    edits = spark.createDataFrame([("t", "new"), ("b", "new"), ("none", "x")], "name string, policy_id string")
    got = {r.name: r for r in E.set_template_policy(edits, templates).collect()}
    nested = {"plugins": {"index_state_management": {"policy_id": "new"}}}
    index["template"]["settings"] = {"index": {"codec": "best"} | nested}
    assert json.loads(got["t"].body) == index and got["t"].before == "old"
    assert json.loads(got["b"].body) == bare | {"template": {"settings": {"index": nested}}}
    assert got["none"].body is None and got["none"].error


def winners(make, frame, parts=(1, 3, 7)):
    out = [make(frame.repartition(n).sortWithinPartitions(F.rand(n))) for n in parts]
    assert all(o == out[0] for o in out)
    return out[0]


def test_the_same_edit_wins_however_rows_lie(spark, policies):
    names = "policy_id string, replace array<struct<old:string,new:string>>, remove array<string>, add array<string>, entry_index int, priority int"
    edits = spark.createDataFrame([("p", None, None, [f"n{k}*"], 0, k) for k in range(20)], names)

    def changed(e):
        return [r.after for r in E.edit_ism_template(e, policies, 99).collect() if r.changed]

    assert len(winners(changed, edits)) == 1
    requests = spark.createDataFrame([("new", f"d{k}", None, [], None) for k in range(20)], "policy_id string, description string, state string, patterns array<string>, priority int")
    assert len(winners(lambda r: [x.description for x in E.create_policies(r, policies)[0].collect()], requests)) == 1


def test_the_same_object_stays_however_rows_lie(spark, tmp_path):
    for k in range(4):
        page = {"saved_objects": [{"type": "t", "id": "1", "attributes": {"title": f"{9 - k}{i}"}} for i in range(5)]}
        (tmp_path / f"p{k}.json").write_text(json.dumps(page))
    pages = readers.read_responses(spark, str(tmp_path))
    assert winners(lambda p: [r.title for r in readers.saved_objects(p).collect()], pages) == ["64"]
    documents = spark.createDataFrame([("t:1", json.dumps({"type": "t", "t": {"title": str(k)}})) for k in range(20)], "_id string, _source string")
    assert len(winners(lambda d: [r.title for r in readers.saved_objects(documents=d).collect()], documents)) == 1
    cached = spark.createDataFrame([("f", "number", k, False) for k in range(20)], "name string, type string, count bigint, scripted boolean")
    caps = spark.createDataFrame([("f", "long", "i", True, True)], "field string, type string, index_name string, aggregatable boolean, searchable boolean")
    assert winners(lambda c: [r["count"] for r in D.refresh_field_list(caps, c).collect()], cached) == [19]


STORED = "type string, id string, title string"


def test_upsert_without_numbers(spark):
    stored = spark.createDataFrame([("t", "1", "old"), ("t", "2", "old")], STORED)
    incoming = spark.createDataFrame([("t", "1", "a", None), ("t", "1", "b", None), ("t", "2", "late", None), ("t", "2", "numbered", 1)], f"{STORED}, n int")
    got = winners(lambda i: sorted(tuple(r) for r in tables.upsert(stored, i, "n").collect()), incoming)
    assert got == [("t", "1", "b"), ("t", "2", "numbered")]
    with pytest.raises(Exception, match="a row has no key"):
        tables.upsert(stored, spark.createDataFrame([("t", None, "x", 1)], f"{STORED}, n int"), "n").collect()


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "objects")
    stored = spark.range(300).selectExpr("'t' AS type", "string(id) AS id", "'old' AS title")
    tables.write_buckets(stored, path, 8)
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    incoming = spark.createDataFrame([("t", "7", "new", 1), ("t", "7", "newer", 2)], f"{STORED}, n int")
    for _ in range(2):  # once more changes nothing
        tables.upsert_into(path, incoming, "n", 8)
        got = {r.id: r.title for r in tables.read_buckets(spark, path).collect()}
        assert len(got) == 300 and got.pop("7") == "newer" and set(got.values()) == {"old"}
    gone = {os.path.dirname(f) for f in before - files()}
    assert len(gone) == 1 and len({os.path.dirname(f) for f in before}) == 8
    tables.upsert_into(path, incoming.limit(0), "n", 8)
    assert tables.read_buckets(spark, path).count() == 300


def test_an_emptied_list_is_stored(spark):
    patterns = spark.createDataFrame([(p, json.dumps({"title": p, "x": 1, "fields": f})) for p, f in (("a", '[{"name":"gone"}]'), ("b", "[]"))], "id string, attributes string")
    cached = D.cached_entries(patterns.select("id", F.get_json_object("attributes", "$.fields").alias("fields")), ["id"])
    caps = spark.createDataFrame([], "id string, field string, type string, index_name string, aggregatable boolean, searchable boolean")
    lists = D.refreshed_lists(D.refresh_field_list(caps, cached, ["id"]), ["id"])
    got = {r.id: json.loads(r.attributes) for r in D.refreshed_patterns(patterns, lists, ["id"]).collect()}
    assert got == {p: {"title": p, "x": 1, "fields": "[]"} for p in "ab"}
