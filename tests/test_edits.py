import json

import pytest
from pyspark.sql import functions as F

from fleetaudit.operators import edits as E
from fleetaudit.sources import schemas as T

NOW = 99


def _conditions(**kw):
    return json.dumps(kw)


@pytest.fixture(scope="module")
def policies(spark):
    rows = [
        ("p", 4, [("hot", ['{"retry":1}', '{"rollover":{"min_size":"1gb"},"x":1}', '{"rollover":{}}'],
                   [("cold", _conditions(min_index_age="1d")), ("cold", _conditions(min_size="5gb")), ("cold", _conditions(min_index_age="9d"))]),
                  ("bare", [], [])],
         [(["a*", "b*"], 1, 10), (["c*"], 2, 20), (["d*"], 3, 30)]),
        ("empty", 0, [("hot", [], [])], None),
    ]
    raw = spark.createDataFrame(rows, """policy_id string, seq_no bigint,
        states array<struct<name:string,actions:array<string>,transitions:array<struct<state_name:string,conditions:string>>>>,
        ism_template array<struct<index_patterns:array<string>,priority:int,last_updated_time:bigint>>""")

    def transition(t):
        return F.struct(t["state_name"].alias("state_name"), F.from_json(t["conditions"], T.CONDITIONS).alias("conditions"))

    states = F.transform("states", lambda s: s.withField("transitions", F.transform(s["transitions"], transition)))
    return raw.withColumn("states", states)


def _rollover(spark, policies, state, conditions, policy="p", **extra):
    edits = spark.createDataFrame([(policy, state, conditions, *extra.values())],
                                  "policy_id string, state_name string, c string" + "".join(f", {k} bigint" for k in extra))
    return E.set_rollover(edits.withColumn("conditions", F.from_json("c", T.CONDITIONS)), policies)


@pytest.mark.parametrize("state,conditions,after,changed", [
    ("hot", _conditions(min_size="1gb"), {"min_size": "1gb"}, False),
    (None, _conditions(min_size="2gb", min_doc_count=5), {"min_size": "2gb", "min_doc_count": 5}, True),
    ("hot", _conditions(min_size="None"), {}, True),
    ("hot", _conditions(min_size=None), {"min_size": "1gb"}, False),
])
def test_rollover(spark, policies, state, conditions, after, changed):
    out = _rollover(spark, policies, state, conditions)
    row = out.first()
    assert (json.loads(row.before), json.loads(row.after), row.changed, row.new_seq_no) == ({"min_size": "1gb"}, after, changed, 4 + changed)
    stored = E.commit(policies, out, "states").filter("policy_id = 'p'").select("seq_no", F.col("states")[0]["actions"].alias("a")).first()
    assert [json.loads(a) for a in stored.a] == [{"retry": 1}, {"rollover": after, "x": 1}, {"rollover": {}}]
    assert stored.seq_no == 4 + changed


@pytest.mark.parametrize("policy,state,extra,error", [
    ("p", "warm", {}, "State 'warm' not found in policy 'p'"),
    ("p", "bare", {}, "State 'bare' has no rollover action; add one to the policy first"),
    ("nobody", "hot", {}, "Policy 'nobody' not found"),
    ("p", "hot", {"expected_seq_no": 3}, "version conflict"),
])
def test_rollover_errors(spark, policies, policy, state, extra, error):
    out = _rollover(spark, policies, state, _conditions(min_size="9gb"), policy, **extra)
    row = out.first()
    assert (row.error, row.changed, row.after) == (error, False, None)
    assert {tuple(r) for r in E.commit(policies, out, "states").select("policy_id", "seq_no").collect()} == {("p", 4), ("empty", 0)}


@pytest.mark.parametrize("to_state,conditions,position,after,changed", [
    ("cold", _conditions(min_index_age="30d"), "first", [("cold", "min_index_age", "30d"), ("cold", "min_size", "5gb"), ("cold", "min_index_age", "9d")], True),
    ("cold", _conditions(min_index_age="1d"), "first", [("cold", "min_index_age", "1d"), ("cold", "min_size", "5gb"), ("cold", "min_index_age", "9d")], False),
    ("cold", _conditions(min_size="none"), "first", [("cold", "min_index_age", "1d"), ("cold", "min_index_age", "9d")], True),
    ("warm", _conditions(min_size="7gb"), None, [("warm", "min_size", "7gb"), ("cold", "min_index_age", "1d"), ("cold", "min_size", "5gb"), ("cold", "min_index_age", "9d")], True),
    ("warm", _conditions(min_size="7gb"), "last", [("cold", "min_index_age", "1d"), ("cold", "min_size", "5gb"), ("cold", "min_index_age", "9d"), ("warm", "min_size", "7gb")], True),
    ("warm", _conditions(min_size="none"), "first", None, False),
])
def test_transition(spark, policies, to_state, conditions, position, after, changed):
    edits = spark.createDataFrame([("p", "hot", to_state, conditions, position)], "policy_id string, from_state string, to_state string, c string, position string")
    row = E.set_transition(edits.withColumn("conditions", F.from_json("c", T.CONDITIONS)), policies).first()
    got = row.after and [(t["state_name"], *next(iter(t["conditions"].items()))) for t in json.loads(row.after)]
    assert (got, row.changed) == (after, changed)
    assert row.error == (None if after else E.NOTHING_TO_REMOVE)


@pytest.mark.parametrize("policy,edit,after,error", [
    ("p", {}, [(["a*", "b*"], 1, 10), (["c*"], 2, 20), (["d*"], 3, 30)], None),
    ("p", {"replace": [("a*", "b*"), ("b*", "z*")]}, [(["z*"], 1, NOW), (["c*"], 2, 20), (["d*"], 3, 30)], None),
    ("p", {"remove": ["a*", "b*"], "add": ["n*"], "entry_index": 2}, [(["c*"], 2, NOW), (["d*", "n*"], 3, NOW)], None),
    ("p", {"remove": ["b*"], "priority": 9}, [(["a*"], 9, NOW), (["c*"], 2, 20), (["d*"], 3, 30)], None),
    ("p", {"add": ["a*"]}, [(["a*", "b*"], 1, 10), (["c*"], 2, 20), (["d*"], 3, 30)], None),
    ("p", {"add": ["n*"], "entry_index": 3}, None, "entry-index 3 is out of range (3 entries)"),
    ("p", {"priority": 1, "entry_index": -1}, None, "entry-index -1 is out of range (3 entries)"),
    ("empty", {"add": ["n*", "n*"], "entry_index": 5}, [(["n*"], 100, NOW)], None),
    ("empty", {"priority": 3}, None, "entry-index 0 is out of range (0 entries)"),
    ("p", {"remove": ["a*", "b*", "c*", "d*"]}, [], None),
])
def test_claims(spark, policies, policy, edit, after, error):
    edits = spark.createDataFrame(
        [(policy, edit.get("replace"), edit.get("remove"), edit.get("add"), edit.get("entry_index"), edit.get("priority"))],
        "policy_id string, replace array<struct<old:string,new:string>>, remove array<string>, add array<string>, entry_index int, priority int")
    out = E.edit_ism_template(edits, policies, NOW)
    row = out.first()
    got = None if row.after is None else [(e["index_patterns"], e["priority"], e.get("last_updated_time")) for e in json.loads(row.after)]
    assert (got, row.error) == (after, error)
    before = [(["a*", "b*"], 1, 10), (["c*"], 2, 20), (["d*"], 3, 30)] if policy == "p" else []
    assert row.changed == (error is None and after != before)


def test_create(spark, policies):
    requests = spark.createDataFrame(
        [("p", None, None, ["x*"], None, 1), ("new", None, None, [], None, 2), ("new", "second", "s", ["y*"], 5, 3), ("own", "mine", "s", ["y*"], 5, 4)],
        "policy_id string, description string, state string, patterns array<string>, priority int, k int")
    created, rejected = E.create_policies(requests, policies, order="k")
    got = {r.policy_id: (r.description, r.states[0].name, r.ism_template) for r in created.drop("x").collect()}
    assert got["new"] == ("No-op policy: indices stay in 'keep' and are never modified.", "keep", None)
    assert got["own"][:2] == ("mine", "s") and got["own"][2][0].index_patterns == ["y*"] and got["own"][2][0].priority == 5
    assert {(r.policy_id, r.k, r.error) for r in rejected.collect()} == {("p", 1, "Policy 'p' already exists"), ("new", 3, "Policy 'new' already exists")}
    assert {(r.policy_id, r.index_pattern) for r in E.claimed_patterns(created).collect()} == {("own", "y*")}


def test_first_edit_wins(spark):
    edits = spark.createDataFrame([("p", 2), ("p", 1), ("q", 5)], "policy_id string, edit_no int")
    first, lost = E.first_edit_per_policy(edits, "edit_no")
    assert {tuple(r) for r in first.collect()} == {("p", 1), ("q", 5)}
    assert {tuple(r) for r in lost.collect()} == {("p", 2, "version conflict")}


def test_template_edit(spark):
    templates = spark.createDataFrame([("t", '{"index.plugins.index_state_management.policy_id":"old"}')], "name string, settings string")
    edits = spark.createDataFrame([("t", "new"), ("nope", "x")], "name string, policy_id string")
    got = {r.name: r for r in E.set_template_policy(edits, templates).collect()}
    assert (got["t"].before, got["t"].after, got["t"].error) == ("old", "new", None)
    assert json.loads(got["t"].settings) == {"index": {"plugins": {"index_state_management": {"policy_id": "new"}}}}
    assert (got["nope"].settings, got["nope"].error) == (None, "template 'nope' not found")


def test_rival_edits_of_one_policy(spark, policies):
    edits = spark.createDataFrame(
        [("p", None, None, ["z*"], 0, None, 2), ("p", None, None, ["y*"], 0, None, 1)],
        "policy_id string, replace array<struct<old:string,new:string>>, remove array<string>, add array<string>, entry_index int, priority int, edit_no int")
    out = E.edit_ism_template(edits, policies, NOW)
    assert sorted((r.changed, r.error) for r in out.collect()) == [(False, "version conflict"), (True, None)]
    stored = E.commit(policies, out, "ism_template").filter("policy_id = 'p'").collect()
    assert len(stored) == 1 and "y*" in stored[0].ism_template[0].index_patterns


def test_rival_requests_without_order(spark, policies):
    requests = spark.createDataFrame([("new", None, None, [], None)] * 2, "policy_id string, description string, state string, patterns array<string>, priority int")
    created, rejected = E.create_policies(requests, policies)
    assert (created.count(), rejected.count()) == (1, 1)
