"""Readers over dumped files, and an export that is written, read back and imported."""

import json

import pytest
from pyspark.sql import functions as F

from fleetaudit.operators import fields as D
from fleetaudit.operators import lifecycle as L
from fleetaudit.operators import saved_objects as O
from fleetaudit.sinks import tables
from fleetaudit.sources import readers
from fleetaudit.streaming import snapshots


def _dump(directory, *bodies):
    directory.mkdir(parents=True, exist_ok=True)
    for i, body in enumerate(bodies):
        (directory / f"r{i}.json").write_text(json.dumps(body, indent=1))
    return str(directory)


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_responses(spark, str(tmp_path / "nothing*.json")).count()


def test_explain_and_friends(spark, tmp_path):
    body = {"i1": {"index.plugins.index_state_management.policy_id": None, "policy_id": "p", "policy_seq_no": 3, "state": {"name": "hot"},
                   "action": {"name": "a", "failed": True, "consumed_retries": 2}, "step": {}, "info": {"message": "m"}},
            "i2": {"policy_id": "p", "state": {}, "info": "text"}, "total_managed_indices": 2}
    for cluster in ("c1", "c2"):
        _dump(tmp_path / "explain" / f"cluster_id={cluster}", body)
    rows = readers.explain_rows(readers.read_responses(spark, str(tmp_path / "explain")), scope=["cluster_id"])
    assert {(r.cluster_id, r.index_name, r.state and r.state.name, r.step, r.policy_seq_no) for r in rows.collect()} == {
        (c, i, s, None, n) for c in ("c1", "c2") for i, s, n in (("i1", "hot", 3), ("i2", None, None))}
    status = L.policy_status(rows, 0, scope=["cluster_id"])
    assert {(r["index"], r.step_status, r.retries, r.error) for r in status.collect()} == {("i1", "failed", 2, "m"), ("i2", "unknown", 0, "text")}

    stats = readers.read_responses(spark, _dump(tmp_path / "stats", {"indices": {"i1": {"total": {"store": {"size_in_bytes": 5}}}, "i2": {}}}))
    assert {tuple(r) for r in readers.index_stats(stats).collect()} == {("i1", 5), ("i2", 0)}

    layers = readers.read_responses(spark, _dump(tmp_path / "set", {"defaults": {"a": "1"}, "transient": {}, "persistent": {"a": "2"}}))
    assert {tuple(r) for r in readers.settings_layers(layers).collect()} == {("defaults", "a", "1"), ("persistent", "a", "2")}

    policy = {"_id": "p", "_seq_no": 7, "_primary_term": 1, "policy": {"policy_id": "p", "states": [
        {"name": "hot", "actions": [{"rollover": {"min_size": "1gb"}}], "transitions": [{"state_name": "cold", "conditions": {"min_doc_count": 5}}]}],
        "ism_template": [{"index_patterns": ["a*"], "priority": 1}]}}
    table = readers.policies(readers.read_responses(spark, _dump(tmp_path / "pol", policy, {"_id": "x"})))
    row = table.select("policy_id", "seq_no", F.col("states")[0]["actions"][0].alias("a"), F.to_json("states").alias("s")).first()
    assert (table.count(), row.policy_id, row.seq_no, json.loads(row.a)) == (1, "p", 7, {"rollover": {"min_size": "1gb"}})


def test_names_mappings_templates_tasks(spark, tmp_path):
    streams = readers.data_streams(readers.read_responses(spark, _dump(tmp_path / "ds", {"data_streams": [
        {"name": "ds", "status": "GREEN", "generation": 2, "indices": [{"index_name": ".ds-1"}, {"index_name": ".ds-2"}]}, {"name": "void", "indices": []}]})))
    indices = spark.createDataFrame([("i1",), (None,)], "index string")
    aliases = spark.createDataFrame([("al", "i1")], "alias string, index string")
    names = readers.index_names(indices, aliases, streams)
    assert {(r.name, r.index_name) for r in names.collect()} == {("i1", "i1"), ("al", "i1"), ("ds", ".ds-1"), ("ds", ".ds-2"), ("void", None),
                                                                (".ds-1", ".ds-1"), (".ds-2", ".ds-2")}
    assert {r.name for r in readers.index_names(streams=streams).collect()} == {"ds", "void", ".ds-1", ".ds-2"}

    maps = readers.index_mappings(readers.read_responses(spark, _dump(tmp_path / "map", {"i1": {"mappings": {"properties": {"a": {}}}}, "i2": {"mappings": {}}})))
    assert {(r.index_name, r.properties) for r in maps.collect()} == {("i1", '{"a":{}}'), ("i2", "{}")}
    mapped, paths = O.flattened_mappings(maps)
    assert [r.index_name for r in mapped.collect()] == ["i1"] and [r.path for r in paths.collect()] == ["a"]

    idx = readers.index_templates(readers.read_responses(spark, _dump(tmp_path / "it", {"index_templates": [
        {"name": "t", "index_template": {"index_patterns": ["a*"], "composed_of": ["c"], "template": {"settings": {"x": 1}}}}, {}]})))
    assert {(r.name, r.settings) for r in idx.collect()} == {("t", '{"x":1}'), ("-", None)}
    comp = readers.component_templates(readers.read_responses(spark, _dump(tmp_path / "ct", {"component_templates": [{"name": "c", "component_template": {"version": 3}}]})))
    assert tuple(comp.first()) == ("c", 3, None, '{"version":3}')

    tasks = readers.tasks(readers.read_responses(spark, _dump(tmp_path / "t", {"nodes": {"n": {"name": "node", "tasks": {"n:1": {"action": "a"}, "n:2": {}}}}})))
    assert {(r.node, r.task_id, r.action) for r in tasks.collect()} == {("node", "n:1", "a"), ("node", "n:2", None)}
    pending = readers.pending_tasks(readers.read_responses(spark, _dump(tmp_path / "p", {"tasks": [{"insert_order": 1, "source": "s"}]})))
    assert pending.first().insert_order == 1
    hits = readers.managed_config(readers.read_responses(spark, _dump(tmp_path / "m", {"hits": {"hits": [
        {"_source": {"managed_index": {"index": "i", "schedule": {"interval": {"period": 5, "unit": "M"}}}}}, {"_source": {}}]}})))
    assert [(r.index_name, r.schedule.interval.period) for r in hits.collect()] == [("i", 5)]
    detectors = readers.detectors(readers.read_responses(spark, _dump(tmp_path / "d", {"hits": {"hits": [{"_id": "a", "_source": {"name": "A"}}, {"_id": "b"}]}})), ids=["b"])
    assert [tuple(r) for r in O.list_detectors(detectors).collect()] == [("detector", "b", "N/A")]


@pytest.mark.parametrize("body", [{"result": {"workspaces": [{"id": "w"}]}}, {"result": [{"id": "w"}]}, [{"id": "w"}], {"workspaces": [{"id": "w"}]}])
def test_workspaces(spark, tmp_path, body):
    got = readers.workspaces(readers.read_responses(spark, _dump(tmp_path / "w", body)))
    assert [tuple(r) for r in got.collect()] == [("w", None, None)]


def test_workspaces_of_another_shape_fail(spark, tmp_path):
    with pytest.raises(Exception, match="unexpected workspace list"):
        readers.workspaces(readers.read_responses(spark, _dump(tmp_path / "w", {"result": {"x": 1}}))).collect()


def test_field_caps_and_refresh(spark, tmp_path):
    body = {"indices": ["i1", "i2"], "fields": {
        "a": {"keyword": {"aggregatable": True, "searchable": True, "indices": ["i1"]}, "text": {"aggregatable": False, "searchable": True, "indices": ["i2"]}},
        "a.raw": {"keyword": {"aggregatable": True, "searchable": False}}, "o": {"object": {}}, "o.x": {"long": {"aggregatable": True}},
        "_id": {"_id": {}}, "n": {"flat_object": {}}}}
    caps = readers.field_caps(readers.read_responses(spark, _dump(tmp_path / "f", body))).withColumn("pattern_id", F.lit("p"))
    assert caps.filter("field = 'a'").count() == 2 and caps.filter("field = 'n'").count() == 2
    report = {r.field: r for r in D.field_report(caps).collect()}
    assert (report["a"].types, report["a"].conflict, report["a"].string_like, report["n"].unknown, report["_id"].unknown) == (["keyword", "text"], True, True, True, False)
    assert {(r.type, r.index_name) for r in D.conflict_indices(caps).collect()} == {("keyword", "i1"), ("text", "i2")}

    cached = spark.createDataFrame([("p", "a", "number", 7, False), ("p", "gone", "string", 1, False), ("p", "_src", "_source", 0, False),
                                    ("p", "o.x", "number", 2, True), ("q", "a", "string", 9, False)],
                                   "pattern_id string, name string, type string, count bigint, scripted boolean")
    out = D.refresh_field_list(caps, cached, scope=["pattern_id"])
    got = {(r.pattern_id, r.name): r for r in out.collect()}
    assert {k: r.change for k, r in got.items()} == {
        ("p", "a"): "kept", ("p", "gone"): "removed", ("p", "_src"): "kept", ("p", "o.x"): "kept", ("p", "a.raw"): "added", ("p", "o"): "added",
        ("p", "n"): "added", ("q", "a"): "removed"}
    a, raw, script = got["p", "a"], got["p", "a.raw"], got["p", "o.x"]
    assert (a.type, a["count"], a.es_types, a.aggregatable, a.read_from_doc_values) == ("string", 7, ["keyword", "text"], True, True)
    assert (raw.multi_parent, script.multi_parent, script.scripted, got["p", "n"].type) == ("a", None, True, "unknown")
    summary = {r.pattern_id: tuple(r)[1:] for r in D.refresh_summary(out, ["pattern_id"]).collect()}
    assert summary == {"p": (4, 6, 3, 1), "q": (1, 0, 0, 1)}
    replaced = D.refreshed_entries(out)
    assert replaced.filter("pattern_id = 'p'").count() == 6


def test_group_limit_runs_before_the_shuffle(spark):
    conflicts = spark.range(100).selectExpr("concat('f', id % 1) AS field", "concat('t', id % 1) AS type", "concat('i', lpad(id, 3, '0')) AS index_name")
    df = D.conflict_examples(conflicts)
    assert tuple(df.first()) == ("f0", "t0", 100, "i000, i001, i002 ...")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_export_round_trip(spark, tmp_path):
    source = json.dumps({"query": {"query": "x", "language": "k"}, "filter": [1]})
    rows = [("dashboard", "d", "D", json.dumps({"title": "D", "kibanaSavedObjectMeta": {"searchSourceJSON": source}}), [("r", "search", "s")], [], ""),
            ("search", "s", "S", '{"title":"S"}', [], [], ""), ("index-pattern", "ip", "logs", '{"title":"logs"}', [], [], "")]
    objects = spark.createDataFrame(rows, "type string, id string, title string, attributes string, references array<struct<name:string,type:string,id:string>>, workspaces array<string>, updated_at string")
    out = str(tmp_path / "export")
    tables.write_export(O.export_records(objects), O.export_header(objects), out)
    read = readers.read_export(spark, [f"{out}/objects", f"{out}/index_patterns"])
    got = {r.id: r for r in read.collect()}
    assert set(got) == {"d", "s"}
    attributes = json.loads(got["d"].attributes)
    assert json.loads(attributes["kibanaSavedObjectMeta"]["searchSourceJSON"]) == {"query": {"query": "", "language": "k"}, "filter": []}
    assert [tuple(r) for r in got["d"].references] == [("r", "search", "s")]
    errors = spark.createDataFrame([("search", "s", "conflict")], "type string, id string, error string")
    outcome = {r.id: (r.title, r.error) for r in O.import_outcome(read, errors).collect()}
    assert outcome == {"d": ("D", None), "s": ("S", "conflict")}


def test_import_takes_the_last_line(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text("\n".join(['{"_index_pattern_map":{}}', '{"id":"1","type":"search","attributes":{"v":1}}', "  ",
                                                  '{"id":"1","type":"search","attributes":{"v":2}}']) + "\n")
    (tmp_path / "b.ndjson").write_text('{"id":"2","type":"search","attributes":{"v":3}}\n')
    read = readers.read_export(spark, [str(tmp_path / "*.ndjson")])
    stored = spark.createDataFrame([("search", "1", "old"), ("search", "9", "kept")], "type string, id string, attributes string")
    after = tables.upsert(stored, read.select("type", "id", "attributes", "ordinal"), order="ordinal")
    assert {(r.id, r.attributes) for r in after.collect()} == {("1", '{"v":2}'), ("2", '{"v":3}'), ("9", "kept")}
    gone = spark.createDataFrame([("search", "9")], "type string, id string")
    assert {r.id for r in tables.delete(after, gone).collect()} == {"1", "2"}


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "bad.ndjson").write_text('{"id":"1"}\n{oops\n')
    with pytest.raises(Exception, match="malformed export line"):
        readers.read_export(spark, str(tmp_path / "bad.ndjson")).collect()


def test_pages_and_documents(spark, tmp_path):
    page = {"total": 2, "saved_objects": [{"type": "search", "id": "s", "attributes": {"title": ""}, "namespaces": ["default", "w"]}, {"type": "tag", "id": "t"}]}
    docs = {"hits": {"hits": [{"_id": "search:a:b", "_source": {"type": "search", "search": {"title": "T"}, "namespace": "default"}},
                              {"_id": "plain", "_source": {"type": "search", "search": [1]}}, {"_id": "config:1", "_source": {"type": "config"}}]}}
    pages = readers.read_responses(spark, _dump(tmp_path / "pages", page))
    raw = readers.search_documents(readers.read_responses(spark, _dump(tmp_path / "docs", docs)))
    got = {(r.id, r.title, tuple(r.workspaces), r.attributes) for r in readers.saved_objects(pages, raw, types=["search"]).collect()}
    assert got == {("s", "N/A", ("w",), '{"title":""}'), ("a:b", "T", (), '{"title":"T"}'), ("plain", "N/A", (), "{}")}


def test_stream_of_snapshots(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    _dump(inbox, {"i1": {"policy_id": "p", "action": {"failed": True}}, "i2": {"policy_id": "p"}})
    writer = snapshots.batch_reports(snapshots.snapshot_stream(spark, str(inbox)),
                                     lambda batch: L.policy_status(readers.explain_rows(batch), 0, failed_only=True), out, str(tmp_path / "cp"))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert [(r["index"], r.batch_id) for r in spark.read.parquet(out).collect()] == [("i1", 0)]


def test_export_files_come_in_argument_order(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.ndjson").write_text(json.dumps({"type": "t", "id": "1", "attributes": {"title": name}, "references": []}) + "\n")
    read = readers.read_export(spark, [str(tmp_path / "b.ndjson"), str(tmp_path / "a.ndjson")])
    stored = tables.upsert(read.drop("ordinal").limit(0), read, order="ordinal")
    assert [json.loads(r.attributes)["title"] for r in stored.collect()] == ["a"]


def test_one_row_per_object_and_error(spark, tmp_path):
    page = {"saved_objects": [{"type": "t", "id": "1", "attributes": {"title": title}} for title in ("old", "new")]}
    pages = readers.read_responses(spark, _dump(tmp_path / "p", page))
    assert [r.title for r in readers.saved_objects(pages, None).collect()] == ["new"]
    records = readers.saved_objects(pages, None)
    errors = spark.createDataFrame([("t", "1", "first", 1), ("t", "1", "again", 2)], "type string, id string, error string, n int")
    assert [r.error for r in O.import_outcome(records, errors, order="n").collect()] == ["again"]


def test_refreshed_list_keeps_scripts(spark):
    fields = json.dumps([{"name": "s", "type": "number", "count": 1, "scripted": True, "script": "old"},
                         {"name": "s", "type": "number", "count": 2, "scripted": True, "script": "doc", "lang": "painless"}, {"name": "a", "type": "number", "count": 7}])
    cached = D.cached_entries(spark.createDataFrame([("p", fields)], "pattern_id string, fields string"), ["pattern_id"])
    caps = spark.createDataFrame([("p", "a", "keyword", "i", True, True)], "pattern_id string, field string, type string, index_name string, aggregatable boolean, searchable boolean")
    refresh = D.refresh_field_list(caps, cached, ["pattern_id"])
    a, s = json.loads(D.refreshed_lists(refresh, ["pattern_id"]).first().fields)
    assert (a["esTypes"], a["count"], a["readFromDocValues"]) == (["keyword"], 7, True)
    assert s == {"name": "s", "type": "number", "count": 2, "scripted": True, "script": "doc", "lang": "painless"}
