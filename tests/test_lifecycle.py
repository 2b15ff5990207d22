import pytest

from fleetaudit.operators import lifecycle as L
from fleetaudit.operators import tasks as K
from fleetaudit.operators import templates as P

SCHEMA = """cluster_id string, index_name string, policy_id_setting string, policy_id string, policy_seq_no bigint, state struct<name:string>,
 action struct<name:string,failed:boolean,consumed_retries:int>, step struct<name:string,step_status:string,start_time:bigint>,
 retry_info struct<failed:boolean,consumed_retries:int>, info string"""
NOW = 1_000_000_000


def _explain(spark, *rows):
    defaults = {"cluster_id": "c1", "policy_id_setting": None, "policy_id": None, "policy_seq_no": None, "state": None, "action": None,
                "step": None, "retry_info": None, "info": None}
    return spark.createDataFrame([tuple({**defaults, **r}[c.split()[0]] for c in
                                        ("cluster_id", "index_name", "policy_id_setting", "policy_id", "policy_seq_no", "state", "action",
                                         "step", "retry_info", "info")) for r in rows], SCHEMA)


def test_blank_policy_is_read_three_ways(spark):
    rows = _explain(spark, {"index_name": "blank", "policy_id": "", "state": ("hot",)}, {"index_name": "none"},
                    {"index_name": "set", "policy_id_setting": "p", "policy_id": "q", "state": ("hot",)}, {"index_name": ".kibana_1"})
    stats = spark.createDataFrame([("set", 2048)], "index_name string, size_in_bytes bigint")
    sizes = {r["index"]: tuple(r)[1:] for r in L.list_indices(rows, stats).collect()}
    assert sizes == {"blank": ("0.0B", 0, "unmanaged", "-"), "set": ("2.0KB", 2048, "p", "hot")}
    assert L.list_indices(rows, stats, show_all=True).count() == 4
    assert [r["index"] for r in L.policy_status(rows, NOW).collect()] == ["set"]
    policies = spark.createDataFrame([("p", 1)], "policy_id string, seq_no bigint")
    versions = {r["index"]: r.orphan for r in L.policy_version(rows, policies, include_orphans=True).collect()}
    assert versions == {"blank": True, "none": True, "set": False}


@pytest.mark.parametrize("row,expected", [
    ({"step": ("s", "RUNNING", NOW - 4250)}, ("running", 0, "4.2s", "")),
    ({"step": ("s", None, 0)}, ("unknown", 0, "-", "")),
    ({"step": ("s", "completed", None), "action": ("a", True, 0)}, ("failed", 0, "-", "(see ISM history)")),
    ({"step": ("s", "Retrying", None), "retry_info": (True, 3), "action": ("a", False, 0)}, ("retrying", 3, "-", "(see ISM history)")),
    ({"info": '{"cause":"","message":" late "}'}, ("unknown", 0, "-", "late")),
    ({"info": '{"cause":"why","message":"m"}', "action": ("a", True, 2)}, ("failed", 2, "-", "why")),
    ({"info": "\n plain \t"}, ("unknown", 0, "-", "plain")),
    ({"info": "{}"}, ("unknown", 0, "-", "")),
])
def test_status(spark, row, expected):
    got = L.policy_status(_explain(spark, {"index_name": "i", "policy_id": "p", **row}), NOW).first()
    assert (got.step_status, got.retries, got.time_in_step, got.error) == expected


def test_versions_by_cluster(spark):
    rows = _explain(spark,
                    {"index_name": "same", "policy_id": "p", "policy_seq_no": 1, "state": ("hot",)},
                    {"index_name": "old", "policy_id": "p", "policy_seq_no": 1, "state": ("hot",), "cluster_id": "c2"},
                    {"index_name": "new", "policy_id": "p", "state": ("hot",)},
                    {"index_name": "stateless", "policy_id": "p", "policy_seq_no": 0},
                    {"index_name": "gone", "policy_id": "x", "policy_seq_no": 0, "state": ("hot",)})
    policies = spark.createDataFrame([("c1", "p", 1), ("c2", "p", 5)], "cluster_id string, policy_id string, seq_no bigint")
    report = L.policy_version(rows, policies, scope=["cluster_id"])
    got = {r["index"]: (r.current_seq_no, r.drift, r.enrolled) for r in report.collect()}
    assert got == {"same": (1, False, True), "old": (5, True, True), "new": (1, False, False), "stateless": (1, False, False),
                   "gone": (None, False, True)}
    counts = {(r.cluster_id, r.version_class): r.indices for r in L.version_counts(report, ["cluster_id"]).collect()}
    assert counts == {("c1", "in sync"): 2, ("c1", "not enrolled"): 2, ("c2", "drifted"): 1}
    assert L.needs_attention(report.filter("false")).first()[0] is False
    assert [r["index"] for r in L.attention_first(report).collect()] == ["new", "stateless", "old", "gone", "same"]


def test_settings_layers(spark):
    rows = [("defaults", "plugins.index_state_management.a", "0"), ("persistent", "plugins.index_state_management.a", "2"),
            ("transient", "plugins.index_state_management.a", "1"), ("transient", "cluster.a", "9")]
    layers = spark.createDataFrame(rows, "source string, setting string, value string")
    assert [tuple(r) for r in L.effective_settings(layers).collect()] == [("plugins.index_state_management.a", "2", "persistent")]
    turned = L.effective_settings(layers, order=("persistent", "defaults"))
    assert [tuple(r)[1:] for r in turned.collect()] == [("0", "defaults")]


def test_templates(spark):
    templates = spark.createDataFrame(
        [("t1", ["a*", "b*"], ["c1", "c2", "c3"], None), ("t2", ["x"], None, '{"index.plugins.index_state_management.policy_id":"inl"}'),
         ("t3", ["y"], ["c3"], "{}"), ("t4", [], ["c1"], '{"index":{"plugins":{"index_state_management":{"policy_id":"n"}}}}')],
        "name string, index_patterns array<string>, composed_of array<string>, settings string")
    components = spark.createDataFrame(
        [("c1", 1, '{"index":{"plugins":{"index_state_management":{"policy_id":"p1"}}}}'),
         ("c2", 2, '{"index.plugins.index_state_management.policy_id":"p2"}'), ("c3", None, "{}")], "name string, version bigint, settings string")
    got = {r.name: (r.index_patterns, r.policy_id, r.source, r.composed_of) for r in P.list_index_templates(templates, components).collect()}
    assert got == {"t1": ("a*,b*", "p2", "via c2", "c1,c2,c3"), "t2": ("x", "inl", "inline", ""), "t3": ("y", None, None, "c3"),
                   "t4": ("", "n", "inline", "c1")}
    assert [r.name for r in P.list_index_templates(templates, components, name_filter="t[34]").collect()] == ["t3", "t4"]


def test_tasks(spark):
    rows = [("n", "1", "internal:x", None, None, None), ("n", "2", "indices:data/write", 65_000_000_000, "p", "d" * 81)]
    tasks = spark.createDataFrame(rows, "node string, task_id string, action string, running_time_in_nanos bigint, parent_task_id string, description string")
    [row] = K.running_tasks(tasks).collect()
    assert (row.running_time, row.running_ms, row.description) == ("1m5s", 65_000, "d" * 77 + "...")
    assert {r.task_id: r.running_time for r in K.running_tasks(tasks, show_all=True).collect()} == {"1": "0ms", "2": "1m5s"}
    assert [r.task_id for r in K.running_tasks(tasks, True, "internal").collect()] == ["1"]
    pending = spark.createDataFrame([(1, "HIGH", None, None, None), (2, "LOW", "5ms", 7, "s" * 91)],
                                    "insert_order bigint, priority string, time_in_queue string, time_in_queue_millis bigint, source string")
    got = [tuple(r) for r in K.longest_waiting_first(K.pending_tasks(pending)).collect()]
    assert got == [(2, "LOW", "5ms", 7, "s" * 87 + "..."), (1, "HIGH", "-", 0, "")]


def test_bulk(spark):
    schema = "request_id string, index_name string, updated boolean, reason string"
    change = spark.createDataFrame([("r", "a", True, None), ("r", "b", False, "It is Not Being Managed"), ("r", "c", False, "closed"),
                                    ("q", "d", False, "not being managed"), ("q", None, False, "not being managed")], schema)
    enrol = spark.createDataFrame([("r", "b", True, None), ("q", "d", False, "locked"), ("q", "z", True, None)], schema)
    got = {r.request_id: (r.updated_indices, r.failed_indices) for r in L.bulk_outcome(change, enrol).collect()}
    assert got == {"r": (2, 1), "q": (0, 1)}
    assert {tuple(r) for r in L.bulk_failures(change, enrol).collect()} == {("r", "c", "closed"), ("q", "d", "locked")}


def test_schedules(spark):
    managed = spark.createDataFrame([("b", "p", 1, ((5, "Minutes"),)), (None, "p", 1, None), ("a", "p", None, ((5, "Minutes"),))],
                                    "index_name string, policy_id string, policy_seq_no bigint, schedule struct<interval:struct<period:int,unit:string>>")
    report = L.shortest_interval_first(L.schedules(managed))
    assert [(r["index"], r.interval) for r in report.collect()] == [(None, None), ("a", 5), ("b", 5)]
    assert [r["index"] for r in L.schedules(managed, "[ab]").orderBy("index").collect()] == ["a", "b"]
    assert {(r.interval, r.indices) for r in L.interval_distribution(report).collect()} == {(5, 2), (None, 1)}
