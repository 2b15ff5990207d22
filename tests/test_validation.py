"""Dashboard validation from raw saved objects; each rule fails once and passes once."""

import json

import pytest

from fleetaudit.operators import saved_objects as O

SCHEMA = """type string, id string, title string, attributes string, references array<struct<name:string,type:string,id:string>>,
 workspaces array<string>, updated_at string"""


def _object(kind, ident, attributes=None, refs=(), title=None):
    title = title or ident.upper()
    body = json.dumps({"title": title, **(attributes or {})})
    return (kind, ident, title, body, [("r", t, i) for t, i in refs], [], "")


def _source(source):
    return {"kibanaSavedObjectMeta": {"searchSourceJSON": source if isinstance(source, str) else json.dumps(source)}}


STATE = {"type": "histogram", "aggs": [{"id": 2, "type": "terms", "params": {"field": "gone", "json": '{"x":[{"field":"msg"},{"field":"deep"}]}'}}, 7],
         "params": {"field": "host", "series": [{"metrics": [{"id": "m1", "field": "lost"}, {"id": "m2", "field": "m1"}], "terms_field": "host.raw"}, "odd"]}}

OBJECTS = [
    _object("index-pattern", "ip1", {"timeFieldName": "ts"}, title="logs-*"),
    _object("index-pattern", "ip2", {"timeFieldName": "nope"}, title="alias?"),
    _object("index-pattern", "ip3", title="none-*"),
    ("index-pattern", "ip4", "N/A", "{}", [], [], ""),
    _object("index-pattern", "ip5", {"timeFieldName": "x"}, title="bare"),
    _object("search", "s1", {"columns": ["msg", "absent", "_id", 5]}, [("index-pattern", "ip1")]),
    _object("search", "s2", {"columns": ["absent"]}, [("index-pattern", "lost")]),
    _object("visualization", "ok", {"visState": json.dumps({"aggs": [{"params": {"field": "*"}}, {"params": {"field": "host"}}]})}, [("index-pattern", "ip1")]),
    _object("visualization", "fields", {"visState": STATE, **_source({"filter": [{"meta": {"key": "kk"}, "query": {"range": {"ts": {}, "rr": 1}}}]})},
            [("search", "s1"), ("index-pattern", "ip2")]),
    _object("visualization", "broken", {}, [("index-pattern", "lost"), ("search", "lost"), ("tag", "any"), ("search", "s2")]),
    _object("visualization", "homeless", {"visState": STATE}, [("index-pattern", "ip3")]),
    _object("visualization", "unknown", {"visState": STATE}, [("index-pattern", "ip5")]),
    _object("visualization", "badjson", _source("{oops")),
    _object("visualization", "blank", _source("  ")),
    _object("visualization", "parens", _source({"query": {"query": "a (b", "language": "kuery"}, "filter": [
        {"query": {"match": {}, "match_phrase": {"a": 1}}}, {"meta": {"disabled": True}, "query": {"match": {}}}, {"query": {"match_phrase": {}}}, 3]})),
    _object("dashboard", "d-ok", {"panelsJSON": "[]"}, [("visualization", "ok"), ("index-pattern", "ip4")]),
    _object("dashboard", "d-twice", {"panelsJSON": "[]"}, [("visualization", "homeless"), ("visualization", "homeless")]),
    _object("dashboard", "d-all", {"panelsJSON": "[{"}, [("visualization", v) for v in ("fields", "broken", "unknown", "badjson", "blank", "parens")]),
    _object("dashboard", "d-search", {}, [("search", "s1"), ("search", "s2"), ("map", "m"), ("visualization", "missing")]),
    _object("dashboard", "d-empty", {}),
    _object("dashboard", "d-blank", {"panelsJSON": ""}),
    _object("dashboard", "d-panels", {"panelsJSON": [{"a": 1}]}),
]
NAMES = [("logs-1", "index", "logs-1"), ("logs-2", "index", "logs-2"), ("alias1", "alias", "logs-1"), ("bare", "index", "bare")]
MAPPING = json.dumps({"ts": {"type": "date"}, "msg": {"type": "text"}, "host": {"type": "text", "fields": {"raw": {}}}})
MAPPINGS = [("logs-1", MAPPING), ("logs-2", MAPPING), ("bare", '{"a":3}')]


@pytest.fixture(scope="module")
def frames(spark):
    return (spark.createDataFrame(OBJECTS, SCHEMA), spark.createDataFrame(NAMES, "name string, kind string, index_name string"),
            spark.createDataFrame(MAPPINGS, "index_name string, properties string"))


def _checks(rows):
    return sorted((r.level, r.check, r.message) for r in rows)


V = "Visualization '{0}' (id: {1})"


def test_issues(frames):
    result = O.validate_dashboards(*frames)
    found = {}
    for r in result.issues.collect():
        found.setdefault(r.id, []).append(r)
    assert "d-ok" not in found and "d-panels" not in found
    miss = "Visualization 'HOMELESS' (id: homeless) uses index pattern 'none-*' with no matching indices"
    assert _checks(found["d-twice"]) == [("error", "missing-index", miss)] * 2
    fields = V.format("FIELDS", "fields") + " references field '{}' not found in 'logs-*' [{}]"
    broken = V.format("BROKEN", "broken")
    parens = V.format("PARENS", "parens")
    assert _checks(found["d-all"]) == sorted([
        ("error", "invalid-json", "Dashboard panelsJSON is malformed"),
        ("error", "missing-field", fields.format("gone", 'agg "terms" (id: 2)')),
        ("error", "missing-field", fields.format("deep", 'agg "terms" (id: 2) custom JSON')),
        ("error", "missing-field", fields.format("lost", "TSVB series[0] metric")),
        ("error", "missing-field", fields.format("kk", "filter")),
        ("error", "missing-field", fields.format("rr", "filter range")),
        ("error", "broken-reference", f"{broken} references missing index pattern 'lost'"),
        ("error", "broken-reference", f"{broken} references missing search 'lost'"),
        ("error", "invalid-query", V.format("BADJSON", "badjson") + ": searchSourceJSON is malformed"),
        ("warning", "invalid-query", f"{parens}: query has mismatched parentheses (kuery): 'a (b'"),
        ("warning", "invalid-query", f"{parens}: filter has an empty match clause"),
        ("warning", "invalid-query", f"{parens}: filter has an empty match_phrase clause"),
    ])
    assert _checks(found["d-search"]) == sorted([
        ("error", "missing-field", "Search 'S1' (id: s1) references field 'absent' not found in 'logs-*' [search column]"),
        ("error", "broken-reference", "Search 'S2' (id: s2) references missing index pattern 'lost'"),
        ("error", "broken-reference", "Referenced map 'm' not found"),
        ("error", "broken-reference", "Referenced visualization 'missing' not found"),
    ])
    assert _checks(found["d-empty"]) == [("warning", "empty-dashboard", "Dashboard has no panels or references")]
    assert _checks(found["d-blank"]) == [("error", "invalid-json", "Dashboard panelsJSON is malformed"),
                                         ("warning", "empty-dashboard", "Dashboard has no panels or references")]


def test_report_and_summary(frames):
    result = O.validate_dashboards(*frames, keep=True)
    got = {r.id: (r.status, r.errors, r.warnings) for r in result.dashboards.collect()}
    assert got == {"d-ok": ("ok", 0, 0), "d-twice": ("error", 2, 0), "d-all": ("error", 9, 3), "d-search": ("error", 4, 0),
                   "d-empty": ("warning", 0, 1), "d-blank": ("error", 1, 1), "d-panels": ("ok", 0, 0)}
    assert result.summary.first().asDict() == {"total_dashboards": 7, "ok": 2, "warnings": 1, "errors": 4, "global_issues": 3}
    assert _checks(result.global_issues.collect()) == [
        ("error", "missing-index", "Index pattern 'ip4' has no title"),
        ("error", "missing-index", "Index pattern 'none-*' (id: ip3) matches no index, alias, or data stream"),
        ("warning", "missing-field", "Index pattern 'alias?': time field 'nope' is not in the mapping"),
    ]


def test_chosen_dashboards_and_clusters(spark, frames):
    from pyspark.sql import functions as F

    chosen = O.validate_dashboards(*frames, dashboard_ids=["d-ok", "d-empty"])
    assert chosen.summary.first().asDict() == {"total_dashboards": 2, "ok": 1, "warnings": 1, "errors": 0, "global_issues": 3}
    assert {r.id for r in chosen.issues.collect()} == {"d-empty"}

    # A second cluster without any index: patterns that match in the first match nothing there.
    objects, names, mappings = frames
    one, two = F.lit("c1").alias("cluster_id"), F.lit("c2").alias("cluster_id")
    both = objects.select(one, "*").unionByName(objects.select(two, "*"))
    result = O.validate_dashboards(both, names.select(one, "*"), mappings.select(one, "*"), scope=["cluster_id"])
    summary = {r.cluster_id: (r.ok, r.errors, r.global_issues) for r in result.summary.collect()}
    assert summary == {"c1": (2, 4, 3), "c2": (1, 5, 5)}


def test_edges_of_a_hot_object_are_split(spark, frames):
    """With one target holding most references, the join splits its partition instead of one task taking it."""
    from pyspark.sql import functions as F

    from fleetaudit.operators import references as R

    hot = spark.range(40_000).select(
        F.lit("dashboard").alias("src_type"), F.concat(F.lit("dash"), F.col("id").cast("string")).alias("src_id"), F.lit("t").alias("src_title"),
        F.lit(0).alias("pos"), F.lit("visualization").alias("ref_type"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("v"), F.col("id").cast("string"))).otherwise("v0").alias("ref_id"))
    objects = spark.range(40_000).select(F.lit("visualization").alias("type"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"),
                                         F.lit("t").alias("title"))
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
              "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df = R.resolved_edges(hot, objects)
        assert df.filter("found").count() == 40_000
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
