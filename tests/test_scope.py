"""With scope columns, clusters never mix: each operator gives per cluster what it gives for that cluster alone."""

import pytest
from pyspark.sql import functions as F

from fleetaudit.operators import edits as E
from fleetaudit.operators import fields as D
from fleetaudit.operators import lifecycle as L
from fleetaudit.operators import references as R
from fleetaudit.operators import saved_objects as O
from fleetaudit.operators import templates as P

SCOPE = ["cluster_id"]


def _caps(spark):
    rows = [("c1", "i1", "a", "text"), ("c1", "i1", "a.raw", "keyword"), ("c2", "i1", "a.raw", "keyword"), ("c2", "i1", "a", "object"),
            ("c2", "i2", "a", "long"), ("c1", "i2", "z", "flat_object")]
    return spark.createDataFrame(rows, "cluster_id string, index_name string, field string, type string").withColumn(
        "aggregatable", F.lit(True)).withColumn("searchable", F.lit(False))


def _layers(spark):
    rows = [("c1", "defaults", "plugins.index_state_management.a", "1"), ("c2", "persistent", "plugins.index_state_management.a", "2")]
    return spark.createDataFrame(rows, "cluster_id string, source string, setting string, value string")


def _templates(spark):
    t = spark.createDataFrame([("c1", "t", ["x"], ["k"], "{}"), ("c2", "t", ["x"], ["k"], "{}")],
                              "cluster_id string, name string, index_patterns array<string>, composed_of array<string>, settings string")
    c = spark.createDataFrame([("c2", "k", 1, '{"index.plugins.index_state_management.policy_id":"p"}')],
                              "cluster_id string, name string, version bigint, settings string")
    return t, c


def _objects(spark):
    edges = spark.createDataFrame([("c1", "visualization", "v", "V", 0, "search", "s"), ("c2", "visualization", "v", "V", 0, "search", "s"),
                                   ("c2", "search", "s", "S", 0, "index-pattern", "ip")],
                                  "cluster_id string, src_type string, src_id string, src_title string, pos int, ref_type string, ref_id string")
    objects = spark.createDataFrame([("c1", "search", "s", "S"), ("c2", "search", "s", "S")], "cluster_id string, type string, id string, title string")
    return edges, objects


OPERATORS = {
    "settings": lambda s, only, scope: L.effective_settings(only(_layers(s)), scope=scope),
    "report": lambda s, only, scope: D.field_report(only(_caps(s)), scope=scope),
    "counts": lambda s, only, scope: D.field_report_counts(only(_caps(s)), scope=scope, unknown=True),
    "examples": lambda s, only, scope: D.conflict_examples(D.conflict_indices(only(_caps(s)), scope=scope), scope),
    "live": lambda s, only, scope: D.live_field_list(only(_caps(s)), scope),
    "templates": lambda s, only, scope: P.list_index_templates(*map(only, _templates(s)), scope=scope),
    "edges": lambda s, only, scope: R.resolved_edges(*map(only, _objects(s)), scope=scope),
    "patterns": lambda s, only, scope: R.resolved_patterns(R.resolved_edges(*map(only, _objects(s)), scope=scope), scope),
    "mappings": lambda s, only, scope: O.flattened_mappings(
        only(s.createDataFrame([("c1", "i", '{"a":{}}'), ("c2", "i", '{"a":{}}')], "cluster_id string, index_name string, properties string")), scope)[1],
    "template_edit": lambda s, only, scope: E.set_template_policy(
        only(s.createDataFrame([("c1", "t", "n"), ("c2", "t", "none")], "cluster_id string, name string, policy_id string")), only(_templates(s)[0]), scope),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clusters_do_not_mix(spark, name):
    build = OPERATORS[name]
    together = build(spark, lambda df: df, SCOPE)
    alone = None
    for cluster in ("c1", "c2"):
        one = build(spark, lambda df, c=cluster: df.filter(F.col("cluster_id") == c).drop("cluster_id"), []).withColumn("cluster_id", F.lit(cluster))
        alone = one if alone is None else alone.unionByName(one)
    columns = sorted(together.columns)
    assert sorted(columns) == sorted(alone.columns)
    assert sorted(map(repr, together.select(columns).collect())) == sorted(map(repr, alone.select(columns).collect()))
