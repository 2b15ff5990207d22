"""Asked paths in mappings, without flattening them."""

import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.operators import references as R
from fleetaudit.operators import saved_objects as O
from fleetaudit.plans import catalog
from tools.check_queries import compare

KEYS = ("a", "b", "a.b", "", "q?", "x y", "[0]", "it's", 'say "so"', "properties", "fields")


def _mapping(rng, depth):
    """A mapping with odd keys, values that are no objects, and multi-fields at any depth."""
    out = {}
    for key in rng.sample(KEYS, rng.randint(0, 4)):
        node = rng.choice([None, 3, "t", []]) if rng.random() < 0.2 else {"type": "x"}
        if isinstance(node, dict) and depth and rng.random() < 0.7:
            node["properties"] = _mapping(rng, depth - 1)
        if isinstance(node, dict) and rng.random() < 0.4:
            node["fields"] = {k: rng.choice([None, {}, 1]) for k in rng.sample(KEYS, 2)}
        out[key] = node
    return out


@pytest.fixture(scope="module")
def mappings(spark):
    rng = random.Random(5)
    docs = [json.dumps(_mapping(rng, 3)) for _ in range(60)] + ["{}", "[1]", "3", '{"a":{"properties":4,"fields":[1]}}', "{oops"]
    return spark.createDataFrame([(str(i), doc) for i, doc in enumerate(docs)], "mapping_id string, properties string")


def _expected(mappings):
    held = mappings.select("mapping_id", F.explode(J.mapping_paths(F.col("properties"))).alias("field")).distinct()
    return {tuple(r) for r in held.collect()}


@pytest.mark.parametrize("per_lookup", (3, 512))
def test_same_as_flattening(spark, mappings, per_lookup):
    held = _expected(mappings)
    assert len(held) > 200
    fields = sorted({f for _, f in held}) + ["a.b.zz", "nope", "a..b", ".", "a.b.", "*"]
    asked = mappings.select("mapping_id", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"))
    asked = asked.unionByName(asked).unionByName(spark.createDataFrame([(None, "a"), ("1", None), ("unknown", "a")], "mapping_id string, field string"))
    got = [tuple(r) for r in R.held_paths(mappings, asked, per_lookup=per_lookup).collect()]
    assert len(got) == len(set(got)) and set(got) == held


def test_validation_flattens_nothing(spark, monkeypatch):
    """Fields are looked up in mappings by path; the wide mapping isn't turned into rows."""
    def refuse(*_):
        raise AssertionError("flattened")

    monkeypatch.setattr(J, "mapping_paths", refuse)
    wide = json.dumps({f"f{i}": {"type": "long"} for i in range(3000)} | {"ts": {"type": "date"}})
    objects = spark.createDataFrame([
        ("index-pattern", "ip", "logs-*", json.dumps({"title": "logs-*", "timeFieldName": "ts"}), [], [], ""),
        ("search", "s", "S", json.dumps({"title": "S", "columns": ["f7", "f2999", "f3000"]}), [("r", "index-pattern", "ip")], [], "")],
        "type string, id string, title string, attributes string, references array<struct<name:string,type:string,id:string>>, workspaces array<string>, updated_at string")
    names = spark.createDataFrame([(f"logs-{i}", "index", f"logs-{i}") for i in range(20)], "name string, kind string, index_name string")
    maps = spark.createDataFrame([(f"logs-{i}", wide) for i in range(20)], "index_name string, properties string")
    result = O.validate_dashboards(objects, names, maps, keep=True)
    assert result.global_issues.count() == 0
    _, texts = O.distinct_mappings(maps)
    assert texts.count() == 1
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_clusters_keep_their_own_mappings(spark):
    texts = spark.createDataFrame([("c1", "m", '{"a":{}}'), ("c2", "m", '{"b":{}}')], "cluster_id string, mapping_id string, properties string")
    asked = spark.createDataFrame([("c1", "m", "a"), ("c1", "m", "b"), ("c2", "m", "a"), ("c2", "m", "b")], "cluster_id string, mapping_id string, field string")
    assert {(r.cluster_id, r.field) for r in R.held_paths(texts, asked, ["cluster_id"]).collect()} == {("c1", "a"), ("c2", "b")}


def test_indices_that_ask_alike_ask_once(spark, monkeypatch, tmp_path):
    """The paths asked of a mapping are few, however many indices share it; an index that is listed twice gets its rows twice."""
    counted = []
    monkeypatch.setattr(R, "held_paths", lambda texts, asked, held=R.held_paths: counted.append(asked.count()) or held(texts, asked))
    orders = spark.range(80).selectExpr("id AS o_orderkey", "id % 2 + 10 AS o_custkey")
    orders.write.parquet(f"{tmp_path}/once/orders.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/once/orders.parquet/*.parquet'")
    assert compare(catalog.QUERIES["mapping_lookup"](spark, f"{tmp_path}/once"), catalog.CHECKS["mapping_lookup"], connection) is None
    orders.unionByName(orders.filter("o_orderkey = 3")).unionByName(spark.sql("SELECT 99L AS o_orderkey, CAST(NULL AS BIGINT) AS o_custkey")).write.parquet(f"{tmp_path}/twice/orders.parquet")
    rows = catalog.QUERIES["mapping_lookup"](spark, f"{tmp_path}/twice").groupBy("index_name").count().collect()
    found = {r.index_name: r["count"] for r in rows}
    assert found["idx-3"] == 4 * found["idx-5"] and "idx-99" not in found
    assert counted == [16, 16]
