"""Queries that edit policy and template documents."""

from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.operators import edits as E
from fleetaudit.plans.lifecycle import NESTED, SETTINGS_POLICY
from fleetaudit.plans.registry import query
from fleetaudit.sources import schemas as T

NOW_MS = 1717200000000


def policy_table(inputs):
    """Policies with two states, a rollover action and a transition each, and their claims."""
    claims = F.array_compact(
        F.array(
            F.when(
                F.col("claims") != "",
                F.struct(
                    F.split("claims", ",").alias("index_patterns"),
                    F.lit(100).alias("priority"),
                    F.lit(1).cast("bigint").alias("last_updated_time"),
                ),
            )
        )
    )
    move = F.array(F.struct(F.lit("cold").alias("state_name"), F.from_json("age_condition", T.CONDITIONS).alias("conditions")))
    actions = F.array(F.lit('{"retry":{"count":3}}'), F.concat(F.lit('{"rollover":'), "rollover", F.lit("}")))
    first = F.struct(F.col("first_state").alias("name"), actions.alias("actions"), move.alias("transitions"))
    last = F.struct(
        F.lit("cold").alias("name"), F.array().cast("array<string>").alias("actions"), F.array().cast(T.TRANSITIONS).alias("transitions")
    )
    return inputs("policy_docs").select(
        "policy_id",
        "seq_no",
        F.lit(1).cast("bigint").alias("primary_term"),
        F.lit("").alias("description"),
        F.col("first_state").alias("default_state"),
        F.array(first, last).cast(T.STATES).alias("states"),
        claims.cast(T.ISM_TEMPLATE).alias("ism_template"),
    )


def edit_table(inputs):
    return inputs("policy_edits").select(
        "policy_id", "expected_seq_no", "position", "k",
        F.from_json("conditions", T.CONDITIONS).alias("conditions"), F.from_json("move", T.CONDITIONS).alias("move"),
    )


MERGED = """, j AS (SELECT e.*, d.seq_no, d.rollover, d.age_condition, d.first_state, d.claims, d.policy_id IS NOT NULL AS found,
  CASE WHEN d.policy_id IS NULL THEN concat('Policy ''', e.policy_id, ''' not found') WHEN e.expected_seq_no <> d.seq_no THEN 'version conflict' END AS refused
  FROM policy_edits e LEFT JOIN policy_docs d USING (policy_id))
"""


@query("policy_edit_rollover", ("policy_docs", "policy_edits"), MERGED + """,
m AS (SELECT *, json_extract_string(rollover, '$.min_size') AS size0, CAST(json_extract(rollover, '$.min_doc_count') AS BIGINT) AS docs0,
  COALESCE(refused, CASE WHEN first_state = 'cold' THEN concat('State ''hot'' not found in policy ''', policy_id, '''') END) AS error FROM j),
n AS (SELECT *, CASE k % 4 WHEN 0 THEN concat(k % 60, 'gb') WHEN 1 THEN NULL ELSE size0 END AS size1, CASE WHEN k % 4 = 2 THEN 5 ELSE docs0 END AS docs1,
  CASE WHEN k % 4 = 1 THEN '1d' END AS age1 FROM m),
o AS (SELECT *, error IS NULL AND (size0 IS DISTINCT FROM size1 OR docs0 <> docs1 OR age1 IS NOT NULL) AS changed FROM n)
SELECT policy_id, CASE WHEN found AND first_state <> 'cold' THEN size0 END AS size_before, CASE WHEN error IS NULL THEN size1 END AS size_after, CASE WHEN error IS NULL THEN docs1 END AS docs_after,
  CASE WHEN error IS NULL THEN age1 END AS age_after, seq_no, seq_no + CASE WHEN changed THEN 1 ELSE 0 END AS new_seq_no, changed, error FROM o""")
def policy_edit_rollover(inputs):
    edits = edit_table(inputs).withColumn("state_name", F.lit("hot"))
    after = J.parsed(F.col("after"))
    return E.set_rollover(edits, policy_table(inputs)).select(
        "policy_id",
        J.as_text(J.parsed(F.col("before")), "min_size").alias("size_before"),
        J.as_text(after, "min_size").alias("size_after"),
        F.try_variant_get(after, "$.min_doc_count", "bigint").alias("docs_after"),
        J.as_text(after, "min_index_age").alias("age_after"),
        "seq_no", "new_seq_no", "changed", "error",
    )


# A third merges into the transition there is, a third removes it, a third adds one for another condition.
@query("policy_edit_transition", ("policy_docs", "policy_edits"), MERGED + """,
m AS (SELECT *, COALESCE(refused, CASE WHEN first_state = 'cold' THEN concat('State ''hot'' not found in policy ''', policy_id, '''') END) AS error,
  concat('{"state_name":"cold","conditions":', age_condition, '}') AS old, concat('{"state_name":"cold","conditions":', move, '}') AS fresh FROM j),
n AS (SELECT *, CASE k % 3 WHEN 0 THEN concat('[', fresh, ']') WHEN 1 THEN '[]' ELSE CASE WHEN position = 'first' THEN concat('[', fresh, ',', old, ']') ELSE concat('[', old, ',', fresh, ']') END END AS edited FROM m),
o AS (SELECT *, error IS NULL AND edited <> concat('[', old, ']') AS changed FROM n)
SELECT policy_id, CASE WHEN found AND first_state <> 'cold' THEN concat('[', old, ']') END AS before, CASE WHEN error IS NULL THEN edited END AS after,
  seq_no, seq_no + CASE WHEN changed THEN 1 ELSE 0 END AS new_seq_no, changed, error FROM o""")
def policy_edit_transition(inputs):
    edits = edit_table(inputs).select(
        "policy_id", "expected_seq_no", "position", F.lit("hot").alias("from_state"), F.lit("cold").alias("to_state"), F.col("move").alias("conditions")
    )
    return E.set_transition(edits, policy_table(inputs)).drop("states")


def claim_edits(inputs):
    k = F.col("k")
    text = lambda prefix, key: F.concat(F.lit(prefix), key.cast("string"))
    none = F.array().cast("array<string>")
    old, new = text("app-", k % 10), text("svc-", k % 10)
    return inputs("policy_edits").select(
        "policy_id",
        "expected_seq_no",
        F.when(k % 2 == 0, F.array(F.struct(old.alias("old"), new.alias("new")))).alias("replace"),
        F.when(k % 3 == 0, F.array(F.concat(F.lit("logs-"), k.cast("string"), F.lit("*")))).otherwise(none).alias("remove"),
        F.when(k % 5 == 0, F.array(F.lit("extra-*"), new)).otherwise(none).alias("add"),
        F.lit(0).alias("entry_index"),
        F.when(k % 4 == 1, F.lit(7)).alias("priority"),
    )


CLAIMS = MERGED + """,
a AS (SELECT *, CASE WHEN claims = '' THEN [] ELSE string_split(claims, ',') END AS p0 FROM j),
b AS (SELECT *, CASE WHEN k % 2 = 0 THEN list_transform(p0, lambda x: CASE WHEN x = concat('app-', k % 10) THEN concat('svc-', k % 10) ELSE x END) ELSE p0 END AS p1 FROM a),
c AS (SELECT *, CASE WHEN k % 3 = 0 THEN list_filter(p1, lambda x: x <> concat('logs-', k, '*')) ELSE p1 END AS p2 FROM b),
d AS (SELECT *, CASE WHEN k % 5 = 0 THEN list_concat(p2, list_filter(['extra-*', concat('svc-', k % 10)], lambda x: NOT list_contains(p2, x))) ELSE p2 END AS p3,
  COALESCE(refused, CASE WHEN k % 4 = 1 AND len(p2) = 0 AND k % 5 <> 0 THEN 'entry-index 0 is out of range (0 entries)' END) AS error FROM c),
e AS (SELECT *, CASE WHEN len(p3) = 0 THEN NULL WHEN k % 4 = 1 THEN 7 ELSE 100 END AS pr, error IS NULL AND (p0 <> p3 OR (k % 4 = 1)) AS changed FROM d)
"""


@query("policy_edit_claims", ("policy_docs", "policy_edits"), CLAIMS + f"""
SELECT policy_id, CASE WHEN error IS NULL THEN array_to_string(p3, ',') END AS patterns_after, CASE WHEN error IS NULL THEN pr END AS priority_after,
  CASE WHEN error IS NULL AND len(p3) > 0 THEN CASE WHEN changed THEN {NOW_MS} ELSE 1 END END AS updated_after,
  seq_no, seq_no + CASE WHEN changed THEN 1 ELSE 0 END AS new_seq_no, changed, error FROM e""")
def policy_edit_claims(inputs):
    after = F.from_json("after", T.ISM_TEMPLATE)
    return E.edit_ism_template(claim_edits(inputs), policy_table(inputs), NOW_MS).select(
        "policy_id",
        F.when(F.col("after").isNotNull(), F.array_join(F.flatten(F.transform(after, lambda x: x["index_patterns"])), ",")).alias("patterns_after"),
        F.get(after, F.lit(0))["priority"].alias("priority_after"),
        F.get(after, F.lit(0))["last_updated_time"].alias("updated_after"),
        "seq_no", "new_seq_no", "changed", "error",
    )


@query("policies_after_edit", ("policy_docs", "policy_edits"), CLAIMS + """
SELECT d.policy_id, CASE WHEN e.changed THEN d.seq_no + 1 ELSE d.seq_no END AS seq_no, CASE WHEN e.changed THEN array_to_string(e.p3, ',') ELSE d.claims END AS patterns
FROM policy_docs d LEFT JOIN e USING (policy_id)""")
def policies_after_edit(inputs):
    policies = policy_table(inputs)
    outcome = E.edit_ism_template(claim_edits(inputs), policies, NOW_MS)
    patterns = F.array_join(F.flatten(F.transform("ism_template", lambda x: x["index_patterns"])), ",")
    return E.commit(policies, outcome, "ism_template").select("policy_id", "seq_no", patterns.alias("patterns"))


@query("claimed_patterns", ("policy_docs",), """
SELECT policy_id, CAST(100 AS INTEGER) AS priority, unnest(string_split(claims, ',')) AS index_pattern FROM policy_docs WHERE claims <> ''""")
def claimed_patterns(inputs):
    return E.claimed_patterns(policy_table(inputs))


def policy_requests(inputs):
    return inputs.table("customer").select(
        F.expr("concat('policy-', c_custkey * 2)").alias("policy_id"),
        F.expr("CASE WHEN c_custkey % 2 = 0 THEN c_name END").alias("description"),
        F.expr("CASE WHEN c_custkey % 3 = 0 THEN 'frozen' END").alias("state"),
        F.expr("CASE WHEN c_custkey % 5 = 0 THEN CAST(array() AS array<string>) ELSE array(concat('new-', c_custkey, '*')) END").alias("patterns"),
        F.expr("CASE WHEN c_custkey % 7 = 0 THEN 5 END").alias("priority"),
    )


REQUESTS = """, q AS (SELECT concat('policy-', c_custkey * 2) AS policy_id, CASE WHEN c_custkey % 3 = 0 THEN 'frozen' ELSE 'keep' END AS st, * EXCLUDE (c_nationkey) FROM customer)
"""


@query("policy_create", ("policy_docs",), REQUESTS + """
SELECT policy_id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE concat('No-op policy: indices stay in ''', st, ''' and are never modified.') END AS description,
  st AS default_state, CASE WHEN c_custkey % 5 <> 0 THEN concat('new-', c_custkey, '*') END AS pattern,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(CASE WHEN c_custkey % 7 = 0 THEN 5 ELSE 100 END AS INTEGER) END AS priority
FROM q WHERE policy_id NOT IN (SELECT policy_id FROM policy_docs)""")
def policy_create(inputs):
    created, _ = E.create_policies(policy_requests(inputs), policy_table(inputs))
    claim = F.get("ism_template", F.lit(0))
    return created.select(
        "policy_id", "description", "default_state", F.get(claim["index_patterns"], F.lit(0)).alias("pattern"), claim["priority"].alias("priority")
    )


@query("policy_create_rejected", ("policy_docs",), REQUESTS + """
SELECT policy_id, concat('Policy ''', policy_id, ''' already exists') AS error FROM q WHERE policy_id IN (SELECT policy_id FROM policy_docs)""")
def policy_create_rejected(inputs):
    _, rejected = E.create_policies(policy_requests(inputs), policy_table(inputs))
    return rejected.select("policy_id", "error")


@query("template_policy_edit", ("index_templates",), f""",
e AS (SELECT concat('tpl-', o_orderkey) AS name, CASE WHEN o_orderkey % 3 = 0 THEN 'None' ELSE concat('new-', o_custkey) END AS policy_id FROM orders)
SELECT e.name, {SETTINGS_POLICY} AS before, CASE WHEN policy_id <> 'None' THEN policy_id END AS after, CASE WHEN policy_id <> 'None' THEN policy_id END AS written,
  CAST(NULL AS VARCHAR) AS dotted, json_extract_string(settings, '$.index.codec') AS codec FROM e JOIN index_templates USING (name)""")
def template_policy_edit(inputs):
    edits = inputs.table("orders").select(
        F.expr("concat('tpl-', o_orderkey)").alias("name"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN 'None' ELSE concat('new-', o_custkey) END").alias("policy_id"),
    )
    return E.set_template_policy(edits, inputs("index_templates")).select(
        "name", "before", "after",
        F.get_json_object("settings", NESTED).alias("written"),
        J.as_text(J.parsed(F.col("settings")), J.POLICY_KEY).alias("dotted"),
        F.get_json_object("settings", "$.index.codec").alias("codec"),
    )
