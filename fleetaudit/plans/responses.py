"""Queries from raw response bodies to reports: every reader in front of the operator it serves."""

from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.operators import edits as E
from fleetaudit.operators import fields as D
from fleetaudit.operators import references as R
from fleetaudit.operators import saved_objects as O
from fleetaudit.plans.edits import NOW_MS
from fleetaudit.plans.registry import query
from fleetaudit.sources import readers
from fleetaudit.sources import schemas as T


@query("index_stats_response", (), """
SELECT concat('idx-', o_orderkey) AS index_name, CAST(o_orderkey * 7 AS BIGINT) AS size_in_bytes FROM orders
UNION ALL SELECT concat('bare-', o_orderkey), 0 FROM orders""")
def index_stats_response(inputs):
    return readers.index_stats(inputs("stats_bodies"))


@query("settings_response", (), """
SELECT 'defaults' AS source, concat('a.', p_partkey) AS setting, p_brand AS value FROM part
UNION ALL SELECT 'persistent', concat('a.', p_partkey), '2' FROM part UNION ALL SELECT 'persistent', 'b', 'x' FROM part""")
def settings_response(inputs):
    return readers.settings_layers(inputs("settings_bodies"))


@query("data_streams_response", (), """
SELECT concat('ds-', c_custkey) AS name, 'GREEN' AS status, CAST(c_custkey % 9 AS BIGINT) AS generation, concat('.ds-', c_custkey, '-1,.ds-', c_custkey, '-2') AS backing FROM customer""")
def data_streams_response(inputs):
    backing = F.array_join(F.col("indices.index_name"), ",").alias("backing")
    return readers.data_streams(inputs("stream_bodies")).select("name", "status", "generation", backing)


@query("pending_tasks_response", (), """
SELECT CAST(event_id AS BIGINT) AS insert_order, 'HIGH' AS priority, CAST(NULL AS VARCHAR) AS time_in_queue, CAST(event_id * 3 AS BIGINT) AS time_in_queue_millis, event_type AS source FROM events""")
def pending_tasks_response(inputs):
    return readers.pending_tasks(inputs("pending_bodies"))


@query("detectors_response", (), """
SELECT 'detector' AS type, concat('det-', s_suppkey) AS id, s_name AS title FROM supplier
UNION ALL SELECT 'detector', concat('bare-', s_suppkey), 'N/A' FROM supplier""")
def detectors_response(inputs):
    return O.list_detectors(readers.detectors(inputs("detector_bodies")))


@query("templates_response", (), """
SELECT concat('tpl-', p_partkey) AS name, concat('logs-', p_partkey, '*,b') AS patterns, concat('c-', p_partkey) AS components, concat('p-', p_size) AS policy_id FROM part
UNION ALL SELECT '-', 'x', NULL, NULL FROM part""")
def templates_response(inputs):
    return readers.index_templates(inputs("template_bodies")).select(
        "name", F.array_join("index_patterns", ",").alias("patterns"), F.array_join("composed_of", ",").alias("components"),
        J.settings_policy(F.col("settings")).alias("policy_id"))


@query("components_response", (), """
SELECT concat('c-', p_partkey) AS name, CAST(p_size AS BIGINT) AS version, concat('p-', p_size) AS policy_id FROM part""")
def components_response(inputs):
    return readers.component_templates(inputs("component_bodies")).select("name", "version", J.settings_policy(F.col("settings")).alias("policy_id"))


@query("field_caps_response", (), """
SELECT concat('one-', p_partkey) AS field, 'text' AS type, false AS aggregatable, true AS searchable FROM part
UNION ALL SELECT concat('two-', p_partkey), 'long', true, true FROM part
UNION ALL SELECT concat('two-', p_partkey), 'keyword', true, false FROM part""")
def field_caps_response(inputs):
    return readers.field_types(inputs("caps_bodies"))


@query("conflicts_response", (), """
SELECT concat('two-', p_partkey) AS field, 'long' AS type, 'i-1' AS index_name FROM part
UNION ALL SELECT concat('two-', p_partkey), 'keyword', i FROM part, (VALUES ('i-2'), ('i-3')) t(i)""")
def conflicts_response(inputs):
    return D.conflict_indices(readers.field_type_indices(inputs("caps_bodies")))


@query("refreshed_pattern", (), """
SELECT concat('ip-', p_partkey) AS id, concat('one-', p_partkey) AS name, 'string' AS type, CAST(4 AS BIGINT) AS count, false AS scripted, CAST(NULL AS VARCHAR) AS script, 'text' AS es_types FROM part
UNION ALL SELECT concat('ip-', p_partkey), concat('two-', p_partkey), 'conflict', 0, false, NULL, 'keyword,long' FROM part
UNION ALL SELECT concat('ip-', p_partkey), concat('s-', p_partkey), 'number', 3, true, concat('doc.', p_size), NULL FROM part""")
def refreshed_pattern(inputs):
    """From the cached text and a response to the new text, which is read again."""
    live = readers.field_types(inputs("caps_bodies"), ["id"])
    refresh = D.refresh_field_list(live, D.cached_entries(inputs("cached_lists"), ["id"]), ["id"])
    entry = J.parsed(F.col("entry"))
    return D.cached_entries(D.refreshed_lists(refresh, ["id"]), ["id"]).select(
        "id", "name", "type", "count", "scripted", J.as_text(entry, "script").alias("script"),
        F.array_join(F.try_variant_get(entry, "$.esTypes", "array<string>"), ",").alias("es_types"))


@query("stored_patterns", (), """
SELECT concat('ip-', p_partkey) AS id, concat('T', p_partkey) AS title, 'kept' AS note, CAST(3 AS INTEGER) AS entries FROM part
UNION ALL SELECT concat('bare-', p_partkey), concat('T', p_partkey), 'kept', 0 FROM part""")
def stored_patterns(inputs):
    """Refreshed lists put into the patterns themselves; a list of which nothing is left becomes empty."""
    lists = inputs("cached_lists").unionByName(inputs("bare_lists"))
    title = F.concat(F.lit("T"), F.substring_index("id", "-", -1))
    patterns = lists.select("id", F.to_json(F.struct(title.alias("title"), F.lit("kept").alias("note"), "fields")).alias("attributes"))
    refresh = D.refresh_field_list(readers.field_types(inputs("caps_bodies"), ["id"]), D.cached_entries(lists, ["id"]), ["id"])
    stored = D.refreshed_patterns(patterns, D.refreshed_lists(refresh, ["id"]), ["id"])
    doc = J.parsed(F.col("attributes"))
    return stored.select("id", J.as_text(doc, "title").alias("title"), J.as_text(doc, "note").alias("note"), F.size(J.as_list(J.parsed(J.as_text(doc, "fields")))).alias("entries"))


# Two thirds of the policies are edited in three places; the others have to come back as they were.
@query("policy_write_back", (), f"""
WITH e AS (SELECT *, c_custkey AS k, c_custkey % 3 <> 0 AS edited FROM customer)
SELECT concat('policy-', k) AS policy_id, CAST(k % 5 + CASE WHEN edited THEN 3 ELSE 0 END AS BIGINT) AS seq_no, NOT edited AS untouched, CAST(k % 20 AS BIGINT) AS schema_version,
  'ops' AS notified, concat('n', k % 8) AS note, CAST(3 AS BIGINT) AS retries, concat(k % 60, 'gb') AS min_size, CAST(CASE WHEN edited THEN 5 END AS BIGINT) AS min_doc_count,
  'warm' AS moves_to, CAST(k % 7 AS BIGINT) AS x, CASE WHEN edited THEN '2d' ELSE '1d' END AS age, concat('logs-', k, '*', CASE WHEN edited THEN ',extra-*' ELSE '' END) AS claimed,
  CAST(CASE WHEN edited THEN 9 ELSE 1 END AS BIGINT) AS priority, concat('team-', k % 4) AS owner, CAST(CASE WHEN edited THEN {NOW_MS} END AS BIGINT) AS updated FROM e""")
def policy_write_back(inputs):
    """Edits of rollover, transition and claims, one after the other, written into whole documents."""
    table = readers.policies(inputs("policy_bodies"))
    chosen = table.where("int(substring(policy_id, 8)) % 3 <> 0").select("policy_id")

    def conditions(text):
        return F.from_json(F.lit(text), T.CONDITIONS).alias("conditions")

    rollover = chosen.select("policy_id", F.lit("hot").alias("state_name"), conditions('{"min_doc_count":5}'))
    move = chosen.select("policy_id", F.lit("hot").alias("from_state"), F.lit("warm").alias("to_state"), conditions('{"min_index_age":"2d"}'), F.lit("first").alias("position"))
    claims = chosen.select(
        "policy_id", F.lit(None).cast("array<struct<old:string,new:string>>").alias("replace"), F.lit(None).cast("array<string>").alias("remove"),
        F.array(F.lit("extra-*")).alias("add"), F.lit(0).alias("entry_index"), F.lit(9).alias("priority"))
    after = inputs.shared("rollover", lambda: E.commit(table, E.set_rollover(rollover, table), "states"))
    after = inputs.shared("move", lambda: E.commit(after, E.set_transition(move, after), "states"))
    after = E.commit(after, E.edit_ism_template(claims, after, NOW_MS), "ism_template")
    read = table.select("policy_id", F.col("document").alias("before"))
    doc = J.parsed(F.col("document"))

    def at(path, kind):
        return F.try_variant_get(doc, path, kind)

    state, claim = "$.states[0]", "$.ism_template[0]"
    return E.policy_documents(after).join(read, "policy_id").select(
        "policy_id", "seq_no", (F.col("document") == F.col("before")).alias("untouched"),
        at("$.schema_version", "bigint").alias("schema_version"), at("$.error_notification.channel", "string").alias("notified"),
        at(f"{state}.note", "string").alias("note"), at(f"{state}.actions[0].retry.count", "bigint").alias("retries"),
        at(f"{state}.actions[0].rollover.min_size", "string").alias("min_size"), at(f"{state}.actions[0].rollover.min_doc_count", "bigint").alias("min_doc_count"),
        at(f"{state}.transitions[0].state_name", "string").alias("moves_to"), at(f"{state}.transitions[0].x", "bigint").alias("x"),
        at(f"{state}.transitions[0].conditions.min_index_age", "string").alias("age"),
        F.array_join(at(f"{claim}.index_patterns", "array<string>"), ",").alias("claimed"), at(f"{claim}.priority", "bigint").alias("priority"),
        at(f"{claim}.owner", "string").alias("owner"), at(f"{claim}.last_updated_time", "bigint").alias("updated"))


# A third of the templates lose their policy; the others get a new one. All else has to stay.
@query("template_write_back", (), """
SELECT 'index' AS kind, concat('tpl-', p_partkey) AS name, concat('p-', p_size) AS before, CASE WHEN p_size % 3 <> 0 THEN concat('new-', p_size) END AS written, CAST(NULL AS VARCHAR) AS dotted,
  concat('logs-', p_partkey, '*') AS pattern, CAST(p_size AS BIGINT) AS number, concat('o-', p_partkey % 9) AS owner, 'false' AS dynamic FROM part
UNION ALL SELECT 'component', concat('c-', p_partkey), concat('p-', p_size), CASE WHEN p_size % 3 <> 0 THEN concat('new-', p_size) END, NULL, concat('{"a-', p_partkey, '":{}}'), CAST(p_size AS BIGINT), NULL, NULL FROM part""")
def template_write_back(inputs):
    """Policies set in index and component templates, read back from the whole bodies that are to be stored."""
    size = F.substring("before", 3, 9).cast("int")
    whole = []
    for kind, table in (("index", readers.index_templates(inputs("template_bodies"))), ("component", readers.component_templates(inputs("component_bodies")))):
        named = table.where("name <> '-'")
        edits = named.select("name", J.settings_policy(F.col("settings")).alias("before")).select(
            "name", F.when(size % 3 == 0, "None").otherwise(F.concat(F.lit("new-"), size.cast("string"))).alias("policy_id"))
        whole.append(E.set_template_policy(edits, named).select(F.lit(kind).alias("kind"), "name", "before", J.parsed(F.col("body")).alias("doc")))
    rows = whole[0].unionByName(whole[1])

    def at(path, kind):
        return F.try_variant_get("doc", path, kind)

    settings = F.to_json(F.try_variant_get("doc", "$.template.settings", "variant"))
    return rows.select(
        "kind", "name", "before", J.settings_policy(settings).alias("written"), J.as_text(J.parsed(settings), J.POLICY_KEY).alias("dotted"),
        F.coalesce(at("$.index_patterns[0]", "string"), F.to_json(at("$.template.aliases", "variant"))).alias("pattern"),
        F.coalesce(at("$.priority", "bigint"), at("$.version", "bigint")).alias("number"), at("$._meta.owner", "string").alias("owner"),
        at("$.template.mappings.dynamic", "string").alias("dynamic"))


@query("validate_documents", (), """
SELECT concat('d-', k) AS id, concat('D', k) AS title, CASE WHEN e > 0 THEN 'error' WHEN w > 0 THEN 'warning' ELSE 'ok' END AS status, e AS errors, w AS warnings
FROM (SELECT c_custkey AS k, CAST(CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 7 = 0 OR c_custkey % 4 = 0 OR c_custkey % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS e,
  CAST(CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 = 0 THEN 1 ELSE 0 END AS BIGINT) AS w FROM customer)""")
def validate_documents(inputs):
    """The whole check, from raw documents, index names and mapping responses."""
    objects = inputs.shared("objects", lambda: readers.saved_objects(documents=inputs("validation_documents").select("_id", "_source")))
    mappings = readers.index_mappings(inputs("mapping_bodies"))
    names = readers.index_names(mappings.select(F.col("index_name").alias("index")))
    return O.validate_dashboards(objects, names, mappings, keep=True).dashboards


@query("chosen_objects", ("saved_objects",), """
SELECT type, id, title FROM saved_objects WHERE type = 'dashboard' AND id IN (SELECT concat('dash-', o_custkey) FROM orders)""")
def chosen_objects(inputs):
    ids = inputs.table("orders").select(F.concat(F.lit("dash-"), F.col("o_custkey").cast("string")).alias("id"))
    return R.only_ids(O.list_objects(inputs("saved_objects"), "dashboard"), ids)
