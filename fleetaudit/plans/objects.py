"""Queries on saved objects, raw dumps and keyed updates."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.operators import saved_objects as O
from fleetaudit.plans.registry import query
from fleetaudit.sinks import tables
from fleetaudit.sources import readers
from fleetaudit.sources import schemas as T
from fleetaudit.sources.layout import new_folder

# ---------------------------------------------------------------------------
# Listings
# ---------------------------------------------------------------------------


@query("object_listing", ("saved_objects",), """
SELECT type, id, title FROM saved_objects WHERE type IN ('dashboard', 'visualization', 'search') ORDER BY type, title""")
def object_listing(inputs):
    return O.by_type_and_title(O.list_objects(inputs("saved_objects")))


def pattern_objects(inputs):
    return inputs("pattern_docs").select(
        "type", "id", "title", "attributes", F.array().cast(T.REFERENCES).alias("references"),
        F.array_distinct(F.split("spaces", ",")).alias("workspaces"), "updated_at",
    )


@query("index_pattern_listing", ("pattern_docs",), """
SELECT id, title, json_extract_string(attributes, '$.timeFieldName') AS time_field,
  CASE WHEN split_part(spaces, ',', 1) = split_part(spaces, ',', 2) THEN split_part(spaces, ',', 1) ELSE replace(spaces, ',', ', ') END AS workspaces,
  CASE WHEN f = '' THEN 0 WHEN json_valid(f) THEN json_array_length(f) END AS fields, COALESCE(left(replace(updated_at, 'T', ' '), 16), '') AS updated
FROM (SELECT *, json_extract_string(attributes, '$.fields') AS f FROM pattern_docs) ORDER BY title""")
def index_pattern_listing(inputs):
    return O.by_title(O.list_index_patterns(pattern_objects(inputs)))


@query("workspace_objects", ("pattern_docs",), "SELECT id FROM pattern_docs WHERE list_contains(string_split(spaces, ','), 'w2')")
def workspace_objects(inputs):
    return O.in_workspace(pattern_objects(inputs), default="w2").select("id")


@query("workspace_scope", ("pattern_docs",), """, w AS (SELECT id, string_split(spaces, ',') AS spaces FROM pattern_docs)
SELECT 'explicit' AS scope, id FROM w WHERE list_contains(spaces, 'w2') UNION ALL SELECT 'all', id FROM w UNION ALL SELECT 'none', id FROM w
UNION ALL SELECT 'default', id FROM w WHERE list_contains(spaces, 'w1')""")
def workspace_scope(inputs):
    """An explicit workspace goes before the lifted scope and the default, the lifted scope before the default."""
    objects = pattern_objects(inputs)
    chosen = {"explicit": {"explicit": "w2", "default": "w1", "everything": True}, "all": {"default": "w1", "everything": True}, "default": {"default": "w1"}, "none": {}}
    return reduce(DataFrame.unionByName, [O.in_workspace(objects, **how).select(F.lit(name).alias("scope"), "id") for name, how in chosen.items()])


@query("listing_totals", ("saved_objects", "pattern_docs", "detector_docs"), """
SELECT type AS listing, COUNT(*) AS entries FROM saved_objects WHERE type IN ('dashboard', 'visualization', 'search') GROUP BY 1
UNION ALL SELECT 'index-pattern', COUNT(*) FROM pattern_docs HAVING COUNT(*) > 0 UNION ALL SELECT 'detector', COUNT(*) FROM detector_docs HAVING COUNT(*) > 0""")
def listing_totals(inputs):
    """The totals under the listings, of all in one pass: ``listing, entries``."""
    listed = O.list_objects(inputs("saved_objects")).select(F.col("type").alias("listing"))
    patterns = O.list_index_patterns(pattern_objects(inputs)).select(F.lit(O.PATTERN_TYPE).alias("listing"))
    detectors = O.list_detectors(inputs("detector_docs")).select(F.col("type").alias("listing"))
    return listed.unionByName(patterns).unionByName(detectors).groupBy("listing").agg(F.count("*").alias("entries"))


@query("detector_listing", ("detector_docs",), """
SELECT 'detector' AS type, id, COALESCE(json_extract_string(detector, '$.name'), 'N/A') AS title FROM detector_docs ORDER BY title""")
def detector_listing(inputs):
    return O.by_title(O.list_detectors(inputs("detector_docs")))


@query("detector_export", ("detector_docs",), """
SELECT id, 'detector' AS type, json_extract_string(detector, '$.name') AS name, CAST(json_extract(detector, '$.nation') AS INTEGER) AS nation FROM detector_docs""")
def detector_export(inputs):
    record = F.from_json("line", "id string, type string, detector struct<name:string,nation:int>").alias("r")
    return O.export_detectors(inputs("detector_docs")).select(record).select("r.id", "r.type", "r.detector.name", "r.detector.nation")


@query("workspace_listing", ("workspace_bodies",), """
SELECT json_extract_string(w.value, '$.id') AS id, json_extract_string(w.value, '$.name') AS name, json_extract_string(w.value, '$.description') AS description
FROM workspace_bodies b, json_each(COALESCE(json_extract(b.value, '$.result.workspaces'), json_extract(b.value, '$.result'))) w ORDER BY COALESCE(name, '')""")
def workspace_listing(inputs):
    return readers.workspaces(inputs("workspace_bodies")).orderBy(F.coalesce("name", F.lit("")))


# ---------------------------------------------------------------------------
# Field reads
# ---------------------------------------------------------------------------


@query("referenced_fields", ("attribute_docs",), """,
base AS (SELECT type, id, attributes, CASE WHEN json_type(attributes, '$.visState') = 'VARCHAR' THEN json_extract_string(attributes, '$.visState')
    ELSE CAST(json_extract(attributes, '$.visState') AS VARCHAR) END AS st,
  json_extract_string(attributes, '$.kibanaSavedObjectMeta.searchSourceJSON') AS src FROM attribute_docs WHERE type IN ('visualization', 'search')),
agg AS (SELECT b.type, b.id, a.value AS v, concat('agg "', COALESCE(json_extract_string(a.value, '$.type'), '?'), '" (id: ', COALESCE(json_extract_string(a.value, '$.id'), '?'), ')') AS cx
  FROM base b, json_each(json_extract(b.st, '$.aggs')) a WHERE a.type = 'OBJECT'),
ser AS (SELECT b.type, b.id, s.value AS v, s.key AS i FROM base b, json_each(json_extract(b.st, '$.params.series')) s WHERE s.type = 'OBJECT'),
met AS (SELECT s.type, s.id, s.i, m.value AS m, json_extract(s.v, '$.metrics[*].id') AS ids FROM ser s, json_each(json_extract(s.v, '$.metrics')) m),
fil AS (SELECT b.type, b.id, f.value AS f FROM base b, json_each(json_extract(b.src, '$.filter')) f)
SELECT b.type, b.id, json_extract_string(c.value, '$') AS field, 'search column' AS context FROM base b, json_each(json_extract(b.attributes, '$.columns')) c WHERE c.type = 'VARCHAR'
UNION ALL SELECT type, id, json_extract_string(v, '$.params.field'), cx FROM agg WHERE json_type(v, '$.params.field') = 'VARCHAR'
UNION ALL SELECT a.type, a.id, json_extract_string(j.atom, '$'), cx || ' custom JSON' FROM agg a, json_tree(json_extract_string(a.v, '$.params.json')) j WHERE j.key = 'field' AND j.type = 'VARCHAR'
UNION ALL SELECT type, id, json_extract_string(st, '$.params.field'), concat('vis params (', json_extract_string(st, '$.type'), ')') FROM base WHERE json_type(st, '$.params.field') = 'VARCHAR'
UNION ALL SELECT type, id, json_extract_string(m, '$.field'), concat('TSVB series[', i, '] metric') FROM met
  WHERE json_type(m, '$.field') = 'VARCHAR' AND NOT list_contains(ids, json_extract(m, '$.field'))
UNION ALL SELECT type, id, json_extract_string(v, '$.terms_field'), concat('TSVB series[', i, '] terms_field') FROM ser WHERE json_type(v, '$.terms_field') = 'VARCHAR'
UNION ALL SELECT type, id, json_extract_string(f, '$.meta.key'), 'filter' FROM fil WHERE json_type(f, '$.meta.key') = 'VARCHAR'
UNION ALL SELECT f.type, f.id, k.key, concat('filter ', c.clause) FROM fil f, (VALUES ('match_phrase'), ('match'), ('term'), ('range')) c(clause), json_each(json_extract(f.f, '$.query.' || c.clause)) k""")
def referenced_fields(inputs):
    return O.referenced_fields(inputs("attribute_docs"))


# ---------------------------------------------------------------------------
# Export and import
# ---------------------------------------------------------------------------


@query("export_stripped", ("object_docs",), """
SELECT id, CASE WHEN ok THEN CASE WHEN json_type(doc, '$.query') = 'OBJECT' THEN '' END ELSE search_source_json END AS query_text,
  CASE WHEN ok THEN json_extract_string(doc, '$.query.language') END AS language,
  CASE WHEN ok AND json_exists(doc, '$.filter') THEN 0 END AS filters
FROM (SELECT *, COALESCE(json_valid(search_source_json), false) AS ok, CASE WHEN json_valid(search_source_json) THEN search_source_json END AS doc FROM object_docs)""")
def export_stripped(inputs):
    text = J.stripped_search_source(F.col("search_source_json"))
    doc = J.parsed(F.col("text"))
    return inputs("object_docs").select("id", text.alias("text")).select(
        "id",
        F.when(doc.isNull(), F.col("text")).otherwise(J.as_text(doc, "query", "query")).alias("query_text"),
        J.as_text(doc, "query", "language").alias("language"),
        F.size(J.as_list(doc, "filter")).alias("filters"),
    )


def attribute_objects(inputs):
    reference = F.struct(F.lit("r").alias("name"), F.lit("search").alias("type"), F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("id"))
    return inputs("attribute_docs").select(
        "type", "id", F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("title"), "attributes", F.array(reference).alias("references")
    )


@query("export_records", ("attribute_docs",), """
SELECT type, id, concat('T', o_orderkey) AS title, concat('s', o_custkey) AS reference, '' AS query_text, 'kuery' AS language, 0 AS filters,
  concat('c', o_custkey) AS first_column FROM attribute_docs""")
def export_records(inputs):
    doc = J.parsed(F.col("line"))
    source = J.parsed(J.search_source_text(F.try_variant_get(doc, "$.attributes", "variant")))
    return O.export_records(attribute_objects(inputs)).select("type", "id", doc.alias("doc"), source.alias("source")).select(
        "type",
        "id",
        J.as_text(F.col("doc"), "attributes", "title").alias("title"),
        F.try_variant_get("doc", "$.references[0].id", "string").alias("reference"),
        J.as_text(F.col("source"), "query", "query").alias("query_text"),
        J.as_text(F.col("source"), "query", "language").alias("language"),
        F.size(J.as_list(F.col("source"), "filter")).alias("filters"),
        F.try_variant_get("doc", "$.attributes.columns[0]", "string").alias("first_column"),
    )



@query("export_files", ("attribute_docs",), """, o AS (SELECT type, id, concat('T', o_orderkey) AS title FROM attribute_docs)
SELECT 'older last' AS reading, type, id, title FROM o
UNION ALL SELECT 'newer last', type, id, CASE WHEN type = 'search' THEN 'renamed' ELSE title END FROM o""")
def export_files(inputs):
    """Two exports written as files and read again; the one named later on counts, at its first naming."""
    objects = attribute_objects(inputs)
    renamed = objects.filter("type = 'search'").withColumn("attributes", F.lit('{"title":"renamed"}'))
    older, newer = new_folder(inputs.spark, "export"), new_folder(inputs.spark, "export")
    header = O.export_header(pattern_objects(inputs))
    tables.write_export(O.export_records(objects), header, older)
    tables.write_export(O.export_records(renamed), header, newer, by_type=False)

    def imported(name, paths):
        last = tables.last_per_key(readers.read_export(inputs.spark, paths), tables.OBJECT_KEY, "ordinal")
        return last.select(F.lit(name).alias("reading"), "type", "id", J.as_text(J.parsed(F.col("attributes")), "title").alias("title"))

    return imported("newer last", [older, newer, older]).unionByName(imported("older last", [newer, older, newer]))


@query("export_header", ("pattern_docs",), "SELECT id, title FROM pattern_docs")
def export_header(inputs):
    entry = F.from_json("line", "map<string,map<string,string>>")[O.HEADER_KEY]
    return O.export_header(pattern_objects(inputs)).select(F.explode(entry).alias("id", "title"))


@query("import_outcome", ("import_records", "import_errors"), """
SELECT r.type, r.id, COALESCE(json_extract_string(r.attributes, '$.title'), 'N/A') AS title, e.error
FROM import_records r LEFT JOIN import_errors e USING (type, id) WHERE r.type = 'dashboard'""")
def import_outcome(inputs):
    wanted, _ = O.split_by_type(inputs("import_records"), "dashboard")
    return O.import_outcome(wanted, inputs("import_errors"))


@query("import_skipped", ("import_records",), "SELECT type, id FROM import_records WHERE type <> 'dashboard'")
def import_skipped(inputs):
    return O.split_by_type(inputs("import_records"), "dashboard")[1].select("type", "id")


@query("import_tally", ("import_records", "import_errors"), """
SELECT COUNT(*) FILTER (WHERE r.type = 'dashboard' AND e.error IS NULL) AS imported, COUNT(*) FILTER (WHERE r.type = 'dashboard' AND e.error IS NOT NULL) AS failed,
  COUNT(*) FILTER (WHERE r.type <> 'dashboard') AS skipped FROM import_records r LEFT JOIN import_errors e USING (type, id)""")
def import_tally(inputs):
    wanted, skipped = O.split_by_type(inputs("import_records"), "dashboard")
    return O.import_tally(O.import_outcome(wanted, inputs("import_errors")), skipped)


LAST = ", last AS (SELECT type, id, last(title ORDER BY ordinal NULLS FIRST, title) AS title FROM incoming_objects GROUP BY 1, 2)"
UPSERTED = LAST + """
SELECT type, id, title FROM stored_objects s WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.type = s.type AND l.id = s.id)
UNION ALL SELECT type, id, title FROM last"""


@query("upsert_objects", ("stored_objects", "incoming_objects"), UPSERTED)
def upsert_objects(inputs):
    return tables.upsert(inputs("stored_objects"), inputs("incoming_objects"), order="ordinal")


@query("upsert_buckets", ("stored_objects", "incoming_objects"), UPSERTED)
def upsert_buckets(inputs):
    """The same on a stored table, of which only touched buckets are written anew."""
    path = new_folder(inputs.spark, "objects")
    tables.write_buckets(inputs("stored_objects"), path, buckets=16)
    tables.upsert_into(path, inputs("incoming_objects"), order="ordinal", buckets=16)
    return tables.read_buckets(inputs.spark, path)


@query("delete_objects", ("stored_objects", "incoming_objects"), """
SELECT type, id, title FROM stored_objects s WHERE NOT EXISTS (SELECT 1 FROM incoming_objects l WHERE l.type = s.type AND l.id = s.id)""")
def delete_objects(inputs):
    return tables.delete(inputs("stored_objects"), inputs("incoming_objects"))


# ---------------------------------------------------------------------------
# Raw dumps
# ---------------------------------------------------------------------------


@query("explain_response", ("explain_bodies",), """
SELECT concat('idx-', o_orderkey) AS index_name, CASE WHEN o_orderkey % 3 <> 0 THEN concat('set-', o_custkey) END AS policy_id_setting,
  concat('policy-', o_custkey) AS policy_id, o_custkey % 3 AS policy_seq_no, CASE WHEN o_orderkey % 4 <> 0 THEN 'hot' END AS state,
  o_orderkey % 5 = 0 AS failed, CAST(o_orderkey % 4 AS INTEGER) AS retries, 1700000000000 + o_orderkey AS start_time,
  CASE WHEN o_orderkey % 2 = 0 THEN '{"message":"m"}' ELSE 'as text' END AS info FROM orders""")
def explain_response(inputs):
    return readers.explain_rows(inputs("explain_bodies")).select(
        "index_name", "policy_id_setting", "policy_id", "policy_seq_no", F.col("state.name").alias("state"),
        F.col("action.failed").alias("failed"), F.col("action.consumed_retries").alias("retries"),
        F.col("step.start_time").alias("start_time"), "info",
    )


@query("managed_hits", (), """
SELECT concat('idx-', o_orderkey) AS index_name, concat('policy-', o_custkey) AS policy_id, o_custkey % 3 AS policy_seq_no,
  CAST(o_orderkey % 60 AS INTEGER) AS period, 'Minutes' AS unit FROM orders""")
def managed_hits(inputs):
    return readers.managed_config(inputs("managed_bodies")).select(
        "index_name", "policy_id", "policy_seq_no", "schedule.interval.period", "schedule.interval.unit"
    )


@query("task_snapshot", (), """
SELECT concat('node-', user_id) AS node, concat('n:', event_id) AS task_id, event_type AS action, event_id * 1000003 AS running_time_in_nanos, CAST(NULL AS VARCHAR) AS parent_task_id FROM events
UNION ALL SELECT concat('node-', user_id), concat('m:', event_id), 'internal:x', NULL, concat('n:', event_id) FROM events""")
def task_snapshot(inputs):
    return readers.tasks(inputs("task_bodies")).drop("description")


PAGES = """
SELECT 'dashboard' AS type, concat('d', c_custkey) AS id, c_name AS title, concat('v', c_custkey) AS reference,
  CASE c_custkey % 3 WHEN 0 THEN concat('w', c_nationkey) WHEN 1 THEN '' ELSE concat('n', c_nationkey) END AS workspaces, '2024-05-06T07:08:09Z' AS updated_at FROM customer
UNION ALL SELECT 'search', concat('s', c_custkey), 'N/A', NULL, '', '' FROM customer"""


@query("saved_object_pages", (), PAGES)
def saved_object_pages(inputs):
    return readers.saved_objects(pages=inputs("page_bodies")).select(
        "type", "id", "title", F.get("references", F.lit(0))["id"].alias("reference"), F.concat_ws(",", "workspaces").alias("workspaces"), "updated_at"
    )


@query("saved_object_documents", ("raw_documents",), """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN 'dashboard' ELSE 'search' END AS type, CASE WHEN o_orderkey % 4 = 3 THEN CAST(o_orderkey AS VARCHAR) ELSE concat('a:', o_orderkey) END AS id,
  CASE WHEN o_orderkey % 4 = 0 THEN concat('D', o_orderkey) ELSE 'N/A' END AS title,
  CASE WHEN o_orderkey % 3 = 1 THEN concat('w', o_custkey) ELSE '' END AS workspaces, 's1' AS reference FROM orders WHERE o_orderkey % 4 <> 2""")
def saved_object_documents(inputs):
    return readers.saved_objects(documents=inputs("raw_documents"), types=("dashboard", "visualization", "search")).select(
        "type", "id", "title", F.concat_ws(",", "workspaces").alias("workspaces"), F.get("references", F.lit(0))["id"].alias("reference")
    )


@query("export_lines", ("export_lines",), """
SELECT json_extract_string(value, '$.id') AS id, json_extract_string(value, '$.type') AS type, json_extract_string(value, '$.attributes.title') AS title
FROM (SELECT CASE WHEN json_valid(value) THEN value END AS value FROM export_lines) WHERE json_exists(value, '$.id')""")
def export_lines(inputs):
    return readers.export_records(inputs("export_lines")).select("id", "type", J.as_text(J.parsed(F.col("attributes")), "title").alias("title"))


@query("known_names", ("field_caps", "data_stream_indices"), """
SELECT DISTINCT index_name AS name FROM field_caps UNION SELECT concat('alias-', s_suppkey % 7) FROM supplier
UNION SELECT name FROM data_stream_indices UNION SELECT index_name FROM data_stream_indices""")
def known_names(inputs):
    indices = inputs("field_caps").select(F.col("index_name").alias("index"))
    supplier = inputs.table("supplier")
    aliases = supplier.select(
        F.concat(F.lit("alias-"), (F.col("s_suppkey") % 7).cast("string")).alias("alias"),
        F.concat(F.lit("logs-"), F.col("s_suppkey").cast("string")).alias("index"),
    )
    streams = inputs("data_stream_indices").select("name", F.array(F.struct("index_name")).alias("indices"))
    return readers.index_names(indices, aliases, streams).select("name").distinct()
