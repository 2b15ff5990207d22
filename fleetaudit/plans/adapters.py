"""Operator inputs derived from the given tables, in SQL that Spark and DuckDB both read.

Each statement keeps all rows of its tables and plants the edge cases of its operators
by changing values: a name that nobody refers to stands for a missing object, and so on.
The same text serves Spark and, as a leading CTE, the check queries.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)
AS_OF_MS = 1717200000000

SQL: dict[str, str] = {}

# System names, NULL and '' policies in either key, missing states, mixed-case statuses, failed
# actions on steps that did not fail, reasons as object, text, empty object or nothing.
SQL["index_explain"] = f"""
SELECT CASE WHEN o_orderkey % 45 = 0 THEN concat('.kibana-', o_orderkey) ELSE concat('idx-', o_orderkey) END AS index_name,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN concat('policy-', o_custkey)
            WHEN o_orderkey % 7 = 0 THEN '' END AS policy_id_setting,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN ''
            WHEN o_orderkey % 41 = 0 THEN 'policy-absent' ELSE concat('policy-', o_custkey) END AS policy_id,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            ELSE (o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END) % 3 END AS policy_seq_no,
       CASE o_orderstatus WHEN 'O' THEN 'hot' WHEN 'F' THEN 'warm' END AS state_name,
       CASE o_orderstatus WHEN 'O' THEN 'rollover' ELSE 'transition' END AS action_name,
       o_orderkey % 19 = 0 AS action_failed,
       o_orderkey % 4 AS action_retries,
       o_orderkey % 43 = 0 AS retry_failed,
       o_orderkey % 6 AS retry_retries,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'failed' WHEN '2-HIGH' THEN 'RUNNING' WHEN '3-MEDIUM' THEN 'completed'
            WHEN '4-NOT SPECIFIED' THEN 'condition_not_met' ELSE '' END AS step_status,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 AND o_orderkey % 11 = 0 THEN 0
            ELSE {AS_OF_MS} - (o_orderkey * 7919) % 200000000 END AS start_time,
       CASE o_orderkey % 7 WHEN 0 THEN '{{"cause":" shard limit ","message":"unused"}}' WHEN 1 THEN '{{"cause":"","message":"rolled over"}}'
            WHEN 2 THEN ' plain reason ' WHEN 3 THEN '{{}}' END AS info
FROM orders"""

# A sixth of the indices have no statistics.
SQL["index_stats"] = """
SELECT CASE WHEN l_orderkey % 6 = 0 THEN concat('gone-', l_orderkey) WHEN l_orderkey % 45 = 0 THEN concat('.kibana-', l_orderkey)
            ELSE concat('idx-', l_orderkey) END AS index_name,
       CAST(SUM(CAST(l_quantity AS BIGINT) * 1048577) AS BIGINT) AS size_in_bytes
FROM lineitem GROUP BY l_orderkey"""

# Some policies that indices name do not exist any more.
SQL["policy_current"] = """
SELECT CASE WHEN c_custkey % 9 = 0 THEN concat('retired-', c_custkey) ELSE concat('policy-', c_custkey) END AS policy_id,
       c_custkey % 3 AS seq_no
FROM customer"""

# One key in up to three layers, keys outside the prefix, and a layer nobody reads.
_SETTING = "concat(CASE WHEN p_partkey % 4 = 0 THEN 'cluster.' ELSE 'plugins.index_state_management.' END, 's', p_partkey)"
SQL["settings_layers"] = f"""
SELECT 'defaults' AS source, {_SETTING} AS setting, p_brand AS value FROM part
UNION ALL
SELECT CASE WHEN p_size % 5 = 0 THEN 'transient' ELSE 'unread' END, {_SETTING}, p_type FROM part
UNION ALL
SELECT CASE WHEN p_size % 7 = 0 THEN 'persistent' ELSE 'unread' END, {_SETTING}, p_name FROM part"""

# A NULL interval sorts as 0.
SQL["managed_config"] = """
SELECT concat('idx-', o_orderkey) AS index_name, concat('policy-', o_custkey) AS policy_id,
       CASE o_orderkey % 4 WHEN 0 THEN 5 WHEN 1 THEN 30 WHEN 2 THEN 60 END AS period,
       CASE WHEN o_orderkey % 4 < 3 THEN 'Minutes' END AS unit,
       o_custkey % 3 AS policy_seq_no
FROM orders"""

# Every eighth field conflicts between odd and even indices, some only as keyword and text, which
# show alike; flat_object is unknown, _m fields and the type _doc are metadata.
_FIELD_KIND = "(l_partkey + CASE WHEN l_partkey % 8 = 0 THEN l_suppkey % 2 ELSE 0 END) % 6"
SQL["field_caps"] = f"""
SELECT concat('logs-', l_suppkey) AS index_name,
       concat(CASE WHEN l_partkey % 120 >= 110 THEN '_m' ELSE 'f' END, l_partkey) AS field,
       CASE WHEN l_partkey % 120 = 109 THEN '_doc' ELSE
         CASE {_FIELD_KIND} WHEN 0 THEN 'keyword' WHEN 1 THEN 'text' WHEN 2 THEN 'long'
              WHEN 3 THEN 'date' WHEN 4 THEN 'flat_object' ELSE 'ip' END END AS type,
       {_FIELD_KIND} <> 1 AS aggregatable,
       l_partkey % 120 <> 60 AS searchable
FROM lineitem"""

# A stale cache: lacks some live fields, holds removed ones, scripted ones and metadata.
SQL["cached_fields"] = """
SELECT concat(CASE WHEN p_partkey % 60 = 0 THEN '_m' WHEN p_partkey % 7 = 0 THEN 'old' ELSE 'f' END, p_partkey) AS name,
       'number' AS type, p_size AS count, p_partkey % 50 = 0 AS scripted
FROM part"""

# Dotted fields under leaf, object, nested and missing parents.
SQL["multi_fields"] = """
SELECT concat('g', p_partkey) AS name,
       CASE p_partkey % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'object' WHEN 2 THEN 'nested' ELSE 'keyword' END AS primary_type FROM part
UNION ALL
SELECT concat('g', p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '.a.b' ELSE '.raw' END), 'keyword' FROM part
UNION ALL
SELECT concat('h', s_suppkey, '.raw'), 'keyword' FROM supplier"""

# Noisy prefixes, descriptions of any length, NULL running times.
SQL["tasks"] = """
SELECT concat('node', doc_id % 10, ':', doc_id) AS task_id, concat('node', doc_id % 10) AS node,
       CASE doc_id % 5 WHEN 0 THEN 'cluster:monitor/nodes/stats' WHEN 1 THEN 'indices:monitor/stats'
            WHEN 2 THEN 'internal:index/shard' WHEN 3 THEN 'indices:data/write/bulk'
            ELSE 'indices:data/read/search' END AS action,
       CASE WHEN doc_id % 17 = 0 THEN NULL ELSE n_chars * 7000003 END AS running_time_in_nanos,
       CASE WHEN doc_id % 4 = 0 THEN concat('node', doc_id % 10, ':', doc_id - 1) END AS parent_task_id,
       CASE WHEN doc_id % 3 = 0 THEN concat(source, ' ', lang) ELSE text END AS description
FROM documents"""

# The wait as text is sometimes missing, then it comes from the milliseconds.
SQL["pending_tasks"] = """
SELECT event_id AS insert_order,
       CASE event_id % 4 WHEN 0 THEN 'URGENT' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'NORMAL' ELSE 'LOW' END AS priority,
       CASE WHEN event_id % 2 = 0 THEN concat(event_id, 'ms') WHEN event_id % 3 = 0 THEN '' END AS time_in_queue,
       (event_id * 7919) % 500000 AS time_in_queue_millis,
       concat(event_type, ' ', props, CASE WHEN event_id % 6 = 0 THEN ' 0123456789012345678901234567890123456789012345678901234567890123456789012345678901234567890123456789' ELSE '' END) AS source
FROM events"""

# Long form, one row per backing index; the highest position is written to.
SQL["data_stream_indices"] = """
SELECT concat('ds-', conv_id) AS name, turn AS pos, concat('.ds-ds-', conv_id, '-', turn) AS index_name
FROM conversations"""

# Backing indices as a comma list, sometimes none.
SQL["data_streams"] = """
SELECT concat('ds-', c_custkey) AS name, CASE WHEN c_acctbal < 0 THEN 'RED' ELSE 'GREEN' END AS status,
       c_custkey % 9 AS generation, concat('tpl-', c_custkey) AS template,
       CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN concat('.ds-', c_custkey, '-1')
            ELSE concat('.ds-', c_custkey, '-1,.ds-', c_custkey, '-2') END AS backing
FROM customer"""

# Inline policies nested or dotted; '' counts as unset. Components as a comma list.
SQL["index_templates"] = """
SELECT concat('tpl-', o_orderkey) AS name, concat('logs-', o_custkey, '*,metrics-', o_custkey) AS index_patterns,
       CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN concat('comp-', o_custkey)
            ELSE concat('comp-', o_custkey, ',comp-', o_orderkey % 97, ',comp-', o_custkey + 1) END AS composed_of,
       CASE o_orderkey % 10 WHEN 0 THEN concat('{"index":{"plugins":{"index_state_management":{"policy_id":"policy-', o_custkey, '"}}}}')
            WHEN 1 THEN '{"index":{"plugins":{"index_state_management":{"policy_id":""}}}}'
            WHEN 2 THEN concat('{"index.plugins.index_state_management.policy_id":"dotted-', o_custkey, '"}')
            WHEN 3 THEN '{"index":{"codec":"best_compression"}}' END AS settings
FROM orders"""

# Long form of the components; the last one with a policy wins.
SQL["template_components"] = """
SELECT concat('tpl-', l_orderkey) AS name, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey AS pos,
       concat('comp-', l_partkey) AS component
FROM lineitem"""

SQL["template_inline"] = """
SELECT concat('tpl-', o_orderkey) AS name, concat('logs-', o_custkey, '*') AS index_pattern,
       CASE WHEN o_orderkey % 10 = 0 THEN concat('policy-', o_custkey) WHEN o_orderkey % 10 = 1 THEN '' END AS inline_policy
FROM orders"""

SQL["component_templates"] = """
SELECT concat(CASE WHEN p_partkey % 23 = 0 THEN 'lost-' ELSE 'comp-' END, p_partkey) AS name, p_size AS version,
       CASE p_partkey % 4 WHEN 0 THEN concat('{"index":{"plugins":{"index_state_management":{"policy_id":"policy-', p_partkey, '"}}}}')
            WHEN 1 THEN concat('{"index.plugins.index_state_management.policy_id":"policy-', p_partkey, '"}')
            WHEN 2 THEN '{"index":{"number_of_shards":"1"}}' END AS settings
FROM part"""

# Blank titles, titles that match nothing, searches and visualizations under names nobody refers to.
SQL["saved_objects"] = """
SELECT 'index-pattern' AS type, concat('ip-', p_partkey) AS id,
       CASE WHEN p_partkey % 12 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN concat('nolog-', p_partkey, '*')
            ELSE concat('logs-', p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '*' ELSE '' END) END AS title,
       CASE WHEN p_partkey % 9 = 0 THEN concat('when', p_partkey) WHEN p_partkey % 3 = 0 THEN concat('f', p_partkey) END AS time_field
FROM part
UNION ALL
SELECT 'search', concat(CASE WHEN s_suppkey % 8 = 7 THEN 'lost-' ELSE 'se-' END, s_suppkey), s_name, NULL FROM supplier
UNION ALL
SELECT 'visualization', concat(CASE WHEN o_orderkey % 17 = 0 THEN 'lost-' ELSE 'vis-' END, o_orderkey), concat('Vis ', o_orderkey), NULL FROM orders
UNION ALL
SELECT 'dashboard', concat('dash-', c_custkey), c_name, NULL FROM customer"""

# Targets of every kind, some of them missing; every 50th dashboard has no reference at all.
# Some visualizations name their search first, some their pattern; a tag is no target anybody loads.
_VIS = "concat(CASE WHEN o_orderkey % 17 = 0 THEN 'lost-' ELSE 'vis-' END, o_orderkey)"
SQL["object_references"] = f"""
SELECT CASE WHEN o_custkey % 50 = 0 THEN 'canvas' ELSE 'dashboard' END AS src_type, concat('dash-', o_custkey) AS src_id,
       concat('Customer ', o_custkey) AS src_title, o_orderkey AS pos,
       CASE WHEN o_orderkey % 61 = 0 THEN 'map' ELSE 'visualization' END AS ref_type, concat('vis-', o_orderkey) AS ref_id FROM orders
UNION ALL
SELECT 'visualization', {_VIS}, concat('Vis ', o_orderkey), o_orderkey % 2, CASE WHEN o_orderkey % 3 = 0 THEN 'tag' ELSE 'index-pattern' END,
       concat(CASE WHEN o_orderkey % 11 = 0 THEN 'none-' ELSE 'ip-' END, o_custkey) FROM orders
UNION ALL
SELECT 'visualization', {_VIS}, concat('Vis ', o_orderkey), 1 - o_orderkey % 2, CASE WHEN o_orderkey % 3 = 2 THEN 'tag' ELSE 'search' END,
       concat('se-', o_custkey) FROM orders
UNION ALL
SELECT 'search', concat(CASE WHEN s_suppkey % 8 = 7 THEN 'lost-' ELSE 'se-' END, s_suppkey), s_name, 0, 'index-pattern',
       concat(CASE WHEN s_suppkey % 13 = 0 THEN 'none-' ELSE 'ip-' END, s_suppkey) FROM supplier"""

# Field reads; some not in the mapping, some exempt.
SQL["object_fields"] = """
SELECT 'visualization' AS type, concat('vis-', l_orderkey) AS id,
       CASE WHEN l_partkey % 29 = 0 THEN '*' WHEN l_partkey % 31 = 0 THEN '_id' ELSE concat('f', l_partkey) END AS field,
       concat('agg "terms" (id: ', l_linenumber, ')') AS context
FROM lineitem"""

# Raw JSON text: NULL, malformed, trailing rubbish, unbalanced query, empty clauses, disabled filter, blank.
SQL["object_docs"] = """
SELECT 'visualization' AS type, concat(CASE WHEN o_orderkey % 17 = 0 THEN 'lost-' ELSE 'vis-' END, o_orderkey) AS id,
       concat('Vis ', o_orderkey) AS title,
       CASE o_orderkey % 9
            WHEN 0 THEN '{"query":{"query":"a AND (b","language":"kuery"},"filter":[]}'
            WHEN 1 THEN '{bad json'
            WHEN 2 THEN '{"query":{"query":"a","language":"kuery"},"filter":[{"meta":{"disabled":false,"key":"f1"},"query":{"match":{}}}]}'
            WHEN 3 THEN '{"filter":[{"meta":{"disabled":true,"key":"f2"},"query":{"match_phrase":{}}}]}'
            WHEN 4 THEN ''
            WHEN 5 THEN '{"query":{"query":")b(("},"filter":[{"query":{"match":{},"match_phrase":{}}},{"query":{"match":{"f1":"x"}}}]}'
            WHEN 6 THEN '{"query":{"query":"ok (fine)","language":"lucene"}}'
            WHEN 7 THEN '{"filter":[]} and more' END AS search_source_json
FROM orders"""

SQL["panels"] = """
SELECT concat('dash-', c_custkey) AS id,
       CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '[{' WHEN 3 THEN '[]' ELSE '[{"panelIndex":"1"}]' END AS panels_json,
       CASE WHEN c_custkey % 50 = 0 THEN 0 ELSE 1 END AS reference_count
FROM customer"""

# Names of every shape and patterns for every way of joining them.
SQL["shaped_patterns"] = """
SELECT CASE p_partkey % 10
            WHEN 0 THEN concat('Customer#', lpad(CAST(p_partkey AS VARCHAR(20)), 9, '0'))
            WHEN 1 THEN concat('Customer#0000', p_partkey % 100, '*')
            WHEN 2 THEN concat('*', p_partkey)
            WHEN 3 THEN concat('Customer*', p_partkey, '?')
            WHEN 4 THEN concat('*', p_partkey % 1000, '*')
            WHEN 5 THEN concat('?ustomer#00000', '[', p_partkey % 5, '-', p_partkey % 5 + 3, ']', p_partkey % 10, '*')
            WHEN 6 THEN concat('[!a-z]*#*', p_partkey)
            WHEN 7 THEN '??????????????????'
            WHEN 8 THEN concat('*[', p_partkey % 10, ']', '[!0-4]', p_partkey % 7)
            ELSE concat('customer#*', p_partkey) END AS pattern
FROM part"""
SQL["shaped_names"] = "SELECT c_name AS name FROM customer"

SQL["import_records"] = """
SELECT CASE doc_id % 4 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'visualization' WHEN 2 THEN 'search' ELSE 'dashboard' END AS type,
       concat('imp-', doc_id) AS id,
       CASE WHEN doc_id % 6 = 0 THEN '{}' ELSE concat('{"title":"', source, ' ', doc_id, '"}') END AS attributes
FROM documents"""
SQL["import_errors"] = """
SELECT CASE doc_id % 4 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'visualization' WHEN 2 THEN 'search' ELSE 'dashboard' END AS type,
       concat(CASE WHEN doc_id % 13 = 0 THEN 'imp-' ELSE 'other-' END, doc_id) AS id, 'conflict' AS error
FROM documents"""

# Two kinds of failure, text in mixed case; a second round for the unmanaged ones.
SQL["bulk_change"] = """
SELECT concat('req-', o_custkey) AS request_id, concat('idx-', o_orderkey) AS index_name, o_orderkey % 4 <> 0 AS updated,
       CASE WHEN o_orderkey % 8 = 0 THEN 'This index is NOT being managed' WHEN o_orderkey % 4 = 0 THEN 'index is closed' END AS reason
FROM orders"""
SQL["bulk_enrol"] = """
SELECT concat('req-', o_custkey) AS request_id, concat('idx-', o_orderkey) AS index_name, o_orderkey % 16 <> 0 AS updated,
       CASE WHEN o_orderkey % 16 = 0 THEN 'policy is locked' END AS reason
FROM orders"""

# A stored object version per part, and incoming ones of which the last per key counts; some have no number, or only such have the key.
SQL["stored_objects"] = """
SELECT 'search' AS type, concat('o-', p_partkey) AS id, p_name AS title FROM part"""
SQL["incoming_objects"] = """
SELECT CASE WHEN l_suppkey % 3 = 0 THEN 'visualization' ELSE 'search' END AS type, concat('o-', l_partkey * 2) AS id,
       concat('v', l_orderkey, '-', l_linenumber, '-', l_suppkey) AS title,
       CASE WHEN l_partkey % 5 <> 0 AND l_suppkey % 11 <> 0 THEN CAST(l_orderkey AS BIGINT) * 100000000 + CAST(l_linenumber AS BIGINT) * 10000000 + l_suppkey END AS ordinal
FROM lineitem"""

# ---------------------------------------------------------------------------
# Raw documents: one response body or document per row
# ---------------------------------------------------------------------------

SQL["explain_bodies"] = """
SELECT o_orderkey, concat('{"idx-', o_orderkey, '":{"policy_id":"policy-', o_custkey, '","index.plugins.index_state_management.policy_id":',
       CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE concat('"set-', o_custkey, '"') END,
       ',"policy_seq_no":', o_custkey % 3, ',"state":', CASE WHEN o_orderkey % 4 = 0 THEN '{}' ELSE '{"name":"hot"}' END,
       ',"step":{"name":"s","step_status":"completed","start_time":', 1700000000000 + o_orderkey, '},"action":{"name":"a","failed":',
       CASE WHEN o_orderkey % 5 = 0 THEN 'true' ELSE 'false' END, ',"consumed_retries":', o_orderkey % 4,
       '},"info":', CASE WHEN o_orderkey % 2 = 0 THEN '{"message":"m"}' ELSE '"as text"' END, '},"total_managed_indices":1}') AS value
FROM orders"""

SQL["managed_bodies"] = """
SELECT o_orderkey, concat('{"hits":{"hits":[{"_source":{"managed_index":{"index":"idx-', o_orderkey, '","policy_id":"policy-', o_custkey,
       '","policy_seq_no":', o_custkey % 3, ',"schedule":{"interval":{"period":', o_orderkey % 60, ',"unit":"Minutes"}}}}},{"_source":{"policy":{}}}]}}') AS value
FROM orders"""

SQL["task_bodies"] = """
SELECT event_id, concat('{"nodes":{"n', event_id, '":{"name":"node-', user_id, '","tasks":{"n:', event_id, '":{"action":"', event_type,
       '","running_time_in_nanos":', event_id * 1000003, '},"m:', event_id, '":{"action":"internal:x","parent_task_id":"n:', event_id, '"}}}}}') AS value
FROM events"""

SQL["page_bodies"] = """
SELECT c_custkey, concat('{"total":2,"saved_objects":[{"type":"dashboard","id":"d', c_custkey, '","attributes":{"title":"', c_name, '"},"references":[{"name":"r","type":"visualization","id":"v', c_custkey,
       '"}],', CASE c_custkey % 3 WHEN 0 THEN concat('"workspaces":["w', c_nationkey, '","default"]') WHEN 1 THEN '"namespaces":["default"]' ELSE concat('"workspaces":[],"namespaces":["n', c_nationkey, '"]') END,
       ',"updated_at":"2024-05-06T07:08:09Z"},{"type":"search","id":"s', c_custkey, '"}]}') AS value
FROM customer"""

SQL["raw_documents"] = """
SELECT concat(CASE o_orderkey % 4 WHEN 0 THEN 'dashboard:' WHEN 1 THEN 'search:' WHEN 2 THEN 'config:' ELSE '' END, 'a:', o_orderkey) AS _id,
       concat('{"type":"', CASE o_orderkey % 4 WHEN 0 THEN 'dashboard' WHEN 1 THEN 'search' WHEN 2 THEN 'config' ELSE 'search' END,
       '","dashboard":{"title":"D', o_orderkey, '"},"search":', CASE WHEN o_orderkey % 5 = 0 THEN '"broken"' ELSE '{"title":""}' END,
       CASE WHEN o_orderkey % 3 = 0 THEN ',"namespace":"default"' WHEN o_orderkey % 3 = 1 THEN concat(',"namespace":"w', o_custkey, '"') ELSE '' END,
       ',"references":[{"name":"x","type":"search","id":"s1"}]}') AS _source
FROM orders"""

SQL["export_lines"] = """
SELECT CASE doc_id % 10 WHEN 0 THEN '   ' WHEN 1 THEN concat('{"_index_pattern_map":{"ip-', doc_id, '":"t"}}')
            ELSE concat('{"id":"x', doc_id, '","type":"', source, '","attributes":{"title":"', lang, '"},"references":[]}') END AS value
FROM documents"""

SQL["mapping_docs"] = """
SELECT concat('idx-', o_orderkey) AS index_name,
       concat('{"a', o_custkey, '":{"type":"text","fields":{"raw":{"type":"keyword"},"len":1}},"o":{"properties":{"x":{"type":"long"},"deep":{"properties":{"z', o_custkey % 7,
       '":{"type":"date","fields":{"kw":{}}}}}}},"odd":', CASE WHEN o_custkey % 2 = 0 THEN '3' ELSE '{}' END, '}') AS properties
FROM orders"""

SQL["agg_docs"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       concat('{"field":"f', l_partkey, '","aggs":[{"terms":{"field":"f', l_suppkey, '"}},{"field":{"field":"g', l_linenumber, '"}},{"field":', l_linenumber, '},[{"field":"h"}]]}') AS doc
FROM lineitem"""

# Attributes with every place a field can be read from; half hold their state as text.
# "~" stands for a backslash until the end, since the engines read those differently.
_STATE = """concat('{"type":"histogram","aggs":[{"id":"', o_orderkey % 5, '","type":"terms","params":{"field":"f', o_custkey,
       '","json":"{~"a~":{~"field~":~"j', o_custkey, '~"}}"}},{"id":2,"params":{}},7],"params":{"field":"p', o_custkey,
       '","series":[{"metrics":[{"id":"m1","field":"v', o_custkey, '"},{"id":"m2","field":"m1"}],"terms_field":"t', o_custkey, '"},"odd"]}}')"""
SQL["attribute_docs"] = f"""
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'visualization' ELSE 'dashboard' END AS type, concat('obj-', o_orderkey) AS id,
       o_orderkey, o_custkey,
       replace(concat('{{"title":"T', o_orderkey, '","columns":["c', o_custkey, '",5],"visState":',
              CASE WHEN o_orderkey % 2 = 0 THEN {_STATE} ELSE concat('"', replace(replace({_STATE}, '~', '~~'), '"', '~"'), '"') END,
              ',"kibanaSavedObjectMeta":{{"searchSourceJSON":"{{~"query~":{{~"query~":~"x~",~"language~":~"kuery~"}},~"filter~":[{{~"meta~":{{~"key~":~"k', o_custkey,
              '~"}},~"query~":{{~"term~":{{~"q', o_custkey, '~":1}},~"match~":{{}}}}}}]}}"}}}}'), '~', chr(92)) AS attributes
FROM orders"""

SQL["pattern_docs"] = """
SELECT 'index-pattern' AS type, concat('ip-', p_partkey) AS id, concat('logs-', p_partkey) AS title,
       concat('{"title":"logs-', p_partkey, '","timeFieldName":"@', p_size, '","fields":"',
              CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '[{},{},3]' WHEN 2 THEN '{bad' ELSE '[]' END, '"}') AS attributes,
       concat('w', p_size % 3, ',', 'w', p_size % 5) AS spaces,
       CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE concat('2024-05-06T07:08:0', p_size % 10, '.5Z') END AS updated_at
FROM part"""

SQL["detector_docs"] = """
SELECT concat('det-', s_suppkey) AS id,
       CASE WHEN s_suppkey % 4 = 0 THEN '{"x":1}' ELSE concat('{"name":"', s_name, '","nation":', s_nationkey, '}') END AS detector
FROM supplier"""

SQL["workspace_bodies"] = """
SELECT s_suppkey, concat(CASE WHEN s_suppkey % 2 = 0 THEN '{"success":true,"result":{"workspaces":[' ELSE '{"result":[' END,
       '{"id":"w', s_suppkey, '","name":"', s_name, '"},{"id":"v', s_suppkey, '","description":"d"}',
       CASE WHEN s_suppkey % 2 = 0 THEN ']}}' ELSE ']}' END) AS value
FROM supplier"""

# Missing sizes, empty layers, hits without a source, templates without a name.
SQL["stats_bodies"] = """
SELECT concat('{"indices":{"idx-', o_orderkey, '":{"total":{"store":{"size_in_bytes":', o_orderkey * 7, '}}},"bare-', o_orderkey, '":{"total":{}}}}') AS value
FROM orders"""
SQL["settings_bodies"] = """
SELECT concat('{"defaults":{"a.', p_partkey, '":"', p_brand, '"},"transient":{},"persistent":{"a.', p_partkey, '":"2","b":"x"}}') AS value FROM part"""
SQL["stream_bodies"] = """
SELECT concat('{"data_streams":[{"name":"ds-', c_custkey, '","status":"GREEN","generation":', c_custkey % 9, ',"template":"t","indices":[{"index_name":".ds-', c_custkey,
       '-1"},{"index_name":".ds-', c_custkey, '-2"}]}]}') AS value
FROM customer"""
SQL["pending_bodies"] = """
SELECT concat('{"tasks":[{"insert_order":', event_id, ',"priority":"HIGH","time_in_queue_millis":', event_id * 3, ',"source":"', event_type, '"}]}') AS value FROM events"""
SQL["detector_bodies"] = """
SELECT concat('{"hits":{"hits":[{"_id":"det-', s_suppkey, '","_source":{"name":"', s_name, '"}},{"_id":"bare-', s_suppkey, '"}]}}') AS value FROM supplier"""
SQL["template_bodies"] = """
SELECT concat('{"index_templates":[{"name":"tpl-', p_partkey, '","index_template":{"index_patterns":["logs-', p_partkey, '*","b"],"composed_of":["c-', p_partkey,
       '"],"template":{"settings":{"index":{"plugins":{"index_state_management":{"policy_id":"p-', p_size, '"}}}},"mappings":{"dynamic":false}},"priority":', p_size, ',"_meta":{"owner":"o-', p_partkey % 9, '"}}},{"index_template":{"index_patterns":["x"]}}]}') AS value
FROM part"""
SQL["component_bodies"] = """
SELECT concat('{"component_templates":[{"name":"c-', p_partkey, '","component_template":{"version":', p_size,
       ',"template":{"settings":{"index.plugins.index_state_management.policy_id":"p-', p_size, '"},"aliases":{"a-', p_partkey, '":{}}}}}]}') AS value
FROM part"""

# One field alike everywhere, whose indices aren't listed, and one with two types.
SQL["caps_bodies"] = """
SELECT concat('ip-', p_partkey) AS id,
       concat('{"indices":["i-1","i-2","i-3"],"fields":{"one-', p_partkey, '":{"text":{"aggregatable":false,"searchable":true}},"two-', p_partkey,
       '":{"long":{"aggregatable":true,"searchable":true,"indices":["i-1"]},"keyword":{"aggregatable":true,"searchable":false,"indices":["i-2","i-3"]}}}}') AS value
FROM part"""

# A scripted field, a name that comes twice, a field that is gone.
SQL["cached_lists"] = """
SELECT concat('ip-', p_partkey) AS id,
       concat('[{"name":"s-', p_partkey, '","type":"number","count":3,"scripted":true,"script":"doc.', p_size, '","lang":"painless"},{"name":"one-', p_partkey,
       '","type":"old","count":2},{"name":"one-', p_partkey, '","type":"older","count":4},{"name":"gone-', p_partkey, '","count":1}]') AS fields
FROM part"""

# A list of which nothing is left.
SQL["bare_lists"] = """
SELECT concat('bare-', p_partkey) AS id, '[{"name":"gone","type":"string","count":1}]' AS fields FROM part"""

# Policies with keys that no table names, at every level.
SQL["policy_bodies"] = """
SELECT concat('{"_id":"policy-', c_custkey, '","_seq_no":', c_custkey % 5, ',"_primary_term":1,"policy":{"policy_id":"policy-', c_custkey, '","schema_version":', c_custkey % 20,
       ',"error_notification":{"channel":"ops"},"default_state":"hot","states":[{"name":"hot","note":"n', c_custkey % 8, '","actions":[{"retry":{"count":3},"rollover":{"min_size":"', c_custkey % 60,
       'gb"}}],"transitions":[{"state_name":"warm","x":', c_custkey % 7, ',"conditions":{"min_index_age":"1d"}}]},{"name":"warm","actions":[],"transitions":[]}],"ism_template":[{"index_patterns":["logs-',
       c_custkey, '*"],"priority":1,"owner":"team-', c_custkey % 4, '"}]}}') AS value
FROM customer"""

# Dashboards with damaged panels or a missing visualization; visualizations that read a missing field
# or hold an unbalanced query; patterns that match nothing. "~" stands for a backslash.
SQL["validation_documents"] = """
SELECT concat('dashboard:d-', c_custkey) AS _id,
       concat('{"type":"dashboard","dashboard":{"title":"D', c_custkey, '","panelsJSON":"', CASE WHEN c_custkey % 5 = 0 THEN '[{' ELSE '[]' END,
       '"},"references":[{"name":"p","type":"visualization","id":"', CASE WHEN c_custkey % 7 = 0 THEN 'none-' ELSE 'v-' END, c_custkey, '"}]}') AS _source
FROM customer
UNION ALL
SELECT concat('visualization:v-', c_custkey),
       replace(concat('{"type":"visualization","visualization":{"title":"V', c_custkey, '","visState":{"type":"pie","aggs":[{"id":"1","type":"terms","params":{"field":"',
       CASE WHEN c_custkey % 3 = 0 THEN 'gone' ELSE 'a' END, '"}}]},"kibanaSavedObjectMeta":{"searchSourceJSON":"{~"query~":{~"query~":~"',
       CASE WHEN c_custkey % 11 = 0 THEN '(x' ELSE 'x' END, '~",~"language~":~"kuery~"}}"}},"references":[{"name":"i","type":"index-pattern","id":"ip-', c_custkey, '"}]}'), '~', chr(92))
FROM customer
UNION ALL
SELECT concat('index-pattern:ip-', c_custkey),
       concat('{"type":"index-pattern","index-pattern":{"title":"', CASE WHEN c_custkey % 4 = 0 THEN 'nope-' ELSE 'idx-' END, c_custkey, '"},"references":[]}')
FROM customer"""
SQL["mapping_bodies"] = """
SELECT concat('{"idx-', c_custkey, '":{"mappings":{"properties":{"a":{"type":"keyword"}}}}}') AS value FROM customer"""

# ---------------------------------------------------------------------------
# Policies with content, for edits
# ---------------------------------------------------------------------------

SQL["policy_docs"] = """
SELECT concat('policy-', c_custkey) AS policy_id, c_custkey % 5 AS seq_no,
       concat('{"min_size":"', c_custkey % 60, 'gb","min_doc_count":', c_custkey, '}') AS rollover,
       concat('{"min_index_age":"', c_custkey % 30, 'd"}') AS age_condition,
       CASE c_custkey % 6 WHEN 0 THEN 'cold' ELSE 'hot' END AS first_state,
       CASE WHEN c_custkey % 7 = 0 THEN '' ELSE concat('logs-', c_custkey, '*,app-', c_custkey % 10) END AS claims
FROM customer"""
SQL["policy_edits"] = """
SELECT concat('policy-', CASE WHEN s_suppkey % 10 = 0 THEN -1 - s_suppkey ELSE s_suppkey END) AS policy_id,
       CASE WHEN s_suppkey % 9 = 0 THEN 77 ELSE s_suppkey % 5 END AS expected_seq_no,
       CASE s_suppkey % 4 WHEN 0 THEN concat('{"min_size":"', s_suppkey % 60, 'gb"}') WHEN 1 THEN '{"min_size":"none","min_index_age":"1d"}'
            WHEN 2 THEN '{"min_doc_count":5}' ELSE '{"min_size":null}' END AS conditions,
       CASE s_suppkey % 3 WHEN 0 THEN '{"min_index_age":"99d"}' WHEN 1 THEN '{"min_index_age":"NONE"}' ELSE '{"min_size":"10gb"}' END AS move,
       CASE WHEN s_suppkey % 2 = 0 THEN 'first' ELSE 'last' END AS position,
       s_suppkey AS k
FROM supplier"""


def tables_in(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\bFROM {t}\b", sql)]


def adapter(spark: SparkSession, name: str, views: dict[str, str]) -> DataFrame:
    """The adapter over views of its tables; ``views`` maps table names to view names."""
    return spark.sql(re.sub(rf"\bFROM ({'|'.join(TABLES)})\b", lambda m: f"FROM {views[m.group(1)]}", SQL[name]))


def with_adapters(names: tuple[str, ...], query: str) -> str:
    """A check query with its adapters as leading CTEs; ``query`` may go on with ", more AS (...)"."""
    ctes = ",\n".join(f"{name} AS ({SQL[name]})" for name in names)
    if not ctes:
        return query
    return f"WITH {ctes}\n{query}"
