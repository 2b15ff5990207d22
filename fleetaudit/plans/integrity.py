"""Queries that check dashboards and everything they refer to."""


from fleetaudit.operators import references as R
from fleetaudit.plans.fields import NAMES, behind, mapped, names, paths, patterns
from fleetaudit.plans.registry import query

ALL = ("saved_objects", "object_references", "field_caps", "object_fields", "object_docs", "panels")

EDGES = """, fst AS (SELECT src_id, arg_min(ref_id, pos) AS inh FROM object_references WHERE src_type = 'search' AND ref_type = 'index-pattern' GROUP BY 1),
res AS (SELECT r.*, t.id IS NOT NULL AS found, CASE WHEN r.ref_type = 'index-pattern' THEN r.ref_id ELSE fst.inh END AS offers
  FROM object_references r LEFT JOIN saved_objects t ON t.type = r.ref_type AND t.id = r.ref_id
  LEFT JOIN fst ON r.ref_type = 'search' AND fst.src_id = r.ref_id),
br AS (SELECT src_type, src_id, src_title, pos, ref_type, ref_id FROM res WHERE NOT found
  AND (src_type = 'dashboard' OR (src_type IN ('visualization', 'search') AND ref_type IN ('index-pattern', 'search')))),
used AS (SELECT src_type AS type, src_id AS id, max(src_title) AS title, arg_min(offers, pos) AS pattern_id FROM res
  WHERE src_type IN ('visualization', 'search') AND ref_type IN ('index-pattern', 'search') AND found AND offers <> '' GROUP BY 1, 2)
"""
LABEL = "concat(upper(left(o.type, 1)), substring(o.type, 2), ' ''', o.title, ''' (id: ', o.id, ')')"
CHILDREN = NAMES + EDGES + """, ch AS (SELECT o.type, o.id, o.title, ip.title AS pattern_title
  FROM saved_objects o JOIN used ON used.type = o.type AND used.id = o.id JOIN ip ON ip.id = used.pattern_id),
mf AS (SELECT ch.type, ch.id, ch.title, ch.pattern_title, r.field, r.context FROM object_fields r JOIN ch USING (type, id)
  WHERE left(r.field, 1) <> '_' AND r.field <> '*' AND ch.pattern_title IN (SELECT title FROM pf)
  AND NOT EXISTS (SELECT 1 FROM pf WHERE pf.title = ch.pattern_title AND pf.field = r.field))
"""
SOURCES = f""", dv AS (SELECT *, CASE WHEN json_valid(search_source_json) THEN search_source_json END AS doc FROM object_docs WHERE trim(search_source_json) <> ''),
fl AS (SELECT o.*, j.value AS f FROM dv o, json_each(json_extract(o.doc, '$.filter')) j),
ssi AS (
SELECT o.type, o.id, 'error' AS level, 'invalid-query' AS "check", concat({LABEL}, ': searchSourceJSON is malformed') AS message FROM dv o WHERE doc IS NULL
UNION ALL
SELECT o.type, o.id, 'warning', 'invalid-query', concat({LABEL}, ': query has mismatched parentheses (', COALESCE(json_extract_string(doc, '$.query.language'), '?'), '): ''', json_extract_string(doc, '$.query.query'), '''')
FROM dv o WHERE length(replace(json_extract_string(doc, '$.query.query'), '(', '')) <> length(replace(json_extract_string(doc, '$.query.query'), ')', ''))
UNION ALL
SELECT o.type, o.id, 'warning', 'invalid-query', concat({LABEL}, ': filter has an empty ', c.clause, ' clause')
FROM fl o, (VALUES ('match'), ('match_phrase')) c(clause)
WHERE COALESCE(json_extract_string(o.f, '$.meta.disabled'), 'false') <> 'true' AND CAST(json_extract(o.f, '$.query.' || c.clause) AS VARCHAR) = '{{}}')
"""
ISSUES = CHILDREN + SOURCES + f""", ci AS (
SELECT o.type, o.id, 'error' AS level, 'broken-reference' AS "check", concat({LABEL}, ' references missing ', CASE WHEN br.ref_type = 'search' THEN 'search' ELSE 'index pattern' END, ' ''', br.ref_id, '''') AS message
FROM br JOIN saved_objects o ON o.type = br.src_type AND o.id = br.src_id WHERE br.src_type <> 'dashboard'
UNION ALL
SELECT o.type, o.id, 'error', 'missing-index', concat({LABEL}, ' uses index pattern ''', pattern_title, ''' with no matching indices') FROM ch o WHERE pattern_title NOT IN (SELECT title FROM hit)
UNION ALL
SELECT o.type, o.id, 'error', 'missing-field', concat({LABEL}, ' references field ''', field, ''' not found in ''', pattern_title, ''' [', context, ']') FROM mf o
UNION ALL
SELECT * FROM ssi),
pn AS (SELECT id, 'error' AS level, 'invalid-json' AS "check", 'Dashboard panelsJSON is malformed' AS message FROM panels WHERE NOT json_valid(panels_json)
UNION ALL SELECT id, 'warning', 'empty-dashboard', 'Dashboard has no panels or references' FROM panels WHERE reference_count = 0 AND COALESCE(panels_json, '') = ''),
di AS (
SELECT src_id AS id, 'error' AS level, 'broken-reference' AS "check", concat('Referenced ', ref_type, ' ''', ref_id, ''' not found') AS message FROM br WHERE src_type = 'dashboard'
UNION ALL SELECT * FROM pn
UNION ALL SELECT r.src_id, ci.level, ci."check", ci.message FROM res r JOIN ci ON ci.type = r.ref_type AND ci.id = r.ref_id WHERE r.src_type = 'dashboard'),
gi AS (
SELECT id AS pattern_id, 'error' AS level, 'missing-index' AS "check", CASE WHEN title = '' THEN concat('Index pattern ''', id, ''' has no title')
  ELSE concat('Index pattern ''', title, ''' (id: ', id, ') matches no index, alias, or data stream') END AS message FROM ip WHERE title NOT IN (SELECT title FROM hit)
UNION ALL
SELECT id, 'warning', 'missing-field', concat('Index pattern ''', title, ''': time field ''', time_field, ''' is not in the mapping') FROM ip
WHERE time_field <> '' AND title IN (SELECT title FROM pf) AND NOT EXISTS (SELECT 1 FROM pf WHERE pf.title = ip.title AND pf.field = ip.time_field)),
dr AS (SELECT o.id, o.title, COUNT(*) FILTER (WHERE di.level = 'error') AS errors, COUNT(*) FILTER (WHERE di.level = 'warning') AS warnings
  FROM saved_objects o LEFT JOIN di ON di.id = o.id WHERE o.type = 'dashboard' GROUP BY 1, 2),
ds AS (SELECT id, title, CASE WHEN errors > 0 THEN 'error' WHEN warnings > 0 THEN 'warning' ELSE 'ok' END AS status, errors, warnings FROM dr)
"""


def resolved(inputs):
    return R.resolved_edges(inputs("object_references"), inputs("saved_objects"))


def shared_resolved(inputs):
    return inputs.shared("resolved", lambda: resolved(inputs))


def shared_behind(inputs):
    return inputs.shared("behind", lambda: behind(inputs))


def child_findings(inputs):
    return R.child_issues(
        shared_resolved(inputs), patterns(inputs), names(inputs), mapped(inputs), paths(inputs), inputs("object_fields"), inputs("object_docs"),
        behind=shared_behind(inputs),
    )


def report(inputs):
    return R.dashboard_report(inputs("saved_objects"), shared_resolved(inputs), inputs("panels"), child_findings(inputs))


def whole_findings(inputs):
    return R.global_issues(patterns(inputs), names(inputs), mapped(inputs), paths(inputs), behind=shared_behind(inputs))


@query("broken_references", ("saved_objects", "object_references"), EDGES + "SELECT * FROM br")
def broken_references(inputs):
    return R.broken_references(resolved(inputs))


@query("broken_references_split", ("saved_objects", "object_references"), EDGES + "SELECT * FROM br")
def broken_references_split(inputs):
    """The same with references to much used objects dealt to several tasks."""
    return R.broken_references(R.resolved_edges(inputs("object_references"), inputs("saved_objects"), rows_per_part=1000))


@query("resolved_pattern", ("saved_objects", "object_references"), EDGES + "SELECT * FROM used")
def resolved_pattern(inputs):
    return R.resolved_patterns(resolved(inputs))


@query("missing_fields", ALL[:4], CHILDREN + "SELECT * FROM mf")
def missing_fields(inputs):
    return R.missing_fields(
        R.child_patterns(resolved(inputs), R.pattern_status(patterns(inputs), shared_behind(inputs))), inputs("object_fields"), shared_behind(inputs), paths(inputs)
    )


@query("invalid_search_source", ("object_docs",), SOURCES + "SELECT * FROM ssi")
def invalid_search_source(inputs):
    return R.search_source_issues(inputs("object_docs"))


@query("panel_issues", ("panels",), """
SELECT id, 'error' AS level, 'invalid-json' AS "check", 'Dashboard panelsJSON is malformed' AS message FROM panels WHERE NOT json_valid(panels_json)
UNION ALL SELECT id, 'warning', 'empty-dashboard', 'Dashboard has no panels or references' FROM panels WHERE reference_count = 0 AND COALESCE(panels_json, '') = ''""")
def panel_issues(inputs):
    return R.panel_issues(inputs("panels"))


@query("global_issues", ALL, ISSUES + "SELECT * FROM gi")
def global_issues(inputs):
    return whole_findings(inputs)


@query("child_issues", ALL, ISSUES + "SELECT * FROM ci")
def child_issues(inputs):
    return child_findings(inputs)


@query("dashboard_issues", ALL, ISSUES + "SELECT * FROM di")
def dashboard_issues(inputs):
    return R.dashboard_issues(shared_resolved(inputs), inputs("panels"), child_findings(inputs))


@query("dashboard_validation", ALL, ISSUES + "SELECT * FROM ds ORDER BY title")
def dashboard_validation(inputs):
    return report(inputs).orderBy("title", "id")


@query("validation_summary", ALL, ISSUES + """
SELECT COUNT(*) AS total_dashboards, COUNT(*) FILTER (WHERE status = 'ok') AS ok, COUNT(*) FILTER (WHERE status = 'warning') AS warnings,
  COUNT(*) FILTER (WHERE status = 'error') AS errors, (SELECT COUNT(*) FROM gi) AS global_issues FROM ds""")
def validation_summary(inputs):
    return R.validation_summary(report(inputs), whole_findings(inputs))
