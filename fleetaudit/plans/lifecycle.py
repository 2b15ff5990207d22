"""Queries on policies, settings, templates and tasks."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import scalars as S
from fleetaudit.operators import lifecycle as L
from fleetaudit.operators import tasks as K
from fleetaudit.operators import templates as P
from fleetaudit.plans.adapters import AS_OF_MS
from fleetaudit.plans.registry import Inputs, query
from fleetaudit.sources import readers


def explain_table(inputs: Inputs) -> DataFrame:
    """The flat adapter as the nested table that ``readers.explain_rows`` gives."""
    return inputs("index_explain").select(
        "index_name",
        "policy_id_setting",
        "policy_id",
        "policy_seq_no",
        F.when(F.col("state_name").isNotNull(), F.struct(F.col("state_name").alias("name"))).alias("state"),
        F.struct(
            F.col("action_name").alias("name"), F.col("action_failed").alias("failed"), F.col("action_retries").alias("consumed_retries")
        ).alias("action"),
        F.struct(F.concat(F.lit("attempt_"), "action_name").alias("name"), "step_status", "start_time").alias("step"),
        F.struct(F.col("retry_failed").alias("failed"), F.col("retry_retries").alias("consumed_retries")).alias("retry_info"),
        "info",
    )


def managed_table(inputs: Inputs) -> DataFrame:
    return inputs("managed_config").select(
        "index_name", "policy_id", "policy_seq_no", F.struct(F.struct("period", "unit").alias("interval")).alias("schedule")
    )


def sql_size(v: str) -> str:
    steps = " ".join(
        f"WHEN {v} / {1024.0**k} < 1024 THEN concat(format('{{:.1f}}', {v} / {1024.0**k}), '{unit}')"
        for k, unit in enumerate(("B", "KB", "MB", "GB", "TB"))
    )
    return f"CASE {steps} ELSE concat(format('{{:.1f}}', {v} / {1024.0**5}), 'PB') END"


def sql_duration(ms: str) -> str:
    s = f"({ms} // 1000)"
    return f"""CASE WHEN {ms} IS NULL THEN '-' WHEN {ms} < 1000 THEN concat({ms}, 'ms')
        WHEN {ms} < 60000 THEN concat(format('{{:.1f}}', {ms} / 1000.0), 's')
        WHEN {s} < 3600 THEN concat({s} // 60, 'm', {s} % 60, 's')
        WHEN {s} < 86400 THEN concat({s} // 3600, 'h', ({s} // 60) % 60, 'm')
        ELSE concat({s} // 86400, 'd', ({s} // 3600) % 24, 'h') END"""


EXPLAIN = ", x AS (SELECT *, COALESCE(NULLIF(policy_id_setting, ''), policy_id) AS pol FROM index_explain)"

# ---------------------------------------------------------------------------
# Versions
# ---------------------------------------------------------------------------

VERSIONS = (
    EXPLAIN
    + """, v AS (
SELECT x.index_name AS index, NULLIF(pol, '') AS policy, CASE WHEN pol <> '' THEN policy_seq_no END AS index_seq_no, c.seq_no AS current_seq_no,
       COALESCE(pol <> '', false) AND policy_seq_no IS NOT NULL AND state_name IS NOT NULL AS enrolled,
       COALESCE(pol, '') = '' AS orphan, CASE WHEN pol <> '' THEN state_name END AS state, CASE WHEN pol <> '' THEN step_status END AS step_status
FROM x LEFT JOIN policy_current c ON c.policy_id = x.pol
WHERE pol <> '' OR NOT (starts_with(index_name, '.opendistro') OR starts_with(index_name, '.kibana') OR starts_with(index_name, '.opensearch') OR starts_with(index_name, '.plugins'))),
w AS (SELECT *, enrolled AND current_seq_no IS NOT NULL AND index_seq_no <> current_seq_no AS drift FROM v),
r AS (SELECT *, CASE WHEN orphan THEN 0 WHEN NOT enrolled THEN 1 WHEN drift THEN 2 ELSE 3 END AS rk FROM w)
"""
)
_VERSION_INPUTS = ("index_explain", "policy_current")


def _versions(inputs: Inputs) -> DataFrame:
    return L.policy_version(explain_table(inputs), inputs("policy_current"), include_orphans=True)


@query("policy_drift", _VERSION_INPUTS, VERSIONS + """
SELECT index, policy, index_seq_no, current_seq_no, drift, enrolled, orphan, state, step_status FROM r ORDER BY rk, index""")
def policy_drift(inputs):
    return L.attention_first(_versions(inputs))


@query("policy_drift_summary", _VERSION_INPUTS, VERSIONS + """
SELECT CASE rk WHEN 0 THEN 'orphan' WHEN 1 THEN 'not enrolled' WHEN 2 THEN 'drifted' ELSE 'in sync' END AS version_class, COUNT(*) AS indices
FROM r GROUP BY rk""")
def policy_drift_summary(inputs):
    return L.version_counts(_versions(inputs))


@query("needs_attention", _VERSION_INPUTS, VERSIONS + "SELECT COALESCE(BOOL_OR(rk < 3), false) AS needs_attention FROM r")
def needs_attention(inputs):
    return L.needs_attention(_versions(inputs))


@query("managed_policy_versions", _VERSION_INPUTS, VERSIONS + """
SELECT index, policy, index_seq_no, current_seq_no, drift, enrolled, orphan, state, step_status FROM r WHERE NOT orphan""")
def managed_policy_versions(inputs):
    return L.policy_version(explain_table(inputs), inputs("policy_current"))


@query("policy_lookup", ("policy_docs",), "SELECT policy_id, seq_no, first_state FROM policy_docs WHERE policy_id = 'policy-7'")
def policy_lookup(inputs):
    return readers.policy_named(inputs("policy_docs"), "policy-7").select("policy_id", "seq_no", "first_state")


# ---------------------------------------------------------------------------
# Sizes
# ---------------------------------------------------------------------------

SIZES = (
    EXPLAIN
    + """, s AS (SELECT index_name AS index, COALESCE(size_in_bytes, 0) AS size_bytes, pol, CASE WHEN pol <> '' THEN pol ELSE 'unmanaged' END AS policy,
    CASE WHEN pol <> '' THEN COALESCE(state_name, '-') ELSE '-' END AS state FROM x LEFT JOIN index_stats USING (index_name))
"""
)


@query("index_sizes", ("index_explain", "index_stats"), SIZES + f"""
SELECT index, {sql_size('size_bytes')} AS size, size_bytes, policy, state FROM s ORDER BY size_bytes DESC, index""")
def index_sizes(inputs):
    return L.largest_first(L.list_indices(explain_table(inputs), inputs("index_stats"), show_all=True))


@query("managed_index_sizes", ("index_explain", "index_stats"), SIZES + f"""
SELECT index, {sql_size('size_bytes')} AS size, size_bytes, policy, state FROM s WHERE pol IS NOT NULL""")
def managed_index_sizes(inputs):
    return L.list_indices(explain_table(inputs), inputs("index_stats"))


# ---------------------------------------------------------------------------
# Status
# ---------------------------------------------------------------------------

STATUS = (
    EXPLAIN
    + f""", y AS (SELECT *, action_failed OR retry_failed AS failed, CASE WHEN COALESCE(step_status, '') = '' THEN 'unknown' ELSE lower(step_status) END AS st,
    CASE WHEN info LIKE '{{%' THEN COALESCE(NULLIF(json_extract_string(info, '$.cause'), ''), json_extract_string(info, '$.message'), '') ELSE COALESCE(info, '') END AS msg
    FROM x WHERE pol <> ''),
z AS (SELECT index_name AS index, pol AS policy, state_name AS state, action_name AS action, concat('attempt_', action_name) AS step,
    CASE WHEN failed AND st NOT IN ('failed', 'retrying') THEN 'failed' ELSE st END AS step_status,
    CAST(COALESCE(NULLIF(action_retries, 0), NULLIF(retry_retries, 0), 0) AS INTEGER) AS retries,
    CASE WHEN COALESCE(start_time, 0) <> 0 THEN {sql_duration(f'({AS_OF_MS} - start_time)')} ELSE '-' END AS time_in_step,
    CASE WHEN trim(msg) <> '' THEN trim(msg) WHEN failed THEN '(see ISM history)' ELSE '' END AS error FROM y)
"""
)


@query("policy_status", ("index_explain",), STATUS + "SELECT * FROM z")
def policy_status(inputs):
    return L.failures_first(L.policy_status(explain_table(inputs), AS_OF_MS))


@query("policy_status_failed", ("index_explain",), STATUS + "SELECT * FROM z WHERE step_status IN ('failed', 'retrying')")
def policy_status_failed(inputs):
    return L.failures_first(L.policy_status(explain_table(inputs), AS_OF_MS, failed_only=True))


@query("policy_status_filtered", ("index_explain",), STATUS + "SELECT * FROM z WHERE index GLOB 'idx-*[02468]' OR index GLOB '*kibana*'")
def policy_status_filtered(inputs):
    return L.policy_status(explain_table(inputs), AS_OF_MS, index_filter=["idx-*[02468]", "*kibana*"])


@query("policy_status_counts", ("index_explain",), STATUS + "SELECT step_status, COUNT(*) AS indices FROM z GROUP BY step_status")
def policy_status_counts(inputs):
    return L.status_counts(L.policy_status(explain_table(inputs), AS_OF_MS))


@query("policy_jobs", ("index_explain",), STATUS + """
SELECT * FROM z WHERE step_status IN ('running', 'in_progress', 'starting', 'retrying', 'failed', 'condition_not_met')""")
def policy_jobs(inputs):
    return L.failures_first(L.policy_jobs(explain_table(inputs), AS_OF_MS))


# ---------------------------------------------------------------------------
# Settings, schedules, bulk outcomes
# ---------------------------------------------------------------------------


@query("effective_settings", ("settings_layers",), """, l AS (
SELECT *, CASE source WHEN 'defaults' THEN 0 WHEN 'transient' THEN 1 WHEN 'persistent' THEN 2 END AS layer FROM settings_layers)
SELECT setting, arg_max(value, layer) AS value, arg_max(source, layer) AS source FROM l
WHERE layer IS NOT NULL AND starts_with(setting, 'plugins.index_state_management.') GROUP BY setting ORDER BY setting""")
def effective_settings(inputs):
    return L.effective_settings(inputs("settings_layers")).orderBy("setting")


SCHEDULE = "SELECT index_name AS index, policy_id AS policy, period AS interval, unit, policy_seq_no FROM managed_config"


@query("schedules", ("managed_config",), SCHEDULE + " ORDER BY COALESCE(period, 0), index_name")
def schedules(inputs):
    return L.shortest_interval_first(L.schedules(managed_table(inputs)))


@query("schedules_filtered", ("managed_config",), SCHEDULE + " WHERE index_name GLOB 'idx-?[!3-6]*7'")
def schedules_filtered(inputs):
    return L.schedules(managed_table(inputs), "idx-?[!3-6]*7")


@query("interval_distribution", ("managed_config",), """
SELECT period AS interval, unit, COUNT(*) AS indices FROM managed_config GROUP BY 1, 2 ORDER BY indices DESC""")
def interval_distribution(inputs):
    return L.interval_distribution(L.schedules(managed_table(inputs))).orderBy(F.desc("indices"))


BULK = """, f AS (SELECT *, lower(COALESCE(reason, '')) LIKE '%not being managed%' AND NOT updated AS un FROM bulk_change),
o AS (SELECT request_id, index_name, updated, reason FROM f WHERE NOT un
  UNION ALL SELECT e.request_id, e.index_name, e.updated, e.reason FROM bulk_enrol e JOIN f USING (request_id, index_name) WHERE f.un)
"""


@query("bulk_outcome", ("bulk_change", "bulk_enrol"), BULK + """
SELECT request_id, COUNT(*) FILTER (WHERE updated) AS updated_indices, COUNT(*) FILTER (WHERE NOT updated) AS failed_indices FROM o GROUP BY 1""")
def bulk_outcome(inputs):
    return L.bulk_outcome(inputs("bulk_change"), inputs("bulk_enrol"))


@query("bulk_failures", ("bulk_change", "bulk_enrol"), BULK + "SELECT request_id, index_name, reason FROM o WHERE NOT updated")
def bulk_failures(inputs):
    return L.bulk_failures(inputs("bulk_change"), inputs("bulk_enrol"))


# ---------------------------------------------------------------------------
# Templates and data streams
# ---------------------------------------------------------------------------

NESTED = "$.index.plugins.index_state_management.policy_id"
DOTTED = '$."index.plugins.index_state_management.policy_id"'
SETTINGS_POLICY = f"COALESCE(NULLIF(json_extract_string(settings, '{NESTED}'), ''), json_extract_string(settings, '{DOTTED}'))"
COMPONENTS = f", comp AS (SELECT name, {SETTINGS_POLICY} AS policy_id, version FROM component_templates)"


@query("component_templates", ("component_templates",), COMPONENTS + "SELECT name, policy_id, version FROM comp ORDER BY name")
def component_templates(inputs):
    return P.by_name(P.list_component_templates(inputs("component_templates")))


@query("template_policy", ("template_inline", "template_components", "component_templates"), COMPONENTS + """,
last AS (SELECT m.name, arg_max(c.name, m.pos) AS component, arg_max(c.policy_id, m.pos) AS inherited
  FROM template_components m JOIN comp c ON c.name = m.component WHERE c.policy_id <> '' GROUP BY m.name)
SELECT t.name, t.index_pattern, COALESCE(NULLIF(inline_policy, ''), inherited) AS policy_id,
  CASE WHEN inline_policy <> '' THEN 'inline' WHEN component IS NOT NULL THEN 'via ' || component END AS source
FROM template_inline t LEFT JOIN last USING (name)""")
def template_policy(inputs):
    inherited = P.inherited_policies(
        inputs("template_components"), P.list_component_templates(inputs("component_templates"))
    )
    return P.resolve_template_policies(inputs("template_inline"), inherited)


def index_template_table(inputs: Inputs) -> DataFrame:
    def items(c: str):
        return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, ","))

    return inputs("index_templates").select(
        "name", items("index_patterns").alias("index_patterns"), items("composed_of").alias("composed_of"), "settings"
    )


@query("index_templates", ("index_templates", "component_templates"), COMPONENTS + f""",
t AS (SELECT *, {SETTINGS_POLICY} AS inl FROM index_templates),
m AS (SELECT name, unnest(string_split(composed_of, ',')) AS component, generate_subscripts(string_split(composed_of, ','), 1) AS pos FROM t),
last AS (SELECT m.name, arg_max(c.name, m.pos) AS component, arg_max(c.policy_id, m.pos) AS inherited
  FROM m JOIN comp c ON c.name = m.component WHERE c.policy_id <> '' GROUP BY m.name)
SELECT t.name, index_patterns, COALESCE(NULLIF(inl, ''), inherited) AS policy_id,
  CASE WHEN inl <> '' THEN 'inline' WHEN component IS NOT NULL THEN 'via ' || component END AS source, composed_of
FROM t LEFT JOIN last USING (name) ORDER BY t.name""")
def index_templates(inputs):
    return P.by_name(P.list_index_templates(index_template_table(inputs), inputs("component_templates")))


@query("write_index", ("data_stream_indices",), """
SELECT name, COUNT(*) AS backing_count, arg_max(index_name, pos) AS write_index FROM data_stream_indices GROUP BY name""")
def write_index(inputs):
    return P.write_indices(inputs("data_stream_indices"))


def stream_table(inputs: Inputs) -> DataFrame:
    names = F.when(F.col("backing") == "", F.array().cast("array<string>")).otherwise(F.split("backing", ","))
    return inputs("data_streams").withColumn("indices", F.transform(names, lambda n: F.struct(n.alias("index_name")))).drop("backing")


@query("data_streams", ("data_streams",), """
SELECT name, status, generation, template, CASE WHEN backing = '' THEN 0 ELSE len(string_split(backing, ',')) END AS backing_count,
  CASE WHEN backing <> '' THEN string_split(backing, ',')[-1] END AS write_index FROM data_streams ORDER BY name""")
def data_streams(inputs):
    return P.by_name(P.list_data_streams(stream_table(inputs)))


# ---------------------------------------------------------------------------
# Tasks
# ---------------------------------------------------------------------------

TASKS = f""", r AS (SELECT *, COALESCE(running_time_in_nanos, 0) // 1000000 AS ms FROM tasks),
report AS (SELECT task_id, node, action, {sql_duration('ms')} AS running_time, ms AS running_ms, parent_task_id AS parent_task,
  CASE WHEN length(description) > 80 THEN concat(substring(description, 1, 77), '...') ELSE COALESCE(description, '') END AS description FROM r)
"""


@query("running_tasks", ("tasks",), TASKS + """
SELECT * FROM report WHERE NOT (starts_with(action, 'cluster:monitor/') OR starts_with(action, 'indices:monitor/') OR starts_with(action, 'internal:'))""")
def running_tasks(inputs):
    return K.longest_running_first(K.running_tasks(inputs("tasks")))


@query("running_tasks_filtered", ("tasks",), TASKS + "SELECT * FROM report WHERE contains(action, 'monitor')")
def running_tasks_filtered(inputs):
    return K.running_tasks(inputs("tasks"), show_all=True, action_filter="monitor")


@query("pending_tasks", ("pending_tasks",), f"""
SELECT insert_order, priority, CASE WHEN time_in_queue <> '' THEN time_in_queue ELSE {sql_duration('time_in_queue_millis')} END AS time_in_queue,
  time_in_queue_millis AS queue_ms, CASE WHEN length(source) > 90 THEN concat(substring(source, 1, 87), '...') ELSE source END AS source
FROM pending_tasks""")
def pending_tasks(inputs):
    return K.longest_waiting_first(K.pending_tasks(inputs("pending_tasks")))


# ---------------------------------------------------------------------------
# Text helpers over whole tables
# ---------------------------------------------------------------------------

_BIG = "CAST(l_orderkey AS BIGINT) * l_partkey * l_partkey * 1021 + l_suppkey"
_MS = "CAST(l_orderkey AS BIGINT) * l_partkey + l_linenumber * 137"


@query("number_texts", (), f"""
SELECT l_orderkey, l_linenumber, {sql_size(f'({_BIG})')} AS size, {sql_duration(f'({_MS})')} AS duration FROM lineitem""")
def number_texts(inputs):
    numbers = inputs.table("lineitem").select("l_orderkey", "l_linenumber", _big().alias("big"), F.expr(_MS).alias("ms"))
    return numbers.select("l_orderkey", "l_linenumber", S.size_text(F.col("big")).alias("size"), S.duration_text(F.col("ms")).alias("duration"))


def _big() -> Column:
    """``_BIG`` as a double: worked out in 64 bits, where those overflow in 38 digits, and beyond them in doubles.

    Doubles tell beforehand which it takes; an overflow that is caught costs far more than the number.
    """

    def product(kind: str) -> Column:
        return reduce(lambda a, b: a * b, [f.cast(kind) for f in (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_partkey"), F.lit(1021))])

    def worked_out(kind: str) -> Column:
        return (product(kind) + F.col("l_suppkey").cast(kind)).cast("double")

    most = F.abs(product("double")) + F.abs(F.col("l_suppkey").cast("double"))
    return F.when(most < 2.0**62, worked_out("bigint")).when(most < 1e37, worked_out("decimal(38,0)")).otherwise(worked_out("double"))


@query("plain_texts", (), """
SELECT doc_id, COALESCE(NULLIF(CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END, ''), '-') AS shown,
  (length(text) - length(replace(text, '(', ''))) = (length(text) - length(replace(text, ')', ''))) AS balanced,
  CASE WHEN strpos(source, '.') > 0 THEN regexp_extract(source, '^(.*)\\.[^.]*$', 1) END AS parent,
  CASE WHEN doc_id % 2 = 0 THEN 'None' WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(n_chars AS VARCHAR) END AS doc_count,
  concat('2024-01-0', doc_id % 10, ' 07:08') AS minute
FROM documents""")
def plain_texts(inputs):
    count = F.expr("CASE WHEN doc_id % 2 = 0 THEN 'None' WHEN doc_id % 5 = 0 THEN 'many' ELSE CAST(n_chars AS STRING) END")
    stamp = F.expr("concat('2024-01-0', doc_id % 10, 'T07:08:09.100Z')")
    return inputs.table("documents").select(
        "doc_id",
        S.dash_if_blank(F.expr("CASE WHEN doc_id % 3 = 0 THEN '' ELSE source END")).alias("shown"),
        S.parens_balanced(F.col("text")).alias("balanced"),
        S.parent_path(F.col("source")).alias("parent"),
        S.document_count(count).alias("doc_count"),
        S.minute_stamp(stamp).alias("minute"),
    )
