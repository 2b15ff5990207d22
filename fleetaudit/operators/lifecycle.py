"""Which policy and state every index is in, how it executes, and whether it is current."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.functions import scalars as S
from fleetaudit.functions.globs import matches_any
from fleetaudit.operators.joins import split_join

Patterns = str | list[str] | tuple[str, ...]

# Statuses, prefixes, labels and ranks of the reports.
FAILED_STATUSES = ("failed", "retrying")
ACTIVE_STATUSES = ("running", "in_progress", "starting", "retrying", "failed", "condition_not_met")
STATUS_RANKS = {
    "failed": 0,
    "retrying": 1,
    "running": 2,
    "in_progress": 2,
    "starting": 3,
    "condition_not_met": 4,
    "completed": 5,
}
LAST_STATUS_RANK = 9
SYSTEM_PREFIXES = (".opendistro", ".kibana", ".opensearch", ".plugins")
SETTINGS_PREFIX = "plugins.index_state_management."
SETTINGS_LAYERS = ("defaults", "transient", "persistent")
VERSION_CLASSES = ("orphan", "not enrolled", "drifted", "in sync")
WHITESPACE = " \t\n\r\f\x0b"


def policy_of() -> Column:
    """Policy of an index: the dotted setting, else the plain key."""
    return S.first_present(F.col("policy_id_setting"), F.col("policy_id"))


def _named(df: DataFrame, column: str, patterns: Patterns | None) -> DataFrame:
    return df.filter(matches_any(F.col(column), patterns)) if patterns else df


# ---------------------------------------------------------------------------
# Sizes
# ---------------------------------------------------------------------------


def list_indices(explain: DataFrame, stats: DataFrame, show_all: bool = False, scope: Sequence[str] = ()) -> DataFrame:
    """Policy, state and store size per index; an index without statistics has size 0."""
    policy = policy_of()
    managed = explain if show_all else explain.filter(policy.isNotNull())
    keys = [*scope, "index_name"]
    base = managed.select(
        *keys,
        F.coalesce(S.blank_to_null(policy), F.lit("unmanaged")).alias("policy"),
        F.when(S.is_present(policy), F.coalesce(F.col("state.name"), F.lit("-"))).otherwise("-").alias("state"),
    )
    size = F.coalesce(F.col("size_in_bytes"), F.lit(0)).cast("bigint")
    return base.join(stats.select(*keys, "size_in_bytes"), keys, "left").select(
        *scope,
        F.col("index_name").alias("index"),
        S.size_text(size).alias("size"),
        size.alias("size_bytes"),
        "policy",
        "state",
    )


def largest_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("size_bytes"), "index")


# ---------------------------------------------------------------------------
# Execution status
# ---------------------------------------------------------------------------


def policy_status(
    explain: DataFrame,
    as_of: int | Column | None = None,
    index_filter: Patterns | None = None,
    failed_only: bool = False,
    scope: Sequence[str] = (),
) -> DataFrame:
    """State, action and step of every managed index, and since when; ``as_of`` (epoch milliseconds) ends the time in step."""
    if as_of is None:
        as_of = F.unix_millis(F.current_timestamp())
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    policy = policy_of()

    failed = F.col("has_failed")
    reported = F.lower(S.first_present(F.col("step.step_status"), F.lit("unknown")))
    status = F.when(failed & ~reported.isin(*FAILED_STATUSES), "failed").otherwise(reported)

    # A JSON object holds the reason under one of two keys; anything else is the message itself.
    def reason(info: Column) -> Column:
        def entry(key: str) -> Column:
            return F.coalesce(J.as_text(info[key]), F.to_json(info[key]))

        return S.first_present(entry("cause"), entry("message"), F.lit(""))

    text = F.coalesce("info", F.lit(""))
    in_object = F.when(F.startswith(F.ltrim(text), F.lit("{")), J.let(J.object_from_text(text), lambda o: F.when(o.isNotNull(), reason(o))))
    message = F.btrim(F.coalesce(in_object, text), F.lit(WHITESPACE))
    start = F.col("step.start_time")

    managed = _named(explain, "index_name", index_filter).filter(S.is_present(policy))
    flags = {
        "has_failed": F.coalesce("action.failed", F.lit(False)) | F.coalesce("retry_info.failed", F.lit(False)),
        "message": message,
    }
    rows = managed.withColumns(flags).select(
        *scope,
        F.col("index_name").alias("index"),
        policy.alias("policy"),
        F.col("state.name").alias("state"),
        F.col("action.name").alias("action"),
        F.col("step.name").alias("step"),
        status.alias("step_status"),
        S.first_nonzero(F.col("action.consumed_retries"), F.col("retry_info.consumed_retries")).cast("int").alias("retries"),
        F.when(S.first_nonzero(start) != 0, S.duration_text(now - start)).otherwise("-").alias("time_in_step"),
        S.first_present(F.col("message"), F.when(failed, "(see ISM history)").otherwise("")).alias("error"),
    )
    return rows.filter(F.col("step_status").isin(*FAILED_STATUSES)) if failed_only else rows


def policy_jobs(explain: DataFrame, as_of: int | Column | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Indices whose policy is being acted on, retried or failing."""
    return policy_status(explain, as_of, scope=scope).filter(F.col("step_status").isin(*ACTIVE_STATUSES))


def status_rank(status: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in STATUS_RANKS.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, status), F.lit(LAST_STATUS_RANK))


def failures_first(report: DataFrame) -> DataFrame:
    return report.orderBy(status_rank(F.col("step_status")), "index")


def status_counts(report: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return report.groupBy(*scope, "step_status").agg(F.count("*").alias("indices"))


# ---------------------------------------------------------------------------
# Settings and schedules
# ---------------------------------------------------------------------------


def effective_settings(
    layers: DataFrame,
    prefix: str = SETTINGS_PREFIX,
    order: Sequence[str] = SETTINGS_LAYERS,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Value of every setting from the highest layer that holds it; later layers win."""
    rank = F.array_position(F.array(*[F.lit(layer) for layer in order]), F.col("source"))
    return (
        layers.filter(F.startswith("setting", F.lit(prefix)) & F.col("source").isin(*order))
        .groupBy(*scope, "setting")
        .agg(F.max_by(F.struct("value", "source"), rank).alias("top"))
        .select(*scope, "setting", "top.value", "top.source")
    )


def schedules(managed: DataFrame, index_filter: Patterns | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Tick interval fixed into every managed index when it was enrolled."""
    return _named(managed, "index_name", index_filter).select(
        *scope,
        F.col("index_name").alias("index"),
        F.col("policy_id").alias("policy"),
        F.col("schedule.interval.period").alias("interval"),
        F.col("schedule.interval.unit").alias("unit"),
        "policy_seq_no",
    )


def shortest_interval_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.coalesce("interval", F.lit(0)), F.coalesce("index", F.lit("")))


def interval_distribution(report: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return report.groupBy(*scope, "interval", "unit").agg(F.count("*").alias("indices"))


# ---------------------------------------------------------------------------
# Policy versions
# ---------------------------------------------------------------------------


def policy_version(
    explain: DataFrame,
    policies: DataFrame,
    index_filter: Patterns | None = None,
    include_orphans: bool = False,
    scope: Sequence[str] = (),
    rows_per_part: int | None = None,
) -> DataFrame:
    """Policy revision every index runs, against the policy's current one.

    Drifted: runs another revision than the current one. Not enrolled: has a policy but
    no state. Orphan: has no policy. An index whose policy is gone does not drift. With
    ``rows_per_part``, indices of a policy with more of them are dealt to several tasks.
    """
    policy = S.blank_to_null(policy_of())
    wanted = policy.isNotNull()
    if include_orphans:
        wanted = wanted | ~F.coalesce(S.starts_with_any(F.col("index_name"), SYSTEM_PREFIXES), F.lit(False))
    base = (
        _named(explain, "index_name", index_filter)
        .filter(wanted)
        .select(
            *scope,
            F.col("index_name").alias("index"),
            policy.alias("policy"),
            F.when(wanted & policy.isNotNull(), F.col("policy_seq_no")).alias("index_seq_no"),
            (policy.isNotNull() & F.col("policy_seq_no").isNotNull() & F.col("state").isNotNull()).alias("enrolled"),
            policy.isNull().alias("orphan"),
            F.when(policy.isNotNull(), F.col("state.name")).alias("state"),
            F.when(policy.isNotNull(), F.col("step.step_status")).alias("step_status"),
        )
    )
    current = policies.select(*scope, F.col("policy_id").alias("policy"), F.col("seq_no").alias("current_seq_no"))
    drift = F.col("enrolled") & F.coalesce(F.col("index_seq_no") != F.col("current_seq_no"), F.lit(False))
    key = [*scope, "policy"]
    versioned = split_join(base, current, key, rows_per_part=rows_per_part) if rows_per_part else base.join(current, key, "left")
    return versioned.select(
        *scope, "index", "policy", "index_seq_no", "current_seq_no", drift.alias("drift"), "enrolled", "orphan", "state",
        "step_status",
    )


def version_rank() -> Column:
    return F.when(F.col("orphan"), 0).when(~F.col("enrolled"), 1).when(F.col("drift"), 2).otherwise(3)


def attention_first(report: DataFrame) -> DataFrame:
    return report.orderBy(version_rank(), "index")


def version_counts(report: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    names = F.array(*[F.lit(name) for name in VERSION_CLASSES])
    return report.groupBy(*scope, F.element_at(names, version_rank() + 1).alias("version_class")).agg(
        F.count("*").alias("indices")
    )


def needs_attention(report: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row (per scope): is any index drifted, not enrolled or an orphan?"""
    flag = F.coalesce(F.bool_or(version_rank() < 3), F.lit(False)).alias("needs_attention")
    return report.groupBy(*scope).agg(flag)


# ---------------------------------------------------------------------------
# Bulk operations
# ---------------------------------------------------------------------------

# Fixed value: how a bulk policy change reports an index that has no policy yet.
UNMANAGED_TEXT = "not being managed"


def bulk_failures(change: DataFrame, enrol: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Failures that remain after the unmanaged ones of ``change`` went through ``enrol``.

    Both tables hold one outcome per index: ``request_id, index_name, updated, reason``.
    """
    keys = [*scope, "request_id", "index_name"]
    failed = change.filter(~F.col("updated"))
    unmanaged = _is_unmanaged()
    retried = failed.filter(unmanaged & S.is_present(F.col("index_name"))).select(*keys)
    real = failed.filter(~unmanaged)
    second = enrol.filter(~F.col("updated")).join(retried, keys, "left_semi")
    return real.select(*keys, "reason").unionByName(second.select(*keys, "reason"))


def bulk_outcome(change: DataFrame, enrol: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Updated and failed counts per request, enrolments of unmanaged indices included."""
    keys = [*scope, "request_id", "index_name"]
    unmanaged = ~F.col("updated") & _is_unmanaged()
    retried = change.filter(unmanaged & S.is_present(F.col("index_name"))).select(*keys)
    # NULL marks an outcome that the second round replaces.
    first = change.select(*scope, "request_id", F.when(~unmanaged, F.col("updated")).alias("updated"))
    second = enrol.join(retried, keys, "left_semi").select(*scope, "request_id", "updated")
    return (
        first.unionByName(second)
        .groupBy(*scope, "request_id")
        .agg(F.count_if(F.col("updated")).alias("updated_indices"), F.count_if(~F.col("updated")).alias("failed_indices"))
    )


def _is_unmanaged() -> Column:
    return F.contains(F.lower(F.coalesce("reason", F.lit(""))), F.lit(UNMANAGED_TEXT))
