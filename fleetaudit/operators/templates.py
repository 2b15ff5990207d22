"""Templates, data streams, and the policies that new indices get through them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import scalars as S
from fleetaudit.functions.globs import matches_any
from fleetaudit.functions.jsonops import settings_policy


def list_component_templates(templates: DataFrame, name_filter=None, scope: Sequence[str] = ()) -> DataFrame:
    """Policy and version of every component template."""
    wanted = templates.filter(matches_any(F.col("name"), name_filter)) if name_filter else templates
    return wanted.select(*scope, "name", settings_policy(F.col("settings")).alias("policy_id"), "version")


def inherited_policies(members: DataFrame, components: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Policy each template inherits: the last of its components that has one.

    ``members`` holds one row per component of a template (``name, pos, component``),
    ``components`` one row per component template (``name, policy_id``).
    """
    with_policy = components.filter(S.is_present(F.col("policy_id"))).select(
        *scope, F.col("name").alias("component"), "policy_id"
    )
    return (
        members.join(with_policy, [*scope, "component"])
        .groupBy(*scope, "name")
        .agg(F.max_by(F.struct("component", "policy_id"), "pos").alias("last"))
        .select(*scope, "name", F.col("last.component").alias("component"), F.col("last.policy_id").alias("inherited"))
    )


def resolve_template_policies(templates: DataFrame, inherited: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Policy of every template and where it comes from; an inline policy beats an inherited one.

    ``templates`` has ``name`` and ``inline_policy``; its other columns pass through.
    """
    inline = S.blank_to_null(F.col("inline_policy"))
    kept = [c for c in templates.columns if c != "inline_policy"]
    return templates.join(inherited, [*scope, "name"], "left").select(
        *kept,
        F.coalesce(inline, "inherited").alias("policy_id"),
        F.when(inline.isNotNull(), "inline").otherwise(F.concat(F.lit("via "), "component")).alias("source"),
    )


def list_index_templates(
    templates: DataFrame, component_templates: DataFrame, name_filter=None, scope: Sequence[str] = ()
) -> DataFrame:
    """Index templates with the policy they apply, inline or through their components."""
    wanted = templates.filter(matches_any(F.col("name"), name_filter)) if name_filter else templates
    members = wanted.select(*scope, "name", F.posexplode("composed_of").alias("pos", "component"))
    inherited = inherited_policies(members, list_component_templates(component_templates, scope=scope), scope)
    rows = wanted.select(
        *scope,
        "name",
        S.joined(F.col("index_patterns"), ",").alias("index_patterns"),
        S.joined(F.col("composed_of"), ",").alias("composed_of"),
        settings_policy(F.col("settings")).alias("inline_policy"),
    )
    return resolve_template_policies(rows, inherited, scope)


def list_data_streams(streams: DataFrame, name_filter=None, scope: Sequence[str] = ()) -> DataFrame:
    """Data streams; ``write_index`` is the last in a stream's list of indices."""
    wanted = streams.filter(matches_any(F.col("name"), name_filter)) if name_filter else streams
    return wanted.select(
        *scope,
        "name",
        "status",
        "generation",
        F.coalesce(F.size("indices"), F.lit(0)).alias("backing_count"),
        F.try_element_at(F.col("indices"), F.lit(-1))["index_name"].alias("write_index"),
        "template",
    )


def write_indices(backing: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The same from a long table ``name, pos, index_name``; the highest position is written to."""
    return backing.groupBy(*scope, "name").agg(
        F.count("*").alias("backing_count"), F.max_by("index_name", "pos").alias("write_index")
    )


def by_name(report: DataFrame) -> DataFrame:
    return report.orderBy(F.coalesce("name", F.lit("")))
