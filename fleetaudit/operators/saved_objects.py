"""Saved objects: listings, the fields they read, validation, export and import.

A saved-object table has ``type, id, title, attributes`` (JSON text), ``references``,
``workspaces`` and ``updated_at``; see ``sources.readers``.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.functions import scalars as S
from fleetaudit.operators import references as R
from fleetaudit.sources.layout import kept

# Object types, stand-in title, dropped workspace, names of the checked clauses.
SAVED_TYPES = ("dashboard", "visualization", "search")
PATTERN_TYPE = "index-pattern"
NO_TITLE = "N/A"
DEFAULT_WORKSPACE = "default"
FILTER_CLAUSES = ("match_phrase", "match", "term", "range")
HEADER_KEY = "_index_pattern_map"


# ---------------------------------------------------------------------------
# Listings
# ---------------------------------------------------------------------------


def in_workspace(objects: DataFrame, explicit: str | None = None, default: str | None = None, everything: bool = False) -> DataFrame:
    """Objects of one workspace: an explicit id wins, ``everything`` lifts the scope, else the default applies."""
    wanted = explicit or (None if everything else default)
    return objects.filter(F.array_contains("workspaces", wanted)) if wanted else objects


def without_default_workspace(workspaces: Column) -> Column:
    return F.array_remove(F.coalesce(workspaces, F.array().cast("array<string>")), DEFAULT_WORKSPACE)


def list_objects(objects: DataFrame, obj_type: str | None = None, scope: Sequence[str] = ()) -> DataFrame:
    types = (obj_type,) if obj_type else SAVED_TYPES
    return objects.filter(F.col("type").isin(*types)).select(*scope, "type", "id", "title")


def by_type_and_title(report: DataFrame) -> DataFrame:
    return report.orderBy("type", "title", "id")


def list_index_patterns(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """What tells two similar patterns apart: time field, workspaces, cached fields, last update."""
    attributes = J.parsed(F.col("attributes"))
    return objects.filter(F.col("type") == PATTERN_TYPE).select(
        *scope,
        "id",
        "title",
        J.as_text(attributes, "timeFieldName").alias("time_field"),
        S.joined(F.col("workspaces"), ", ").alias("workspaces"),
        J.cached_field_count(J.as_text(attributes, "fields")).alias("fields"),
        S.minute_stamp(F.coalesce("updated_at", F.lit(""))).alias("updated"),
    )


def by_title(report: DataFrame) -> DataFrame:
    return report.orderBy("title", "id")


def list_detectors(detectors: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    name = J.as_text(J.parsed(F.col("detector")), "name")
    return detectors.select(
        *scope, F.lit("detector").alias("type"), "id", F.coalesce(name, F.lit(NO_TITLE)).alias("title")
    )


# ---------------------------------------------------------------------------
# The parts of an object that validation looks at
# ---------------------------------------------------------------------------


def reference_edges(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return objects.select(
        *scope,
        F.col("type").alias("src_type"),
        F.col("id").alias("src_id"),
        F.col("title").alias("src_title"),
        F.posexplode("references").alias("pos", "ref"),
    ).select(*scope, "src_type", "src_id", "src_title", "pos", F.col("ref.type").alias("ref_type"), F.col("ref.id").alias("ref_id"))


def index_patterns(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    attributes = J.parsed(F.col("attributes"))
    return objects.filter(F.col("type") == PATTERN_TYPE).select(
        *scope,
        "id",
        F.coalesce(J.as_text(attributes, "title"), F.lit("")).alias("title"),
        J.as_text(attributes, "timeFieldName").alias("time_field"),
    )


def search_sources(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return objects.filter(F.col("type").isin(*R.CHILD_TYPES)).select(
        *scope, "type", "id", "title", J.search_source_text(J.parsed(F.col("attributes"))).alias("search_source_json")
    )


def dashboard_panels(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    node = F.try_variant_get(J.parsed(F.col("attributes")), "$.panelsJSON", "variant")
    return objects.filter(F.col("type") == "dashboard").select(
        *scope,
        "id",
        F.coalesce(J.as_text(node), F.when(J.is_truthy(node), F.to_json(node))).alias("panels_json"),
        F.coalesce(F.size("references"), F.lit(0)).alias("reference_count"),
    )


def referenced_fields(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every field a visualization or search reads and where: ``type, id, field, context``.

    One pass over each object; attributes, visualization state and search source are
    each parsed once.
    """
    none = F.array().cast("array<struct<field:string,context:string>>")
    no_items = F.array().cast(J.LIST)

    def use(field: Column, context: Column) -> Column:
        return F.struct(field.alias("field"), context.alias("context"))

    def present(uses: Column) -> Column:
        return F.filter(uses, lambda u: u["field"].isNotNull())

    def items(value: Column, *path: str) -> Column:
        return F.coalesce(J.as_list(value, *path), no_items)

    attributes, state, source = F.col("attrs"), F.col("state"), F.col("source")

    columns = F.transform(items(attributes, "columns"), lambda c: use(J.as_text(c), F.lit("search column")))

    def agg_uses(agg: Column) -> Column:
        context = F.format_string('agg "%s" (id: %s)', J.shown(agg, "type", "?"), J.shown(agg, "id", "?"))
        custom = J.values_of_key(J.as_text(agg, "params", "json"))
        direct = F.array(use(J.as_text(agg, "params", "field"), context))
        written = F.transform(custom, lambda name: use(name, F.concat(context, F.lit(" custom JSON"))))
        return F.when(J.as_object(agg).isNotNull(), F.concat(direct, F.coalesce(written, none))).otherwise(none)

    aggs = F.flatten(F.transform(items(state, "aggs"), agg_uses))
    vis = F.array(
        use(J.as_text(state, "params", "field"), F.format_string("vis params (%s)", J.shown(state, "type", "?")))
    )

    def series_uses(series: Column, position: Column) -> Column:
        metrics = items(series, "metrics")
        # A metric computed from another one holds that one's id under "field".
        siblings = F.array_compact(F.transform(metrics, lambda m: J.as_text(m, "id")))
        read = F.transform(metrics, lambda m: J.as_text(m, "field"))
        fields = F.filter(read, lambda f: f.isNotNull() & ~F.array_contains(siblings, f))
        where = F.concat(F.lit("TSVB series["), position.cast("string"), F.lit("] "))
        terms = use(J.as_text(series, "terms_field"), F.concat(where, F.lit("terms_field")))
        return F.concat(F.transform(fields, lambda f: use(f, F.concat(where, F.lit("metric")))), F.array(terms))

    series = F.flatten(F.transform(items(state, "params", "series"), series_uses))

    def clause_uses(filter_: Column, clause: str) -> Column:
        names = F.coalesce(F.map_keys(J.as_object(filter_, "query", clause)), F.array().cast("array<string>"))
        return F.transform(names, lambda name: use(name, F.lit(f"filter {clause}")))

    def filter_uses(filter_: Column) -> Column:
        by_key = F.array(use(J.as_text(filter_, "meta", "key"), F.lit("filter")))
        return F.concat(by_key, *[clause_uses(filter_, clause) for clause in FILTER_CLAUSES])

    filters = F.flatten(F.transform(items(source, "filter"), filter_uses))

    # The state is an object, or an object written as text.
    state_node = F.try_variant_get(attributes, "$.visState", "variant")
    return (
        objects.filter(F.col("type").isin(*R.CHILD_TYPES))
        .select(*scope, "type", "id", J.parsed(F.col("attributes")).alias("attrs"))
        .select(
            *scope,
            "type",
            "id",
            "attrs",
            F.coalesce(J.parsed(J.as_text(state_node)), state_node).alias("state"),
            J.parsed(J.search_source_text(attributes)).alias("source"),
        )
        .select(*scope, "type", "id", F.explode(present(F.concat(columns, aggs, vis, series, filters))).alias("read"))
        .select(*scope, "type", "id", "read.field", "read.context")
    )


def distinct_mappings(mappings: DataFrame, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Mappings as ``(index_name, mapping_id)`` and ``(mapping_id, properties)``, those with a field only.

    Indices rolled over from one template share their mapping. Equal texts fall together in the
    task that reads them, by hashing, so a text leaves a task once, whatever the number of its indices.
    The id is 128 bits of a text's SHA-256 as bytes, since it goes with every index through several shuffles.
    """
    keyed = mappings.withColumn("mapping_id", F.unhex(F.left(F.sha2("properties", 256), F.lit(32))))
    key = [*scope, "mapping_id"]
    fields = J.object_from_text(F.col("properties"))
    has_field = F.exists(F.map_values(fields), lambda v: J.as_object(v).isNotNull())
    # Behind the count the test can't move ahead of the grouping, where it would parse every index's text.
    texts = keyed.groupBy(*key, "properties").agg(F.count("*").alias("n")).filter(F.when(F.col("n") > 0, has_field)).drop("n")
    return keyed.select(*scope, "index_name", "mapping_id").join(texts.select(*key), key, "left_semi"), texts


def flattened_mappings(mappings: DataFrame, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Mappings as ``(index_name, mapping_id)`` and ``(mapping_id, path)``; each distinct one is flattened once."""
    mapped, texts = distinct_mappings(mappings, scope)
    return mapped, texts.select(*scope, "mapping_id", F.explode(J.mapping_paths(F.col("properties"))).alias("path"))


class Validation(NamedTuple):
    dashboards: DataFrame
    issues: DataFrame
    global_issues: DataFrame
    summary: DataFrame


def validate_dashboards(
    objects: DataFrame,
    names: DataFrame,
    mappings: DataFrame,
    dashboard_ids: list[str] | DataFrame | None = None,
    scope: Sequence[str] = (),
    keep: bool = False,
) -> Validation:
    """Full check of dashboards from saved objects, index names and raw mappings.

    With ``keep``, references and findings are worked out once, right away, and kept in the
    checkpoint folder; otherwise each of the four results works them out when it is used.
    """
    store = kept if keep else (lambda df: df)
    listed = objects.select(*scope, "type", "id", "title")
    resolved = store(R.resolved_edges(reference_edges(objects, scope), listed, scope))
    patterns, panels = index_patterns(objects, scope), dashboard_panels(objects, scope)
    mapped, paths = distinct_mappings(mappings, scope)
    behind = store(R.pattern_mappings(R.titled(patterns), names, mapped, scope))
    found = R.child_issues(
        resolved, patterns, names, mapped, paths, referenced_fields(objects, scope), search_sources(objects, scope), scope, behind
    )
    children = store(found)
    report = R.dashboard_report(listed, resolved, panels, children, dashboard_ids, scope)
    issues = R.only_ids(R.dashboard_issues(resolved, panels, children, scope), dashboard_ids)
    whole = store(R.global_issues(patterns, names, mapped, paths, scope, behind))
    return Validation(report, issues, whole, R.validation_summary(report, whole, scope))


# ---------------------------------------------------------------------------
# Export and import
# ---------------------------------------------------------------------------


def export_records(
    objects: DataFrame, ids: list[str] | DataFrame | None = None, obj_type: str | None = None, scope: Sequence[str] = ()
) -> DataFrame:
    """Objects as they are exported, pinned queries and filters taken out: ``type, id, line``."""
    types = (obj_type,) if obj_type else SAVED_TYPES
    wanted = R.only_ids(objects.filter(F.col("type").isin(*types)), ids)
    record = F.struct(
        "id",
        "type",
        J.stripped_attributes(F.col("attributes")).alias("attributes"),
        F.coalesce("references", F.array().cast("array<struct<name:string,type:string,id:string>>")).alias("references"),
    )
    return wanted.select(*scope, "type", "id", F.to_json(record).alias("line"))


def export_header(objects: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Header lines naming the index patterns, one line per pattern.

    Importers skip every line that holds the header key, so the map does not have to be
    gathered into one row.
    """
    titled = objects.filter((F.col("type") == PATTERN_TYPE) & (F.col("title") != NO_TITLE))
    entry = F.create_map(F.lit(HEADER_KEY), F.create_map("id", "title"))
    return titled.select(*scope, F.to_json(entry).alias("line"))


def export_detectors(detectors: DataFrame, ids: list[str] | DataFrame | None = None, scope: Sequence[str] = ()) -> DataFrame:
    record = F.struct("id", F.lit("detector").alias("type"), J.parsed(F.col("detector")).alias("detector"))
    return R.only_ids(detectors, ids).select(*scope, "id", F.to_json(record).alias("line"))


def split_by_type(records: DataFrame, obj_type: str | None) -> tuple[DataFrame, DataFrame]:
    """Records to import and those skipped for being of another type."""
    if not obj_type:
        return records, records.filter(F.lit(False))
    same = F.coalesce(F.col("type") == obj_type, F.lit(False))
    return records.filter(same), records.filter(~same)


def import_outcome(records: DataFrame, errors: DataFrame, scope: Sequence[str] = (), order: str = "error") -> DataFrame:
    """Result per imported record: ``type, id, title, error``; a NULL error means it went in.

    Of several errors for one object the last by ``order`` counts, by default the greatest text.
    """
    errors = errors.groupBy(*scope, "type", "id").agg(F.max_by("error", order).alias("error"))
    title = F.coalesce(J.as_text(J.parsed(F.col("attributes")), "title"), F.lit(NO_TITLE))
    return records.join(errors, [*scope, "type", "id"], "left").select(*scope, "type", "id", title.alias("title"), "error")


def import_tally(outcome: DataFrame, skipped: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    failed = S.is_present(F.col("error"))
    rows = outcome.select(*scope, F.when(failed, "failed").otherwise("imported").alias("result"))
    result = F.col("result")
    return (
        rows.unionByName(skipped.select(*scope, F.lit("skipped").alias("result")))
        .groupBy(*scope)
        .agg(*[F.count_if(result == name).alias(name) for name in ("imported", "failed", "skipped")])
    )


