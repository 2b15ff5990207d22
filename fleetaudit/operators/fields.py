"""Field types across many indices, and a cached field list against the live one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J

from fleetaudit.functions.globs import matches_any
from fleetaudit.functions.scalars import parent_path

# Display type -> the mapping types shown as it. A type not listed is unknown.
DISPLAY_TYPES = {
    "string": (
        "text", "keyword", "string", "match_only_text", "constant_keyword", "wildcard", "version", "search_as_you_type",
        "_id", "_index", "_type",
    ),
    "date": ("date", "date_nanos"),
    "boolean": ("boolean",),
    "number": (
        "byte", "double", "float", "half_float", "integer", "long", "scaled_float", "short", "unsigned_long", "token_count",
    ),
    "geo_point": ("geo_point",),
    "geo_shape": ("geo_shape",),
    "ip": ("ip",),
    "attachment": ("attachment",),
    "murmur3": ("murmur3",),
    "nested": ("nested",),
    "object": ("object",),
    "histogram": ("histogram",),
    "_source": ("_source",),
}
STRING_TYPES = tuple(t for t in DISPLAY_TYPES["string"] if not t.startswith("_"))
NO_DOC_VALUES = ("text", "geo_shape", "flattened")
UNKNOWN = "unknown"
CONFLICT = "conflict"
SHOWN_INDICES = 3


def display_type(mapping_type: Column) -> Column:
    """Display type of a mapping type; a fixed rule, so no join is needed."""
    shown = F.lit(UNKNOWN)
    for display, types in DISPLAY_TYPES.items():
        shown = F.when(mapping_type.isin(*types), display).otherwise(shown)
    return shown


def field_types(caps: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row per field and mapping type.

    A common field occurs once per index of the fleet. This first, hash-based grouping
    shrinks it to a row per type inside every map task, before anything is shuffled.
    """
    return caps.groupBy(*scope, "field", "type").agg(
        F.coalesce(F.bool_or("aggregatable"), F.lit(False)).alias("aggregatable"),
        F.coalesce(F.bool_or("searchable"), F.lit(False)).alias("searchable"),
    )


def _matching(caps: DataFrame, index_filter) -> DataFrame:
    return caps.filter(matches_any(F.col("index_name"), index_filter)) if index_filter else caps


def field_report(
    caps: DataFrame,
    non_keyword: bool = False,
    conflicts: bool = False,
    unknown: bool = False,
    index_filter=None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Types and flags per field; the three switches narrow the report, all at once if several are set."""
    types = field_types(_matching(caps, index_filter), scope)
    metadata = F.startswith("field", F.lit("_")) | F.every(F.startswith("type", F.lit("_")))
    report = types.groupBy(*scope, "field").agg(
        F.array_sort(F.collect_set("type")).alias("types"),
        (F.count("*") > 1).alias("conflict"),
        (~metadata & F.bool_or(display_type(F.col("type")) == UNKNOWN)).alias("unknown"),
        F.every(F.col("type").isin(*STRING_TYPES)).alias("string_like"),
        F.bool_or("aggregatable").alias("aggregatable"),
        F.bool_or("searchable").alias("searchable"),
    )
    if conflicts:
        report = report.filter("conflict")
    if unknown:
        report = report.filter("unknown")
    if non_keyword:
        report = report.filter("NOT string_like")
    return report


def by_field(report: DataFrame) -> DataFrame:
    return report.orderBy("field")


def conflict_indices(caps: DataFrame, index_filter=None, scope: Sequence[str] = ()) -> DataFrame:
    """Which index maps a conflicting field as what; one row per field, type and index."""
    matching = _matching(caps, index_filter)
    conflicting = field_types(matching, scope).groupBy(*scope, "field").count().filter("count > 1").select(*scope, "field")
    return matching.join(conflicting, [*scope, "field"], "left_semi").select(*scope, "field", "type", "index_name").distinct()


def conflict_examples(conflicts: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """First index names per conflicting type, and how many there are.

    The row-number filter runs as a group limit inside every task before the shuffle, so
    a type held by a third of all indices moves only a few rows per task.
    """
    keys = [*scope, "field", "type"]
    order = Window.partitionBy(*keys).orderBy("index_name")
    first = (
        conflicts.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= SHOWN_INDICES)
        .groupBy(*keys)
        .agg(F.array_join(F.array_sort(F.collect_list("index_name")), ", ").alias("shown"))
    )
    totals = conflicts.groupBy(*keys).agg(F.count("*").alias("indices"))
    more = F.when(F.col("indices") > SHOWN_INDICES, " ...").otherwise("")
    return totals.join(first, keys).select(*keys, "indices", F.concat("shown", more).alias("shown"))


def field_report_counts(caps: DataFrame, scope: Sequence[str] = (), index_filter=None, **narrow: bool) -> DataFrame:
    """Totals under the report: fields seen, fields reported, indices matched, conflicts and unknowns reported."""
    all_fields = field_report(caps, index_filter=index_filter, scope=scope)
    shown = F.lit(True)
    if narrow.get("conflicts"):
        shown = shown & F.col("conflict")
    if narrow.get("unknown"):
        shown = shown & F.col("unknown")
    if narrow.get("non_keyword"):
        shown = shown & ~F.col("string_like")
    fields = all_fields.select(*scope, F.lit(True).alias("is_field"), shown.alias("shown"), "conflict", "unknown")
    nothing = F.lit(None).cast("boolean")
    indices = (
        _matching(caps, index_filter)
        .select(*scope, "index_name")
        .distinct()
        .select(*scope, F.lit(False).alias("is_field"), *[nothing.alias(c) for c in ("shown", "conflict", "unknown")])
    )
    return fields.unionByName(indices).groupBy(*scope).agg(
        F.count_if("is_field").alias("total_fields"),
        F.count_if("shown").alias("reported_fields"),
        F.count_if(~F.col("is_field")).alias("matching_indices"),
        F.count_if(F.col("shown") & F.col("conflict")).alias("conflicts"),
        F.count_if(F.col("shown") & F.col("unknown")).alias("unknowns"),
    )


# ---------------------------------------------------------------------------
# Cached field lists
# ---------------------------------------------------------------------------


def with_multi_field_parents(fields: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Adds ``multi_parent``: the parent of a dotted field when that parent is itself a leaf.

    ``fields`` has one row per field with its ``primary_type``.
    """
    leaves = fields.filter(~F.col("primary_type").isin("object", "nested")).select(
        *[F.col(c).alias(f"parent_{c}") for c in scope], F.col("name").alias("multi_parent")
    )
    same = [F.col(c) == F.col(f"parent_{c}") for c in scope]
    dotted = fields.withColumn("parent", parent_path(F.col("name")))
    return dotted.join(leaves, [*same, F.col("parent") == F.col("multi_parent")], "left").select(*fields.columns, "multi_parent")


def live_field_list(caps: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The field list a refresh builds from live field capabilities; metadata fields stay out."""
    types = field_types(caps.filter(~F.startswith("field", F.lit("_"))), scope)
    shown = display_type(F.col("type"))
    first = F.min("type")
    fields = (
        types.groupBy(*scope, F.col("field").alias("name"))
        .agg(
            F.when(F.min(shown) == F.max(shown), F.min(shown)).otherwise(CONFLICT).alias("type"),
            F.array_sort(F.collect_set("type")).alias("es_types"),
            F.bool_or("searchable").alias("searchable"),
            F.bool_or("aggregatable").alias("aggregatable"),
            first.alias("primary_type"),
        )
        .withColumn(
            "read_from_doc_values",
            F.col("aggregatable")
            & ~F.col("primary_type").isin(*NO_DOC_VALUES)
            & ~F.startswith("primary_type", F.lit("_")),
        )
    )
    return with_multi_field_parents(fields, scope)


def refresh_field_list(caps: DataFrame, cached: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """A cached field list against the live one: every name with its change and its new entry.

    ``scope`` holds the pattern id when several lists are refreshed at once. ``cached`` has
    ``name, type, count, scripted``, perhaps ``position`` (of several rows of a name the last
    counts, by position and then contents) and ``entry``, the whole entry as JSON. Cached metadata and scripted fields are
    kept as they are, ``entry`` included, and hide a live field of the same name; ``count``
    carries over.
    """
    live = live_field_list(caps, scope)
    keys, keep_entry = [*scope, "name"], "entry" in cached.columns
    entry = F.col("entry") if "entry" in cached.columns else F.lit(None).cast("string")
    row = F.struct("type", "count", "scripted", entry.alias("entry"))
    position = F.col("position") if "position" in cached.columns else F.lit(None).cast("int")
    last = F.max_by(row, "place")
    cached = cached.withColumn("place", F.struct(position.alias("position"), row.alias("row"))).groupBy(*keys).agg(last.alias("row")).select(*keys, "row.*")
    old = cached.select(
        *keys,
        F.col("entry").alias("cached_entry"),
        F.lit(True).alias("in_cache"),
        F.col("type").alias("cached_type"),
        F.col("count").alias("cached_count"),
        F.coalesce("scripted", F.lit(False)).alias("cached_scripted"),
        (F.startswith("name", F.lit("_")) | F.coalesce("scripted", F.lit(False))).alias("preserved"),
    )
    both = old.join(live.withColumn("in_live", F.lit(True)), keys, "full_outer")
    preserved = F.coalesce("preserved", F.lit(False))
    in_live, in_cache = F.col("in_live").isNotNull(), F.col("in_cache").isNotNull()
    change = F.when(preserved, "kept").when(in_live & in_cache, "kept").when(in_live, "added").otherwise("removed")

    def fresh(column: str) -> Column:
        return F.when(~preserved, F.col(column)).alias(column)

    return both.select(
        *keys,
        change.alias("change"),
        in_cache.alias("in_cache"),
        F.when(preserved | ~in_live, F.col("cached_type")).otherwise(F.col("type")).alias("type"),
        F.coalesce("cached_count", F.lit(0)).cast("bigint").alias("count"),
        F.when(preserved, F.col("cached_scripted")).otherwise(F.lit(False)).alias("scripted"),
        *[fresh(c) for c in ("es_types", "searchable", "aggregatable", "read_from_doc_values", "multi_parent")],
        *([F.when(preserved, F.col("cached_entry")).alias("entry")] if keep_entry else []),
    )


def refreshed_entries(refresh: DataFrame) -> DataFrame:
    """The new field list, ready to replace the cached one."""
    return refresh.filter(F.col("change") != "removed").drop("change", "in_cache")


def cached_entries(patterns: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The cached list inside index patterns (``scope`` and ``fields``, JSON text) as rows for :func:`refresh_field_list`.

    Text that isn't a list has no entries; entries without a name are left out.
    """
    listed = patterns.select(*scope, F.posexplode(J.as_list(J.parsed(F.col("fields")))).alias("position", "e"))
    return listed.select(
        *scope, J.as_text(F.col("e"), "name").alias("name"), J.as_text(F.col("e"), "type").alias("type"),
        F.coalesce(F.try_variant_get("e", "$.count", "bigint"), F.lit(0)).alias("count"),
        F.coalesce(F.try_variant_get("e", "$.scripted", "boolean"), F.lit(False)).alias("scripted"), F.to_json("e").alias("entry"), "position",
    ).filter("name IS NOT NULL")


def refreshed_lists(refresh: DataFrame, scope: Sequence[str]) -> DataFrame:
    """A refresh as JSON text per pattern, ``fields``: preserved entries whole, the others built anew, by name.

    A pattern that loses all its fields gets an empty list.
    """
    parent = F.when(F.col("multi_parent").isNotNull(), F.struct(F.struct(F.col("multi_parent").alias("parent")).alias("multi")))
    built = F.to_json(F.struct(
        "name", "type", F.col("es_types").alias("esTypes"), "count", "scripted", "searchable", "aggregatable",
        F.col("read_from_doc_values").alias("readFromDocValues"), parent.alias("subType")))
    kept = F.when(F.col("change") != "removed", F.struct("name", F.coalesce("entry", built).alias("text")))
    rows = refresh.groupBy(*scope).agg(F.array_sort(F.collect_list(kept)).alias("rows"))
    return rows.select(*scope, F.concat(F.lit("["), F.array_join("rows.text", ","), F.lit("]")).alias("fields"))


def refreshed_patterns(patterns: DataFrame, lists: DataFrame, scope: Sequence[str]) -> DataFrame:
    """``patterns`` with their new lists (``scope`` and ``fields``) put into ``attributes``, to be stored.

    Only the cached list in the attributes changes; patterns without a new list stay as they are.
    """
    found = patterns.join(lists.select(*scope, F.col("fields").alias("new_fields")), [*scope], "left")
    patched = J.let(J.parsed(F.col("attributes")), lambda doc: J.changed_at(doc, ["fields"], lambda _: J.text_variant(F.col("new_fields"))))
    attributes = F.when(F.col("new_fields").isNotNull(), F.to_json(patched)).otherwise(F.col("attributes"))
    return found.select(*[attributes.alias(c) if c == "attributes" else F.col(c) for c in patterns.columns])


def refresh_summary(refresh: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return refresh.groupBy(*scope).agg(
        F.count_if("in_cache").alias("old_field_count"),
        F.count_if(F.col("change") != "removed").alias("new_field_count"),
        F.count_if(F.col("change") == "added").alias("added"),
        F.count_if(F.col("change") == "removed").alias("removed"),
    )
