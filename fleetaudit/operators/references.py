"""Do dashboards still work? References, index patterns, fields and queries checked.

The chain is dashboard -> visualization -> search -> index pattern -> mapping. Tables:

``objects``   type, id, title            one row per saved object
``edges``     src_type, src_id, src_title, pos, ref_type, ref_id
``patterns``  id, title, time_field      the index patterns among the objects
``names``     name, index_name           every index, alias and data stream with the index behind it
``mapped``    index_name, mapping_id     indices with at least one field; equal mappings share one id
``paths``     mapping_id, path           flattened field paths; or
              mapping_id, properties     the mappings' texts, which are searched for the asked paths only
``reads``     type, id, field, context   the fields an object reads
``docs``      type, id, title, search_source_json

Problems of a visualization or search are worked out once per object and joined to the
dashboards that show it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.functions import scalars as S
from fleetaudit.operators.globjoin import covered_patterns, glob_pairs
from fleetaudit.operators.joins import split_join

# Object types, levels, check names and message texts of the report.
CHILD_TYPES = ("visualization", "search")
LOADED_TYPES = ("dashboard", "visualization", "search", "index-pattern")
ERROR, WARNING = "error", "warning"
NO_TITLE = "Index pattern '%s' has no title"
NO_INDEX = "Index pattern '%s' (id: %s) matches no index, alias, or data stream"
NO_TIME_FIELD = "Index pattern '%s': time field '%s' is not in the mapping"
NOT_FOUND = "Referenced %s '%s' not found"
BAD_PANELS = "Dashboard panelsJSON is malformed"
NO_PANELS = "Dashboard has no panels or references"
LABEL = "%s '%s' (id: %s)"
NO_PATTERN = "%s references missing index pattern '%s'"
NO_SEARCH = "%s references missing search '%s'"
NO_MATCH = "%s uses index pattern '%s' with no matching indices"
NO_FIELD = "%s references field '%s' not found in '%s' [%s]"
BAD_SOURCE = "%s: searchSourceJSON is malformed"
BAD_PARENS = "%s: query has mismatched parentheses (%s): '%s'"
EMPTY_CLAUSE = "%s: filter has an empty %s clause"


def _union(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _issue(level: str | Column, check: str | Column, message: Column) -> list[Column]:
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return [as_col(level).alias("level"), as_col(check).alias("check"), message.alias("message")]


def _text(template: str, *args: Column) -> Column:
    """The template filled in; a missing value prints as ``None``."""
    return F.format_string(template, *[F.coalesce(a, F.lit("None")) for a in args])


def label(kind: Column, title: Column, ident: Column) -> Column:
    return _text(LABEL, F.initcap(kind), title, ident)


# ---------------------------------------------------------------------------
# Index patterns against names and mappings
# ---------------------------------------------------------------------------


def pattern_index_pairs(titles: DataFrame, names: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Index behind every name a pattern title matches: ``title, index_name``.

    A name that is itself an index stands for itself; aliases and streams lead to theirs.
    """
    behind = names.select(*scope, "name", F.coalesce("index_name", "name").alias("index_name"))
    pairs = glob_pairs(titles, behind, "title", scope, carry=["index_name"])
    return pairs.select(*scope, F.col("pattern").alias("title"), "index_name").distinct()


def pattern_mappings(titles: DataFrame, names: DataFrame, mapped: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Distinct mappings behind every pattern title: ``title, mapping_id``, NULL where a name has no fields.

    Names get their mapping before they meet the patterns. A broad pattern then leaves the
    join as a few mappings per task, and its long list of indices is never shuffled.
    """
    behind = names.select(*scope, "name", F.coalesce("index_name", "name").alias("index_name"))
    with_mapping = behind.join(mapped, [*scope, "index_name"], "left").select(*scope, "name", "mapping_id")
    pairs = glob_pairs(titles, with_mapping, "title", scope, carry=["mapping_id"])
    return pairs.select(*scope, F.col("pattern").alias("title"), "mapping_id").distinct()


#: Most paths looked up in one copy of a mapping; further ones take a copy of their own.
PATHS_PER_LOOKUP = 512


def held_paths(texts: DataFrame, asked: DataFrame, scope: Sequence[str] = (), per_lookup: int = PATHS_PER_LOOKUP) -> DataFrame:
    """The pairs of ``asked`` (``mapping_id, field``) whose mapping has the field.

    ``texts`` holds each mapping once (``mapping_id, properties``). It is parsed once for every
    ``per_lookup`` paths that are asked of it and is never flattened; a mapping of which very many
    paths are asked is dealt to as many rows as it takes. Only such mappings are counted out to all tasks;
    there are fewer than pairs over ``per_lookup``.
    """
    key = [*scope, "mapping_id"]
    wanted = asked.select(*key, "field").filter("mapping_id IS NOT NULL AND field IS NOT NULL").distinct()
    heavy = F.broadcast(wanted.groupBy(*key).agg(F.ceil(F.count("*") / per_lookup).alias("lookups")).filter("lookups > 1"))
    lookups = F.coalesce("lookups", F.lit(1))
    dealt = wanted.join(heavy, key, "left").withColumn("lookup", F.pmod(F.xxhash64("field"), lookups))
    lists = dealt.groupBy(*key, "lookup").agg(F.collect_list("field").alias("wanted"))
    copies = texts.join(heavy, key, "left").withColumn("lookup", F.explode(F.sequence(F.lit(0).cast("bigint"), lookups - 1))).drop("lookups")
    found = J.let(J.parsed(F.col("properties")), lambda doc: F.filter("wanted", lambda field: J.holds_path(doc, field)))
    return lists.join(copies, [*key, "lookup"]).select(*key, F.explode(found).alias("field"))


def pattern_fields(behind: DataFrame, paths: DataFrame, asked: DataFrame | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Field set of every pattern title: ``title, field``. ``behind`` comes from ``pattern_mappings``.

    With ``asked`` (a table of ``title, field``), only those pairs are looked up, so that a
    broad title doesn't meet all paths of its mappings. Texts of mappings need ``asked``.
    """
    if asked is None:
        found = behind.join(paths.withColumnRenamed("path", "field"), [*scope, "mapping_id"])
    else:
        pairs = asked.select(*scope, "title", "field").distinct().join(behind, [*scope, "title"])
        held = held_paths(paths, pairs, scope) if "properties" in paths.columns else paths.withColumnRenamed("path", "field")
        found = pairs.join(held, [*scope, "mapping_id", "field"], "left_semi")
    return found.select(*scope, "title", "field").distinct()


def pattern_status(patterns: DataFrame, behind: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Index patterns with two flags: ``covered``, some name matches; ``known``, some field is known."""
    flags = behind.groupBy(*scope, "title").agg(F.bool_or(F.col("mapping_id").isNotNull()).alias("known"))
    return patterns.join(flags, [*scope, "title"], "left").select(
        *scope,
        "id",
        F.coalesce("title", F.lit("")).alias("title"),
        "time_field",
        F.col("known").isNotNull().alias("covered"),
        F.coalesce("known", F.lit(False)).alias("known"),
    )


def titled(patterns: DataFrame) -> DataFrame:
    return patterns.filter(S.is_present(F.col("title")))


def unmatched_patterns(patterns: DataFrame, names: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Patterns whose title is blank or matches no name: ``id, title``. Needs no mappings."""
    covered = covered_patterns(titled(patterns), names, "title", scope).withColumnRenamed("pattern", "title")
    return patterns.join(covered, [*scope, "title"], "left_anti").select(*scope, "id", "title")


def absent_time_fields(status: DataFrame, behind: DataFrame, paths: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Patterns whose time field is not in the mapping: ``id, title, time_field``."""
    timed = status.filter(F.col("known") & S.is_present(F.col("time_field")))
    present = pattern_fields(behind, paths, timed.withColumnRenamed("time_field", "field"), scope).withColumnRenamed("field", "time_field")
    return timed.join(present, [*scope, "title", "time_field"], "left_anti").select(*scope, "id", "title", "time_field")


def global_issues(
    patterns: DataFrame, names: DataFrame, mapped: DataFrame, paths: DataFrame, scope: Sequence[str] = (), behind: DataFrame | None = None
) -> DataFrame:
    """Problems of index patterns, each told once: ``pattern_id, level, check, message``.

    ``behind`` is the result of ``pattern_mappings`` where it is at hand.
    """
    if behind is None:
        behind = pattern_mappings(titled(patterns), names, mapped, scope)
    status = pattern_status(patterns, behind, scope)
    untitled = F.when(F.col("title") == "", _text(NO_TITLE, F.col("id")))
    unmatched = status.filter("NOT covered").select(
        *scope,
        F.col("id").alias("pattern_id"),
        *_issue(ERROR, "missing-index", F.coalesce(untitled, _text(NO_INDEX, F.col("title"), F.col("id")))),
    )
    untimed = absent_time_fields(status, behind, paths, scope).select(
        *scope,
        F.col("id").alias("pattern_id"),
        *_issue(WARNING, "missing-field", _text(NO_TIME_FIELD, F.col("title"), F.col("time_field"))),
    )
    return unmatched.unionByName(untimed)


# ---------------------------------------------------------------------------
# References
# ---------------------------------------------------------------------------


def resolved_edges(edges: DataFrame, objects: DataFrame, scope: Sequence[str] = (), rows_per_part: int | None = None) -> DataFrame:
    """Every reference with ``found`` and the index pattern it offers to its owner.

    A pattern offers itself, a search the first index pattern it refers to, even a
    missing one. One join answers all existence checks of the report. With
    ``rows_per_part``, references to an object with more of them are dealt to several tasks,
    at the price of counting them first; else that is left to adaptive execution.
    """
    first = (
        edges.filter((F.col("src_type") == "search") & (F.col("ref_type") == "index-pattern"))
        .groupBy(*scope, F.col("src_id").alias("id"))
        .agg(F.min_by("ref_id", "pos").alias("inherited"))
        .withColumn("type", F.lit("search"))
    )
    offers = F.when(F.col("type") == "index-pattern", F.col("id")).otherwise(F.col("inherited"))
    targets = (
        objects.filter(F.col("type").isin(*LOADED_TYPES))
        .select(*scope, "type", "id")
        .join(first, [*scope, "type", "id"], "left")
        .select(
            *scope, F.col("type").alias("ref_type"), F.col("id").alias("ref_id"), F.lit(True).alias("found"), offers.alias("offers")
        )
    )
    key = [*scope, "ref_type", "ref_id"]
    answered = split_join(edges, targets, key, rows_per_part=rows_per_part) if rows_per_part else edges.join(targets, key, "left")
    return answered.withColumn("found", F.coalesce("found", F.lit(False)))


def broken_references(resolved: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """References to nothing: any kind from a dashboard, patterns and searches from its children."""
    of_child = F.col("src_type").isin(*CHILD_TYPES) & F.col("ref_type").isin("index-pattern", "search")
    return resolved.filter(~F.col("found") & ((F.col("src_type") == "dashboard") | of_child)).select(
        *scope, "src_type", "src_id", "src_title", "pos", "ref_type", "ref_id"
    )


def resolved_patterns(resolved: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Index pattern each visualization or search reads, ``type, id, title, pattern_id``: the first one its references offer."""
    offered = resolved.filter(
        F.col("src_type").isin(*CHILD_TYPES)
        & F.col("ref_type").isin("index-pattern", "search")
        & F.col("found")
        & S.is_present(F.col("offers"))
    )
    return offered.groupBy(*scope, F.col("src_type").alias("type"), F.col("src_id").alias("id")).agg(
        F.first("src_title").alias("title"), F.min_by("offers", "pos").alias("pattern_id")
    )


# ---------------------------------------------------------------------------
# Children: visualizations and searches
# ---------------------------------------------------------------------------


def search_source_issues(docs: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Malformed search sources, unbalanced queries and empty filters; one narrow pass, no shuffle."""
    raw = F.col("search_source_json")
    source = F.col("source")
    name = label(F.col("type"), F.col("title"), F.col("id"))
    query = J.as_text(source, "query", "query")
    language = J.shown(F.try_variant_get(source, "$.query", "variant"), "language", "?")

    def issue(level: str, message: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), F.lit("invalid-query").alias("check"), message.alias("message"))

    nothing = F.array().cast("array<struct<level:string,check:string,message:string>>")

    def when(condition: Column, found: Column) -> Column:
        return F.when(condition, F.array(found)).otherwise(nothing)

    malformed = when(source.isNull(), issue(ERROR, _text(BAD_SOURCE, name)))
    unbalanced = when(
        F.coalesce(~S.parens_balanced(query), F.lit(False)), issue(WARNING, _text(BAD_PARENS, name, language, query))
    )
    live = F.filter(
        F.coalesce(J.as_list(source, "filter"), F.array().cast(J.LIST)),
        lambda f: J.as_object(f).isNotNull() & ~J.is_truthy(F.try_variant_get(f, "$.meta.disabled", "variant")),
    )

    def clause(f: Column, key: str) -> Column:
        return when(
            F.coalesce(F.size(J.as_object(f, "query", key)) == 0, F.lit(False)), issue(WARNING, _text(EMPTY_CLAUSE, name, F.lit(key)))
        )

    empties = F.flatten(F.transform(live, lambda f: F.concat(clause(f, "match_phrase"), clause(f, "match"))))
    return (
        docs.filter(S.is_present(F.btrim(raw, F.lit(" \t\n\r\f\x0b"))))
        .select(*scope, "type", "id", "title", J.parsed(raw).alias("source"))
        .select(*scope, "type", "id", F.explode(F.concat(malformed, unbalanced, empties)).alias("issue"))
        .select(*scope, "type", "id", "issue.*")
    )


def child_patterns(resolved: DataFrame, status: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Children that read an existing index pattern: ``type, id, title, pattern_title, covered, known``."""
    read = status.select(*scope, F.col("id").alias("pattern_id"), F.col("title").alias("pattern_title"), "covered", "known")
    return resolved_patterns(resolved, scope).join(read, [*scope, "pattern_id"]).drop("pattern_id")


def missing_fields(
    children: DataFrame, reads: DataFrame, behind: DataFrame, paths: DataFrame, scope: Sequence[str] = ()
) -> DataFrame:
    """Fields a child reads that its pattern's mappings lack; ``_`` names and ``*`` are exempt.

    Nothing is said about patterns without any known field.
    """
    checked = reads.filter(~F.startswith("field", F.lit("_")) & (F.col("field") != "*"))
    used = checked.join(children.filter("known").drop("covered", "known"), [*scope, "type", "id"])
    asked = used.select(*scope, F.col("pattern_title").alias("title"), "field")
    present = pattern_fields(behind, paths, asked, scope).withColumnRenamed("title", "pattern_title")
    return used.join(present, [*scope, "pattern_title", "field"], "left_anti").select(
        *scope, "type", "id", "title", "pattern_title", "field", "context"
    )


def child_issues(
    resolved: DataFrame,
    patterns: DataFrame,
    names: DataFrame,
    mapped: DataFrame,
    paths: DataFrame,
    reads: DataFrame,
    docs: DataFrame,
    scope: Sequence[str] = (),
    behind: DataFrame | None = None,
) -> DataFrame:
    """All problems of visualizations and searches: ``type, id, level, check, message``.

    ``behind`` is the result of ``pattern_mappings`` where it is at hand.
    """
    key = [*scope, "type", "id"]
    name = label(F.col("type"), F.col("title"), F.col("id"))
    broken = (
        broken_references(resolved, scope)
        .filter(F.col("src_type").isin(*CHILD_TYPES))
        .withColumnsRenamed({"src_type": "type", "src_id": "id", "src_title": "title"})
    )
    gone = F.when(F.col("ref_type") == "search", _text(NO_SEARCH, name, F.col("ref_id"))).otherwise(
        _text(NO_PATTERN, name, F.col("ref_id"))
    )
    dangling = broken.select(*key, *_issue(ERROR, "broken-reference", gone))

    if behind is None:
        behind = pattern_mappings(titled(patterns), names, mapped, scope)
    children = child_patterns(resolved, pattern_status(patterns, behind, scope), scope)
    homeless = children.filter("NOT covered").select(
        *key, *_issue(ERROR, "missing-index", _text(NO_MATCH, name, F.col("pattern_title")))
    )
    missing = missing_fields(children, reads, behind, paths, scope).select(
        *key,
        *_issue(
            ERROR, "missing-field", _text(NO_FIELD, name, F.col("field"), F.col("pattern_title"), F.col("context"))
        ),
    )
    return _union(dangling, homeless, missing, search_source_issues(docs, scope).select(*key, "level", "check", "message"))


# ---------------------------------------------------------------------------
# Dashboards
# ---------------------------------------------------------------------------


def panel_issues(panels: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Problems of the dashboard itself; ``panels`` has ``id, panels_json, reference_count``.

    Blank panel text is both malformed and "no panels".
    """
    text = F.col("panels_json")
    bad = text.isNotNull() & J.parsed(text).isNull()
    empty = (F.coalesce("reference_count", F.lit(0)) == 0) & ~S.is_present(text)

    def issue(level: str, check: str, message: str) -> Column:
        return F.struct(F.lit(level).alias("level"), F.lit(check).alias("check"), F.lit(message).alias("message"))

    found = F.array_compact(
        F.array(F.when(bad, issue(ERROR, "invalid-json", BAD_PANELS)), F.when(empty, issue(WARNING, "empty-dashboard", NO_PANELS)))
    )
    return panels.select(*scope, "id", F.explode(found).alias("issue")).select(*scope, "id", "issue.*")


def _own_issues(resolved: DataFrame, panels: DataFrame, scope: Sequence[str]) -> DataFrame:
    broken = broken_references(resolved, scope).filter(F.col("src_type") == "dashboard")
    missing = broken.select(
        *scope,
        F.col("src_id").alias("id"),
        *_issue(ERROR, "broken-reference", _text(NOT_FOUND, F.col("ref_type"), F.col("ref_id"))),
    )
    return missing.unionByName(panel_issues(panels, scope))


def _shown_children(resolved: DataFrame, scope: Sequence[str]) -> DataFrame:
    """One row per reference from a dashboard to a child; a child listed twice counts twice."""
    return resolved.filter(
        (F.col("src_type") == "dashboard") & F.col("ref_type").isin(*CHILD_TYPES) & F.col("found")
    ).select(*scope, F.col("src_id").alias("dashboard_id"), F.col("ref_type").alias("type"), F.col("ref_id").alias("id"))


def dashboard_issues(resolved: DataFrame, panels: DataFrame, of_children: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Every finding under its dashboard: ``id, level, check, message``."""
    inherited = (
        _shown_children(resolved, scope)
        .join(of_children, [*scope, "type", "id"])
        .select(*scope, F.col("dashboard_id").alias("id"), "level", "check", "message")
    )
    return _own_issues(resolved, panels, scope).unionByName(inherited)


def dashboard_report(
    objects: DataFrame,
    resolved: DataFrame,
    panels: DataFrame,
    of_children: DataFrame,
    dashboard_ids: list[str] | DataFrame | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Status and issue counts per dashboard.

    Only counts travel: findings are summed per child before they meet the references,
    so a child shown on very many dashboards adds one small row to each.
    """
    counts = [F.count_if(F.col("level") == level).alias(name) for level, name in ((ERROR, "errors"), (WARNING, "warnings"))]
    per_child = of_children.groupBy(*scope, "type", "id").agg(*counts)
    inherited = (
        _shown_children(resolved, scope)
        .join(per_child, [*scope, "type", "id"])
        .select(*scope, F.col("dashboard_id").alias("id"), "errors", "warnings")
    )
    own = _own_issues(resolved, panels, scope).select(
        *scope,
        "id",
        *[(F.col("level") == level).cast("bigint").alias(name) for level, name in ((ERROR, "errors"), (WARNING, "warnings"))],
    )
    totals = (
        own.unionByName(inherited)
        .groupBy(*scope, "id")
        .agg(F.sum("errors").alias("errors"), F.sum("warnings").alias("warnings"))
    )
    dashboards = only_ids(objects.filter(F.col("type") == "dashboard").select(*scope, "id", "title"), dashboard_ids)
    errors, warnings = F.coalesce("errors", F.lit(0)), F.coalesce("warnings", F.lit(0))
    return dashboards.join(totals, [*scope, "id"], "left").select(
        *scope,
        "id",
        "title",
        F.when(errors > 0, ERROR).when(warnings > 0, WARNING).otherwise("ok").alias("status"),
        errors.alias("errors"),
        warnings.alias("warnings"),
    )


def only_ids(df: DataFrame, ids: list[str] | DataFrame | None) -> DataFrame:
    """Rows with one of the ids: a short list, or a table with an ``id`` column. None or [] keeps all."""
    if isinstance(ids, DataFrame):
        shared = [c for c in ids.columns if c in df.columns]
        return df.join(ids, shared, "left_semi")
    return df.filter(F.col("id").isin(*ids)) if ids else df


def validation_summary(report: DataFrame, issues: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Totals by status, and how many global issues there are."""
    both = report.select(*scope, "status").unionByName(issues.select(*scope, F.lit("global").alias("status")))
    status = F.col("status")
    return both.groupBy(*scope).agg(
        F.count_if(status != "global").alias("total_dashboards"),
        F.count_if(status == "ok").alias("ok"),
        F.count_if(status == WARNING).alias("warnings"),
        F.count_if(status == ERROR).alias("errors"),
        F.count_if(status == "global").alias("global_issues"),
    )
