"""Dumped responses -> tables.

A dump is a directory of response bodies. ``read_responses`` gives one row per body in
the column ``value`` (plus scope columns, when the directory is partitioned by them);
every other function turns such a frame into the table an operator takes. A body is
bounded by what one cluster answered to one request, and files are read in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.functions import scalars as S
from fleetaudit.operators.saved_objects import HEADER_KEY, NO_TITLE, without_default_workspace
from fleetaudit.sources import schemas as T


#: The file that a body came from; with the place inside the body it numbers rows alike however they are dealt out.
SOURCE_FILE = "source_file"


def _place(df: DataFrame, position: Column) -> Column:
    """Where a row stood in the dump. Nothing is known of bodies that came from no file."""
    file = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.lit(None).cast("string")
    return F.struct(file.alias("file"), position.cast("int").alias("position")).alias("place")


def read_responses(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per file, with its path in ``source_file``. Paths may hold wildcards; one that matches nothing is an error."""
    wanted = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    return spark.read.text(wanted, wholetext=True).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def _parsed(responses: DataFrame, schema: str, scope: Sequence[str]) -> DataFrame:
    return responses.select(*scope, F.from_json("value", schema).alias("body"))


def _entries(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


# ---------------------------------------------------------------------------
# Lifecycle
# ---------------------------------------------------------------------------


def explain_rows(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Explain response -> ``index_explain``; summary counters among the entries are dropped."""
    info = _entries(F.col("body"))

    def part(key: str, schema: str) -> Column:
        # An empty object says as little as a missing one.
        return F.when(F.col("info")[key] != "{}", F.from_json(F.col("info")[key], schema))

    return (
        responses.select(*scope, F.explode(_entries(F.col("value"))).alias("index_name", "body"))
        .filter(F.startswith(F.ltrim("body"), F.lit("{")))
        .select(*scope, "index_name", info.alias("info"))
        .select(
            *scope,
            "index_name",
            F.col("info")[J.POLICY_KEY].alias("policy_id_setting"),
            F.col("info")["policy_id"].alias("policy_id"),
            F.col("info")["policy_seq_no"].try_cast("bigint").alias("policy_seq_no"),
            part("state", T.STATE).alias("state"),
            part("action", T.ACTION).alias("action"),
            part("step", T.STEP).alias("step"),
            part("retry_info", T.RETRY).alias("retry_info"),
            F.col("info")["info"].alias("info"),
        )
    )


def index_stats(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return _parsed(responses, T.STATS, scope).select(
        *scope, F.explode("body.indices").alias("index_name", "stats")
    ).select(*scope, "index_name", F.coalesce("stats.total.store.size_in_bytes", F.lit(0)).alias("size_in_bytes"))


def settings_layers(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    layers = F.create_map(*[x for layer in ("defaults", "transient", "persistent") for x in (F.lit(layer), F.col(f"body.{layer}"))])
    return (
        _parsed(responses, T.SETTINGS, scope)
        .select(*scope, F.explode(layers).alias("source", "entries"))
        .select(*scope, "source", F.explode("entries").alias("setting", "value"))
    )


def managed_config(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Search hits of the managed-index configuration; other documents are left out."""
    return (
        _parsed(responses, T.MANAGED_SEARCH, scope)
        .select(*scope, F.explode("body.hits.hits._source.managed_index").alias("managed"))
        .filter(F.col("managed").isNotNull())
        .select(*scope, F.col("managed.index").alias("index_name"), "managed.policy_id", "managed.policy_seq_no", "managed.schedule")
    )


def policies(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Policies with their parts as columns and, in ``document``, their whole text."""
    whole = F.from_json("value", "struct<policy:string>")["policy"]
    return (
        responses.select(*scope, F.from_json("value", T.POLICY).alias("body"), whole.alias("document"))
        .filter(F.col("body.policy").isNotNull())
        .select(
            *scope,
            F.coalesce("body._id", "body.policy.policy_id").alias("policy_id"),
            F.col("body._seq_no").alias("seq_no"),
            F.col("body._primary_term").alias("primary_term"),
            "body.policy.description",
            "body.policy.default_state",
            "body.policy.states",
            "body.policy.ism_template",
            "document",
        )
    )


def policy_named(policies_table: DataFrame, name: str) -> DataFrame:
    return policies_table.filter(F.col("policy_id") == name)


def _templates(responses: DataFrame, kind: str, scope: Sequence[str]) -> DataFrame:
    """``name``, the template's parts as ``t``, and its whole text as ``body``."""
    listed = _parsed(responses, T.TEMPLATE_LIST, scope).select(*scope, F.explode(F.col("body")[f"{kind}s"]).alias("e"))
    return listed.select(*scope, F.coalesce("e.name", F.lit("-")).alias("name"), F.col("e")[kind].alias("body")).withColumn("t", F.from_json("body", T.INDEX_TEMPLATE))


def index_templates(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return _templates(responses, "index_template", scope).select(
        *scope, "name", "t.index_patterns", "t.composed_of", F.col("t.template.settings").alias("settings"), "body")


def component_templates(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return _templates(responses, "component_template", scope).select(
        *scope, "name", "t.version", F.col("t.template.settings").alias("settings"), "body")


def data_streams(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return _parsed(responses, T.DATA_STREAMS, scope).select(*scope, F.inline("body.data_streams"))


def tasks(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Task snapshot, nodes and their tasks flattened to one row per task."""
    return (
        _parsed(responses, T.TASK_NODES, scope)
        .select(*scope, F.explode(F.map_values("body.nodes")).alias("node"))
        .select(*scope, F.col("node.name").alias("node"), F.explode("node.tasks").alias("task_id", "task"))
        .select(*scope, "node", "task_id", "task.*")
    )


def pending_tasks(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return _parsed(responses, T.PENDING, scope).select(*scope, F.inline("body.tasks"))


# ---------------------------------------------------------------------------
# Names, mappings, field capabilities
# ---------------------------------------------------------------------------


def index_names(
    indices: DataFrame | None = None,
    aliases: DataFrame | None = None,
    streams: DataFrame | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Every name a pattern can match and the index behind it: ``name, kind, index_name``.

    ``indices`` has ``index``, ``aliases`` has ``alias, index`` and ``streams`` is a
    ``data_streams`` table. A source that could not be dumped is left out.
    """
    parts = []
    if indices is not None:
        parts.append(indices.select(*scope, F.col("index").alias("name"), F.lit("index").alias("kind"), F.col("index").alias("index_name")))
    if aliases is not None:
        parts.append(aliases.select(*scope, F.col("alias").alias("name"), F.lit("alias").alias("kind"), F.col("index").alias("index_name")))
    if streams is not None:
        backing = streams.select(*scope, "name", F.explode_outer("indices.index_name").alias("index_name"))
        parts.append(backing.select(*scope, "name", F.lit("data_stream").alias("kind"), "index_name"))
        parts.append(backing.select(*scope, F.col("index_name").alias("name"), F.lit("index").alias("kind"), "index_name"))
    if not parts:
        raise ValueError("index_names needs at least one source")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.filter(S.is_present(F.col("name"))).distinct()


def index_mappings(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    return (
        responses.select(*scope, F.explode(F.from_json("value", T.MAPPINGS)).alias("index_name", "m"))
        .select(*scope, "index_name", F.coalesce("m.mappings.properties", F.lit("{}")).alias("properties"))
    )


def _field_specs(responses: DataFrame, scope: Sequence[str]) -> DataFrame:
    return (
        _parsed(responses, T.FIELD_CAPS, scope)
        .select(*scope, F.col("body.indices").alias("all_indices"), F.explode("body.fields").alias("field", "by_type"))
        .select(*scope, "all_indices", "field", F.explode("by_type").alias("type", "spec"))
    )


def field_types(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Field capabilities, one row per field and type of a response, however many indices it is about.

    Enough for the field report and the live field list, unless they are narrowed to some indices.
    """
    return _field_specs(responses, scope).select(*scope, "field", "type", "spec.aggregatable", "spec.searchable")


def field_type_indices(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The indices that a response lists by field and type, which it does only where types differ.

    Enough for the conflicts within a response; ``field_caps`` is for conflicts between several.
    """
    return _field_specs(responses, scope).select(
        *scope, F.explode("spec.indices").alias("index_name"), "field", "type", "spec.aggregatable", "spec.searchable"
    )


def field_caps(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Field capabilities, one row per field, type and index, for reports narrowed to some indices.

    Where a response lists no indices, the field is taken to be of that type in all of them,
    so this has as many rows as fields times indices.
    """
    indices = F.explode(F.coalesce("spec.indices", "all_indices")).alias("index_name")
    return _field_specs(responses, scope).select(*scope, indices, "field", "type", "spec.aggregatable", "spec.searchable")


# ---------------------------------------------------------------------------
# Saved objects
# ---------------------------------------------------------------------------


def _titled(objects: DataFrame, scope: Sequence[str]) -> DataFrame:
    title = J.as_text(J.parsed(F.col("attributes")), "title")
    return objects.select(
        *scope, "type", "id", S.first_present(title, F.lit(NO_TITLE)).alias("title"), "attributes", "references", "workspaces",
        "updated_at",
    )


def _no_references() -> Column:
    return F.array().cast(T.REFERENCES)


def objects_from_pages(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Pages of a saved-object search -> saved objects; missing keys get their defaults."""
    return _placed_pages(responses, scope).drop("place")


def _placed_pages(responses: DataFrame, scope: Sequence[str]) -> DataFrame:
    spaces = F.when(F.size("o.workspaces") > 0, F.col("o.workspaces")).otherwise(F.col("o.namespaces"))
    body = F.from_json("value", T.FIND_PAGE)
    listed = responses.select("*", F.posexplode(body["saved_objects"]).alias("position", "o"))
    rows = listed.select(
        *scope,
        _place(listed, F.col("position")),
        "o.type",
        "o.id",
        F.coalesce("o.attributes", F.lit("{}")).alias("attributes"),
        F.coalesce("o.references", _no_references()).alias("references"),
        without_default_workspace(spaces).alias("workspaces"),
        F.coalesce("o.updated_at", F.lit("")).alias("updated_at"),
    )
    return _titled(rows, [*scope, "place"])


def objects_from_documents(documents: DataFrame, types: Sequence[str] = (), scope: Sequence[str] = ()) -> DataFrame:
    """Raw documents ``_id, _source`` -> saved objects.

    The id loses its ``type:`` prefix; attributes sit under the key the type names, and
    anything there but an object counts as no attributes.
    """
    return _placed_documents(documents, types, scope).drop("place")


def _placed_documents(documents: DataFrame, types: Sequence[str], scope: Sequence[str]) -> DataFrame:
    kind = F.col("source")["type"]
    own = F.try_element_at(F.col("source"), kind)
    space = S.blank_to_null(F.col("source")["namespace"])
    place = F.col("place") if "place" in documents.columns else _place(documents, F.lit(None))
    rows = documents.select(*scope, place, "_id", _entries(F.col("_source")).alias("source"))
    if types:
        rows = rows.filter(kind.isin(*types))
    rows = rows.select(
        *scope,
        "place",
        kind.alias("type"),
        F.substring("_id", F.locate(":", F.col("_id")) + 1, F.length("_id")).alias("id"),
        F.when(J.object_from_text(own).isNotNull(), own).otherwise("{}").alias("attributes"),
        F.coalesce(F.from_json(F.col("source")["references"], T.REFERENCES), _no_references()).alias("references"),
        without_default_workspace(F.array_compact(F.array(space))).alias("workspaces"),
        F.coalesce(F.col("source")["updated_at"], F.lit("")).alias("updated_at"),
    )
    return _titled(rows, [*scope, "place"])


def search_documents(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Search response -> raw documents ``_id, _source`` and the ``place`` where each stood."""
    hits = responses.select("*", F.posexplode(F.from_json("value", T.RAW_SEARCH)["hits"]["hits"]).alias("position", "hit"))
    return hits.select(*scope, _place(hits, F.col("position")), "hit.*")


def saved_objects(
    pages: DataFrame | None = None, documents: DataFrame | None = None, types: Sequence[str] = (), scope: Sequence[str] = ()
) -> DataFrame:
    """One table from either layout, or from both, with one row per object: the last of its rows, documents after pages.

    Rows follow each other by file and place in the file; rows of one place, and those of which no place is
    known, by their contents. So the row that stays doesn't depend on how the rows are dealt out.
    """
    frames = []
    if pages is not None:
        found = _placed_pages(pages, scope)
        frames.append(found.filter(F.col("type").isin(*types)) if types else found)
    if documents is not None:
        frames.append(_placed_documents(documents, types, scope))
    if not frames:
        raise ValueError("saved_objects needs at least one source")
    columns = [c for c in frames[0].columns if c != "place"]
    contents = F.to_json(F.struct(*columns)).alias("contents")
    placed = [f.withColumn("place", F.struct(F.lit(k).alias("layout"), "place.file", "place.position", contents)) for k, f in enumerate(frames)]
    rows = reduce(DataFrame.unionByName, placed)
    kept = F.struct(*columns)
    return rows.groupBy(*[F.col(c).alias(f"key_{c}") for c in (*scope, "type", "id")]).agg(F.max_by(kept, "place").alias("kept")).select("kept.*")


def export_records(lines: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Lines of an export (column ``value``) -> records to import.

    Blank lines and header lines are skipped; a line that is no JSON object fails the read.
    """
    malformed = F.raise_error(F.concat(F.lit("malformed export line: "), F.left("value", F.lit(200))))
    entries = F.coalesce(J.object_from_text(F.col("value")), malformed.cast(J.OBJECT))
    return (
        lines.filter(F.btrim(F.col("value"), F.lit(" \t\n\r\f\x0b")) != "")
        .filter(~F.map_contains_key(entries, HEADER_KEY))
        .select(*[c for c in lines.columns if c != "value"], F.from_json("value", T.EXPORT_RECORD).alias("record"))
        .select(*[c for c in lines.columns if c != "value"], "record.*")
    )


def read_export(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """NDJSON files -> records, numbered in ``ordinal`` by argument, file name and place in the file.

    Directories are read in depth; the type directories of an export are no extra column.
    """
    wanted = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    lines = [
        spark.read.option("recursiveFileLookup", "true").text(path).select(
            "value",
            F.struct(
                F.lit(place).alias("argument"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("ordinal"),
        )
        for place, path in enumerate(wanted)
    ]
    return export_records(reduce(DataFrame.unionByName, lines))


def detectors(responses: DataFrame, ids: Sequence[str] = (), scope: Sequence[str] = ()) -> DataFrame:
    hits = search_documents(responses, scope)
    if ids:
        hits = hits.filter(F.col("_id").isin(*ids))
    return hits.select(*scope, F.col("_id").alias("id"), F.coalesce("_source", F.lit("{}")).alias("detector"))


def workspaces(responses: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Workspace list in either of its shapes: ``result.workspaces`` or ``result``, or the same at the top."""
    doc = J.parsed(F.col("value"))
    result = F.coalesce(F.try_variant_get(doc, "$.result", "variant"), doc)
    found = F.coalesce(F.try_variant_get(result, "$.workspaces", "variant"), result)
    items = J.as_list(found)
    wrong = F.raise_error(F.lit("unexpected workspace list")).cast(J.LIST)
    return (
        responses.select(*scope, F.explode(F.coalesce(items, wrong)).alias("w"))
        .select(*scope, *[J.as_text(F.col("w"), key).alias(key) for key in ("id", "name", "description")])
    )
