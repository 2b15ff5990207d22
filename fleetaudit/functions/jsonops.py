"""JSON documents as VARIANT columns: typed access, rewriting, bounded descent.

Documents here have no fixed shape: a key may hold text in one row and an object in
the next. VARIANT keeps that apart, so every helper asks for one type and gives NULL
for any other.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetaudit.functions.scalars import blank_to_null, first_present

OBJECT = "map<string,variant>"
LIST = "array<variant>"
END_MARK = "~end of document~"

# Where a template's settings name its lifecycle policy.
POLICY_PATH = ("index", "plugins", "index_state_management", "policy_id")
POLICY_KEY = "index.plugins.index_state_management.policy_id"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def parsed(text: Column) -> Column:
    """Text as VARIANT; NULL when it is not exactly one JSON value.

    The parser stops after the first value and would let ``[1] rubbish`` pass. With an
    end mark behind the text, all of it has to be that one value.
    """

    def whole(framed: Column) -> Column:
        ends = (F.try_variant_get(framed, "$[1]", "string") == END_MARK) & F.try_variant_get(framed, "$[2]", "variant").isNull()
        return F.when(ends, F.try_variant_get(framed, "$[0]", "variant"))

    return let(F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{END_MARK}"]'))), whole)


def is_json(text: Column) -> Column:
    return parsed(text).isNotNull()


def _path(keys: tuple[str, ...]) -> str:
    return "$" + "".join(f"['{key}']" for key in keys)


def as_object(value: Column, *keys: str) -> Column:
    """Object at a path as a map; NULL for any other type."""
    return F.try_variant_get(value, _path(keys), OBJECT)


def as_list(value: Column, *keys: str) -> Column:
    """Array at a path; NULL for any other type."""
    return F.try_variant_get(value, _path(keys), LIST)


def as_text(value: Column, *keys: str) -> Column:
    """String at a path; NULL for numbers, objects and the rest."""
    return F.when(
        F.schema_of_variant(F.try_variant_get(value, _path(keys), "variant")) == "STRING",
        F.try_variant_get(value, _path(keys), "string"),
    )


def shown(value: Column, key: str, missing: str) -> Column:
    """A value as it prints in a message: the text for an absent key, ``None`` for a JSON null."""
    node = F.try_variant_get(value, _path((key,)), "variant")
    return (
        F.when(node.isNull(), F.lit(missing))
        .when(F.is_variant_null(node), F.lit("None"))
        .otherwise(F.coalesce(F.try_variant_get(value, _path((key,)), "string"), F.to_json(node)))
    )


def is_truthy(value: Column) -> Column:
    """False for null, false, zero and anything empty."""
    return F.coalesce(~F.to_json(value).isin("null", "false", "0", "0.0", '""', "[]", "{}"), F.lit(False))


def empty_object() -> Column:
    return F.expr("map_from_arrays(cast(array() AS array<string>), cast(array() AS array<variant>))")


def object_from_text(text: Column) -> Column:
    """JSON object text as a map of VARIANT; NULL when it is anything else."""
    return as_object(parsed(text))


def to_text(obj: Column) -> Column:
    """A map of VARIANT back to JSON text, keys sorted so that equal objects read equal."""
    return F.to_json(F.call_function("to_variant_object", obj))


def with_key(obj: Column, key: str, value: Column) -> Column:
    return F.map_concat(without_key(obj, key), F.create_map(F.lit(key), value))


def without_key(obj: Column, key: str) -> Column:
    return F.map_filter(obj, lambda k, _: k != key)


def object_variant(obj: Column) -> Column:
    return F.call_function("to_variant_object", obj)


def list_variant(items: Column) -> Column:
    return F.call_function("to_variant_object", items)


def text_variant(text: Column) -> Column:
    return text.cast("variant")


def changed_at(value: Column, path: Sequence[str | Column], change: Callable[[Column], Column]) -> Column:
    """A VARIANT with the part at a path changed and all else as it is.

    A step is a key or, as a column, a position from 0. ``change`` gets the part, NULL where
    there is none; what it gives is put there, and NULL takes a key out. Objects on the way that
    are missing come into being; a position that a list doesn't have changes nothing.
    """
    if not path:
        return change(value)
    step, rest = path[0], path[1:]
    if isinstance(step, str):

        def put(obj: Column) -> Column:
            return let(changed_at(obj[step], rest, change), lambda new: F.when(new.isNull(), without_key(obj, step)).otherwise(with_key(obj, step, new)))

        return object_variant(let(F.coalesce(as_object(value), empty_object()), put))
    items = F.coalesce(as_list(value), F.array().cast(LIST))
    return list_variant(F.transform(items, lambda item, i: F.when(i == step, changed_at(item, rest, change)).otherwise(item)))


# ---------------------------------------------------------------------------
# Conditions of a lifecycle policy
# ---------------------------------------------------------------------------


def apply_conditions(current: Column, updates: Column) -> Column:
    """Merge condition updates: null is ignored, the text ``none`` removes a key, anything else sets it."""

    def merge(_: Column, old: Column, new: Column) -> Column:
        absent = new.isNull() | F.coalesce(F.is_variant_null(new), F.lit(True))
        return F.when(absent, old).when(F.coalesce(F.lower(as_text(new)) == "none", F.lit(False)), F.lit(None)).otherwise(new)

    merged = F.map_zip_with(F.coalesce(current, empty_object()), F.coalesce(updates, empty_object()), merge)
    return F.map_filter(merged, lambda _, v: v.isNotNull())


# ---------------------------------------------------------------------------
# Descent through a document, one pass and no shuffle
# ---------------------------------------------------------------------------


def nesting(text: Column) -> Column:
    """How deep the brackets of a JSON text are nested; those inside its strings don't count."""
    bare = F.regexp_replace(F.regexp_replace(text, r"(?s)\\.", ""), '"[^"]*"', "")
    brackets = F.split(F.regexp_replace(bare, r"[^\[\]{}]+", ""), "")
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("most"))

    def count(s: Column, bracket: Column) -> Column:
        now = s["open"] + F.when(bracket.isin("[", "{"), 1).when(bracket == "", 0).otherwise(-1)
        return F.struct(now.alias("open"), F.greatest(s["most"], now).alias("most"))

    return F.aggregate(brackets, start, count, lambda s: s["most"])


def _descend(text: Column, start: Column, step: Callable[[Column], Column]) -> Column:
    """Walk a document level by level inside one row.

    ``start`` is the array of nodes of the first level; ``step`` maps the nodes of a level
    to a struct of the next ``level`` and of the texts ``found`` on this one. There are as
    many rounds as the document is deep.
    """
    rounds = F.greatest(F.lit(1), F.coalesce(nesting(text), F.lit(1)))
    state = F.struct(start.alias("level"), F.array().cast("array<string>").alias("found"))
    walked = F.aggregate(
        F.sequence(F.lit(1), rounds),
        state,
        lambda s, _: let(
            step(s["level"]), lambda n: F.struct(n["level"].alias("level"), F.concat(s["found"], n["found"]).alias("found"))
        ),
    )
    return walked["found"]


def mapping_paths(properties: Column) -> Column:
    """Dotted field paths of a mapping's text: object parents, leaves and multi-fields."""

    def nodes(obj: Column, prefix: Column) -> Column:
        entries = F.map_entries(F.coalesce(obj, empty_object()))
        objects = F.filter(entries, lambda e: as_object(e["value"]).isNotNull())
        return F.transform(objects, lambda e: F.struct(F.concat(prefix, e["key"]).alias("path"), e["value"].alias("node")))

    def paths(n: Column) -> Column:
        subs = F.map_keys(F.coalesce(as_object(n["node"], "fields"), empty_object()))
        return F.concat(F.array(n["path"]), F.transform(subs, lambda sub: F.concat(n["path"], F.lit("."), sub)))

    def step(level: Column) -> Column:
        below = F.transform(level, lambda n: nodes(as_object(n["node"], "properties"), F.concat(n["path"], F.lit("."))))
        return F.struct(F.flatten(below).alias("level"), F.flatten(F.transform(level, paths)).alias("found"))

    return F.array_distinct(_descend(properties, nodes(as_object(parsed(properties)), F.lit("")), step))


#: Keys that a VARIANT path can spell; any other is looked up in the object as a map.
PLAIN_KEY = r"\A[A-Za-z0-9_@-]+\z"


def member(obj: Column, key: Column) -> Column:
    """The value at a key that is itself a column; NULL where there is none or ``obj`` is no object."""
    return F.when(F.rlike(key, F.lit(PLAIN_KEY)), F.try_variant_get(obj, F.concat(F.lit("$."), key), "variant")).otherwise(as_object(obj)[key])


def holds_path(properties: Column, path: Column) -> Column:
    """Whether one path is among the ``mapping_paths`` of a mapping (VARIANT), found by walking that path alone.

    Keys may hold dots themselves, so from every node that is reached each longer stretch of the
    rest is tried as a key. A mapping's size doesn't matter, only the number of parts of the path.
    """
    parts = F.split(path, r"\.", -1)

    def key(after: Column, upto: Column) -> Column:
        return F.array_join(F.slice(parts, after + 1, upto - after), ".")

    def reached(at: Column, node: Column) -> Column:
        is_object = F.startswith(F.schema_of_variant(node), F.lit("OBJECT<"))
        inside = {name: F.try_variant_get(node, _path((name,)), "variant").alias(name) for name in ("properties", "fields")}
        return F.when(is_object, F.struct(at.alias("at"), *inside.values()))

    def onward(nodes: Column, upto: Column) -> Column:
        found = F.transform(nodes, lambda n: let(member(n["properties"], key(n["at"], upto)), lambda node: reached(upto, node)))
        return F.concat(nodes, F.array_compact(found))

    start = F.array(F.struct(F.lit(0).alias("at"), properties.alias("properties"), F.lit(None).cast("variant").alias("fields")))

    def ends(nodes: Column) -> Column:
        n = F.size(parts)
        return F.exists(nodes, lambda s: (s["at"] == n) | ((s["at"] < n) & member(s["fields"], key(s["at"], n)).isNotNull()))

    return F.aggregate(F.sequence(F.lit(1), F.size(parts)), start, onward, ends)


#: Stand for an escaped backslash and an escaped quote; written JSON has no such characters of its own.
BACKSLASH, QUOTE = "\x01", "\x02"


def values_of_key(document: Column, key: str = "field") -> Column:
    """Every text held by ``key`` at any depth of a JSON text, repeats kept.

    The document is parsed and written again, which leaves one spelling of each key, the last of
    equal keys, and no spaces. In that text every quoted string is looked at once, together with the
    string it is the key of, if it is; however deep it lies, a key is told by what follows it.
    """
    name = json.dumps(key, ensure_ascii=False) + ":"
    told = F.replace(F.replace(F.to_json(parsed(document)), F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))
    pairs = F.filter(F.regexp_extract_all(told, F.lit('"[^"]*+"(?::"[^"]*+")?'), F.lit(0)), lambda pair: F.startswith(pair, F.lit(name + '"')))

    def value(pair: Column) -> Column:
        quoted = F.substring(pair, len(name) + 1, F.length(pair))
        escaped = F.replace(F.replace(quoted, F.lit(BACKSLASH), F.lit("\\\\")), F.lit(QUOTE), F.lit('\\"'))
        plain = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
        return F.when(F.contains(escaped, F.lit("\\")), F.try_parse_json(escaped).cast("string")).otherwise(plain)

    return F.coalesce(F.transform(pairs, value), F.array().cast("array<string>"))


# ---------------------------------------------------------------------------
# Template settings
# ---------------------------------------------------------------------------


def settings_policy(settings: Column) -> Column:
    """Policy named by a template's settings text, nested form first, then the dotted key."""
    return let(
        parsed(settings),
        lambda doc: first_present(
            F.try_variant_get(doc, _path(POLICY_PATH), "string"), F.try_variant_get(doc, _path((POLICY_KEY,)), "string")
        ),
    )


def with_settings_policy(settings: Column, policy_id: Column) -> Column:
    """Settings text with the policy set, or taken out when ``policy_id`` says ``none``.

    Only the nested form is written, and objects that a removal empties are removed too.
    Readers would prefer a key in the dotted form, so that one never stays.
    """

    def child(parent: Column, key: str) -> Column:
        return F.coalesce(as_object(parent[key]), empty_object())

    def below(parent: Column, key: str, change: Callable[[Column], Column], prune: bool = True) -> Column:
        """The parent with one of its objects changed, or without it when the change empties it."""

        def put(changed: Column) -> Column:
            kept = with_key(parent, key, object_variant(changed))
            return F.when(F.size(changed) == 0, without_key(parent, key)).otherwise(kept) if prune else kept

        return let(change(child(parent, key)), put)

    def policy(ism: Column) -> Column:
        return F.when(F.lower(policy_id) == "none", without_key(ism, "policy_id")).otherwise(
            with_key(ism, "policy_id", text_variant(policy_id))
        )

    def plugins(obj: Column) -> Column:
        return below(obj, "index_state_management", policy)

    def index(obj: Column) -> Column:
        return below(obj, "plugins", plugins)

    doc = without_key(F.coalesce(object_from_text(settings), empty_object()), POLICY_KEY)
    return let(doc, lambda d: to_text(below(d, "index", index, prune=False)))


# ---------------------------------------------------------------------------
# Saved-object attributes
# ---------------------------------------------------------------------------


def search_source_text(attributes: Column) -> Column:
    """The search-source JSON text inside an object's attributes (VARIANT)."""
    return as_text(attributes, "kibanaSavedObjectMeta", "searchSourceJSON")


def _stripped_source(source: Column) -> Column:
    """A search source (map of VARIANT) without its pinned query text and filters."""
    query = as_object(source["query"])
    blank = with_key(query, "query", text_variant(F.lit("")))
    no_query = F.when(query.isNotNull(), with_key(source, "query", object_variant(blank))).otherwise(source)
    has_filter = F.map_contains_key(source, "filter")
    return F.when(has_filter, with_key(no_query, "filter", F.parse_json(F.lit("[]")))).otherwise(no_query)


def stripped_search_source(text: Column) -> Column:
    """Search-source text without its pinned query and filters; unreadable text is kept."""
    return F.coalesce(let(object_from_text(text), lambda source: to_text(_stripped_source(source))), text)


def stripped_attributes(attributes: Column) -> Column:
    """Attributes text as VARIANT, with ``stripped_search_source`` applied to the text inside.

    The text is parsed once, and only where it names a search source is the result rebuilt.
    """

    def rewrite(doc: Column) -> Column:
        def put(meta: Column) -> Column:
            source = as_text(meta["searchSourceJSON"])
            new_meta = with_key(meta, "searchSourceJSON", text_variant(stripped_search_source(source)))
            return object_variant(with_key(as_object(doc), "kibanaSavedObjectMeta", object_variant(new_meta)))

        named = as_text(doc, "kibanaSavedObjectMeta", "searchSourceJSON").isNotNull()
        return F.when(named, let(as_object(doc, "kibanaSavedObjectMeta"), put)).otherwise(doc)

    return let(parsed(attributes), rewrite)


def cached_field_count(fields: Column) -> Column:
    """Entries of a cached field list kept as JSON text: blank is 0, unreadable is NULL."""
    doc = parsed(fields)
    return F.when(blank_to_null(fields).isNull(), F.lit(0)).otherwise(
        F.coalesce(F.size(as_list(doc)), F.size(as_object(doc)), F.length(as_text(doc)))
    )
