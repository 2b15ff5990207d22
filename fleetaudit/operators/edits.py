"""Versioned edits of policy and template documents, in bulk.

An edit table is joined to the policy table. Every edit yields one row with ``before``,
``after``, ``changed``, ``error``, ``seq_no`` and ``new_seq_no`` next to the new value of
the edited column; ``commit`` writes the changed ones back. An edit may carry
``expected_seq_no`` and ``expected_primary_term``, the version its author read: if either
differs from the policy's by now, the edit is a conflict and changes nothing. Of several edits that would change one policy only
the first by ``edit_no`` does; they all were made for the same version, so the others are
conflicts too. Where numbers tie or that column is missing, the contents of the edits
decide, so the outcome doesn't depend on how the table is laid out.

Where the policy table has the whole text of a policy in ``document``, an edit patches that text
at the paths it changes; keys that no column names stay, at any depth.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetaudit.functions import jsonops as J
from fleetaudit.functions import scalars as S
from fleetaudit.sources import schemas as T

# Defaults of a new policy and of a new claim, and the error texts.
DEFAULT_STATE = "keep"
DEFAULT_PRIORITY = 100
DEFAULT_DESCRIPTION = "No-op policy: indices stay in '%s' and are never modified."
NO_POLICY = "Policy '%s' not found"
CONFLICT = "version conflict"
NO_STATE = "State '%s' not found in policy '%s'"
NO_ROLLOVER = "State '%s' has no rollover action; add one to the policy first"
NOTHING_TO_REMOVE = "All conditions were 'none' and no matching transition exists to remove"
OUT_OF_RANGE = "entry-index %d is out of range (%d entries)"
EXISTS = "Policy '%s' already exists"


def first_edit_per_policy(edits: DataFrame, order: str | None = None, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Splits edits into the first one of each policy and those that lose against it.

    All were read at the same version, so only one can be written; the rest are conflicts.
    """
    ranked = edits.withColumn("edit_place", _place(edits, order)).withColumn("edit_rank", _rank([*scope, "policy_id"]))
    first, lost = (ranked.filter(test).drop("edit_place", "edit_rank") for test in ("edit_rank = 1", "edit_rank > 1"))
    return first, lost.withColumn("error", F.lit(CONFLICT))


def _place(edits: DataFrame, order: str | None) -> Column:
    """What decides between rivals: the order column, then the contents."""
    return F.struct((F.col(order) if order else F.lit(None)).alias("order"), F.to_json(F.struct(*edits.columns)).alias("contents"))


def _rank(keys: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy("edit_place"))


def _edited(edits: DataFrame, policies: DataFrame, scope: Sequence[str]) -> DataFrame:
    placed = edits.withColumn("edit_place", _place(edits, "edit_no" if "edit_no" in edits.columns else None))
    joined = placed.join(policies.withColumn("found", F.lit(True)), [*scope, "policy_id"], "left")
    moved_on = F.lit(False)
    for version in ("seq_no", "primary_term"):
        if f"expected_{version}" in edits.columns:
            moved_on = moved_on | F.coalesce(F.col(f"expected_{version}") != F.col(version), F.lit(False))
    return joined.withColumn("moved_on", moved_on)


def _outcome(
    df: DataFrame, column: str, error: Column, before: Column, after: Column, key: Column, new_key: Column, scope: Sequence[str],
    patch: Callable[[Column], Column],
) -> DataFrame:
    """Adds the outcome columns. ``key`` and ``new_key`` are comparable forms of before and after.

    ``after`` is expected in the column ``new``, which is dropped in favour of ``column``.
    ``patch`` makes the same change in a policy's whole document, a VARIANT.
    """
    documents = "document" in df.columns
    patched = F.coalesce(F.to_json(J.let(J.parsed(F.col("document")), patch)), F.col("document")) if documents else None
    problem = (
        F.when(F.col("found").isNull(), F.format_string(NO_POLICY, "policy_id"))
        .when(F.col("moved_on"), CONFLICT)
        .otherwise(error)
    )
    return (
        df.withColumn("error", problem)
        .withColumn("changed", F.col("error").isNull() & ~key.eqNullSafe(new_key))
        .withColumn("rival", F.col("changed") & (_rank([*scope, "policy_id", "changed"]) > 1))
        .withColumn("error", F.when(F.col("rival"), CONFLICT).otherwise(F.col("error")))
        .withColumn("changed", F.col("changed") & ~F.col("rival"))
        .select(
            *scope,
            "policy_id",
            before.alias("before"),
            F.when(F.col("error").isNull(), after).alias("after"),
            "seq_no",
            (F.col("seq_no") + F.col("changed").cast("int")).alias("new_seq_no"),
            "changed",
            "error",
            F.when(F.col("changed"), F.col("new")).otherwise(F.col(column)).alias(column),
            *([F.when(F.col("changed"), patched).otherwise(F.col("document")).alias("document")] if documents else []),
        )
    )


def commit(policies: DataFrame, outcome: DataFrame, column: str, scope: Sequence[str] = ()) -> DataFrame:
    """The policy table with all changed rows of an outcome written in, whole documents too, versions moved on."""
    keys = [*scope, "policy_id"]
    written = [c for c in (column, "document") if c in policies.columns and c in outcome.columns]
    changed = outcome.filter("changed").select(*keys, F.col("new_seq_no"), *[F.col(c).alias(f"new_{c}") for c in written])
    merged = policies.join(changed, keys, "left")
    hit = F.col("new_seq_no").isNotNull()
    new = {"seq_no": F.coalesce("new_seq_no", "seq_no")} | {c: F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)) for c in written}
    return merged.select(*[new[c].alias(c) if c in new else F.col(c) for c in policies.columns])


def policy_documents(policies: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Policies as they are to be stored: ``policy_id, seq_no, primary_term, document``.

    A policy that was read with its whole text in ``document`` is stored as that text, which every
    edit has kept up to date; one that no edit touched goes back as it came. A policy without
    such text, a new one, is built from its columns.
    """

    def transition(t: Column) -> Column:
        return F.struct(t["state_name"].alias("state_name"), J.object_variant(t["conditions"]).alias("conditions"))

    def state(s: Column) -> Column:
        moves = F.transform(s["transitions"], transition).alias("transitions")
        return F.struct(s["name"].alias("name"), F.transform(s["actions"], J.parsed).alias("actions"), moves)

    built = F.to_json(F.struct("description", "default_state", F.transform("states", state).alias("states"), "ism_template"))
    document = F.coalesce("document", built) if "document" in policies.columns else built
    return policies.select(*scope, "policy_id", "seq_no", "primary_term", document.alias("document"))


def _first_index(array: Column, test) -> Column:
    """Position of the first element that passes the test, 0 when none does."""
    return F.coalesce(F.array_position(F.transform(array, lambda x: F.coalesce(test(x), F.lit(False))), True), F.lit(0))


def _replaced(array: Column, position: Column, change) -> Column:
    """The array with the element at a 1-based position changed."""
    return F.transform(array, lambda x, i: F.when(i + 1 == position, change(x)).otherwise(x))


# ---------------------------------------------------------------------------
# New policies
# ---------------------------------------------------------------------------


def create_policies(requests: DataFrame, policies: DataFrame, order: str | None = None, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Policies with one state and no actions, from ``policy_id, description, state, patterns, priority``.

    Returns the new policies and the rejected requests: those whose policy exists, and,
    of several requests for one new policy, all but the first by ``order`` and contents.
    """
    keys = [*scope, "policy_id"]
    taken = requests.join(policies.select(*keys), keys, "left_semi")
    new = requests.join(policies.select(*keys), keys, "left_anti")
    new, late = first_edit_per_policy(new, order, scope)
    taken = taken.unionByName(late.drop("error"))
    state = S.first_present(F.col("state"), F.lit(DEFAULT_STATE))
    no_actions, no_transitions = F.array().cast("array<string>"), F.array().cast(T.TRANSITIONS)
    claim = F.struct(
        F.col("patterns").alias("index_patterns"),
        F.coalesce("priority", F.lit(DEFAULT_PRIORITY)).cast("int").alias("priority"),
        F.lit(None).cast("bigint").alias("last_updated_time"),
    )
    created = new.select(
        *keys,
        F.lit(0).cast("bigint").alias("seq_no"),
        F.lit(1).cast("bigint").alias("primary_term"),
        S.first_present(F.col("description"), F.format_string(DEFAULT_DESCRIPTION, state)).alias("description"),
        state.alias("default_state"),
        F.array(F.struct(state.alias("name"), no_actions.alias("actions"), no_transitions.alias("transitions"))).alias("states"),
        F.when(F.size("patterns") > 0, F.array(claim)).alias("ism_template"),
    )
    return created, taken.withColumn("error", F.format_string(EXISTS, "policy_id"))


def claimed_patterns(policies: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Index patterns each policy claims, one per row."""
    return policies.select(*scope, "policy_id", F.explode("ism_template").alias("entry")).select(
        *scope, "policy_id", F.col("entry.priority").alias("priority"), F.explode("entry.index_patterns").alias("index_pattern")
    )


# ---------------------------------------------------------------------------
# Rollover conditions and transitions
# ---------------------------------------------------------------------------


def set_rollover(edits: DataFrame, policies: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Edits ``policy_id, state_name, conditions`` (map of VARIANT) of a state's first rollover action."""
    states = F.col("states")
    df = _edited(edits, policies, scope).withColumn("wanted", S.first_present(F.col("state_name"), F.lit("hot")))
    df = df.withColumn("s", _first_index(states, lambda s: s["name"] == F.col("wanted")).cast("int"))
    df = df.withColumn("actions", F.when(F.col("s") > 0, F.get(states, F.col("s") - 1)["actions"]))
    is_rollover = lambda a: F.map_contains_key(J.object_from_text(a), "rollover")
    df = df.withColumn("a", _first_index(F.col("actions"), is_rollover).cast("int"))
    df = df.withColumn("action", J.object_from_text(F.when(F.col("a") > 0, F.get(F.col("actions"), F.col("a") - 1))))
    df = df.withColumn("old", F.coalesce(J.as_object(F.col("action")["rollover"]), J.empty_object()))
    df = df.withColumn("merged", J.apply_conditions(F.col("old"), F.col("conditions")))
    written = J.to_text(J.with_key(F.col("action"), "rollover", J.object_variant(F.col("merged"))))
    new = _replaced(
        states,
        F.col("s"),
        lambda s: s.withField("actions", _replaced(s["actions"], F.col("a"), lambda _: written)),
    )
    error = F.when(F.col("s") == 0, F.format_string(NO_STATE, "wanted", "policy_id")).when(
        F.col("a") == 0, F.format_string(NO_ROLLOVER, "wanted")
    )
    before = F.when(F.col("a") > 0, J.to_text(F.col("old")))
    after = J.to_text(F.col("merged"))
    path = ("states", F.col("s") - 1, "actions", F.col("a") - 1, "rollover")
    patch = lambda document: J.changed_at(document, path, lambda _: J.object_variant(F.col("merged")))
    return _outcome(df.withColumn("new", new), "states", error, before, after, before, after, scope, patch)


def _transition_text(transitions: Column) -> Column:
    """Transitions as JSON text, comparable because condition keys come out sorted."""
    texts = F.transform(
        transitions,
        lambda t: F.to_json(
            F.struct(
                t["state_name"].alias("state_name"), J.object_variant(F.coalesce(t["conditions"], J.empty_object())).alias("conditions")
            )
        ),
    )
    return F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))


def set_transition(edits: DataFrame, policies: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Edits ``policy_id, from_state, to_state, conditions, position`` (``first`` or ``last``).

    A transition is the one to edit when its target and its exact set of condition keys
    agree; it goes when its last condition goes. Without one, a new one is put in.
    """
    states = F.col("states")
    no_transitions = F.array().cast(T.TRANSITIONS)
    df = _edited(edits, policies, scope)
    df = df.withColumn("s", _first_index(states, lambda s: s["name"] == F.col("from_state")).cast("int"))
    df = df.withColumn(
        "old", F.coalesce(F.when(F.col("s") > 0, F.get(states, F.col("s") - 1)["transitions"]), no_transitions)
    )
    fits = lambda t: (t["state_name"] == F.col("to_state")) & S.same_keys(t["conditions"], F.col("conditions"))
    df = df.withColumn("t", _first_index(F.col("old"), fits).cast("int"))
    df = df.withColumn("base", F.when(F.col("t") > 0, F.get(F.col("old"), F.col("t") - 1)["conditions"]))
    df = df.withColumn("merged", J.apply_conditions(F.col("base"), F.col("conditions")))
    fresh = F.array(F.struct(F.col("to_state").alias("state_name"), F.col("merged").alias("conditions")))
    removed = F.filter(F.col("old"), lambda _, i: i + 1 != F.col("t"))
    changed = _replaced(F.col("old"), F.col("t"), lambda t: t.withField("conditions", F.col("merged")))
    edited = (
        F.when((F.col("t") > 0) & (F.size("merged") == 0), removed)
        .when(F.col("t") > 0, changed)
        .when(F.coalesce("position", F.lit("first")) == "first", F.concat(fresh, F.col("old")))
        .otherwise(F.concat(F.col("old"), fresh))
    )
    df = df.withColumn("edited", edited)
    new = _replaced(states, F.col("s"), lambda s: s.withField("transitions", F.col("edited")))
    error = F.when(F.col("s") == 0, F.format_string(NO_STATE, "from_state", "policy_id")).when(
        (F.col("t") == 0) & (F.size("merged") == 0), NOTHING_TO_REMOVE
    )
    before, after = F.when(F.col("s") > 0, _transition_text(F.col("old"))), _transition_text(F.col("edited"))
    conditions = J.object_variant(F.col("merged"))

    def transitions(found: Column) -> Column:
        items = F.coalesce(J.as_list(found), F.array().cast(J.LIST))
        one = F.array(J.object_variant(F.create_map(F.lit("state_name"), J.text_variant(F.col("to_state")), F.lit("conditions"), conditions)))
        return J.list_variant(
            F.when((F.col("t") > 0) & (F.size("merged") == 0), F.filter(items, lambda _, i: i + 1 != F.col("t")))
            .when(F.col("t") > 0, _replaced(items, F.col("t"), lambda t: J.changed_at(t, ["conditions"], lambda _: conditions)))
            .when(F.coalesce("position", F.lit("first")) == "first", F.concat(one, items))
            .otherwise(F.concat(items, one))
        )

    patch = lambda document: J.changed_at(document, ("states", F.col("s") - 1, "transitions"), transitions)
    return _outcome(df.withColumn("new", new), "states", error, before, after, before, after, scope, patch)


# ---------------------------------------------------------------------------
# Claims
# ---------------------------------------------------------------------------


def edit_ism_template(edits: DataFrame, policies: DataFrame, now_ms: int | Column | None = None, scope: Sequence[str] = ()) -> DataFrame:
    """Changes to the index patterns and priorities under a policy's ``ism_template``.

    Edit columns: ``replace`` (array of ``old, new``), ``remove``, ``add`` (arrays of
    patterns), ``entry_index`` and ``priority``. Replacements come first, then removals,
    which drop the entries they empty, then additions and priority at the entry index,
    moved down by the entries dropped before it. Changed entries get a new update time.
    """
    if now_ms is None:
        now_ms = F.unix_millis(F.current_timestamp())
    now = (now_ms if isinstance(now_ms, Column) else F.lit(now_ms)).cast("bigint")
    none = F.array().cast("array<string>")
    no_entries = F.array().cast(T.ISM_TEMPLATE)
    has = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))

    df = _edited(edits, policies, scope).withColumn("old", F.coalesce("ism_template", no_entries))
    # Entries know where they stood, so that the document's own entries can be found again.
    placed = F.transform("old", lambda e, i: e.withField("origin", i))
    plain = lambda e: e.dropFields("origin")

    def patterns(entry: Column) -> Column:
        return F.coalesce(entry["index_patterns"], none)

    def renamed(entry: Column) -> Column:
        return F.aggregate(
            F.col("replace"),
            patterns(entry),
            lambda acc, r: F.array_distinct(F.transform(acc, lambda p: F.when(p == r["old"], r["new"]).otherwise(p))),
        )

    replaced = F.transform(placed, lambda e: e.withField("index_patterns", renamed(e)))
    df = df.withColumn("replaced", F.when(has("replace"), replaced).otherwise(placed))

    trimmed = F.transform(
        "replaced",
        lambda e: e.withField("index_patterns", F.filter(patterns(e), lambda p: ~F.array_contains(F.col("remove"), p))),
    )
    df = df.withColumn("trimmed", F.when(has("remove"), trimmed).otherwise(F.col("replaced")))
    start = F.coalesce("entry_index", F.lit(0))
    dropped = F.size(F.filter("trimmed", lambda e, i: (i < start) & (F.size(e["index_patterns"]) == 0)))
    df = df.withColumn("at", F.when(has("remove"), F.greatest(F.lit(0), start - dropped)).otherwise(start))
    df = df.withColumn(
        "left", F.when(has("remove"), F.filter("trimmed", lambda e: F.size(e["index_patterns"]) > 0)).otherwise(F.col("trimmed"))
    )

    blank = F.array(
        F.struct(
            none.alias("index_patterns"), F.lit(DEFAULT_PRIORITY).alias("priority"), F.lit(None).cast("bigint").alias("last_updated_time"),
            F.lit(-1).alias("origin"),
        )
    )
    starts_empty = has("add") & (F.size("left") == 0)
    df = df.withColumn("at", F.when(starts_empty, 0).otherwise(F.col("at")))
    df = df.withColumn("left", F.when(starts_empty, blank).otherwise(F.col("left")))
    touches = has("add") | F.col("priority").isNotNull()
    in_range = (F.col("at") >= 0) & (F.col("at") < F.size("left"))
    error = F.when(touches & ~in_range, F.format_string(OUT_OF_RANGE, F.col("at"), F.size("left")))

    def grown(entry: Column) -> Column:
        added = F.when(has("add"), F.array_distinct(F.concat(patterns(entry), F.col("add")))).otherwise(entry["index_patterns"])
        return entry.withField("index_patterns", added).withField("priority", F.coalesce(F.col("priority"), entry["priority"]))

    df = df.withColumn(
        "edited", F.transform("left", lambda e, i: F.when((i == F.col("at")) & touches, grown(e)).otherwise(e))
    )
    stamped = F.transform(
        "edited",
        lambda e, i: F.when(plain(e).eqNullSafe(F.get(F.col("old"), i)), e).otherwise(e.withField("last_updated_time", now)),
    )
    df = df.withColumn("stamped", stamped).withColumn("new", F.transform("stamped", plain))
    before, after = F.to_json("old"), F.to_json("new")

    def entries(found: Column) -> Column:
        own = F.coalesce(J.as_list(found), F.array().cast(J.LIST))

        def entry(e: Column) -> Column:
            before = F.when(e["origin"] >= 0, F.get(own, e["origin"]))
            same = F.coalesce(plain(e).eqNullSafe(F.when(e["origin"] >= 0, F.get(F.col("old"), e["origin"]))) & before.isNotNull(), F.lit(False))
            parts = F.create_map(
                F.lit("index_patterns"), J.list_variant(patterns(e)), F.lit("priority"), e["priority"].cast("variant"),
                F.lit("last_updated_time"), e["last_updated_time"].cast("variant"))
            named = F.map_filter(parts, lambda _, v: v.isNotNull())
            kept = F.map_filter(F.coalesce(J.as_object(before), J.empty_object()), lambda key, _: ~F.map_contains_key(named, key))
            return F.when(same, before).otherwise(J.object_variant(F.map_concat(kept, named)))

        return J.list_variant(F.transform("stamped", entry))

    patch = lambda document: J.changed_at(document, ["ism_template"], entries)
    return _outcome(df, "ism_template", error, before, after, F.col("old"), F.col("new"), scope, patch)


# ---------------------------------------------------------------------------
# Templates
# ---------------------------------------------------------------------------


def set_template_policy(edits: DataFrame, templates: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Edits ``name, policy_id`` of template settings; the policy ``none`` takes it out.

    Gives ``name, before, after, settings, error`` and, where the templates have their whole text in
    ``body``, that text patched at its settings and nowhere else, to be stored.
    """
    after = F.when(F.lower("policy_id") != "none", F.col("policy_id"))
    body = [c for c in ("body",) if c in templates.columns]
    joined = edits.join(templates.select(*scope, "name", "settings", *body, F.lit(True).alias("found")), [*scope, "name"], "left")
    found = F.col("found").isNotNull()

    def patched(document: Column) -> Column:
        return J.changed_at(document, ("template", "settings"), lambda own: J.parsed(J.with_settings_policy(F.to_json(own), F.col("policy_id"))))
    return joined.select(
        *scope,
        "name",
        J.settings_policy(F.col("settings")).alias("before"),
        F.when(found, after).alias("after"),
        F.when(found, J.with_settings_policy(F.col("settings"), F.col("policy_id"))).alias("settings"),
        *[F.when(found, F.to_json(J.let(J.parsed(F.col(c)), patched))).alias(c) for c in body],
        F.when(~found, F.format_string("template '%s' not found", "name")).alias("error"),
    )
