"""Joining name patterns to names without comparing every pattern to every name.

Each pattern gets an *anchor*, a text that every name it matches must contain at a known
place, and each name is expanded into the anchors it could answer to. Pattern and name
then meet in an equi join:

=========  ======================  ==========================================
kind       pattern                 anchor
=========  ======================  ==========================================
exact      ``logs``                the whole name
prefix     ``logs-*``              the first characters
suffix     ``*-old``               the last characters
any        ``*``                   none, every name matches
ends       ``logs-*-old``          the first characters and the last ones
inner      ``*mid*``               characters of it, then the whole text is looked for
head       ``logs-?*``             the first characters, or a fixed run; then the regex
gram       ``?ab*c``               a fixed run, then the regex
length     ``??``, ``[ab]``        name length, then the regex if there are sets
shape      ``??*``, ``[ab]*``      least name length, then the regex if there are sets
=========  ======================  ==========================================

A fixed run ahead of the first ``*`` lies at a known distance from the start of a name (``after``), one
behind the last ``*`` from its end (``before``), and all of it is the anchor; of a run between two ``*``
it is one of its stretches of 3, 6, 12 or 24 characters (``gram``), the longest that fit.

Names are expanded only for the kinds and lengths that some pattern asks for; that small
set (at most a few lengths per kind) reaches the scan as a scalar subquery.

Where a pattern has several anchors to choose from, it takes the one that the fewest names answer
to. Those counts come from the names themselves, in one pass ahead of the join, and also tell
which anchors so many names answer to that their rows have to be spread over tasks. A pattern that
every name matches takes no part in the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.functions.globs import glob_regex, tokens
from fleetaudit.sources.layout import has_folder, kept

GRAM = 3
#: Longer stretches of a run between two ``*``. Each length that a pattern asks for makes rows of every name.
LONGER_GRAMS = (24, 12, 6)
#: So many names with one anchor go to one task; more are spread over several.
NAMES_PER_TASK = 100_000
CERTAIN = ("exact", "prefix", "suffix", "any", "ends")
FROM_START = ("prefix", "head", "ends")
ANCHOR = ("kind", "size", "tail", "anchor")
HASH = "anchor_hash"


def anchored_patterns(patterns: DataFrame, column: str, scope: Sequence[str] = ()) -> DataFrame:
    """Distinct patterns with ``kind``, ``size``, ``tail`` (size of the second piece) and ``anchor``, and the regex where one is needed.

    ``choices`` are all anchors that a pattern can be found by, the one above among them unless the pattern
    has fixed runs between wildcards. Where ``probe`` is NULL, any of them decides.
    """
    toks, marks = F.col("toks"), F.col("marks")
    kind_of = F.col("kind")

    def piece(start: Column | int, length: Column) -> Column:
        return F.array_join(F.slice(toks, start, length), "")

    # One letter per token: L fixed character, A any run, Q any character, S set.
    mark = F.transform(
        "raw", lambda t: F.when(_is_set(t), "S").when(t == "*", "A").when(t == "?", "Q").otherwise("L")
    )
    head = F.length(F.regexp_extract(marks, "^L*", 0))
    tail = F.length(F.regexp_extract(marks, "L*$", 0))
    # The texts between wildcards with their first places, and the longest of them.
    places = F.when(marks != "", F.sequence(F.lit(1), F.length(marks))).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (F.substr(marks, i, F.lit(1)) == "L") & ((i == 1) | (F.substr(marks, i - 1, F.lit(1)) != "L")))
    length = lambda i: F.length(F.regexp_extract(F.substr(marks, i), "^L*", 0))
    runs = F.transform(starts, lambda i: F.struct(i.alias("at"), piece(i, length(i)).alias("run")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(F.length(r["run"]).alias("length"), r["run"].alias("run"))))
    run = F.coalesce(F.col("longest.length"), F.lit(0))
    kind = (
        F.when(F.rlike(marks, F.lit("^L*$")), "exact")
        .when(F.rlike(marks, F.lit("^A+$")), "any")
        .when(F.rlike(marks, F.lit("^L+A+$")), "prefix")
        .when(F.rlike(marks, F.lit("^A+L+$")), "suffix")
        .when(F.rlike(marks, F.lit("^L+A+L+$")), "ends")
        .when(F.rlike(marks, F.lit("^A+L+A+$")), "inner")
        .when(F.rlike(marks, F.lit("^L")), "head")
        .when(F.contains(marks, F.lit("L")), "gram")
        .when(F.contains(marks, F.lit("A")), "shape")
        .otherwise("length")
    )
    size = (
        F.when(kind_of.isin(*FROM_START), head)
        .when(kind_of == "suffix", tail)
        .when(kind_of.isin("gram", "inner"), F.least(run, F.lit(GRAM)))
        .when(kind_of.isin("shape", "length"), F.length(F.replace(marks, F.lit("A"), F.lit(""))))
        .otherwise(0)
    )

    anchor = (
        F.when(kind_of == "exact", F.array_join(toks, ""))
        .when(kind_of == "ends", F.concat(piece(1, F.col("size")), piece(F.size(toks) - F.col("tail") + 1, F.col("tail"))))
        .when(kind_of.isin(*FROM_START), piece(1, F.col("size")))
        .when(kind_of == "suffix", piece(F.size(toks) - F.col("size") + 1, F.col("size")))
        .when(kind_of.isin("gram", "inner"), F.left("longest.run", F.col("size")))
        .otherwise("")
    )
    # No NULLs in the join keys: the optimizer would push null checks, and with them copies of
    # these expressions, down to the scan.
    size, anchor = F.coalesce(size, F.lit(0)), F.coalesce(anchor, F.lit(""))
    # What is left to compare once the anchors agree; NULL when nothing is. A text that a
    # matching name must contain comes first, since it is far cheaper than the regex.
    gram = F.least(run, F.lit(GRAM))
    settled = kind_of.isin(*CERTAIN) | (kind_of.isin("shape", "length") & ~F.contains(marks, F.lit("S"))) | ((kind_of == "inner") & (run == gram))
    probe = F.when(~settled, F.coalesce("longest.run", F.lit("")))
    own = F.struct("kind", "size", "tail", "anchor")

    def at(kind: Column, size: Column, tail: Column, anchor: Column) -> Column:
        return F.struct(kind.alias("kind"), size.alias("size"), tail.alias("tail"), anchor.alias("anchor"))

    def found_by(r: Column) -> Column:
        """The anchors of a fixed run: all of it at its distance from an end, or its stretches if both are open."""
        text, ahead = r["run"], r["at"] - 1
        size = F.length(text)
        behind = F.length(marks) - ahead - size
        stretch = reduce(lambda least, k: F.when(size >= k, k).otherwise(least), reversed(LONGER_GRAMS), F.least(size, F.lit(GRAM)))
        stretches = F.transform(F.sequence(F.lit(1), size - stretch + 1), lambda i: at(F.lit("gram"), stretch, F.lit(0), F.substring(text, i, stretch)))
        return (
            F.when(~F.contains(F.left(marks, ahead), F.lit("A")), F.array(at(F.when(ahead == 0, "prefix").otherwise("after"), size, ahead, text)))
            .when(~F.contains(F.right(marks, behind), F.lit("A")), F.array(at(F.when(behind == 0, "suffix").otherwise("before"), size, behind, text)))
            .when(size >= gram, stretches)
            .otherwise(F.array().cast("array<struct<kind:string,size:int,tail:int,anchor:string>>"))
        )

    by_run = F.array_distinct(F.flatten(F.transform("runs", found_by)))
    choices = F.when(kind_of.isin("gram", "inner", "head"), by_run).otherwise(F.array(own))
    regex = F.when(~kind_of.isin(*CERTAIN, "inner"), glob_regex(F.col("pattern")))
    rows = patterns.select(*scope, F.col(column).alias("pattern")).filter(F.col("pattern").isNotNull()).distinct()
    rows = _dealt(rows)
    steps = (
        {"raw": tokens(F.col("pattern"))},
        {"toks": F.transform("raw", lambda t: F.when(_is_fixed_set(t), F.substring(t, 2, 1)).otherwise(t)), "marks": F.array_join(mark, "")},
        {"kind": kind, "runs": runs},
        {"longest": longest},
        {"size": size, "tail": F.when(kind_of == "ends", F.coalesce(tail, F.lit(0))).otherwise(0)},
        {"anchor": anchor, "probe": probe, "regex": regex},
        {"choices": choices},
    )
    for step in steps:
        rows = _settle(rows.withColumns(step))
    return rows.drop("raw", "toks", "marks", "runs", "longest")


def _dealt(rows: DataFrame) -> DataFrame:
    """Few and narrow rows that each cost much work, spread over all cores however they are stored."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _settle(rows: DataFrame) -> DataFrame:
    """Keeps the optimizer from working columns out anew wherever they are used."""
    return rows.select(F.inline(F.array(F.struct("*"))))


def _is_fixed_set(token: Column) -> Column:
    """A set of one character, such as ``[*]``, is that character."""
    return (F.length(token) == 3) & ~F.startswith(token, F.lit("[!"))


def _is_set(token: Column) -> Column:
    return (F.length(token) > 1) & ~_is_fixed_set(token)


def _anchored_names(names: DataFrame, anchored: DataFrame, scope: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Each name once per anchor that ``anchored`` could ask it for."""
    demand = anchored.select(F.coalesce(F.collect_set(F.struct("kind", "size", "tail")), F.array()).alias("d"))
    name, kind, size, tail = F.col("name"), F.col("kind"), F.col("size"), F.col("tail")
    # No NULLs in the join keys, as with patterns.
    whole = F.inline("demand").alias("kind", "size", "tail")
    dealt = _dealt(names.filter(name != "").select(*scope, "name", *carry))
    asked = dealt.select(*scope, "name", *carry, demand.scalar().alias("demand")).select(*scope, "name", *carry, whole)
    length = F.length(name)
    long_enough = length >= size + tail
    once = F.array(F.lit(1))
    never = F.array().cast("array<int>")
    places = (
        F.when(kind.isin("exact", "any"), once)
        .when(~long_enough, never)
        .when(kind.isin("gram", "inner"), F.sequence(F.lit(1), length - size + 1))
        .when((kind == "length") & (length > size), never)
        .otherwise(once)
    )
    text = (
        F.when(kind == "exact", name)
        .when(kind == "ends", F.concat(F.left(name, size), F.right(name, tail)))
        .when(kind.isin(*FROM_START), F.left(name, size))
        .when(kind == "suffix", F.right(name, size))
        .when(kind == "after", F.substring(name, tail + 1, size))
        .when(kind == "before", F.substring(name, length - tail - size + 1, size))
        .when(kind.isin("gram", "inner"), F.substring(name, F.col("place"), size))
        .otherwise("")
    )
    placed = asked.withColumn("place", F.explode(places)).select(
        *scope,
        "name",
        *carry,
        F.coalesce(kind, F.lit("")).alias("kind"),
        F.coalesce(size, F.lit(0)).alias("size"),
        F.coalesce(tail, F.lit(0)).alias("tail"),
        F.coalesce(text, F.lit("")).alias("anchor"),
        "place",
    )
    # A stretch that a name holds twice counts at its first place.
    return placed.filter(~kind.isin("gram", "inner") | (F.instr(name, F.col("anchor")) == F.col("place"))).drop("place")


def _fits() -> Column:
    """Does a name that shares a pattern's anchor match the pattern?"""
    name, probe = F.col("name"), F.col("probe")
    return (
        F.when(probe.isNull(), True)
        .when(~F.contains(name, probe), False)
        .when(F.col("regex").isNull(), True)
        .otherwise(F.rlike(name, F.col("regex")))
    )


def _settled(anchored: DataFrame, names: DataFrame, scope: Sequence[str], names_per_task: int) -> DataFrame:
    """``anchored`` with the anchor that the fewest names answer to, and into how many ``parts`` those names are dealt.

    Patterns that no name answers to are gone.
    """
    carried = ("pattern", "probe", "regex")
    offered = anchored.select(*scope, *carried, F.explode("choices").alias("c")).select(*scope, *carried, "c.*")
    # Counted in the tasks that read the names, so that an anchor is shuffled once from each.
    loads = _hashed(_anchored_names(names, offered, scope), scope).groupBy(HASH, *scope, *ANCHOR).agg(F.count(F.lit(1)).alias("load"))
    # A choice that no name answers to settles that the pattern matches nothing.
    weighed = _hashed(offered, scope).join(loads, [HASH, *scope, *ANCHOR], "left").withColumn("load", F.coalesce("load", F.lit(0)))
    best = F.min_by(F.struct(*ANCHOR, "probe", "regex", "load"), F.struct("load", *ANCHOR))
    chosen = weighed.groupBy(*scope, "pattern").agg(best.alias("b")).select(*scope, "pattern", "b.*").filter("load > 0")
    settled = chosen.withColumn("parts", F.ceil(F.col("load") / names_per_task).cast("int")).drop("load")
    return _once(_hashed(settled, scope))


def _hashed(rows: DataFrame, scope: Sequence[str]) -> DataFrame:
    """``rows`` with a hash of the anchor, which as first key of a join or a grouping nearly always settles the order."""
    return rows.withColumn(HASH, F.xxhash64(*scope, *ANCHOR))


def _once(patterns: DataFrame) -> DataFrame:
    """A table of patterns that several parts of a join use, written down where the session names a folder for that."""
    return kept(patterns) if has_folder(patterns.sparkSession) else patterns


def glob_pairs(
    patterns: DataFrame,
    names: DataFrame,
    pattern_column: str = "pattern",
    scope: Sequence[str] = (),
    carry: Sequence[str] = (),
    names_per_task: int = NAMES_PER_TASK,
) -> DataFrame:
    """All pairs of a distinct pattern and a name it matches: ``scope, pattern, name``.

    One naming prefix often holds a large part of all names, so the rows of an anchor that more
    than ``names_per_task`` names answer to are dealt out by a hash of the name, and its patterns copied to
    each part. Every row of ``names`` is matched by itself and keeps the columns in ``carry``.
    """
    anchored = _once(anchored_patterns(patterns, pattern_column, scope))
    some = _pairs(anchored.filter("kind <> 'any'"), names, scope, names_per_task, carry)
    return some.select(*scope, "pattern", "name", *carry).unionByName(_with_any(anchored, names, scope, carry))


def _with_any(anchored: DataFrame, names: DataFrame, scope: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Every name with the patterns that match all names (``*``, ``**``); each scope has a list of those."""
    every = anchored.filter("kind = 'any'").groupBy(*scope).agg(F.collect_list("pattern").alias("every"))
    named = names.filter(F.col("name") != "")
    found = named.join(every, [*scope]) if scope else named.withColumn("every", every.select("every").scalar())
    return found.select(*scope, F.explode("every").alias("pattern"), "name", *carry)


def _pairs(anchored: DataFrame, names: DataFrame, scope: Sequence[str], names_per_task: int, carry: Sequence[str] = ()) -> DataFrame:
    keys = [HASH, *scope, *ANCHOR]
    settled = _settled(anchored, names, scope, names_per_task)
    heavy = settled.filter("parts > 1").select(*keys, "parts").distinct()
    left = _hashed(_anchored_names(names, settled, scope, carry), scope).join(heavy, keys, "left")
    left = left.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("name"), F.col("parts")).cast("int"), F.lit(0))).drop("parts")
    right = settled.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return left.join(right, [*keys, "salt"]).filter(_fits())


def covered_patterns(
    patterns: DataFrame, names: DataFrame, pattern_column: str = "pattern", scope: Sequence[str] = (), names_per_task: int = NAMES_PER_TASK
) -> DataFrame:
    """The distinct patterns that match at least one name.

    Where the anchor alone decides, names shrink to distinct anchors inside the map tasks
    before they are shuffled. The other patterns meet the single names; as long as those
    patterns are few enough for Spark to broadcast them, the names are not shuffled at all.
    """
    anchored = _once(anchored_patterns(patterns, pattern_column, scope))
    by_anchor = F.col("probe").isNull()
    certain, others = anchored.filter(by_anchor), anchored.filter(~by_anchor)
    keys = [HASH, *scope, *ANCHOR]
    answered = _hashed(_anchored_names(names, certain, scope), scope).select(*keys).distinct()
    found = _hashed(certain, scope).join(answered, keys, "left_semi").select(*scope, "pattern")
    return found.unionByName(_pairs(others, names, scope, names_per_task).select(*scope, "pattern").distinct())
