"""Shell-style name patterns: ``*``, ``?``, ``[set]``, ``[!set]``; case counts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetaudit.functions.scalars import starts_with_any

# One token per match: a closed set, or any single character (an unclosed "[" is plain text).
TOKEN = r"(\[!?+\]?+[^\]]*\]|.)"
SET_PART = r"(?s)(.-.|.)"
NOT_WORD_NOR_RANGE_DASH = r"(?s)(?!(?<=^.)-(?=.$))([^A-Za-z0-9_])"
NEVER = r"(?!)"
_WORD = re.compile(r"[A-Za-z0-9_]")


def tokens(pattern: Column) -> Column:
    return F.regexp_extract_all(pattern, F.lit("(?s)" + TOKEN), F.lit(1))


def _token_regex(token: Column) -> Column:
    # A part of a set is one character or a range; a backward range stands for no character.
    parts = F.regexp_extract_all(F.regexp_extract(token, r"(?s)^\[!?(.*)\]$", 1), F.lit(SET_PART), F.lit(1))
    kept = F.filter(parts, lambda p: F.left(p, F.lit(1)) <= F.right(p, F.lit(1)))
    inner = F.array_join(F.transform(kept, lambda p: F.regexp_replace(p, NOT_WORD_NOR_RANGE_DASH, r"\\$1")), "")
    negated = F.startswith(token, F.lit("[!"))
    return (
        F.when(token == "*", ".*")
        .when(token == "?", ".")
        .when(F.length(token) == 1, F.regexp_replace(token, "([^A-Za-z0-9_])", r"\\$1"))
        .when(inner == "", F.when(negated, ".").otherwise(NEVER))
        .otherwise(F.concat(F.when(negated, "[^").otherwise("["), inner, F.lit("]")))
    )


def glob_regex(pattern: Column) -> Column:
    """The regular expression that matches the same whole names as the pattern."""
    body = F.array_join(F.transform(tokens(pattern), _token_regex), "")
    return F.concat(F.lit(r"(?s)\A"), body, F.lit(r"\z"))


def _literal_regex(pattern: str) -> str:
    """``glob_regex`` for one pattern known when the plan is built."""

    def plain(char: str) -> str:
        return char if _WORD.match(char) else "\\" + char

    def one(token: str) -> str:
        if token in ("*", "?"):
            return ".*" if token == "*" else "."
        if len(token) == 1:
            return plain(token)
        negated = token[1] == "!"
        parts = re.findall(SET_PART, token[2 if negated else 1 : -1])
        kept = [p for p in parts if len(p) == 1 or p[0] <= p[2]]
        if not kept:
            return "." if negated else NEVER
        inner = "".join("-".join(map(plain, (p[0], p[2]))) if len(p) == 3 else plain(p) for p in kept)
        return "[" + ("^" if negated else "") + inner + "]"

    return r"(?s)\A" + "".join(map(one, re.findall(TOKEN, pattern, re.S))) + r"\z"


def matches_any(name: Column, patterns: str | list[str] | tuple[str, ...]) -> Column:
    """Filter on one pattern or several, given as text. A NULL name counts as ''.

    A fixed head of every pattern is also tested with ``startswith``, which the
    Parquet scan can use to skip row groups.
    """
    wanted = [patterns] if isinstance(patterns, str) else list(patterns)
    text = F.coalesce(name, F.lit(""))
    hit = text.rlike("|".join(_literal_regex(p) for p in wanted))
    heads = [re.match(r"[^*?\[]*", p).group() for p in wanted]
    return starts_with_any(name, heads) & hit if all(heads) else hit
