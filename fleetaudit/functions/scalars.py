"""Scalar text, number and map helpers (Column -> Column)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit names of the size text, base 1024.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def blank_to_null(col: Column) -> Column:
    """NULL where a text is empty: both mean "absent" in the dumps."""
    return F.when(col != "", col)


def first_present(*cols: Column) -> Column:
    """First text that is neither NULL nor empty; the last one is taken as it is."""
    return F.coalesce(*[blank_to_null(c) for c in cols[:-1]], cols[-1])


def first_nonzero(*cols: Column) -> Column:
    """First number that is neither NULL nor 0, else 0."""
    return F.coalesce(*[F.when(c != 0, c) for c in cols], F.lit(0))


def is_present(col: Column) -> Column:
    return F.coalesce(col != "", F.lit(False))


def one_decimal(col: Column) -> Column:
    """One decimal place, ties decided on the binary value of the double."""
    return F.call_function("format_number", col, F.lit("0.0"))


def size_text(num_bytes: Column) -> Column:
    """Bytes as ``1.5KB``; anything beyond terabytes stays in petabytes."""
    value = num_bytes.cast("double")
    text = F.concat(one_decimal(value / float(1024 ** (len(SIZE_UNITS) - 1))), F.lit(SIZE_UNITS[-1]))
    for power in reversed(range(len(SIZE_UNITS) - 1)):
        scaled = value / float(1024**power)
        text = F.when(scaled < 1024, F.concat(one_decimal(scaled), F.lit(SIZE_UNITS[power]))).otherwise(text)
    return text


def duration_text(millis: Column) -> Column:
    """Milliseconds as ``750ms``, ``4.2s``, ``3m20s``, ``5h12m`` or ``2d6h``; NULL as ``-``."""
    ms = millis.cast("bigint")
    secs = F.call_function("div", ms, F.lit(1000))

    def whole(divisor: int) -> Column:
        return F.call_function("div", secs, F.lit(divisor))

    def pair(major: Column, major_unit: str, minor: Column, minor_unit: str) -> Column:
        return F.concat(major.cast("string"), F.lit(major_unit), minor.cast("string"), F.lit(minor_unit))

    return (
        F.when(ms.isNull(), "-")
        .when(ms < 1000, F.concat(ms.cast("string"), F.lit("ms")))
        .when(ms < 60_000, F.concat(one_decimal(ms / F.lit(1000.0)), F.lit("s")))
        .when(secs < 3600, pair(whole(60), "m", secs % 60, "s"))
        .when(secs < 86_400, pair(whole(3600), "h", whole(60) % 60, "m"))
        .otherwise(pair(whole(86_400), "d", whole(3600) % 24, "h"))
    )


def ellipsis(col: Column, limit: int) -> Column:
    """Text longer than ``limit`` characters ends in ``...`` at that length."""
    return F.when(F.length(col) > limit, F.concat(F.substring(col, 1, limit - 3), F.lit("..."))).otherwise(col)


def minute_stamp(iso: Column) -> Column:
    """ISO timestamp text cut to minutes, with a space in place of the ``T``."""
    return F.substring(F.replace(iso, F.lit("T"), F.lit(" ")), 1, 16)


def parent_path(path: Column) -> Column:
    """Dotted path without its last part; NULL at the top level."""
    last = F.substring_index(path, ".", -1)
    return blank_to_null(F.left(path, F.length(path) - F.length(last) - 1))


def parens_balanced(text: Column) -> Column:
    """Equal counts of opening and closing parentheses, order aside."""
    return F.length(F.replace(text, F.lit("("), F.lit(""))) == F.length(F.replace(text, F.lit(")"), F.lit("")))


def starts_with_any(col: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.startswith(col, F.lit(p)) for p in prefixes])


def document_count(col: Column) -> Column:
    """A count given as text: an integer, ``none`` as it is, NULL when neither."""
    return F.when(F.lower(col) == "none", col).otherwise(col.try_cast("bigint").cast("string"))


def dash_if_blank(col: Column) -> Column:
    return first_present(col.cast("string"), F.lit("-"))


def joined(col: Column, separator: str) -> Column:
    return F.concat_ws(separator, col)


def same_keys(a: Column, b: Column) -> Column:
    """Do two maps have exactly the same key set? A NULL map has no keys."""

    def keys(m: Column) -> Column:
        return F.coalesce(F.array_sort(F.map_keys(m)), F.array().cast("array<string>"))

    return keys(a) == keys(b)
