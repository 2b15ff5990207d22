import fnmatch
import itertools
import random

from pyspark.sql import functions as F

from fleetaudit.functions.globs import _literal_regex, glob_regex, matches_any

NAMES = ["", "a", "b", "ab", "abc", "a.b", "a]c", "a[c", "a-c", "a^c", "a!c", "a\\c", "a*c", "a?c", "A", "aé", "a\n", "\n",
         "a&&c", "z", "-", "]", "[", "logs-1", "logs-12", ".logs"]


def _patterns():
    rng = random.Random(7)
    fuzz = ["".join(rng.choice("ab*?[]!^-\\z&c.é") for _ in range(rng.randrange(1, 8))) for _ in range(700)]
    fixed = ["", "*", "?", "[*]", "[]a]", "[!]a]", "[a", "[z-a]", "[!z-a]", "[z-ab]*", "a[b-", "a[--a]c", "a[a-c-z]c", "logs-*",
             "logs-?", "[[]", "a[&&]*c", "[^a]", "a\\c", "**", "*c", "a*c"]
    return fixed + fuzz


def test_column_and_literal_forms_agree_with_fnmatch(spark):
    patterns = _patterns()
    pats = spark.createDataFrame([(i, p, _literal_regex(p)) for i, p in enumerate(patterns)], "i int, p string, lit string")
    names = spark.createDataFrame([(n,) for n in NAMES], "n string")
    got = pats.withColumn("re", glob_regex(F.col("p"))).crossJoin(names).select(
        "i", "n", F.expr("n RLIKE re").alias("by_column"), F.expr("n RLIKE lit").alias("by_text")
    )
    wrong = [r for r in got.collect()
             if not (r.by_column == r.by_text == fnmatch.fnmatchcase(r.n, patterns[r.i]))]
    assert wrong == []


def test_matches_any(spark):
    names = spark.createDataFrame([(n,) for n in [None, "logs-1", "logs-x", "other"]], "n string")

    def hits(patterns):
        return {r.n for r in names.filter(matches_any(F.col("n"), patterns)).collect()}

    assert hits("logs-[0-9]") == {"logs-1"}
    assert hits(["logs-?", "oth*"]) == {"logs-1", "logs-x", "other"}
    assert hits("*") == {None, "logs-1", "logs-x", "other"}
