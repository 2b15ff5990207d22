import fnmatch
import random

from pyspark.sql import functions as F

from fleetaudit.operators.globjoin import ANCHOR, _anchored_names, _settled, anchored_patterns, covered_patterns, glob_pairs
from tests.test_globs import NAMES, _patterns


def _inputs(spark):
    rng = random.Random(3)
    extra = ["".join(rng.choice("ab-c.z1") for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    names = sorted(set(NAMES) | set(extra))
    patterns = sorted(set(_patterns()) | {"a*b", "*ab*", "*-c", "??", "???*", "[ab]*", "*[ab]", "?b*", "a?c", "*a*b*", "**a", "a**"})
    return (patterns, names, spark.createDataFrame([(p,) for p in patterns], "pattern string"),
            spark.createDataFrame([(n,) for n in names], "name string"))


def test_pairs_agree_with_brute_force(spark):
    patterns, names, p, n = _inputs(spark)
    expected = {(a, b) for a in patterns for b in names if b and fnmatch.fnmatchcase(b, a)}
    got = [(r.pattern, r.name) for r in glob_pairs(p, n).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected


def test_covered_agrees_with_brute_force(spark):
    patterns, names, p, n = _inputs(spark)
    expected = {a for a in patterns if any(b and fnmatch.fnmatchcase(b, a) for b in names)}
    got = [r.pattern for r in covered_patterns(p, n).collect()]
    assert sorted(got) == sorted(expected)


def test_scope_keeps_clusters_apart(spark):
    p = spark.createDataFrame([("c1", "a*"), ("c2", "a*"), ("c2", "*b?")], "cluster_id string, pattern string")
    n = spark.createDataFrame([("c1", "abc"), ("c2", "xbc")], "cluster_id string, name string")
    got = {tuple(r) for r in glob_pairs(p, n, scope=["cluster_id"]).collect()}
    assert got == {("c1", "a*", "abc"), ("c2", "*b?", "xbc")}
    assert {tuple(r) for r in covered_patterns(p, n, scope=["cluster_id"]).collect()} == {("c1", "a*"), ("c2", "*b?")}


def test_kinds(spark):
    kinds = {"logs": "exact", "": "exact", "lo*": "prefix", "*x": "suffix", "*": "any", "a*b": "ends", "a?b": "head", "*mid*": "inner", "?b*": "gram",
             "??*": "shape", "[ab]": "length", "a[": "exact", "a[*]": "exact", "[?]*": "prefix", "a?bb*": "head"}
    df = spark.createDataFrame([(k,) for k in kinds], "pattern string")
    assert {r.pattern: r.kind for r in anchored_patterns(df, "pattern").collect()} == kinds


def test_no_nested_loop_join(spark):
    _, _, p, n = _inputs(spark)
    for df in (glob_pairs(p, n), covered_patterns(p, n)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_common_head_makes_no_candidates(spark):
    """Patterns and names that share a head meet only where the tails agree too; of one length only, where lengths agree."""
    p = spark.range(200).select(F.concat(F.lit("logs-*-x"), F.col("id").cast("string")).alias("pattern")).unionByName(
        spark.createDataFrame([("?" * k,) for k in range(1, 60)], "pattern string"))
    n = spark.range(1000).select(F.concat(F.lit("logs-"), F.col("id").cast("string"), F.lit("-x"), (F.col("id") % 200).cast("string")).alias("name"))
    anchored = anchored_patterns(p, "pattern")
    met = _anchored_names(n, anchored, ()).join(anchored, list(ANCHOR)).count()
    assert met == glob_pairs(p, n).count() == 2000


def test_runs_at_a_known_place_make_no_other_candidates(spark):
    """A number ahead of a last ``?`` or behind several ``*`` meets only names that have it there, however many hold it elsewhere."""
    number = F.col("id").cast("string")
    p = spark.range(1000, 1300).select(F.explode(F.array(F.concat(F.lit("Customer*"), number, F.lit("?")), F.concat(F.lit("[!a-z]*#*"), number))).alias("pattern"))
    n = spark.range(100_000, 103_000).select(F.concat(F.lit("Customer#"), F.col("id").cast("string"), F.col("id").cast("string")).alias("name"))
    settled = _settled(anchored_patterns(p, "pattern"), n, (), 10**6)
    met = _anchored_names(n, settled, ()).join(settled, list(ANCHOR)).count()
    assert met == glob_pairs(p, n).count() > 0


def test_long_runs_agree_with_brute_force(spark):
    rng = random.Random(7)
    names = sorted({"".join(rng.choice("ab\U0001f600") for _ in range(rng.randrange(1, 40))) for _ in range(200)})
    parts = [name[i : i + size] for name in names for size in (1, 5, 6, 11, 12, 24, 30) for i in [rng.randrange(len(name))]]
    shapes = ("*{}*", "*?{}*", "*{}?", "?{}*", "*{}*{}*", "*{}??{}", "{}?{}*", "*{}[ab]", "[!a]*{}*{}", "?{}?", "{}*{}*b")
    patterns = sorted({rng.choice(shapes).format(*rng.sample(parts, 2)) for _ in range(400)})
    p, n = spark.createDataFrame([(x,) for x in patterns], "pattern string"), spark.createDataFrame([(x,) for x in names], "name string")
    expected = {(a, b) for a in patterns for b in names if fnmatch.fnmatchcase(b, a)}
    got = [(r.pattern, r.name) for r in glob_pairs(p, n).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    covered = [r.pattern for r in covered_patterns(p, n).collect()]
    assert sorted(covered) == sorted({a for a, _ in expected})


def test_covered_by_anchor_alone(spark):
    """Short contained texts, and ``?`` without sets, are answered by distinct anchors; nothing is left to compare."""
    left = {"*ab*": False, "*a*": False, "??": False, "??*": False, "*?": False, "*abcd*": True, "[ab]": True, "?[ab]*": True, "?b*": True, "a*b": False}
    df = spark.createDataFrame([(k,) for k in left], "pattern string")
    assert {r.pattern: r.probe is not None for r in anchored_patterns(df, "pattern").collect()} == left
    n = spark.createDataFrame([("xaby",), ("z",)], "name string")
    assert {r.pattern for r in covered_patterns(df, n).collect()} == {"*ab*", "*a*", "??*", "*?", "?[ab]*"}
