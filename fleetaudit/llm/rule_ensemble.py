"""A quality classifier as a sparse ensemble of rules over text statistics.

Shallow trees are grown on labelled documents; each path from a root is a rule, a conjunction
of bounds on statistics. A logistic model with a lasso penalty weighs the rules, and those
it leaves at zero are dropped. What remains is one column expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.llm.common import id_crc, text_or_empty, word_count, written

#: At most so many labelled documents, in order of a hash of their id, train the model.
SAMPLE = 12_000
TREES, DEPTH, LASSO, SEED = 24, 4, 0.002, 5


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), chars, text))


def statistics(text: Column) -> Column:
    """Statistics of a text that is not null, as a struct. None knows a language, a source or a label.

    What several of them need is bound once, as the optimizer would copy it to every use.
    """
    given = F.struct(text.alias("text"), (word_count(text) + 1).alias("n"), (F.length(text) + 1).alias("size"), F.split(text, "\n", -1).alias("lines"))

    def of(g: Column) -> Column:
        t, n, size, lines = g["text"], g["n"], g["size"], g["lines"]
        values = (
            F.log1p(n), size / n, F.regexp_count(t, F.lit("[A-Z]")) / size, _count(t, "!") / n, _count(t, "#$%&*") / n, _count(t, "|") / n,
            _count(t, ".") / n, _count(t, ",") / n, (F.octet_length(t) - F.length(t)) / size, F.regexp_count(t, F.lit("[0-9]")) / size,
            n / F.size(lines), 1 - F.size(F.array_distinct(lines)) / F.size(lines), F.regexp_count(t, F.lit(r"(?<!\S)(\S+) (?=\1(?!\S))")) / n)
        return F.struct(*[value.cast("double").alias(name) for name, value in zip(STATISTICS, values, strict=True)])

    return F.transform(F.array(given), of)[0]


STATISTICS = ("words", "word_size", "upper", "exclaimed", "symbols", "bars", "stops", "commas", "wide", "digits", "line_size", "same_lines", "stutter")


@dataclass(frozen=True)
class Bound:
    statistic: str
    above: bool
    at: float

    def holds(self, of: Column) -> Column:
        value = of[self.statistic]
        return value > self.at if self.above else value <= self.at


Rule = frozenset  # of bounds


def rules_of(forest) -> list[Rule]:
    """Every path from a root of the trees, to inner nodes too, without repeats."""
    found: dict[Rule, None] = {}
    path: list[Bound] = []
    depth = 0
    for line in forest.toDebugString.splitlines():
        if "Tree" in line:
            depth = len(line) - len(line.lstrip()) + 2
        elif m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line):
            path = path[: len(m[1]) - depth] + [Bound(STATISTICS[int(m[2])], m[3] == ">", float(m[4]))]
            found[frozenset(path)] = None
    return sorted(found, key=lambda rule: sorted((b.statistic, b.above, b.at) for b in rule))


@dataclass(frozen=True)
class Ensemble:
    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, stats: Column) -> Column:
        """The probability of label 1 from a struct of statistics, which is worked out once for all rules."""

        def of(s: Column) -> Column:
            total = reduce(lambda a, b: a + b, [
                F.when(reduce(lambda x, y: x & y, [b.holds(s) for b in sorted(rule, key=lambda b: (b.statistic, b.above, b.at))]), F.lit(weight)).otherwise(F.lit(0.0))
                for rule, weight in self.weights], F.lit(self.intercept))
            return 1 / (1 + F.exp(-total))

        return F.transform(F.array(stats), of)[0]


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Ensemble:
    """The ensemble for ``rows`` of ``stats`` (struct) and ``label`` (0 or 1).

    With one class only, or none, it has no rules and the share of label 1, smoothed.
    """
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    zero, one = counts.get(0, 0), counts.get(1, 0)
    if not zero or not one:
        return Ensemble(log((one + 1) / (zero + 1)), ())
    vectors = rows.select(F.col("label").cast("double").alias("label"), array_to_vector(F.array(*[f"stats.{s}" for s in STATISTICS])).alias("x"), "stats")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird").fit(vectors)
    rules = rules_of(forest)
    if not rules:
        return Ensemble(log((one + 1) / (zero + 1)), ())
    held = [F.when(reduce(lambda x, y: x & y, [b.holds(F.col("stats")) for b in rule]), 1.0).otherwise(0.0) for rule in rules]
    model = LogisticRegression(featuresCol="r", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(vectors.select("label", array_to_vector(F.array(*held)).alias("r")))
    weights = zip(rules, (float(w) for w in model.coefficients.toArray()))
    return Ensemble(float(model.intercept), tuple((rule, w) for rule, w in weights if w))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``stats`` and ``label`` of at most ``sample`` documents. Rows without id or with a label other than 0 and 1 are not used; of several labels, the largest; of rows that repeat an id, the one whose text has the smallest hash."""
    picked = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "label", F.xxhash64("text").alias("text_hash"), statistics(text_or_empty()).alias("stats"))
    found = found.groupBy("doc_id", "label").agg(F.min_by("stats", "text_hash").alias("stats"))
    return written(found, "labelled").orderBy("doc_id").coalesce(1)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    return fit(labelled(docs, labels, sample))


def scored(docs: DataFrame, model: Ensemble) -> DataFrame:
    """``docs`` as ``row`` (all columns) with ``score``. A null text counts as empty."""
    row = docs.select(F.struct("*").alias("row"))
    return row.select("row", model.score(statistics(F.coalesce("row.text", F.lit("")))).alias("score"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out, its score and the prediction at 0.5."""
    held_out = id_crc() % 3 == 1
    model = train(docs, labels.where(~held_out).select("doc_id", F.col("quality").alias("label")))
    s = scored(docs.select("doc_id", "text"), model).select("row.doc_id", "score")
    return s.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
