"""A corpus pipeline of five stages over ``documents``.

Each stage is a function of (spark, docs, sf_dir); its result is written as a table, which
is the next stage's ``docs``. All but the last return the columns they are given.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetaudit.llm import bpe, line_dedup, mixing, rule_ensemble, simhash
from fleetaudit.llm.catalog import RANKS
from fleetaudit.llm.common import table, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on those with labels, doesn't reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return rule_ensemble.scored(docs, rule_ensemble.train(docs, labels)).where("score >= 0.5").select("row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``text`` (and ``n_chars``) less the lines that many documents share."""
    kept = line_dedup.deduplicated(docs)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[
        F.when(F.col("n_dropped") > 0, changed[c]).otherwise(F.col("row")[c]).alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked: four-word shingles, at most four differing bits, over any number of links."""
    return simhash.representatives(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token count and digests of the ids and of the text decoded from them."""
    return bpe.digests(docs, RANKS)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", tokenized),
]

#: SQL can't express the classifier, the near copies and the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
