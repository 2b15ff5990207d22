"""Heavy and missing keys of a join, with adaptive execution off."""

import pytest
from pyspark.sql import functions as F

from fleetaudit.operators.joins import split_join

STATIC = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}


@pytest.fixture
def static(spark):
    before = {k: spark.conf.get(k) for k in STATIC}
    for k, v in STATIC.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _tables(spark):
    """A third of the rows on one key, a third without key, two partners of the heavy key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id").cast("string")))
    left = spark.range(30_000).select("id", F.lit("c").alias("cluster"), key.alias("key"))
    right = spark.createDataFrame([("c", "hot", 1), ("c", "hot", 2), ("c", "k1", 3), ("c", None, 4), ("d", "hot", 5), ("c", "lone", 6)], "cluster string, key string, value int")
    return left, right


@pytest.mark.parametrize("how", ("left", "inner"))
def test_rows_as_in_the_plain_join(static, how):
    left, right = _tables(static)
    got = split_join(left, right, ["cluster", "key"], how, rows_per_part=500)
    plain = left.join(right, ["cluster", "key"], how)
    assert got.columns == plain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.collect()))


def test_no_task_takes_all_rows_of_a_key(static):
    left, right = _tables(static)

    def most(df):
        """The greatest number of rows that a task of the join gives out."""
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    assert most(left.join(right, ["cluster", "key"], "left")) >= 20_000
    assert most(split_join(left, right, ["cluster", "key"], rows_per_part=500)) < 8_000


def test_empty_tables_and_wrong_kind(spark):
    left, right = _tables(spark)
    assert split_join(left.limit(0), right, ["cluster", "key"]).count() == 0
    assert split_join(left, right.limit(0), ["cluster", "key"]).count() == 30_000
    with pytest.raises(ValueError):
        split_join(left, right, ["key"], "outer")
