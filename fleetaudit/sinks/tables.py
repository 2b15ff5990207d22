"""Keyed updates of tables and NDJSON output."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetaudit.sources.layout import kept

OBJECT_KEY = ("type", "id")
BUCKET = "key_bucket"


def last_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one that comes last; repeats of a key shrink inside the map tasks.

    Rows without a number come before all others, and rows of one number are in the order of
    their contents, so which row stays doesn't depend on how the table is dealt out. A row
    without a key is an error.
    """
    if not key:
        raise ValueError("a key is needed")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    place = F.struct(F.col(order).alias("order"), F.to_json(F.struct(*df.columns)).alias("contents"))
    checked = F.when(missing, F.raise_error(F.lit("a row has no key")).cast(df.select(place).schema[0].dataType)).otherwise(place)
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), checked).alias("row")).select("row.*")


def upsert(existing: DataFrame, incoming: DataFrame, order: str, key: Sequence[str] = OBJECT_KEY) -> DataFrame:
    """``existing`` with ``incoming`` written over it; a key that comes twice keeps its last row.

    ``order`` is the column of ``incoming`` that numbers its rows. The result is a new table;
    :func:`upsert_into` changes a stored one.
    """
    fresh = last_per_key(incoming, key, order).drop(order)
    kept = existing.join(incoming.select(*key).distinct(), [*key], "left_anti")
    return kept.select(*existing.columns).unionByName(fresh.select(*existing.columns))


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def write_buckets(rows: DataFrame, path: str, buckets: int, key: Sequence[str] = OBJECT_KEY) -> None:
    """Stores a table for :func:`upsert_into`: one folder for each remainder of the key's hash."""
    bucketed = rows.withColumn(BUCKET, _bucket(key, buckets))
    bucketed.repartition(buckets, BUCKET).write.mode("errorifexists").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BUCKET)


def upsert_into(path: str, incoming: DataFrame, order: str, buckets: int, key: Sequence[str] = OBJECT_KEY) -> None:
    """Writes ``incoming`` over the table that :func:`write_buckets` stored at ``path``.

    Only folders that a key of ``incoming`` falls into are read and written anew, so the work
    grows with what comes in, not with what is stored. The new rows are worked out in the shared folder before
    a folder is touched; a run that was cut short is simply run again, as the same rows win.
    """
    spark = incoming.sparkSession
    fresh = kept(last_per_key(incoming, key, order).drop(order).withColumn(BUCKET, _bucket(key, buckets)))
    touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # as many as there are buckets, at most
    if not touched:
        return
    stored = spark.read.parquet(path)
    fields = stored.columns
    old = stored.where(F.col(BUCKET).isin(touched))
    rows = kept(old.join(fresh.select(*key), [*key], "left_anti").select(*fields).unionByName(fresh.select(*fields)))
    rows.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def delete(existing: DataFrame, doomed: DataFrame, key: Sequence[str] = OBJECT_KEY) -> DataFrame:
    return existing.join(doomed.select(*key), [*key], "left_anti").select(*existing.columns)


def write_ndjson(records: DataFrame, path: str, by_type: bool = True, mode: str = "errorifexists") -> None:
    """Writes the ``line`` column as text files, one directory per object type."""
    if by_type and "type" in records.columns:
        records.select("type", "line").write.mode(mode).partitionBy("type").text(path)
    else:
        records.select("line").write.mode(mode).text(path)


def write_export(records: DataFrame, header: DataFrame, path: str, by_type: bool = True, mode: str = "errorifexists") -> None:
    """An export: ``objects`` with the records and ``index_patterns`` with the header lines."""
    write_ndjson(records, f"{path}/objects", by_type, mode)
    write_ndjson(header, f"{path}/index_patterns", False, mode)
