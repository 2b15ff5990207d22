"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def has_folder(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None))


def new_folder(spark: SparkSession, name: str) -> str:
    """A path not used before in the folder that ``spark.checkpoint.dir`` names, which all executors have to share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the session's checkpoint folder and read from there from now on.

    For a result that several outputs share: a table of known size, of which each reads the columns it needs.
    """
    path = new_folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
