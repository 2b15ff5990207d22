"""Tables, the shared folder for intermediate results, and small column helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that part words, as a regular expression class and as a string to strip.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, with a known size, safe from lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else as it is. Texts of ASCII alone take the short way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def count_of(text: Column, chars: str) -> Column:
    """How many of the characters are in the text."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[^{SPACE_CLASS}]+")).cast("long")


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of an id written as text, by which held-out rows are told."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
