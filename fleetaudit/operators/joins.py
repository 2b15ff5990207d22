"""Joins whose rows per key differ widely."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task takes on; a key with more is dealt to several tasks.
ROWS_PER_PART = 500_000
#: Parts that rows without a key are dealt to. They match nothing and need no partner.
KEYLESS_PARTS = 1 << 16
PART = "key_part"


def split_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``left.join(right, on, how)`` (left or inner) with heavy keys of ``left`` dealt to several tasks.

    Keys are counted first, by a sum that combines in the map tasks. Only rows of keys with more than
    ``rows_per_part`` rows get a part, by a hash of the row, and only those keys' partners are copied, once
    per part. There are fewer such keys than rows of ``left`` over ``rows_per_part``, which bounds the
    table of them that goes to all tasks. Rows with a NULL in the key are spread over all tasks. Nothing
    depends on adaptive execution. Columns of ``left`` must be such as Spark can hash (no maps).
    """
    if how not in ("left", "inner"):
        raise ValueError("left or inner")
    keys = list(on)
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    heavy = left.groupBy(*keys).agg(F.ceil(F.count("*") / rows_per_part).alias("parts")).filter(F.col("parts") > 1)
    heavy = F.broadcast(heavy.filter(~keyless))
    number = F.xxhash64(*left.columns)
    part = F.when(keyless, F.pmod(number, F.lit(KEYLESS_PARTS))).otherwise(F.pmod(number, F.coalesce("parts", F.lit(1))))
    dealt = left.join(heavy, keys, "left").withColumn(PART, part).drop("parts")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1))
    partners = right.join(heavy, keys, "left").withColumn(PART, copies).drop("parts")
    return dealt.join(partners, [*keys, PART], how).drop(PART)
