"""Deals documents into shards of nearly equal bytes by Karmarkar-Karp differencing; equal texts stay together.

A partial partition holds, per shard, the bytes and the items dealt so far. The two with the largest
spread (most bytes less fewest) are combined over and over, the largest part of one with the smallest of the
other, until one is left.

A corpus has too many groups of equal texts for one task, so differencing runs over a bounded number
of items: every group that is large, at least 1 / ``bundles`` of all bytes (there can't be more than
``bundles`` of these), is an item by itself; of the others, those with equal remainders of their
text's hash are one item, of which there are ``bundles`` as well. Groups are summed up where they lie, and a
document finds its shard by two joins with tables of that bounded size, so no text is moved.

A group that alone is more than a fair share gets a shard for itself, and the others share the rest.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetaudit.llm.common import text_or_empty, written

SHARDS = 16
#: Groups with at least this part of all bytes are items of their own; the others form so many bundles.
BUNDLES = 4096
#: What tells groups apart: equal texts agree in all of them.
GROUP = ("size", "text_crc32", "text_hash")


def differenced(items: list[tuple[int, int]], shards: int) -> list[list[int]]:
    """Names of the items (name, bytes) dealt to each shard, most bytes first."""
    rest = sorted(items, key=lambda x: (-x[1], x[0]))
    alone, left = [], sum(size for _, size in rest)
    while len(alone) < min(shards - 1, len(rest)) and rest[len(alone)][1] * (shards - len(alone)) >= left:
        left -= rest[len(alone)][1]
        alone.append([rest[len(alone)][0]])
    rest, parts = rest[len(alone) :], shards - len(alone)
    # A partial partition: spread (negated), its number, and its parts as (bytes, names), most bytes first; names are nested pairs.
    heap = [(-size, k, [(size, (name, None))] + [(0, None)] * (parts - 1)) for k, (name, size) in enumerate(rest)]
    heapq.heapify(heap)
    number = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        both = sorted(((a + b, (x, y) if x and y else x or y) for (a, x), (b, y) in zip(one, reversed(two))), key=lambda part: -part[0])
        heapq.heappush(heap, (both[-1][0] - both[0][0], number, both))
        number += 1

    def names(tree) -> list[int]:
        out, stack = [], [tree] if tree else []
        while stack:
            left, right = stack.pop()
            if isinstance(left, tuple):
                stack += [left, right]
            else:
                out.append(left)
        return out

    dealt = [names(tree) for _, tree in heap[0][2]] if heap else [[] for _ in range(parts)]
    return alone + dealt


def text_size(text: Column) -> Column:
    return (F.octet_length(text) + 1).cast("long")


def grouped(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns that tell groups of equal texts apart. A null text counts as an empty one."""
    value = text_or_empty(text)
    return docs.withColumns({"size": text_size(value), "text_crc32": F.crc32(value.cast("binary")), "text_hash": F.xxhash64(value)})


@dataclass
class Plan:
    """Which shard an item's documents go to: ``large`` by group, ``bundles`` by remainder. Both have at most as many rows as there may be bundles."""

    large: DataFrame
    bundles: DataFrame
    count: int

    def apply(self, docs: DataFrame) -> DataFrame:
        """Grouped documents with their ``shard``."""
        found = docs.withColumn("bundle", bundle(self.count))
        found = found.join(F.broadcast(self.large), list(GROUP), "left").join(F.broadcast(self.bundles), "bundle", "left")
        return found.withColumn("shard", F.coalesce("own_shard", "bundle_shard")).drop("bundle", "own_shard", "bundle_shard")


def bundle(count: int) -> Column:
    return F.pmod(F.xxhash64("text_hash", "size"), F.lit(count)).cast("int")


def plan(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> Plan:
    """How grouped documents are dealt. Ties go by hash, so equal corpora are dealt alike however they are stored."""
    groups = written(docs.groupBy(*GROUP).agg((F.count(F.lit(1)) * F.col("size")).alias("bytes")), "groups")
    total = groups.agg(F.sum(F.col("bytes").cast("decimal(38,0)"))).first()[0] or 0
    is_large = F.col("bytes").cast("decimal(38,0)") * bundles >= F.lit(total).cast("decimal(38,0)")
    large = groups.where(is_large).select(*GROUP, "bytes", F.lit(None).cast("int").alias("bundle"))
    small = groups.where(~is_large).groupBy(bundle(bundles).alias("bundle")).agg(F.sum("bytes").alias("bytes"))
    small = small.select(*[F.lit(None).cast("bigint").alias(c) for c in GROUP], "bytes", "bundle")
    items = large.unionByName(small).repartition(1).sortWithinPartitions(F.desc("bytes"), *GROUP, "bundle")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = list(batches)
        if not given:
            return
        table = pa.Table.from_batches(given)
        shard = [0] * len(table)
        for k, names in enumerate(differenced(list(enumerate(table["bytes"].to_pylist())), shards)):
            for name in names:
                shard[name] = k
        yield from table.append_column("shard", pa.array(shard, pa.int32())).to_batches()

    found = written(items.mapInArrow(dealt, "size bigint, text_crc32 bigint, text_hash bigint, bytes bigint, bundle int, shard int"), "shards")
    return Plan(found.where("bundle IS NULL").select(*GROUP, F.col("shard").alias("own_shard")),
                found.where("bundle IS NOT NULL").select("bundle", F.col("shard").alias("bundle_shard")), bundles)


def slotted(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``shard``), each with its ``slot``: its place in the shard, gapless from 0.

    Rows are written as they lie; a slot is the number of the shard's rows in earlier parts and
    of those before it in its own part, so neither a shard nor a group is gathered in one task.
    """
    place = F.monotonically_increasing_id()
    parts = written(docs.withColumns({"part": F.shiftright(place, 33).cast("int"), "place": place}), "slots")
    counts = parts.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("behind"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("place")) - 1
    return parts.withColumn("within", within).join(counts, ["shard", "part"]).withColumn("slot", F.col("behind") + F.col("within")).drop("part", "place", "within", "behind")


def sharded(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES, text: str = "text", into: str = "shard") -> DataFrame:
    """All columns of ``docs`` and ``into``, the shard from 0 on; a column of that name is replaced.

    Null and empty texts are one group of a byte each. Equal texts, so repeated rows too, share a shard.
    Shard 0 has the most bytes. An empty table gives an empty one.
    """
    row = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    found = grouped(row)
    dealt = plan(found, shards, bundles).apply(found)
    return dealt.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != into], F.col("shard").alias(into))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, tasks_per_shard: int = 1, into: str = "shard") -> None:
    """Writes ``docs`` into one folder per shard, each by ``tasks_per_shard`` tasks."""
    spread = sharded(docs, shards, into=into)
    spread.repartition(shards * tasks_per_shard, into, F.pmod(F.xxhash64(*docs.columns), F.lit(tasks_per_shard))).write.partitionBy(into).parquet(path)


def report(docs: DataFrame) -> DataFrame:
    """Per document: size, crc32 of its text, shard and slot, by the law of equal bytes."""
    found = grouped(docs.select("doc_id", "text")).drop("text")
    found = written(found, "sizes")
    dealt = slotted(plan(found).apply(found))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
