"""Exact top-k search by vector-approximation files.

Vectors are whole numbers. Beside each stands its approximation, the cell per component
(its high bits). For a query, cells alone bound the inner product from both sides; exact
vectors are read in order of their upper bounds, and only until the kth result found is
above all bounds left. Equal vectors are one entry with its smallest ids, which is all that
a top k can show of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetaudit.llm.common import written

SCALE, TOP = 64, 20
#: Bits of a component that its cell leaves out; vectors and queries in a block.
SHIFT, VECTORS_IN_BLOCK, QUERIES_IN_BLOCK = 3, 4096, 1024


def whole_vectors(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the components as ``floor(scale * x)``; rows with a null vector or id, or a null or non-finite component, are left out.

    Inner products have to fit 64 bits.
    """
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False))).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))


def bounds(queries: np.ndarray, cells: np.ndarray, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner products (rows: queries) of vectors whose components lie in the cells.

    A component is its cell's lower edge and a rest of 0 to ``2**shift - 1``; the rests can
    add the positive components' share at most, and take the negative ones' at most.
    """
    exact = np.abs(queries).sum(axis=1, dtype=np.float64).max(initial=0) * (np.abs(cells).max(initial=0) + 1.0) < 2**50
    base = (queries.astype(np.float64) @ cells.T.astype(np.float64)).astype(np.int64) if exact else queries @ cells.T
    base <<= shift
    rest = (1 << shift) - 1
    return base + rest * np.minimum(queries, 0).sum(axis=1)[:, None], base + rest * np.maximum(queries, 0).sum(axis=1)[:, None]


def best(query: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Positions and scores of all vectors that can be in the query's top k, ties with the kth included."""
    if len(vectors) > k:
        floor = np.partition(low, len(low) - k)[len(low) - k]  # so much the kth best has at least
        able = np.flatnonzero(high >= floor)
    else:
        able = np.arange(len(vectors))
    able = able[np.argsort(-high[able], kind="stable")]
    scores = np.empty(0, np.int64)
    for at in range(0, len(able), step):
        if len(scores) >= k and high[able[at]] < np.partition(scores, len(scores) - k)[len(scores) - k]:
            able = able[:at]
            break
        scores = np.concatenate([scores, vectors[able[at : at + step]] @ query])
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        able, scores = able[scores >= kth], scores[scores >= kth]
    return able, scores


def searched(batches: Iterator[pa.RecordBatch], k: int, shift: int) -> Iterator[pa.RecordBatch]:
    """Per query of a pair of blocks, its best entries. Rows come sorted by pair, those of queries first."""
    held: list[pa.RecordBatch] = []

    def results(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows)
        number = table.column("entry").to_numpy()
        asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        size = len(table.column("v")[0])
        values = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(number), size)
        queries, vectors = values[asks], values[~asks]
        if not len(queries) or not len(vectors):
            return
        entries, cells = number[~asks], vectors >> shift
        for at in range(0, len(queries), 128):
            low, high = bounds(queries[at : at + 128], cells, shift)
            for i in range(len(low)):
                found, scores = best(queries[at + i], vectors, low[i], high[i], k)
                # Every entry has a row of its own under its number, so of equal scores the k smallest numbers are enough.
                first = np.lexsort((entries[found], -scores))[:k]
                found, scores = found[first], scores[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), number[asks][at + i])), pa.array(entries[found]), pa.array(scores)], names=["query", "entry", "score"])

    last = None
    for batch in batches:
        pair = np.stack([batch.column(n).to_numpy() for n in ("dim", "qb", "vb")], axis=1)
        if not len(pair):
            continue
        edges = np.flatnonzero((pair[1:] != pair[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(pair)]):
            if held and tuple(pair[start]) != last:
                yield from results(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = tuple(pair[start])
    if held:
        yield from results(held)


def top(embeddings: DataFrame, asking, k: int = TOP, shift: int = SHIFT, vectors_in_block: int = VECTORS_IN_BLOCK, queries_in_block: int = QUERIES_IN_BLOCK) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best rows for each row for which ``asking`` (of ``vec_id``) holds.

    Every row but the query's own is searched; ties go to the smaller id. Vectors of another
    length than the query's are not compared with it. Rows with equal id and vector are one.
    """
    rows = whole_vectors(embeddings).dropDuplicates(["vec_id", "v"])
    rows = written(rows.select("vec_id", "v", F.struct(F.xxhash64("v"), F.xxhash64(F.lit(1), "v"), F.size("v")).alias("same")), "vectors")
    # One entry per distinct vector, with the k + 1 smallest ids: a query may itself be one of them.
    nth = F.row_number().over(Window.partitionBy("same").orderBy("vec_id"))
    members = written(rows.select("same", "vec_id", nth.alias("nth")).where(F.col("nth") <= k + 1), "members")
    first = members.where("nth = 1").select("same", F.col("vec_id").alias("entry"))
    entries = rows.join(first, (rows["vec_id"] == first["entry"]) & (rows["same"] == first["same"])).select("entry", "v", F.size("v").alias("dim"))
    asked = rows.where(asking(F.col("vec_id")))
    queries = asked.join(first, "same").select("vec_id", "entry")
    queries = written(queries.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")), "queries")
    entries = written(entries.join(queries.select(F.col("query").alias("entry"), F.lit(True).alias("asks")).distinct(), "entry", "left"), "entries")
    n_vectors = entries.count()
    n_queries = entries.where("asks").count()
    vector_blocks, query_blocks = max(1, -(-n_vectors // vectors_in_block)), max(1, -(-n_queries // queries_in_block))

    def block(n: int):
        return F.pmod(F.xxhash64("entry"), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Each block of queries meets each block of vectors.
    dealt = entries.withColumns({"vb": block(vector_blocks), "asks": F.lit(False)}).withColumn("qb", every(query_blocks)).unionByName(
        entries.where("asks").withColumn("qb", block(query_blocks)).withColumn("vb", every(vector_blocks)))
    dealt = dealt.where("dim > 0").repartition(vector_blocks * query_blocks, "dim", "qb", "vb").sortWithinPartitions("dim", "qb", "vb")
    found = dealt.mapInArrow(lambda batches: searched(batches, k + 1, shift), "query bigint, entry bigint, score bigint")
    # The blocks' best entries, then their rows.
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "entry"))
    found = found.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    ids = members.join(first, "same").select("entry", "vec_id")
    inside = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    lists = found.join(ids, "entry").withColumn("place", inside).where(F.col("place") <= k + 1)
    lists = lists.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("hits"))
    mine = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return queries.distinct().join(lists, "query").select("query_id", F.posexplode(mine).alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def report(embeddings: DataFrame) -> DataFrame:
    return top(embeddings, lambda vec_id: vec_id % 20 == 0)


REPORT_SQL = """
WITH e AS (
    SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)])::BIGINT AS score
    FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
