"""Near duplicates by SimHash, compared bit-sliced.

Fingerprints are first made distinct. Two of them within the radius agree in at least
``keep`` of ``parts`` bit ranges, so each choice of that many ranges deals the fingerprints
into buckets, and any link is inside one of them. A bucket is compared with its bits stored
as planes: one machine operation updates the distances to 64 fingerprints, which are held in
counters of one bit per plane; a block of fingerprints is given up as soon as all of it is
beyond the radius. A large bucket is dealt out as pairs of its chunks, and a comparison
hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetaudit.llm.common import text_or_empty, written

SHINGLE, RADIUS, PARTS = 4, 4, 6
#: Fingerprints in one chunk of a large bucket.
CHUNK = 2048


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles under XXH64 with seed 42; zero without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1]))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):  # bits unpacked take 64 times a hash
        part = np.array(hashes[at : at + 8192], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > len(hashes)))


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_hash`` and the fingerprint ``fp`` as a signed 64-bit integer."""

    @F.arrow_udf("bigint")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.array(values.view(np.int64))

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), prints(text_or_empty()).alias("fp"))


def planes(values: np.ndarray) -> np.ndarray:
    """Bits stored vertically: row b holds bit b of all values, 64 to a word; the last word is filled up with zeros."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    padded = np.zeros((64, -(-len(values) // 64) * 64), np.uint8)
    padded[:, : len(values)] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def within(value: int, sliced: np.ndarray, count: int, radius: int = RADIUS, step: int = 16) -> np.ndarray:
    """Positions of the sliced fingerprints within the radius of ``value``.

    Differing bits are added to carry-save counters, one word per 64 fingerprints and digit.
    The counters start so that passing the radius carries out of the highest digit, which
    marks the fingerprint for good; words with all 64 marked are left out of further planes.
    """
    digits = (radius + 1).bit_length()
    start = (1 << digits) - radius - 1
    words = np.arange(sliced.shape[1])
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    counter = [np.full(len(words), full if start >> d & 1 else 0, np.uint64) for d in range(digits)]
    beyond = np.zeros(len(words), np.uint64)
    for bit in range(64):
        carry = sliced[bit][words] if len(words) < sliced.shape[1] else sliced[bit]
        if value >> bit & 1:
            carry = ~carry
        for d in range(digits):
            counter[d], carry = counter[d] ^ carry, counter[d] & carry
        beyond = beyond | carry
        if bit % step == step - 1:
            alive = beyond != full
            if not alive.any():
                return np.empty(0, np.int64)
            if alive.sum() < len(alive) // 2:
                words, beyond = words[alive], beyond[alive]
                counter = [c[alive] for c in counter]
    near = np.unpackbits((~beyond).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, column = np.nonzero(near)
    found = words[row] * 64 + column
    return found[found < count]


def forest(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links that connect what the pairs within the radius connect: of ``left`` with ``right``, or among ``left``."""
    other = left if right is None else right
    every = left if right is None else np.concatenate([left, right])
    parent = list(range(len(every)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sliced, shift, links = planes(other), 0 if right is None else len(left), []
    for i, value in enumerate(left.tolist()):
        for j in within(value, sliced, len(other), radius).tolist():
            a, b = root(i), root(j + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(every[i]), int(every[j + shift])))
    return links


def near_in_runs(values: np.ndarray, run: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Positions of pairs within the radius in the same short run; ``run`` is in order.

    Each value meets the one ``shift`` behind it, for one shift after the other; the
    differences of a shift are sliced and counted like a block.
    """
    found, shift = [], 1
    while shift < len(values) and len(same := np.flatnonzero(run[:-shift] == run[shift:])):
        near = same[within(0, planes(values[same] ^ values[same + shift]), len(same), radius)]
        found += zip(near.tolist(), (near + shift).tolist())
        shift += 1
    return found


def compared(batches: Iterator[pa.RecordBatch], radius: int, short: int = 64) -> Iterator[pa.RecordBatch]:
    """Links in rows that are sorted by bucket and pair of chunks. A bucket at a batch's end waits for the next batch."""
    keys, rest = ("deal", "key", "low", "high"), None

    def found(columns: dict[str, np.ndarray], starts: np.ndarray, end: int) -> pa.RecordBatch:
        values = columns["fp"].view(np.uint64)
        sizes = np.diff(np.append(starts, end))
        long = sizes > short
        run = np.repeat(np.arange(len(starts)), sizes)
        rows = np.flatnonzero(~(long | (columns["low"][starts] != columns["high"][starts]))[run])
        links = [(int(values[rows[i]]), int(values[rows[j]])) for i, j in near_in_runs(values[rows], run[rows], radius)]
        for k in np.flatnonzero(long | (columns["low"][starts] != columns["high"][starts])):
            part = slice(starts[k], starts[k] + sizes[k])
            if columns["low"][starts[k]] == columns["high"][starts[k]]:
                links += forest(values[part], None, radius)
            else:
                second = columns["second"][part]
                if second.any() and not second.all():
                    links += forest(values[part][~second], values[part][second], radius)
        ends = np.array(spanning(links), np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    for batch in batches:
        columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in (*keys, "fp", "second")}
        if rest is not None:
            columns = {n: np.concatenate([rest[n], c]) for n, c in columns.items()}
        new = np.zeros(len(columns["fp"]), bool)
        new[:1] = True
        for n in keys:
            new[1:] |= columns[n][1:] != columns[n][:-1]
        starts = np.flatnonzero(new)
        if not len(starts):
            continue
        rest = {n: c[starts[-1] :] for n, c in columns.items()}
        yield found({n: c[: starts[-1]] for n, c in columns.items()}, starts[:-1], int(starts[-1]))
    if rest is not None:
        yield found(rest, np.array([0]), len(rest["fp"]))


def spanning(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """As few of the links as connect the same."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def links(prints: DataFrame, radius: int = RADIUS, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints ``fp`` that connect all those within the radius of each other."""
    keep = parts - radius
    if keep < 1:
        raise ValueError("more parts than the radius are needed")
    edges = [64 * k // parts for k in range(parts + 1)]
    masks = [sum(((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in chosen) for chosen in combinations(range(parts), keep)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("deal"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(signed)])).alias("b")).select("fp", "b.*")
    large = written(dealt.groupBy("deal", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk), "large-buckets")
    dealt = dealt.join(large, ["deal", "key"], "left")
    # Chunk i of m meets chunks i to m - 1: each fingerprint goes to the m pairs that its chunk is in.
    m = F.coalesce(F.ceil(F.col("n") / chunk), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), m).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), m - 1), lambda k: F.struct(
        F.least(k, mine).alias("low"), F.greatest(k, mine).alias("high"), (mine > k).alias("second")))
    dealt = dealt.select("deal", "key", "fp", F.explode(pairs).alias("p")).select("deal", "key", "fp", "p.*")
    dealt = dealt.repartition("deal", "key", "low", "high").sortWithinPartitions("deal", "key", "low", "high")
    return dealt.mapInArrow(lambda batches: compared(batches, radius), "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that it is connected with, for every node of ``edges`` (``a``, ``b``).

    Two steps in turn until nothing changes: every node's larger neighbours are tied to the
    smallest node it knows, then its smaller ones. Rows per node are reduced to a minimum
    before they meet, and each round is a table in the shared folder.
    """
    ties = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "ties")
    before = None
    while True:
        both = ties.unionByName(ties.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        ties = written(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "ties")
        seen = ties.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            break
        before = seen
    return ties.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(ties.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per document: ``doc_id``, ``text_hash``, ``fp``, its component's ``root`` and ``component_id``, the smallest ``doc_id`` it is linked with over any number of links.

    Null and empty texts have the fingerprint zero and are linked like others. Rows without
    id belong to a component too; its id is null only if none of its rows has one.
    """
    prints = written(with_fingerprint(docs, shingle), "simhash")
    found = components(links(prints.select("fp").distinct(), radius))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = least.join(found, least["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = written(roots, "simhash-roots")
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = roots.join(named, "root").select("fp", "root", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs``, all columns, with one document of each group of near copies: the one with the smallest id.

    Of rows that repeat this id in a group one stays; an id whose rows are in several groups
    can stay in each. Of a group without any id one row stays.
    """
    row = docs.select(F.struct("*").alias("row"))
    stay = grouped(row.select("row.doc_id", "row.text"), shingle, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rival = stay.groupBy("root", "doc_id").agg(F.min("text_hash").alias("text_hash"))
    rival = rival.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"))
    keyed = row.select("row", F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.text").alias("text_hash"))
    kept = keyed.join(rival, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")), "left_semi")
    first = Window.partitionBy("doc_id", "text_hash").orderBy(F.xxhash64("row"))
    return kept.withColumn("n", F.row_number().over(first)).where("n = 1").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    return grouped(docs.select("doc_id", "text")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
