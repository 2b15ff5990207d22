"""Stretches of words that repeat periodically, found in a Re-Pair grammar of each text.

A text's words become ids, and pairs of neighbouring symbols that recur in the text are replaced by
nonterminals, in rounds: in each round a pair is replaced wherever no overlapping pair recurs more
often. A pair that occurs once can never be part of a recurring pair, so a round looks only at
those that recurred before. Symbols that are left are paired level by level until one covers the text.

Any periodic stretch crosses the boundary between the two halves of exactly one node of this
derivation, the lowest that holds it all. Per nonterminal, not per occurrence, the stretches that cross its
boundary are worked out once, at its first occurrence, and carried over to all positions where it is derived; of the
intervals so found the maximal ones are kept. A stretch of at least four periods has two of them on one
side of the boundary, so equal hashes of the two words blocks there pick the (nonterminal, period)
pairs to look at; words themselves then decide how far a stretch goes.

All texts of a block of bounded size are worked on at once, with arrays; symbols of different texts
are different, so a text's result doesn't depend on its neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetaudit.llm.common import SPACE_CLASS, id_crc, text_or_empty

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts are taken together until they have this many words (a longer text is alone), and this many (nonterminal, period) pairs are tested at a time.
BLOCK_WORDS, BLOCK_TESTS = 200_000, 1_000_000
MULTIPLIER = 0x9E3779B97F4A7C15


class Derivation:
    """Nodes of the derivation trees of all texts: ``symbol``, ``start``, ``middle`` and ``end`` in the words of all texts."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, symbol: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> None:
        self.parts.append((symbol, start, middle, end))

    def nodes(self) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(x) for x in zip(*self.parts)) if self.parts else (np.empty(0, np.int64),) * 4


def re_pair(ids: np.ndarray, text: np.ndarray) -> Derivation:
    """The derivation of texts given as word ids; ``text`` is the number of each word's text, in order."""
    made, n = Derivation(), len(ids)
    # The sequence: symbol at each place, and how far it reaches. A text's ids are its own.
    symbol = pd.factorize(text * (ids.max(initial=0) + 1) + ids)[0].astype(np.int64)
    start = np.arange(n, dtype=np.int64)
    fresh = int(symbol.max(initial=-1)) + 1
    live = np.ones(n, bool)  # may the pair of this place and the next one recur?
    live[-1:] = False
    live[:-1] &= text[1:] == text[:-1]
    end_of = np.append(start[1:], n)
    while live.any():
        at = np.flatnonzero(live)
        pair = symbol[at] * fresh + symbol[at + 1]
        kind, count = _counted(pair)
        often = count[kind] > 1
        live[at[~often]] = False
        at, pair, kind = at[often], pair[often], kind[often]
        if not len(at):
            break
        # More often goes first; ties by a hash of the pair, so that equal counts don't queue up along a text.
        rank = (count[kind].astype(np.uint64) << np.uint64(40)) | ((kind.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(24))
        weight = np.zeros(len(symbol) + 1, np.uint64)
        weight[at] = rank
        best = (rank >= weight[at + 1]) & (rank >= weight[at - 1])
        # Neighbours of one weight are one pair over itself (aaa): every other one is taken.
        best_at = at[best]
        gap = np.ones(len(best_at), bool)
        gap[1:] = np.diff(best_at) != 1
        group = np.cumsum(gap) - 1
        odd = (best_at - best_at[gap][group]) % 2 == 1
        taken, taken_kind = best_at[~odd], kind[best][~odd]
        made.add(fresh + taken_kind, start[taken], start[taken + 1], end_of[taken + 1])
        symbol[taken] = fresh + taken_kind
        live[taken] = live[taken + 1]
        keep = np.ones(len(symbol), bool)
        keep[taken + 1] = False
        symbol, start, live = symbol[keep], start[keep], live[keep]
        end_of = np.append(start[1:], n)
        fresh += len(count)
    # What is left, level by level: pairs of neighbours, each a nonterminal of its own.
    owner = text[start]
    while len(start):
        first = np.ones(len(start), bool)
        first[1:] = owner[1:] != owner[:-1]
        place = np.arange(len(start)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        left = np.flatnonzero((place[:-1] % 2 == 0) & (owner[1:] == owner[:-1]))
        if not len(left):
            break
        made.add(fresh + np.arange(len(left)), start[left], start[left + 1], end_of[left + 1])
        fresh += len(left)
        keep = np.ones(len(start), bool)
        keep[left + 1] = False
        start, owner = start[keep], owner[keep]
        end_of = np.append(start[1:], n)
    return made


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct value, from 0, and how often each occurs."""
    codes, distinct = pd.factorize(values)
    return codes, np.bincount(codes, minlength=len(distinct))


def _reach(ids: np.ndarray, at: np.ndarray, period: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
    """How many words in a row, from ``at`` on in the direction of ``step``, equal the word a period later; at most ``limit``."""
    length, left, width = np.zeros(len(at), np.int64), np.arange(len(at)), 4
    while len(left):
        room = limit[left] - length[left]
        ahead = np.arange(width)
        inside = ahead < room[:, None]
        where = np.where(inside, (at[left] + step * length[left])[:, None] + step * ahead, 0)
        later = np.where(inside, where + period[left, None], 0)
        equal = inside & (ids[where] == ids[later])
        run = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
        length[left] += run
        left = left[run == width]
        width = int(max(4, min(4 * width, 2_000_000 // max(1, len(left)))))
    return length


def crossing(ids: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Periodic stretches across the middle of nodes: the node's number, first word, end and period; maximal within the node."""
    codes = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(MULTIPLIER)
    codes ^= codes >> np.uint64(29)
    power = np.empty(len(ids) + 1, np.uint64)
    power[0] = 1
    power[1:] = np.uint64(MULTIPLIER | 1)
    power = np.cumprod(power, dtype=np.uint64)
    upto = np.concatenate(([np.uint64(0)], np.cumsum(codes * power[:-1], dtype=np.uint64)))

    def square(at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Do the q words from ``at`` on and the q behind them have one hash?"""
        return (upto[at + q] - upto[at]) * power[q] == upto[at + 2 * q] - upto[at + q]

    found: list[tuple[np.ndarray, ...]] = []
    most = np.maximum(middle - start, end - middle) // 2
    order = np.flatnonzero((most > 0) & (end - start >= LEAST_WORDS))
    upto_node = np.concatenate(([0], np.cumsum(most[order])))
    first = 0
    while first < len(order):
        last = max(first + 1, int(np.searchsorted(upto_node, upto_node[first] + BLOCK_TESTS, "right")) - 1)
        counts = most[order[first:last]]
        node = np.repeat(order[first:last], counts)
        q = np.arange(1, len(node) + 1) - np.repeat(np.cumsum(counts) - counts, counts)
        for left in (True, False):
            fits = np.flatnonzero(middle[node] - 2 * q >= start[node] if left else middle[node] + 2 * q <= end[node])
            n, p = node[fits], q[fits]
            hit = square(middle[n] - 2 * p if left else middle[n], p)
            found += _extended(ids, n[hit], p[hit], start, middle, end, left)
        first = last
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4


def _extended(ids, node, q, start, middle, end, left: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """The stretches around squares that end (``left``) or begin at the middle of nodes.

    A node's periods come in rising order. Multiples of a period whose square lies in the
    stretch just found are no news; so few rounds are left, whatever the node's length.
    """
    while len(node):
        lead = np.ones(len(node), bool)
        lead[1:] = node[1:] != node[:-1]
        n, p = node[lead], q[lead]
        pivot = middle[n] - p if left else middle[n]
        stop = pivot + _reach(ids, pivot, p, end[n] - p - pivot, 1) + p
        begin = pivot - _reach(ids, pivot - 1, p, pivot - start[n], -1)
        long = stop - begin >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        yield n[long], begin[long], stop[long], p[long]
        which = np.cumsum(lead) - 1
        inside = middle[node] - 2 * q >= begin[which] if left else middle[node] + 2 * q <= stop[which]
        keep = ~lead & ~(inside & (q % p[which] == 0))
        node, q = node[keep], q[keep]


def runs_of(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """All runs, as rows of text, first word (among all words given), end and period, in this order."""
    symbol, start, middle, end = re_pair(ids, text).nodes()
    if not len(symbol):
        return np.empty((0, 4), np.int64)
    # A nonterminal's first occurrence stands for all.
    order = np.argsort(symbol, kind="stable")
    symbol, start, middle, end = symbol[order], start[order], middle[order], end[order]
    new = np.ones(len(symbol), bool)
    new[1:] = symbol[1:] != symbol[:-1]
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(symbol))
    node, begin, stop, period = crossing(ids, start[heads], middle[heads], end[heads])
    if not len(node):
        return np.empty((0, 4), np.int64)
    # Carried over to all places where the nonterminal is derived.
    times = (tails - heads)[node]
    row = np.repeat(np.arange(len(node)), times)
    place = heads[node][row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    shift = start[place] - start[heads[node]][row]
    begin, stop, period = begin[row] + shift, stop[row] + shift, period[row]
    # Maximal intervals of each period: those not inside one that begins earlier.
    order = np.lexsort((-stop, begin, period))
    begin, stop, period = begin[order], stop[order], period[order]
    reach = np.maximum.accumulate(stop + period * (len(ids) + 1)) - period * (len(ids) + 1)
    kept = np.ones(len(begin), bool)
    kept[1:] = (stop[1:] > reach[:-1]) | (period[1:] != period[:-1])
    begin, stop, period = begin[kept], stop[kept], period[kept]
    # One stretch, several periods: the smallest.
    order = np.lexsort((period, stop, begin))
    begin, stop, period = begin[order], stop[order], period[order]
    kept = np.ones(len(begin), bool)
    kept[1:] = (begin[1:] != begin[:-1]) | (stop[1:] != stop[:-1])
    begin, stop, period = begin[kept], stop[kept], period[kept]
    order = np.lexsort((period, begin))
    return np.stack([text[begin[order]], begin[order], stop[order], period[order]], axis=1)


KIND = pa.struct([
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
    ("collapsed", pa.string())])


def _block(texts: list[list[bytes]]) -> list[dict]:
    """Runs and collapsed text of each text, given as its words."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if not sizes.sum():
        return [{"n_words": 0, "runs": [], "collapsed": ""} for _ in texts]
    ids = pd.factorize(np.array([w for words in texts for w in words], object))[0].astype(np.int64)
    offset = np.cumsum(sizes) - sizes
    runs = runs_of(ids, np.repeat(np.arange(len(texts)), sizes))
    first = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    out = []
    for k, words in enumerate(texts):
        mine = runs[first[k] : first[k + 1]]
        kept = words
        if len(mine):
            dropped = np.zeros(len(words) + 1, np.int64)
            np.add.at(dropped, mine[:, 1] + mine[:, 3] - offset[k], 1)
            np.add.at(dropped, mine[:, 2] - offset[k], -1)
            kept = [words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]
        out.append({"n_words": len(words), "collapsed": b" ".join(kept).decode(),
                    "runs": [{"start": b - int(offset[k]), "length": e - b, "period": p} for _, b, e, p in mine.tolist()]})
    return out


def _in_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows, waiting, words = [], [], 0
        for value in texts:
            waiting.append(value.as_py().encode().split())
            words += len(waiting[-1])
            if words >= BLOCK_WORDS:
                rows += _block(waiting)
                waiting, words = [], 0
        rows += _block(waiting)
        yield pa.array(rows, KIND)


def periodic_runs(docs: DataFrame, text: str = "text", into: str = "periodic") -> DataFrame:
    """All columns of ``docs`` and the struct ``into``: ``n_words``, ``runs`` and ``collapsed``; a column of that name is replaced.

    ``runs`` are all maximal stretches of words with their smallest period that have at least
    six words and four periods: ``start`` (word number from 0), ``length``, ``period``, by start and period.
    ``collapsed`` is the text with each run cut to its first period, words joined by one space.
    A null or empty text has no words and no runs; equal texts get equal results; an empty
    table gives an empty one.
    """
    periodic = F.arrow_udf(_in_batches, "n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, collapsed string")
    return docs.withColumn(into, periodic(text_or_empty(text)))


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, which for one id in ten by crc32 ends in repeats of one passage.

    Other texts, those of rows without id and those without words stay; null counts as empty.
    """
    h = id_crc()
    words = F.when(h % 10 == 0, F.regexp_extract_all(text_or_empty(), F.lit(f"[^{SPACE_CLASS}]+"), F.lit(0)))
    d = docs.select("doc_id", text_or_empty().alias("text"), words.alias("w"), F.floor(h / 10).alias("g")).withColumn("n", F.expr("nullif(size(w), 0)"))
    d = d.withColumn("a", F.expr("int(pmod(g, n))")).withColumn("p", F.expr("int(1 + floor((n - a) / (3 + g % 8)))"))
    end = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.expr("int(ceil((n - a) / p))"))), F.lit(1), F.col("n") - F.col("a"))
    return d.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), end), " ")).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the longest one and digests of all runs and of the collapsed text."""
    found = periodic_runs(looped(docs)).select("doc_id", "periodic.*")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.short")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


REPORT_SQL = r"""
WITH ids AS (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL
), crc AS (
    SELECT doc_id, xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
        list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295), 4294967295) AS h
    FROM ids
), t AS (
    SELECT row_number() OVER () AS r, d.doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id
), a AS (SELECT *, len(w)::BIGINT AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN g % len(w) END AS a FROM t
), b AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a
), words AS (
    SELECT r, doc_id, n, i, CASE WHEN a IS NULL OR i < a THEN w[i + 1] ELSE w[1 + a + (i - a) % p] END AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM b)
), same AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 4
), islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same
), stretches AS (SELECT r, q, min(i) AS i, count(*) + q AS length FROM islands GROUP BY r, q, k HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS (SELECT r, i, length, min(q) AS q FROM stretches GROUP BY r, i, length
), per AS (
    SELECT r, count(*) AS n_runs, arg_min({'i': i, 'length': length, 'q': q}, {'a': -length, 'b': i, 'c': q}) AS best,
        string_agg(concat(i, ',', length, ',', q, chr(10)), '' ORDER BY i, q) AS lines
    FROM runs GROUP BY r
), dropped AS (SELECT DISTINCT r, unnest(range(i + q, i + length)) AS i FROM runs
), kept AS (SELECT w.r, string_agg(word, ' ' ORDER BY w.i) AS text FROM words w ANTI JOIN dropped x ON w.r = x.r AND w.i = x.i GROUP BY w.r)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.i AS start, best.length AS length, best.q AS period, 1000 * best.length // best.q AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM t LEFT JOIN per ON t.r = per.r LEFT JOIN kept ON t.r = kept.r
"""
