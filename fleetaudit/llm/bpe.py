"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has one encoding, so it has one last token. A table of those
last tokens is the whole state of an encoder: a longer text only adds entries, and reading
the table backwards gives the encoding of any prefix. A token can end a prefix exactly if
the last token of what stands before it, followed by the token, is itself how their bytes
are encoded; as a sequence is an encoding when each neighbouring pair is one, a look at one
pair settles it.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from public_tokenizers import PATTERN
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetaudit.llm.common import text_or_empty

#: Pieces whose packed ids a Python worker remembers, and neighbouring pairs whose fit it remembers.
REMEMBERED_PIECES = 400_000
REMEMBERED_PAIRS = 1_000_000
#: Characters of texts that are encoded together; a longer text is taken by itself.
TOGETHER = 4_000_000


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks by token from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


class PrefixCoder:
    """Last tokens of prefixes for one vocabulary. Every single byte has to be a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.sizes.values())
        self.never = max(self.tokens) + 1
        #: By what tokens begin with: the tokens that end it, longest first, with size and ``_fit``, once they were asked for.
        self.heads: dict[bytes, tuple[tuple[int, int, dict[int, bool]], ...] | None] = dict.fromkeys(token[:n] for token in ranks for n in range(1, len(token) + 1))
        #: By token: does it fit behind others?
        self._fit: dict[int, dict[int, bool]] = {rank: {} for rank in self.tokens}
        self._pairs = 0
        self._parts: dict[int, tuple[int, ...]] = {}
        self._edges: dict[tuple[int, int], list[int]] = {}

    def merged(self, piece: bytes, least: int = 1) -> list[int]:
        """The encoding by definition: merge the pair of lowest rank until none, or ``least`` parts, are left. For short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > least:
            ranked = [self.ranks.get(a + b, self.never) for a, b in zip(parts, parts[1:])]
            rank = min(ranked)
            if rank == self.never:
                break
            best = ranked.index(rank)
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[part] for part in parts]

    def parts(self, token: int) -> tuple[int, ...]:
        """The two tokens whose merge makes this one, itself alone if it is a byte, none if merges never make it."""
        known = self._parts.get(token)
        if known is None:
            piece = self.tokens[token]
            found = self.merged(piece, 2) if len(piece) > 1 else [token]
            made = len(found) == 1 or len(found) == 2 and self.ranks.get(self.tokens[found[0]] + self.tokens[found[1]]) == token
            known = self._parts[token] = tuple(found) if made else ()
        return known

    def edge(self, token: int, side: int) -> list[int]:
        """The tokens that stand at one end of this one (1: right, 0: left) while it is put together, from the byte to itself."""
        known = self._edges.get((token, side))
        if known is None:
            chain = [token]
            while len(parts := self.parts(chain[-1])) == 2:
                chain.append(parts[side])
            known = self._edges[token, side] = chain[::-1]
        return known

    def fits(self, left: int, right: int) -> bool:
        """Are the two tokens the encoding of their joint bytes? With -1 on the left: is the other one that of its own?

        Both are put together in order of rank. They come out whole unless, at some moment,
        what stands on either side of the border would be merged first.
        """
        known = self._fit[right].get(left)
        if known is None:
            if self._pairs >= REMEMBERED_PAIRS:
                self._pairs = 0
                for behind in self._fit.values():
                    behind.clear()
            self._pairs += 1
            known = self._fit[right][left] = self._apart(self.edge(left, 1), self.edge(right, 0)) if left >= 0 else bool(self.parts(right))
        return known

    def _apart(self, ends: list[int], starts: list[int]) -> bool:
        i = j = 0
        while True:
            across = self.ranks.get(self.tokens[ends[i]] + self.tokens[starts[j]], self.never)
            before = ends[i + 1] if i + 1 < len(ends) else self.never
            behind = starts[j + 1] if j + 1 < len(starts) else self.never
            if across < before and across <= behind and across < self.never:  # of equal ranks, the leftmost pair goes first
                return False
            if before == behind == self.never:
                return True
            if before <= behind:
                i += 1
            else:
                j += 1

    def extend(self, data: bytes, table: list[int]) -> list[int]:
        """Fills the table up to the end of the data. ``table[i]`` is the last token of ``data[:i]``; an empty one is ``[-1]``.

        The entries there are stay valid whatever is appended.
        """
        self._fill(data, table, [max(0, len(table) - self.longest)], len(data))
        return table

    def _fill(self, data: bytes, table: list[int], starts: list[int], stop: int) -> None:
        """Entries up to ``stop``. No token that ends behind the table begins before the last of ``starts``, which grows along.

        A token that ends somewhere also ends the longest text there that tokens begin with.
        Where that one begins only moves on, so a byte takes two lookups, however long tokens are.
        """
        heads, at = self.heads, starts[-1]
        for end in range(len(table), stop + 1):
            while (head := data[at:end]) not in heads:
                at += 1
            starts.append(at)
            for size, token, fit in heads[head] or self._endings(head):
                known = fit.get(table[end - size])
                if known or known is None and self.fits(table[end - size], token):
                    table.append(token)
                    break

    def _endings(self, head: bytes) -> tuple[tuple[int, int, dict[int, bool]], ...]:
        ends = [self.ranks.get(head[at:]) for at in range(len(head))]
        found = self.heads[head] = tuple((self.sizes[token], token, self._fit[token]) for token in ends if token is not None)
        return found

    def edited(self, data: bytes, table: list[int], start: int, stop: int, put: bytes) -> tuple[bytes, list[int], int]:
        """``data[start:stop]`` replaced by ``put``: the new bytes, their table, and how many entries had to be computed.

        Entries before the edit stay. After it, as soon as one token's length of entries in
        a row agrees with the old ones, all later entries do, as they depend on nothing else.
        """
        new, shift = data[:start] + put + data[stop:], len(put) - (stop - start)
        fresh, agreed = table[: start + 1], 0
        while len(fresh) <= len(new):
            done = len(fresh)
            self._fill(new, fresh, [max(0, done - self.longest)], min(len(new), done - 1 + self.longest))
            for end in range(done, len(fresh)):
                agreed = agreed + 1 if end - shift > stop and fresh[end] == table[end - shift] else 0
                if agreed >= self.longest:
                    return new, fresh[: end + 1] + table[end - shift + 1 :], len(fresh) - start - 1
        return new, fresh, len(new) - start

    def read(self, table: list[int], end: int | None = None) -> list[int]:
        """The encoding of the prefix that ends there (of all, if None), read backwards."""
        end, ids = len(table) - 1 if end is None else end, []
        while end > 0:
            ids.append(table[end])
            end -= self.sizes[table[end]]
        return ids[::-1]

    def pieces(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """Encodings of matches of the splitting pattern: one token if it is in the vocabulary, else by the table.

        The table goes on from match to match, less what is not a prefix of the next one. In
        ascending order most of it stays.
        """
        table, starts, last = [-1], [0], b""
        for piece in pieces:
            known = self.ranks.get(piece)
            if known is not None:
                yield [known]
                continue
            same = 0
            for a, b in zip(piece, last):
                if a != b:
                    break
                same += 1
            del table[same + 1 :], starts[same + 1 :]
            self._fill(piece, table, starts, len(piece))
            yield self.read(table)
            last = piece


class TextCoder:
    """Whole texts: each match of the splitting pattern is encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.coder, self.split = PrefixCoder(ranks), regex.compile(pattern, regex.VERSION1)
        #: Ids by match.
        self.packed: dict[str, bytes] = {}
        #: Ids of a run without spaces, with the one space before it; None if it is empty or has white space at an end.
        self.spaced: dict[str, bytes | None] = {}
        self.tokens = pa.array([self.coder.tokens.get(rank, b"") for rank in range(self.coder.never)], pa.large_binary())

    def learn(self, matches: Iterable[str]) -> None:
        """The ids of these matches are in ``packed`` afterwards."""
        new = sorted(set(matches).difference(self.packed))
        for match, ids in zip(new, self.coder.pieces(map(str.encode, new))):
            self.packed[match] = array("I", ids).tobytes()

    def learn_runs(self, runs: set[str]) -> None:
        """The runs are in ``spaced`` afterwards. They are split as one text, in which each begins with its space."""
        new = runs.difference(self.spaced)
        whole = [run for run in new if run and run == run.strip()]
        self.spaced.update(dict.fromkeys(new))
        matches = self.split.findall(" " + " ".join(whole)) if whole else []
        self.learn(matches)
        ids = list(map(self.packed.__getitem__, matches))
        starts = [i for i, match in enumerate(matches) if match[0] == " "]
        for run, start, stop in zip(whole, starts, [*starts, len(ids)][1:], strict=True):
            self.spaced[run] = ids[start] if stop - start == 1 else b"".join(ids[start:stop])

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text. What was not met before is encoded once for all of them, in order.

        No match spans a single space between two characters that aren't white space, and one
        begins there; such texts are looked up run by run. Others are split as a whole.
        """
        for remembered in (self.packed, self.spaced):
            if len(remembered) >= REMEMBERED_PIECES:
                remembered.clear()
        self.learn_runs(set().union(*(text.split(" ")[1:] for text in texts)))
        found, split = [], []
        for text in texts:
            first, *rest = text.split(" ")
            ids = list(map(self.spaced.__getitem__, rest))
            by_run = first and first == first.strip() and None not in ids
            found.append(b"".join(ids) if by_run else b"")
            split.append(self.split.findall(first if by_run else text))
        self.learn(match for matches in split for match in matches)
        return [b"".join(map(self.packed.__getitem__, matches)) + ids for matches, ids in zip(split, found)]

    def decode(self, ids: bytes) -> bytes:
        if not ids:
            return b""
        places = pa.Array.from_buffers(pa.uint32(), len(ids) // 4, [None, pa.py_buffer(ids)])
        taken = self.tokens.take(places)
        start, stop = memoryview(taken.buffers()[1]).cast("q")[: len(places) + 1 : len(places)]
        return taken.buffers()[2][start:stop].to_pybytes()

    def edited(self, text: str, start: int, stop: int, put: str) -> tuple[str, bytes, int]:
        """``text[start:stop]`` replaced by ``put``: the new text, its ids, and how many pieces were encoded anew.

        A match depends on its characters and the one behind it. Matches that end before the
        edit stay, and from where a new match begins at an old boundary behind the edit, all stay.
        """
        old = list(self.split.finditer(text))
        new, shift = text[:start] + put + text[stop:], len(put) - (stop - start)
        keep = 0
        while keep < len(old) and old[keep].end() < start:
            keep += 1
        keep = max(0, keep - 1)
        at = old[keep].start() if keep < len(old) else 0
        starts = {m.start() + shift: k for k, m in enumerate(old) if m.start() >= stop}
        middle = []
        for match in self.split.finditer(new, at):
            if match.start() in starts and match.start() >= start + len(put):
                tail = [m.group() for m in old[starts[match.start()] :]]
                break
            middle.append(match.group())
        else:
            tail = []
        pieces = [m.group() for m in old[:keep]] + middle + tail
        self.learn(pieces)
        return new, b"".join(map(self.packed.__getitem__, pieces)), len(middle)


def together(texts: Iterable[str], size: int = TOGETHER) -> Iterator[list[str]]:
    """The texts in groups of about as many characters."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def encoder(spark: SparkSession, ranks_path: str) -> Column:
    """A function of a text column: struct of ``n_tokens``, ``ids`` (packed) and ``decoded`` bytes.

    The rank file is read by the driver and sent to the executors; its size is that of the
    vocabulary, whatever the corpus. A Python worker keeps what it was sent, and with it the
    coder it made, for its later tasks.
    """
    with open(ranks_path, "rb") as file:
        sent = spark.sparkContext.broadcast({"ranks": file.read()})

    @F.arrow_udf("n_tokens bigint, ids binary, decoded binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kept = sent.value
        if "coder" not in kept:
            kept["coder"] = TextCoder(parse_ranks(kept["ranks"]))
        coder = kept["coder"]
        for texts in batches:
            ids = [found for group in together(text.as_py() for text in texts) for found in coder.encode_all(group)]
            columns = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(map(coder.decode, ids), pa.binary())]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "ids", "decoded"])

    return encode


def encode(docs: DataFrame, ranks_path: str, text: str = "text", into: str = "bpe") -> DataFrame:
    """All columns of ``docs`` and the struct ``into``; a column of that name is replaced.

    A null or empty text has no tokens. Equal texts get equal ids. Rows are independent, so
    an empty table gives an empty table and a lost task is simply run again.
    """
    return docs.withColumn(into, encoder(docs.sparkSession, ranks_path)(text_or_empty(text)))


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Per document: ``doc_id``, ``n_tokens`` and the SHA-256 of the packed ids and of the decoded bytes."""
    coded = encode(docs.select("doc_id", "text"), ranks_path)
    return coded.select(
        "doc_id", F.col("bpe.n_tokens").alias("n_tokens"),
        F.sha2("bpe.ids", 256).alias("ids_sha256"), F.sha2("bpe.decoded", 256).alias("decoded_sha256"))
