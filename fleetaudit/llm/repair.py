"""Repairs the structure of conversations by the cheapest edits, found by branch and bound.

A conversation is sound when the initials of its turns' roles read ``(s?(ua)+)?``. Turns may be
kept, given another role, deleted, and empty ones put in, each at a cost; of the cheapest ways the
one whose edits, as letters, come first in ASCII order is taken.

The search goes depth first with a stack of its own. A branch ends when its cost and the lower bound
of what follows pass the best way found so far (on equal costs, when its letters do), or when its
node, a place and the role that stands before it, was reached before at less cost or by lesser letters.
The bound of a suffix is what its blank, repeated, truncated and odd rows cost at least,
and one for each disjoint pair of neighbours that can't both stay as they are.

Rows come sorted and are searched in blocks. Only the best way to each role that can stand before
a block matters behind it (equal costs and equal letters can't lead to one role by two ways), and
only if going on from another one isn't cheaper in any case. Those, four at most, go into the next
block; rows on which all of them agree are handed on at once, so a conversation's texts needn't be in
memory together. What stays per row is a digest of role and text, to tell repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fleetaudit.llm.common import SPACES

BLOCK = 32
DELETE, REROLE, INSERT, LEAVE = 2, 1, 5, 5
#: What may stand before a place: nothing, or a turn of the role with this initial; and the role that may follow.
STATES = "^sua"
NEXT = {"^": "user", "s": "user", "u": "assistant", "a": "user"}
LEGAL = {"su", "ua", "au"}
#: Cost of the turns that have to be put in at the end.
TAIL = {"^": 0, "a": 0, "u": INSERT, "s": 2 * INSERT}
#: What it costs at most to go on behind one role as if another stood there: by putting a turn in, or deleting a system turn.
INSTEAD = {
    ("a", "^"): DELETE, ("a", "s"): 0, ("a", "u"): INSERT, ("u", "^"): INSERT + DELETE, ("u", "s"): INSERT, ("u", "a"): INSERT,
    ("^", "a"): 0, ("^", "s"): 0, ("^", "u"): INSERT,
}


@dataclass
class Row:
    role: str
    text: str
    fault: str  # "b"lank, "d"uplicate, "t"runcated, or none

    @property
    def doomed(self) -> bool:
        return self.fault in ("b", "d")


class Bounds:
    """Lower bounds of what the rows from a place on cost, by the role before them."""

    def __init__(self, rows: list[Row]):
        n = len(rows)
        self.initial = [r.role[:1] for r in rows]
        self.least, self.pairs, self.clean = [0] * (n + 1), [0] * (n + 2), [n] * (n + 1)
        for i in reversed(range(n)):
            row, known = rows[i], self.initial[i] in ("s", "u", "a")
            self.least[i] = self.least[i + 1] + (DELETE if row.fault else 0 if known else min(REROLE, DELETE))
            self.pairs[i], self.clean[i] = self.pairs[i + 1], self.clean[i + 1]
            if row.fault:
                continue
            # The next row without fault whose role is known; a row of another role stands for any.
            after = self.clean[i + 1]
            if known and after < n and self.initial[i] + self.initial[after] not in LEGAL:
                self.pairs[i] = max(self.pairs[i], 1 + self.pairs[after + 1])
            self.clean[i] = i if known else n

    def of(self, i: int, state: str) -> int:
        first, pairs = self.clean[i], self.pairs[i]
        if first < len(self.initial):
            initial = self.initial[first]
            if state + initial not in LEGAL and not (state == "^" and initial in "su"):
                pairs = max(pairs, 1 + self.pairs[first + 1])
        return self.least[i] + pairs


#: For a role before a place: cost and letters of the best way there.
Ways = dict[str, tuple[int, str]]


def search(rows: list[Row], bounds: Bounds, ways: Ways, goal: str | None) -> tuple[int, str, str, str] | None:
    """The best way through the rows: cost, letters, the role it began behind, the letters of these rows.

    ``goal`` is the role to end behind; with None the conversation ends here, soundly.
    """
    n, best = len(rows), None
    table: dict[tuple[int, str], tuple[int, str]] = {}
    stack = sorted(((cost + bounds.of(0, s), letters, 0, s, cost, s, 0) for s, (cost, letters) in ways.items()), reverse=True)
    stack = [(i, s, cost, letters, begun, len(letters)) for _, letters, i, s, cost, begun, _ in stack]
    while stack:
        i, state, cost, letters, begun, behind = stack.pop()
        total = cost + bounds.of(i, state) + (TAIL[state] if i == n and goal is None else 0)
        if best and (total > best[0] or total == best[0] and letters > best[1][: len(letters)]):
            continue
        node = table.get((i, state))
        if node and node <= (cost, letters):
            continue
        table[i, state] = (cost, letters)
        if i == n and (TAIL[state] == 0 if goal is None else state == goal):
            if best is None or (cost, letters) < best[:2]:
                best = (cost, letters, begun, letters[behind:])
            continue
        steps = []
        if i < n:
            row, initial = rows[i], bounds.initial[i]
            steps.append((DELETE, "D", i + 1, state))
            if not row.doomed:
                left = LEAVE if row.fault else 0
                if initial == NEXT[state][0] or state == "^" and initial == "s":
                    steps.append((left, "K", i + 1, initial))
                if initial != NEXT[state][0]:
                    steps.append((left + REROLE, "R", i + 1, NEXT[state][0]))
        if i < n or goal is None:
            steps.append((INSERT, "I", i, NEXT[state][0]))
        # The most promising step is looked at first.
        steps.sort(key=lambda x: (x[0] + bounds.of(x[2], x[3]), x[1]), reverse=True)
        stack += [(j, s, cost + price, letters + letter, begun, behind) for price, letter, j, s in steps]
    return best


@dataclass
class Block:
    rows: list[Row]
    ends: dict[str, tuple[str, str]]  # by the role at its end: the role before it, and the letters


@dataclass
class Conversation:
    """Takes a conversation's rows in order, and hands repaired turns on to ``put(edit, role, text)`` (a deleted one with its own role)."""

    put: Callable[[str, str, str], None]
    block: int = BLOCK
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0
    turns: int = 0
    low: int | None = None
    high: int | None = None
    rows: list[Row] = field(default_factory=list)
    waiting: list[Block] = field(default_factory=list)
    ways: Ways = field(default_factory=lambda: {"^": (0, "")})
    seen: set[bytes] = field(default_factory=set)
    before: str | None = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        key = hashlib.md5(f"{len(role)}:{role}{text}".encode(), usedforsecurity=False).digest()
        stripped, fault = text.rstrip(SPACES), ""
        if not stripped:
            fault, self.blank = "b", self.blank + 1
        elif key in self.seen:
            fault, self.duplicate = "d", self.duplicate + 1
        elif stripped[-1] not in ".!?":
            fault, self.truncated = "t", self.truncated + 1
        self.seen.add(key)
        self.rows.append(Row(role, text, fault))
        if len(self.rows) == self.block:
            self._close(None)

    def _close(self, final: tuple | None) -> None:
        """Ends a block: the best way to each role at its end."""
        bounds, ends, ways = Bounds(self.rows), {}, {}
        found = {s: way for s in STATES if (way := search(self.rows, bounds, self.ways, s))}
        for state, (cost, letters, begun, mine) in found.items():
            if all(way[0] + INSTEAD.get((other, state), cost) >= cost for other, way in found.items()):
                ends[state], ways[state] = (begun, mine), (cost, letters)
        self.waiting.append(Block(self.rows, ends))
        self.rows, self.ways = [], ways
        # How far do all ways agree? Those rows are settled.
        live = set(ends)
        for k in reversed(range(len(self.waiting))):
            if len(live) == 1:
                self._settle(k + 1, live.pop())
                return
            live = {self.waiting[k].ends[s][0] for s in live}

    def _settle(self, count: int, state: str) -> None:
        path = []
        for block in reversed(self.waiting[:count]):
            state, letters = block.ends[state]
            path.append((block, state, letters))
        size = 0
        for block, begun, letters in reversed(path):
            self._replay(block.rows, begun, letters)
            size += len(letters)
        del self.waiting[:count]
        self.ways = {s: (cost, letters[size:]) for s, (cost, letters) in self.ways.items()}

    def _replay(self, rows: list[Row], state: str, letters: str) -> None:
        rest = iter(rows)
        for letter in letters:
            row = Row("", "", "") if letter == "I" else next(rest)
            role = NEXT[state] if letter in "IR" else row.role
            self.put(letter, role, row.text)
            state = state if letter == "D" else role[:1]

    def finish(self) -> None:
        cost, _, begun, letters = search(self.rows, Bounds(self.rows), self.ways, None)
        self.cost = cost
        self.waiting.append(Block(self.rows, {"": (begun, letters)}))
        self._settle(len(self.waiting), "")

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _walk(batches: Iterator[pa.RecordBatch], begin: Callable[[object], Conversation], done: Callable[[object, Conversation], None]) -> Iterator[None]:
    """Feeds sorted rows to one conversation after the other; a pause after each batch."""
    current, talk = None, None
    for batch in batches:
        for conv, turn, role, text, gone in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "gone"))):
            if talk is None or conv != current:
                if talk is not None:
                    talk.finish()
                    done(current, talk)
                current, talk = conv, begin(conv)
            if not gone:
                talk.add(turn, role, text)
        yield
    if talk is not None:
        talk.finish()
        done(current, talk)
    yield


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def sorted_turns(turns: DataFrame) -> DataFrame:
    """Rows of a conversation together and in order: by turn (nulls first), then role and text; the rest in the order of repeats."""
    if "gone" not in turns.columns:
        turns = turns.withColumn("gone", F.lit(False))
    one = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "gone")
    return one.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text", "gone")


def repairs(turns: DataFrame) -> DataFrame:
    """Per conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``): what is wrong, and the cheapest repair.

    ``gaps`` (missing turn numbers), ``blank``, ``duplicate``, ``truncated`` rows (each by its first
    fault), ``illegal`` neighbours, ``cost``, ``audit`` (edits as letters: Keep, Rerole, Delete, Insert)
    and ``repaired_sha256`` of the repaired ``role:text`` lines. Nulls in role and text count as one
    space, so such texts are blank. Rows without ``conv_id`` are one conversation; rows with equal
    turns are ordered by role and text. Rows marked in a boolean column ``gone`` only name their
    conversation. Other columns are not used; an empty table has no conversations. A conversation is
    read by one task, block by block, as its digest runs over all of it.
    """
    rows = sorted_turns(turns)
    conv = rows.schema["conv_id"]
    kinds = StructType([conv, *[StructField(c, LongType()) for c in COUNTS], StructField("audit", StringType()), StructField("repaired_sha256", StringType())])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind: list[pa.DataType] = []

        def begin(_):
            letters, digest = [], hashlib.sha256()

            def put(letter: str, role: str, text: str) -> None:
                letters.append(letter)
                if letter != "D":
                    digest.update((f"\n{role}:{text}" if put.any else f"{role}:{text}").encode())
                    put.any = True

            put.any, put.letters, put.digest = False, letters, digest
            return Conversation(put)

        def done(conv_id, talk):
            out.append((conv_id, *[getattr(talk, c) for c in COUNTS], "".join(talk.put.letters), talk.put.digest.hexdigest()))

        def first(given):
            for batch in given:
                kind[:] = [batch.schema.field("conv_id").type]
                yield batch

        for _ in _walk(first(batches), begin, done):
            if out:
                types = [*kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=kinds.names)
                out.clear()

    return rows.mapInArrow(repaired, kinds)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``position`` (from 0), ``role``, ``text`` and ``edit`` (K, R or I)."""
    rows = sorted_turns(turns)
    kinds = StructType([rows.schema["conv_id"], StructField("position", LongType()), *[StructField(c, StringType()) for c in ("role", "text", "edit")]])

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind: list[pa.DataType] = []

        def begin(conv_id):
            place = iter(range(1 << 62))

            def put(letter: str, role: str, text: str) -> None:
                if letter != "D":
                    out.append((conv_id, next(place), role, text, letter))

            return Conversation(put)

        def first(given):
            for batch in given:
                kind[:] = [batch.schema.field("conv_id").type]
                yield batch

        for _ in _walk(first(batches), begin, lambda *_: None):
            if out:
                types = [*kind, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=kinds.names)
                out.clear()

    return rows.mapInArrow(repaired, kinds)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by crc32 of ``conv_id:turn``: rows dropped (marked ``gone``), emptied, cut, repeated, or given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    d = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("code"))
    code = F.col("code")
    return d.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"), (code == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(code == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def report(turns: DataFrame) -> DataFrame:
    return repairs(damaged(turns))


REPORT_SQL = r"""
WITH RECURSIVE keys AS (SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), crc AS (
    SELECT k, xor(list_reduce(list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT), lambda c, b:
        list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295), 4294967295) % 20 AS code
    FROM keys
), convs AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)
), given AS (
    SELECT g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, code
    FROM conversations c JOIN convs v ON c.conv_id IS NOT DISTINCT FROM v.conv_id
    JOIN crc ON k = coalesce(c.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')
), made AS (
    SELECT g, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM given
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM made
), told AS (
    SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS seen, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS before FROM placed
), rows AS (
    SELECT *, left(role, 1) AS initial, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 't' ELSE '' END AS fault
    FROM told
), found AS (
    SELECT g, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
    FROM rows GROUP BY g
), inserts AS (SELECT * FROM (VALUES ('^', 0, '^', []::VARCHAR[]), ('s', 0, 's', []), ('u', 0, 'u', []), ('a', 0, 'a', []),
    ('^', 1, 'u', ['user:']), ('s', 1, 'u', ['user:']), ('u', 1, 'a', ['assistant:']), ('a', 1, 'u', ['user:']),
    ('^', 2, 'a', ['user:', 'assistant:']), ('s', 2, 'a', ['user:', 'assistant:']), ('u', 2, 'u', ['assistant:', 'user:']), ('a', 2, 'a', ['user:', 'assistant:'])) v(state, k, now, puts)
), needs AS (SELECT * FROM (VALUES ('^', 'user'), ('s', 'user'), ('u', 'assistant'), ('a', 'user')) v(now, role)
), edits AS (SELECT unnest(['D', 'K', 'R']) AS edit
), ways AS (
    SELECT g, 0::BIGINT AS i, '^' AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM found
  UNION ALL
    SELECT g, i, state, best.cost, best.audit, best.lines FROM (
        SELECT w.g, w.i + 1 AS i, CASE WHEN edit = 'D' THEN n.now WHEN edit = 'K' THEN r.initial ELSE left(q.role, 1) END AS state,
            min({'cost': w.cost + 5 * n.k + CASE WHEN edit = 'D' THEN 2 ELSE CASE WHEN edit = 'R' THEN 1 ELSE 0 END + CASE WHEN r.fault = 't' THEN 5 ELSE 0 END END,
                'audit': w.audit || repeat('I', n.k) || edit,
                'lines': w.lines || n.puts || CASE WHEN edit = 'D' THEN [] WHEN edit = 'K' THEN [r.role || ':' || r.text] ELSE [q.role || ':' || r.text] END}) AS best
        FROM ways w JOIN inserts n ON n.state = w.state JOIN needs q ON q.now = n.now JOIN rows r ON r.g = w.g AND r.i = w.i + 1, edits
        WHERE edit = 'D' OR r.fault IN ('', 't') AND (edit = 'R' OR r.initial = left(q.role, 1) OR n.now = '^' AND r.initial = 's')
        GROUP BY ALL
    )
), ended AS (
    SELECT w.g, min({'cost': w.cost + 5 * k, 'audit': w.audit || repeat('I', k), 'lines': w.lines || puts}) AS best
    FROM ways w JOIN found f ON w.g = f.g AND w.i = f.n JOIN inserts n ON n.state = w.state WHERE n.now IN ('^', 'a') GROUP BY w.g
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM convs v LEFT JOIN found f ON v.g = f.g LEFT JOIN ended e ON v.g = e.g
"""
