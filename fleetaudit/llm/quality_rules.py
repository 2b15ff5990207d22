"""Quality rules as a short-circuit cascade.

A sample tells what each rule costs and how much it rejects; rules are then tried in order
of rejection per cost, each measured on what the rules before it let pass, and a text meets
only the rules up to the first that rejects it. The order changes the cost, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.llm.common import SPACES, text_or_empty

#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Texts in the sample on which the order of rules is found, at most about so many.
SAMPLE = 1000


class Text:
    """A text with the counts that rules ask for, each made when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes are split at the six characters that part words, and no others

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        if self.n_words < 4:
            return 0
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in self.words), np.int64, self.n_words)
        pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
        _, window, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
        again = times[window] > 1
        covered = np.zeros(self.n_words, bool)
        for k in range(3):
            covered[k : k + len(again)] |= again
        return int(covered.sum())

    @cached_property
    def base_failed(self) -> bool:
        return self.n_words < 50 or 100 * self.n_repeat_words > 50 * self.n_words

    @cached_property
    def n_upper(self) -> int:
        return sum(map(self.text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    @cached_property
    def n_lower(self) -> int:
        return sum(map(self.text.count, "abcdefghijklmnopqrstuvwxyz"))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


#: The base rules are one of the rules; the others come on top of it.
RULES = (
    Rule("base", lambda t: t.base_failed),
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("shouting", lambda t: t.n_upper > t.n_lower),
    Rule("exclaimed", lambda t: 10 * t.text.count("!") > 3 * t.n_words),
    Rule("repeated lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("overlong words", lambda t: t.word_chars > 20 * t.n_words),
)


def trial(docs: DataFrame, rules=RULES, sample: int = SAMPLE, text: str = "text") -> list[tuple[list[bool], list[float]]]:
    """For each text of a random sample: what each rule says, and its seconds. Texts stay with the executors."""
    rows = docs.count()
    if not rows:
        return []

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, cost = [], []
            for value in batch.column(0):
                verdicts, seconds = [], []
                for rule in rules:
                    fresh, began = Text(value.as_py()), time.perf_counter()
                    verdicts.append(bool(rule.rejects(fresh)))
                    seconds.append(time.perf_counter() - began)
                said.append(verdicts)
                cost.append(seconds)
            yield pa.RecordBatch.from_arrays([pa.array(said, pa.list_(pa.bool_())), pa.array(cost, pa.list_(pa.float64()))], names=["said", "cost"])

    picked = docs.select(text_or_empty(text).alias("text")).sample(min(1.0, sample / rows), seed=11)
    return [(r.said, r.cost) for r in picked.mapInArrow(tried, "said array<boolean>, cost array<double>").limit(2 * sample).collect()]


def ordered(rules, tried) -> list[Rule]:
    """Greedily, the rule with the most rejection per second among the texts that are left; the cheapest if none rejects."""
    left, rest, order = list(tried), list(range(len(rules))), []
    while rest:
        def worth(k: int) -> tuple[float, float, int]:
            cost = sum(c[k] for _, c in left) + 1e-9
            return sum(s[k] for s, _ in left) / cost, -cost, -k

        best = max(rest, key=worth)
        order.append(rules[best])
        rest.remove(best)
        left = [x for x in left if not x[0][best]]
    return order


def cascade(rules: list[Rule]) -> Column:
    """A function of a text column: the counts, ``base_failed``, and ``rejected_by``, the first rule that rejects (else null)."""
    kind = pa.struct([(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
        ("base_failed", pa.bool_()), ("rejected_by", pa.string())])

    @F.arrow_udf("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, rejected_by string")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for value in texts:
                t = Text(value.as_py())
                by = next((rule.name for rule in rules if rule.rejects(t)), None)
                rows.append({"n_words": t.n_words, "word_chars": t.word_chars, "n_symbols": t.n_symbols, "n_dup_lines": t.n_dup_lines,
                             "n_repeat_words": t.n_repeat_words, "base_failed": t.base_failed, "rejected_by": by})
            yield pa.array(rows, kind)

    return judged


def judge(docs: DataFrame, rules=RULES, sample: int = SAMPLE, text: str = "text", into: str = "quality") -> DataFrame:
    """All columns of ``docs`` and the struct ``into`` of counts and verdict; a column of that name is replaced.

    Null texts count as empty and fail the base rule. Repeated rows get equal counts; an
    empty table gives an empty one.
    """
    order = ordered(rules, trial(docs, rules, sample, text))
    return docs.withColumn(into, cascade(order)(text_or_empty(text)))


def report(docs: DataFrame) -> DataFrame:
    counted = judge(docs.select("doc_id", "text"))
    return counted.select("doc_id", *[f"quality.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
                          F.col("quality.rejected_by").isNull().alias("kept"))


REPORT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT r, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w, generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM d
), g AS (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)
), a AS (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM g WHERE w3 IS NOT NULL
), rep AS (SELECT r, count(DISTINCT i + k) AS n FROM a, (VALUES (0), (1), (2)) k(k) WHERE n > 1 GROUP BY r
), l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d
), ln AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), c AS (
    SELECT d.doc_id, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(ln.dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        coalesce(ln.n, 0) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^a-z]', '', 'g')) AS n_lower,
        length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks
    FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN ln ON d.r = ln.r
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR n_upper > n_lower OR 10 * n_marks > 3 * n_words OR 2 * n_dup_lines > n_lines OR word_chars > 20 * n_words) AS kept
FROM b
"""
