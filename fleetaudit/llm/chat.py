"""Conversations as training windows of bounded length, and their text read back.

A window holds whole turns: new ones up to the budget, before them a limited stretch of
history, and the system turn in front. Everything is placed by running sums per
conversation. New assistant turns are under the loss mask; repeated ones are not.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Control strings of widely used chat templates, none of which may come out of a text.
FOREIGN_CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")


@dataclass(frozen=True)
class Template:
    """``<|turn|>role<|text|>text<|end|>``. In roles and texts every control string gets a
    backslash behind its first character, and those that look like one so escaped get one
    more; taking one away gives the text back.
    """

    turn: str = "<|turn|>"
    text: str = "<|text|>"
    end: str = "<|end|>"
    foreign: tuple[str, ...] = FOREIGN_CONTROLS
    heads: str = field(init=False)
    rests: str = field(init=False)

    def __post_init__(self):
        controls = (self.turn, self.text, self.end, *self.foreign)
        object.__setattr__(self, "heads", "[" + "".join(sorted({re.escape(c[0]) for c in controls})) + "]")
        object.__setattr__(self, "rests", "(?:" + "|".join(re.escape(c[1:]) for c in sorted(controls, key=len, reverse=True)) + ")")

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"({self.heads})(\\*)({self.rests})", r"$1\\$2$3")

    def unescaped(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"({self.heads})\\(\\*)({self.rests})", "$1$2$3")


def default_tokens(text: Column) -> Column:
    """Words and marks of a text and four for the template: an estimate that needs no vocabulary."""
    return F.regexp_count(text, F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]")).cast("long") + 4


def windows(turns: DataFrame, budget: int = 512, history: int = 128, template: Template = Template(), tokens=default_tokens) -> DataFrame:
    """Windows of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``).

    Returns ``conv_id``, ``window`` (from 0), ``text``, ``repeated`` (how many leading turns
    of it stood in an earlier window) and ``loss`` (start from 1 and length, in code points,
    of each text under the mask).

    A conversation's first turn is its system turn if its role is ``system``. The tokens of
    the other turns are summed up; what the budget leaves beside history and system turn is
    the length of a cell, and a turn belongs to the cell in which it ends. A cell is one
    window if its turns fit, else two, parted behind the turn that began before the cell.
    A single turn over that length has a window of its own, whole. History is as many of the
    turns before a window as fit ``history`` tokens and what the budget leaves beside the window's
    own turns. So only a window of one turn and no history can be over the budget.

    Null roles and texts count as empty. Turns with equal numbers are ordered by role and
    text and none is dropped; rows without ``conv_id`` are one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    t = t.withColumns({"pos": F.row_number().over(order), "full": tokens(F.col("text"))})
    t = t.withColumn("system", (F.col("pos") == 1) & (F.col("role") == "system"))
    t = t.withColumns({
        "cost": F.when(F.col("system"), F.lit(0)).otherwise(F.col("full")),
        "lead": F.concat(F.lit(template.turn), template.escaped(F.col("role")), F.lit(template.text)),
        "body": template.escaped(F.col("text"))})
    t = t.withColumn("block", F.concat("lead", "body", F.lit(template.end)))
    t = t.withColumns({
        "upto": F.sum("cost").over(so_far),
        "beside": F.lit(budget) - F.coalesce(F.sum(F.when(F.col("system"), F.col("full"))).over(so_far), F.lit(0)),
        "chars": F.sum(F.length("block")).over(so_far) - F.length("block")})
    t = t.withColumn("room", F.greatest(F.lit(1), F.col("beside") - history))
    t = t.withColumn("start", F.col("upto") - F.col("cost"))
    # Turns longer than a cell stand alone; they alone leave less than the whole history.
    left = F.greatest(F.lit(0), F.least(F.lit(history), F.col("beside") - F.col("cost")))
    t = t.withColumn("since", F.col("start") - F.when(F.col("cost") > F.col("room"), left).otherwise(history))
    t = t.withColumn("cell", F.when(F.col("system"), F.lit(0)).otherwise(F.floor((F.col("upto") - 1) / F.col("room"))))
    t = t.withColumn("astride", F.col("start") < F.col("cell") * F.col("room"))
    t = t.withColumn("overfull", F.sum("cost").over(Window.partitionBy("conv_id", "cell")) > F.col("room"))
    before = {c: F.lag(c).over(order) for c in ("cell", "astride")}
    t = t.withColumn("opens", (F.col("pos") == 1) | (before["cell"] != F.col("cell")) | (before["astride"] & F.col("overfull")))
    t = t.withColumn("from", F.min(F.when(~F.col("system"), F.col("pos"))).over(
        Window.partitionBy("conv_id").orderBy("start").rangeBetween(-history, Window.currentRow)))
    t = t.withColumn("from", F.least(F.coalesce("from", "pos"), "pos"))

    one = F.struct("pos", "opens", "from", "start", "since", "block", "chars", F.length("lead").alias("head"), F.length("body").alias("size"),
                   (F.col("role") == "assistant").alias("target"), "system")
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    c = c.withColumn("firsts", F.filter("turns", lambda x: x["opens"]))

    def window(first: Column, k: Column) -> Column:
        last = F.when(k + 1 < F.size("firsts"), F.get("firsts", k + 1)["pos"] - 1).otherwise(F.size("turns"))
        past = F.filter(F.slice("turns", first["from"], first["pos"] - first["from"]), lambda x: x["start"] >= first["since"])
        begin = F.when(k == 0, F.lit(1)).otherwise(first["pos"] - F.size(past))
        system = F.when((k > 0) & F.get("turns", F.lit(0))["system"], F.get("turns", F.lit(0))["block"]).otherwise("")
        shown = F.slice("turns", begin, last - begin + 1)
        shift = F.length(system) - F.get("turns", begin - 1)["chars"]
        fresh = F.filter(F.slice("turns", first["pos"], last - first["pos"] + 1), lambda x: x["target"])
        return F.struct(
            k.alias("window"),
            F.concat(system, F.array_join(F.transform(shown, lambda x: x["block"]), "")).alias("text"),
            (first["pos"] - begin + F.when(F.length(system) > 0, 1).otherwise(0)).alias("repeated"),
            F.transform(fresh, lambda x: F.struct((x["chars"] + shift + x["head"] + 1).alias("start"), x["size"].alias("length"))).alias("loss"))

    return c.select("conv_id", F.explode(F.transform("firsts", window)).alias("w")).select("conv_id", "w.*")


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, from its windows alone: ``turns`` (role and text, each once, in order),
    ``loss_text`` (all text under the mask) and ``formatted_chars``.
    """
    blocks = F.split("text", re.escape(template.end), -1)
    fresh = F.slice(blocks, F.col("repeated") + 1, F.size(blocks) - 1 - F.col("repeated"))

    def turn(block: Column) -> Column:
        parts = F.split(block, re.escape(template.text), 2)
        return F.struct(
            template.unescaped(F.substring(F.get(parts, F.lit(0)), len(template.turn) + 1, 2**31 - 1)).alias("role"),
            template.unescaped(F.get(parts, F.lit(1))).alias("text"))

    masked = F.transform("loss", lambda span: template.unescaped(F.substring(F.col("text"), span["start"], span["length"])))
    read = formatted.select("conv_id", F.struct(
        "window", F.transform(fresh, turn).alias("turns"), F.array_join(masked, "").alias("loss"), F.length("text").cast("long").alias("chars")).alias("w"))
    return read.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w")).select(
        "conv_id", F.flatten("w.turns").alias("turns"), F.array_join("w.loss", "").alias("loss_text"),
        F.aggregate("w.chars", F.lit(0).cast("long"), lambda a, b: a + b).alias("formatted_chars"))


def digests(turns: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """What :func:`read_back` finds in the windows of the turns, as counts and SHA-256 digests."""
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read_back(windows(turns, budget, history)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


#: The same counts and digests without windows, and the windows' length by the same sums.
DIGEST_SQL = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), t AS (
    SELECT *, row_number() OVER o AS pos, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\s]')) + 4 AS whole,
        length(role) + length(text) + 8 + 8 + 7
        + len(regexp_extract_all(role || chr(10) || text, '[<\[]\\*(?:\|endoftext\|>|\|im_start\|>|\|im_end\|>|\|turn\|>|\|text\|>|\|end\|>|/INST\]|</SYS>>|<SYS>>|INST\]|/s>|s>)')) AS chars
    FROM given WINDOW o AS (PARTITION BY conv_id ORDER BY turn, role, text)
), s AS (SELECT *, pos = 1 AND role = 'system' AS system FROM t
), u AS (
    SELECT *, CASE WHEN system THEN 0 ELSE whole END AS cost, sum(CASE WHEN system THEN 0 ELSE whole END) OVER o AS upto,
        512 - coalesce(sum(CASE WHEN system THEN whole END) OVER o, 0) AS beside, greatest(1, beside - 128) AS room,
        sum(CASE WHEN system THEN chars END) OVER o AS system_chars
    FROM s WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
), v AS (SELECT *, upto - cost AS start, CASE WHEN system THEN 0 ELSE (upto - 1) // room END AS cell FROM u
), w AS (SELECT *, start < cell * room AS astride, sum(cost) OVER (PARTITION BY conv_id, cell) > room AS overfull FROM v
), x AS (
    SELECT *, pos = 1 OR lag(cell) OVER o <> cell OR (lag(astride) OVER o AND overfull) AS opens FROM w WINDOW o AS (PARTITION BY conv_id ORDER BY pos)
), history AS (
    SELECT a.conv_id, a.pos, sum(b.chars) AS chars FROM x a JOIN x b
    ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos < a.pos AND NOT b.system 
        AND a.start - b.start <= CASE WHEN a.cost > a.room THEN greatest(0, least(128, a.beside - a.cost)) ELSE 128 END WHERE a.opens GROUP BY ALL
)
SELECT x.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY x.pos)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY x.pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(x.chars) + coalesce(sum(h.chars), 0) + coalesce(sum(system_chars) FILTER (opens AND x.pos > 1), 0))::BIGINT AS formatted_chars
FROM x LEFT JOIN history h ON x.conv_id IS NOT DISTINCT FROM h.conv_id AND x.pos = h.pos GROUP BY x.conv_id
"""
