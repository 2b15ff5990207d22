"""Mixing sources to target weights by Pareto order sampling.

A source whose target exceeds its size gives each document as many whole copies as all can
have. For what is left, a document's odds of being included grow with its size: it is
included with a probability in proportion to its words, such that the words expected are
those left to take. Documents whose probability would reach one are certain and get their
copy first. All others are ranked by the odds of a random number over their own odds, and
taken in that order until the source's words are reached. No source is ever sorted in one
place: words are summed per narrow band of ranks, and only the band in which the target
falls is put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetaudit.llm.common import text_or_empty, word_count, written

#: Weights of sources in order of name, repeating; the mix's share of all sizes; most copies of a document.
WEIGHTS, SHARE_PERCENT, MOST_COPIES = (5, 2, 1), 150, 2


def targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_COPIES) -> DataFrame:
    """Target words of each ``source`` from ``sizes`` (``source``, ``source_size``).

    Sources by code point, null last, weigh ``weights`` in turn. All share ``share_percent``
    of all sizes by weight, and a target stops at ``most`` times its source's size. With
    sources ordered by that stop over weight, those before some place are at their stops
    and the others share the rest, so running sums give the result of all rounds at once.
    Sums are whole numbers, so reruns agree to the last bit. One row per source is sorted.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(named) - 1) % len(weights))
    s = sizes.withColumn("weight", weight.cast("long")).withColumn("stop", F.lit(most) * F.col("source_size"))
    tight = Window.orderBy((F.col("stop") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    rest = tight.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    s = s.withColumn("whole", F.sum("source_size").over(every) * F.lit(share_percent))
    s = s.withColumn("level", (F.col("whole") - 100 * F.coalesce(F.sum("stop").over(before), F.lit(0))) / (100 * F.sum("weight").over(rest)))
    # The level rises from row to row while sources are at their stops; the first source below its stop sets it for all behind.
    open_level = F.min(F.when(F.col("stop") >= F.col("level") * F.col("weight"), F.struct("rank", "level"))).over(every)
    s = s.withColumn("rank", F.row_number().over(tight)).withColumn("open", open_level)
    below = F.col("open").isNull() | (F.col("rank") < F.col("open.rank"))
    return s.select("source", "source_size", F.when(below, F.col("stop").cast("double")).otherwise(F.col("open.level") * F.col("weight")).alias("target"))


def random_of(key: Column, seed: int = 0) -> Column:
    """A number in (0, 1) from the MD5 of a text: the same on every run and machine."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def with_size(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words; null text: 0), the random number ``u`` and the hash ``tie`` of each document."""
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), random_of(F.col("doc_id"), seed).alias("u"), F.xxhash64("text").alias("tie"))


def rates(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """Per source with words ``left``: ``rate``, a document's chance of inclusion per word, ``sure_from``, the size
    from which documents are certain (null: none is), and ``sure``, the words of those.

    With the largest sizes certain, the words still left over the sum of squares of all smaller
    sizes give the rate; it holds at the largest size that it leaves below one. Each source's
    distinct sizes are sorted, and their number grows with the root of its words at most.
    """
    g = goal.select(F.col("source").alias("of_source"), "left")
    sizes = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.join(g, F.col("source").eqNullSafe(F.col("of_source"))).where("left > 0")
    larger = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    smaller = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    size = F.col("size").cast("decimal(19,0)")
    sizes = sizes.withColumns({
        "sure": F.coalesce(F.sum(F.col("size") * F.col("n")).over(larger), F.lit(0)), "sure_from": F.min("size").over(larger),
        "squares": F.sum((size * F.col("size") * F.col("n")).cast("decimal(38,0)")).over(smaller)})
    sizes = sizes.withColumn("rate", (F.col("left") - F.col("sure")) / F.col("squares").cast("double"))
    able = sizes.where(F.col("rate") * F.col("size") < 1)
    return able.groupBy("of_source").agg(F.max_by(F.struct("rate", "sure_from", "sure"), "size").alias("r")).select("of_source", "r.*")


def plan(sized: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """Per source: ``source``, ``source_size``, ``target``, ``copies`` that each document gets for
    certain, the ``rate`` of one more and the size ``sure_from`` which that one is certain too, the words ``left``
    for the others, the last rank that gets it (``last``), how many documents have
    that rank (``peers``) and how many of them get it (``take``), so that the source comes nearest to its target.
    """
    goal = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    goal = goal.withColumn("copies", F.least("copies", F.lit(most)))
    goal = written(goal.withColumn("left", F.col("target") - F.col("copies") * F.col("source_size")), "mix-targets")
    rate = rates(sized, goal)
    goal = goal.join(rate, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")
    # Where rounding leaves no size below one, all documents are certain.
    full = (F.col("left") > 0) & F.col("rate").isNull()
    goal = goal.withColumns({
        "sure_from": F.when(full, F.lit(1)).otherwise(F.col("sure_from")), "rate": F.coalesce("rate", F.lit(0.0)),
        "left": F.when(full, F.lit(0.0)).otherwise(F.col("left") - F.coalesce("sure", F.lit(0)))})
    goal = written(goal.drop("sure"), "mix-goals")

    ranked = _ranked(sized, goal).where("left > 0 and not certain")
    bands = F.ceil(F.sqrt(F.lit(sized.count() + 1.0)))  # so many bands, and so many documents in one
    ranked = ranked.withColumn("band", F.floor(F.col("rank.order") * bands))
    in_order = Window.partitionBy("source").orderBy("band")
    sums = ranked.groupBy("source", "band").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    sums = sums.withColumn("until", F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    cut = sums.where((F.col("until") >= F.col("left")) & (F.col("until") - F.col("words") < F.col("left"))).select(
        "source", "band", (F.col("until") - F.col("words")).alias("below"))
    # The band's ranks, each once with the number of documents that have it (more than one only where ids
    # repeat), and the place where the sum is nearest: before, behind or among a rank's documents.
    inside = ranked.alias("r").join(cut.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.band") == F.col("c.band")))
    inside = inside.groupBy("r.source", "rank", "left", "below").agg(F.count(F.lit(1)).alias("peers"))
    before = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("rank.size")
    inside = inside.withColumn("reached", F.col("below") + F.coalesce(F.sum(size * F.col("peers")).over(before), F.lit(0)))
    least = F.when(size > 0, F.floor((F.col("left") - F.col("reached")) / size)).otherwise(F.lit(0))

    def option(take: Column) -> Column:
        take = F.least(F.greatest(take, F.lit(0)), F.col("peers"))
        return F.struct(F.abs(F.col("reached") + take * size - F.col("left")).alias("gap"), "rank", take.alias("take"), "peers")

    options = inside.select("source", F.explode(F.array(option(least), option(least + 1))).alias("o"))
    last = options.groupBy("source").agg(F.min("o").alias("o")).select(F.col("source").alias("in_source"), F.col("o.rank").alias("last"), "o.take", "o.peers")
    goal = goal.join(last, F.col("source").eqNullSafe(F.col("in_source")), "left").drop("in_source")
    return written(goal, "mix-plan")


def _ranked(sized: DataFrame, goal: DataFrame) -> DataFrame:
    """Documents with their source's row of ``goal``, whether one more copy is ``certain``, and their ``rank``.

    The rank is the Pareto order, then the random number, id and size. The order ``x`` (random
    odds over inclusion odds) stands as ``x / (1 + x)``: from 0 to 1, and 1 for documents without words.
    """
    chance = F.col("rate") * F.col("size")
    before, behind = F.col("u") * (1 - chance), (1 - F.col("u")) * chance
    g = goal.withColumnRenamed("source", "of_source")
    return sized.join(g, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source").withColumns({
        "certain": F.coalesce(F.col("size") >= F.col("sure_from"), F.lit(False)),
        "rank": F.struct((before / (before + behind)).alias("order"), "u", "doc_id", "size")})


def copies(sized: DataFrame, planned: DataFrame) -> DataFrame:
    """``sized`` with its source's plan and ``times``, how often the mix takes the document whole.

    Of documents that share the last rank of a source (equal id and size), those with the smallest
    ``tie`` come first; only where that rank is parted are they, and they alone, put in order.
    """
    ranked = _ranked(sized, planned)
    open_ = (F.col("left") > 0) & ~F.col("certain")
    at_last = F.coalesce(open_ & (F.col("rank") == F.col("last")), F.lit(False))
    parted = at_last & (F.col("take") > 0) & (F.col("take") < F.col("peers"))
    whole = F.col("certain") | open_ & ((F.col("rank") < F.col("last")) | (at_last & (F.col("take") == F.col("peers"))))
    some = F.row_number().over(Window.partitionBy("source").orderBy("tie")) <= F.col("take")
    rows = ranked.where(~parted).withColumn("extra", whole).unionByName(ranked.where(parted).withColumn("extra", some))
    return rows.withColumn("times", F.col("copies") + F.when(F.col("extra"), 1).otherwise(0))


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix's documents, all columns as given, each as often as it is taken.

    A source's words come within half the size of one document of its target, also where ids
    repeat or are missing. Null texts have size 0; documents
    without source are a source of their own; an empty table gives an empty mix.
    """
    row = docs.select(F.struct("*").alias("row"))
    sized = row.select("row", "row.doc_id", "row.source", word_count(F.coalesce("row.text", F.lit(""))).alias("size"), random_of(F.col("row.doc_id"), seed).alias("u"), F.xxhash64("row.text").alias("tie"))
    planned = plan(written(sized.drop("row"), "mix-sizes"))
    taken = copies(sized, planned).where("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("row.*")


def report(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    sized = written(with_size(docs, seed), "mix-sizes")
    return copies(sized, plan(sized)).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


REPORT_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
        (CAST('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM sized GROUP BY source
), l AS (
    SELECT *, row_number() OVER o AS k, (sum(source_size) OVER () * 150 - 100 * coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (100 * sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM s WINDOW o AS (ORDER BY (2 * source_size)::DOUBLE / weight, source NULLS LAST)
), f AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM l WHERE 2 * source_size >= level * weight
), g AS (
    SELECT source, source_size, CASE WHEN f.k IS NULL OR l.k < f.k THEN (2 * source_size)::DOUBLE ELSE f.level * weight END AS target FROM l, f
), h AS (
    SELECT *, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size))::BIGINT ELSE 0 END AS copies FROM g
), i AS (
    SELECT *, target - copies * source_size AS rest FROM h
), z AS (SELECT source, size, count(*) AS n FROM sized WHERE size > 0 GROUP BY source, size
), y AS (
    SELECT z.*, i.rest, coalesce(sum(size * n) OVER b, 0) AS sure, min(size) OVER b AS sure_from, sum(size::HUGEINT * size * n) OVER (PARTITION BY z.source ORDER BY size) AS squares
    FROM z JOIN i ON z.source IS NOT DISTINCT FROM i.source WHERE i.rest > 0
    WINDOW b AS (PARTITION BY z.source ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), x AS (SELECT *, (rest - sure) / squares::DOUBLE AS rate FROM y
), a AS (SELECT source, max(size) AS size FROM x WHERE rate * size < 1 GROUP BY source
), e AS (SELECT x.source, x.rate, x.sure, x.sure_from FROM x JOIN a ON x.source IS NOT DISTINCT FROM a.source AND x.size = a.size
), q AS (
    SELECT i.source, i.source_size, i.target, i.copies, coalesce(e.rate, 0) AS rate, CASE WHEN i.rest > 0 AND e.rate IS NULL THEN 1 ELSE e.sure_from END AS sure_from,
        CASE WHEN i.rest > 0 AND e.rate IS NULL THEN 0 ELSE i.rest - coalesce(e.sure, 0) END AS rest
    FROM i LEFT JOIN e ON i.source IS NOT DISTINCT FROM e.source
), r AS (
    SELECT d.*, source_size, target, copies, rest, coalesce(d.size >= sure_from, false) AS certain,
        u * (1 - rate * d.size) / (u * (1 - rate * d.size) + (1 - u) * (rate * d.size)) AS ord
    FROM sized d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), c AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY pos) AS upto
    FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ord, u, doc_id NULLS FIRST, size) AS pos FROM r WHERE NOT certain)
), o AS (
    SELECT source, pos, abs(upto - rest) AS gap FROM c WHERE rest > 0
    UNION ALL SELECT source, 0, rest FROM c WHERE rest > 0 AND pos = 1
), b AS (SELECT source, min(pos) AS pos FROM (SELECT *, min(gap) OVER (PARTITION BY source) AS least_gap FROM o) WHERE gap = least_gap GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (copies + CASE WHEN c.pos <= b.pos THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c LEFT JOIN b ON c.source IS NOT DISTINCT FROM b.source
UNION ALL SELECT doc_id, size, source_size, target, (size * (copies + 1))::BIGINT FROM r WHERE certain
"""
