"""Dropping lines that repeat across documents, with an index of line hashes in levelled sorted runs.

A run is a table of line hashes, each once, in buckets by hash and in order within them, with
the number of documents that held it when it came and the largest of their ids. A new batch is
reduced to one row per hash and anti-joined with the runs there are: hashes that none of them
holds become a run of their own, and only the others, few in most corpora, leave a row of what
they add. A hash therefore lies in one run. When a level has as many runs as its fan-out, they
are merged into one run of the next level, so a hash is rewritten once per level and a batch
meets few runs. Runs are bucketed alike, so that no join shuffles them again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetaudit.llm.common import SPACES, ascii_lower, new_folder, text_or_empty, written

#: Shortest key, in code points, and fewest documents for which lines are dropped.
LEAST_CHARS, LEAST_DOCS = 40, 5
BATCHES, FAN_OUT = 4, 3
HASH = ("h1", "h2")


def line_key(line: Column) -> Column:
    """The line without white space at its ends and with A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``doc_id``, ``text_hash``, ``pos`` (from 0) and the 128-bit hash of each line whose key is long enough."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("pos", "line"))
    lines = lines.where(F.length("line") >= least_chars).withColumn("line", F.btrim("line", F.lit(SPACES))).where(F.length("line") >= least_chars)
    key = ascii_lower(F.col("line"))
    return lines.select("doc_id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


class LineRuns:
    """The index: a list of runs per level, each a bucketed table in the shared folder, and what later batches add to their hashes."""

    def __init__(self, spark: SparkSession, fan_out: int = FAN_OUT):
        self.spark, self.fan_out = spark, fan_out
        self.folder = new_folder(spark, "line-runs")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.added: list[DataFrame] = []
        self._made = 0

    def _write(self, rows: DataFrame, level: int) -> None:
        self._made += 1
        path = f"{self.folder}/level{level}-run{self._made}"
        name = "line_run_" + "".join(c for c in path.rsplit("line-runs-", 1)[1] if c.isalnum())
        rows = rows.repartition(self.buckets, *HASH)
        rows.write.format("parquet").option("path", path).bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fan_out:
            whole, self.levels[level] = self.levels[level], []
            self._write(reduce(DataFrame.unionAll, map(self.spark.table, whole)), level + 1)
            self._forget(whole)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    @property
    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def unseen(self, rows: DataFrame) -> DataFrame:
        """The rows whose hash no run holds."""
        return reduce(lambda left, name: left.join(self.spark.table(name), list(HASH), "left_anti"), self.runs, rows)

    def add(self, lines: DataFrame) -> DataFrame:
        """Adds a batch (``doc_id`` and hash; all rows of a document in one batch); returns the rows of the hashes that are new."""
        once = lines.select(*HASH, "doc_id").distinct()
        rows = written(once.groupBy(*HASH).agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last")), "line-batch")
        known = bool(self.runs)
        fresh = written(self.unseen(rows), "line-fresh") if known else rows
        if known:
            # A hash that isn't new is in some run, and what it adds there is kept aside until it is asked for.
            self.added.append(written(rows.join(fresh, list(HASH), "left_anti"), "line-again"))
        self._write(fresh, 0)
        return fresh

    def frequent(self, least_docs: int = LEAST_DOCS) -> DataFrame:
        """Hashes that at least so many documents hold, with the largest of their ids."""
        rows = reduce(DataFrame.unionAll, map(self.spark.table, self.runs))
        if self.added:
            more = reduce(DataFrame.unionAll, self.added).groupBy(*HASH).agg(F.sum("docs").alias("more"), F.max("last").alias("later"))
            rows = rows.join(more, list(HASH), "left").select(
                *HASH, (F.col("docs") + F.coalesce("more", F.lit(0))).alias("docs"), F.greatest("last", "later").alias("last"))
        return rows.where(F.col("docs") >= least_docs).select(*HASH, "last")

    def first_seen(self, lines: DataFrame) -> DataFrame:
        """Online use: the batch's lines that are new to the index, which then holds them too."""
        return lines.join(self.add(lines).select(*HASH), list(HASH), "left_semi")

    def close(self) -> None:
        """Takes the runs out of the session's catalog; their files stay in the shared folder."""
        self._forget(self.runs)
        self.levels = []


def doomed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, batches: int = BATCHES) -> DataFrame:
    """``doc_id``, ``text_hash`` and the sorted ``drop`` positions of lines to drop, for documents that have any.

    The corpus goes into the index in batches by document; then each line is joined with the
    frequent hashes and stays if it is in none or its document is the last to hold it.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "lines")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    hashed_lines(docs, least_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    lines = spark.read.schema(f"doc_id {id_type}, text_hash bigint, pos int, h1 bigint, h2 bigint, batch int").parquet(path)
    runs = LineRuns(spark)
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k))
    frequent = written(runs.frequent(least_docs), "frequent-lines")
    runs.close()
    repeats = lines.join(frequent, list(HASH)).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    return repeats.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("drop"))


def deduplicated(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` as ``row`` (all columns), with ``kept`` text, ``n_lines`` and ``n_dropped``.

    A null or empty text is one empty line. A document given twice counts once, and both
    rows keep the same lines. Documents without id count as one that is before all others.
    If all lines go, the text is empty; an empty table gives an empty one.
    """
    row = docs.select(F.struct("*").alias("row"))
    row = row.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    doomed = doomed_lines(row.select("doc_id", "text"), **limits).select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "drop")
    row = row.withColumn("text_hash", F.xxhash64("text"))
    joined = row.join(doomed, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")), "left")
    lines = F.split(text_or_empty(), "\n", -1)
    joined = joined.withColumn("lines", lines)
    # What stays lies between the dropped positions: slices, so that a long text is copied once.
    edges = F.concat(F.array(F.lit(-1)), F.col("drop"), F.array(F.size("lines")))
    between = F.flatten(F.transform(F.sequence(F.lit(0), F.size("drop")), lambda k: F.slice(
        "lines", F.get("edges", k) + 2, F.get("edges", k + 1) - F.get("edges", k) - 1)))
    joined = joined.withColumn("edges", edges)
    return joined.select(
        "row", F.when(F.col("drop").isNull(), text_or_empty()).otherwise(F.array_join(between, "\n")).alias("kept"),
        F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"))


def digests(docs: DataFrame) -> DataFrame:
    return deduplicated(docs.select("doc_id", "text")).select(
        "row.doc_id", "n_lines", F.greatest("n_dropped", F.lit(0)).alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


DIGEST_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d
), k AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key
    HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INTEGER) >= 5
), m AS (SELECT k.*, f.key IS NOT NULL AND f.last IS DISTINCT FROM k.doc_id AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, (count(*) FILTER (gone)) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
