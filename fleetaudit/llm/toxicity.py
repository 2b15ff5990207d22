"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text. A window
of a few words is compressed with either; the bytes that the toxic one saves are its gain.
A document's score comes from its highest gains and the number of windows over a threshold,
both calibrated on labelled documents that the dictionaries haven't seen.

Windows are much shorter than what zstandard is made for. So both dictionaries share their
ordinary part and differ only in toxic words, every window starts with the same 64 bytes
that both know (else the block header would outweigh what is saved, and the window would be
stored as it is), and matches of under six bytes are off, as they are chance.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetaudit.llm.common import id_crc, text_or_empty

#: At most so many toxic and so many ordinary documents train the model, in order of a hash of their id, and none over so many bytes.
TOXIC_SAMPLE, ORDINARY_SAMPLE, LONGEST = 2_500, 5_000, 30_000
WINDOW, ORDINARY_BYTES, TOXIC_WORDS = 4, 2048, 1500
#: From so many windows on, every n-th one trains the ordinary dictionary: so many to twice as many.
WINDOWS = 60_000
#: Beginnings of words that may mark toxic text, the share of toxic documents that have one, and its log odds.
BEGINNINGS, SHARE, LOG_ODDS = (4, 5, 6, 8), 0.02, 3.0
CARRIER = bytes((i * i * 37 + i * 11) % 256 for i in range(64))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]


def compressor(content: bytes) -> Callable[[bytes], bytes]:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=15, hash_log=10, chain_log=10, search_log=4, min_match=6, target_length=64, strategy=zstandard.STRATEGY_GREEDY,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress


@dataclass(frozen=True)
class Model:
    """The dictionaries' contents, the gain over which a window counts, and a logistic model of a document's figures."""

    ordinary: bytes
    toxic: bytes
    threshold: int
    intercept: float
    weights: tuple[float, ...]

    def figures(self) -> Callable[[str], list[float]]:
        ordinary, toxic, threshold = compressor(self.ordinary), compressor(self.toxic), self.threshold

        def of(text: str) -> list[float]:
            gains = [len(ordinary(w)) - len(toxic(w)) for w in (CARRIER + w for w in windows_of(words_of(text)))]
            high = [*heapq.nlargest(3, gains), 0, 0, 0][:3]
            over = sum(g >= threshold for g in gains)
            return [*map(float, high), log1p(over), over / (len(gains) + 1), log1p(len(gains))]

        return of

    def scorer(self) -> Callable[[str], float]:
        if not self.weights:
            return lambda text: 1 / (1 + exp(-self.intercept))
        figures = self.figures()
        return lambda text: 1 / (1 + exp(-max(-700.0, min(700.0, self.intercept + sum(w * x for w, x in zip(self.weights, figures(text)))))))


def _beginnings(word: bytes) -> set[bytes]:
    return {word[:k] for k in BEGINNINGS if len(word) >= k} | {word}


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary.

    The ordinary one is trained on windows. The toxic one is the same and, behind it, the
    words of toxic texts whose beginnings are found in many contexts there and in few
    ordinary texts, commonest last, where a match is cheapest.
    """
    found = Counter()
    for text in toxic:
        found.update(set().union(*map(_beginnings, set(words_of(text)))))
    # Of all beginnings, not one would be expected in so many toxic and no other texts by chance.
    chance = (log(len(found) + 1) + 3) / log((len(toxic) + len(ordinary)) / len(toxic))
    least = max(chance, SHARE * len(toxic))
    found = {g: n for g, n in found.items() if len(g) >= BEGINNINGS[0] and n >= least}
    plain = Counter()
    for text in ordinary:
        plain.update(found.keys() & set().union(*map(_beginnings, set(words_of(text)))))
    odds = lambda n, of: log((n + 0.5) / (of + 1))
    marks = {g for g, n in found.items() if odds(n, len(toxic)) - odds(plain[g], len(ordinary)) > LOG_ODDS}
    # Copies of one toxic text share its words and what stands before them, which words that mark don't.
    contexts: dict[bytes, set[bytes]] = {g: set() for g in marks}
    for text in toxic:
        words = words_of(text)
        for before, word in zip([b"", *words], words):
            for g in marks & _beginnings(word):
                contexts[g].add(before)
    marks = {g for g in marks if len(contexts[g]) >= least}
    words = Counter(w.strip(b".,;:!?") for text in toxic for w in words_of(text) if not marks.isdisjoint(_beginnings(w)))
    windows = [w for text in ordinary for w in windows_of(words_of(text))]
    step = max(1, len(windows) // WINDOWS)
    try:
        base = zstandard.train_dictionary(ORDINARY_BYTES, windows[::step]).as_bytes()
    except zstandard.ZstdError:  # too few windows to train on: some of them serve as they are
        base = b"".join(windows[::step])[-ORDINARY_BYTES:]
    extra = b" ".join(w for w, _ in reversed(sorted(words.most_common(TOXIC_WORDS), key=lambda x: (-x[1], x[0]))))
    return base + CARRIER, base + b" " + extra + b"  " + CARRIER


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> tuple[float, tuple[float, ...]]:
    """Intercept and weights of a ridge logistic model, by Newton's method on scaled figures."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    b = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (weight * (y - p)) - penalty @ b)
        b += step
        if np.abs(step).max() < 1e-8:
            break
    slopes = b[1:] / scale
    return float(b[0] - slopes @ mean), tuple(map(float, slopes))


def fit(texts: list[tuple[str, int]], share: float) -> Model:
    """The model from whole texts and labels; ``share`` is that of toxic documents among all labelled ones.

    Every third text only serves to calibrate. With one class only the score is constant.
    """
    toxic, ordinary = ([t for t, label in texts if label == k] for k in (1, 0))
    if len(toxic) < 6 or len(ordinary) < 6:
        share = (len(toxic) + 0.5) / (len(texts) + 1)
        return Model(b"", b"", 0, log(share / (1 - share)), ())
    learn = lambda rows: [t for i, t in enumerate(rows) if i % 3]
    contents = dictionaries(learn(toxic), learn(ordinary))
    draft = Model(*contents, 0, 0.0, ())
    a, b = (compressor(c) for c in contents)
    plain = [len(a(w)) - len(b(w)) for text in ordinary[::3] for w in (CARRIER + w for w in windows_of(words_of(text)))]
    threshold = int(np.quantile(plain, 0.999)) + 1
    figures = Model(*contents, threshold, 0.0, ()).figures()
    held = toxic[::3] + ordinary[::3]
    y = np.array([1.0] * len(toxic[::3]) + [0.0] * len(ordinary[::3]))
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    intercept, weights = logistic(np.array([figures(t) for t in held]), y, weight)
    return Model(draft.ordinary, draft.toxic, threshold, intercept, weights)


def train(docs: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE, ordinary_sample: int = ORDINARY_SAMPLE, longest: int = LONGEST) -> Model:
    """The model for ``docs`` from ``labels`` (``doc_id``, ``label``); the samples' bounds hold whatever the corpus.

    Of rows that repeat an id, the one whose text has the smallest hash is used.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in one.groupBy("label").count().collect()}
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = one.where("label = 1").orderBy(*order).limit(toxic_sample).unionByName(one.where("label = 0").orderBy(*order).limit(ordinary_sample))
    rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(picked), "doc_id").where(F.octet_length("text") <= longest)
    rows = rows.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = sorted((r["doc_id"], r["text"], r["label"]) for r in rows.collect())
    return fit([(text, label) for _, text, label in found], (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1))


def score(model: Model) -> Column:
    """A function of a text column: the probability that it is toxic."""

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = model.scorer()
        for texts in batches:
            yield pa.array([scorer(t.as_py()) for t in texts], pa.float64())

    return scores


def scored(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score; a column of that name is replaced. A null text counts as empty, which has a score as well."""
    return docs.withColumn(into, score(model)(text_or_empty(text)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: whether it is held out, its score and the prediction at 0.3."""
    held_out = id_crc() % 4 == 2
    model = train(docs, labels.where(~held_out).select("doc_id", F.col("toxic").alias("label")))
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))
