"""Budgets, ties, missing and repeated ids, ids of other types, and columns with clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetaudit.llm import chat, line_dedup, mixing, search
from tests.llm.test_operators import checked

LINE = "This line is long enough to be counted as one that repeats."
CLASHING = "doc_id bigint, text string, source string, row string, kept string, drop string, size int, u string, rank string, tie string, times int, copy string"


@pytest.mark.parametrize("system_words", (0, 20, 900))
def test_windows_keep_the_budget(spark, system_words):
    """Tokens are words and four a turn. Only a window of one new turn without history may be over the budget."""
    r = random.Random(system_words)
    sizes = [r.choice((1, 5, 40, 120, 370, 380, 480, 500, 600)) for _ in range(120)]
    turns = [(1, i, ("user", "assistant")[i % 2], " ".join(["w"] * n)) for i, n in enumerate(sizes, 1)]
    turns += [(1, 0, "system", " ".join(["s"] * system_words))] if system_words else []
    table = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    found = chat.windows(table).orderBy("window").collect()
    whole, history = 0, 0
    for w in found:
        blocks = w.text.split("<|end|>")[:-1]
        tokens = [len(b.split("<|text|>")[1].split()) + 4 for b in blocks]
        system = 1 if blocks[0].startswith("<|turn|>system") else 0
        repeated = w.repeated - (system if w.window else 0)
        fresh = len(blocks) - system - repeated
        whole += fresh
        history += repeated
        if sum(tokens) > 512:
            assert fresh <= 1 and repeated == 0
        assert sum(tokens[system:system + repeated]) <= 128
    assert whole == len(sizes) and (history > 0 or system_words == 900)
    checked(spark, chat.digests(table.unionByName(chat_extra(spark))), "op4_chat", conversations=table)


def chat_extra(spark):
    """The conversation that the check adds to its table."""
    text = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")


@pytest.mark.parametrize("ident", (None, 7))
@pytest.mark.parametrize("same_text", (True, False))
def test_repeated_ids_are_mixed_to_the_target(spark, ident, same_text):
    rows = [(ident, " ".join(["w" if same_text else f"w{i}"] * 100), "only") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.report(docs).collect()
    assert {r.target for r in got} == {7500.0} and sum(r.taken for r in got) == 7500
    assert sorted({r.taken for r in got}) == [100, 200]
    assert mixing.mix(docs.repartition(7)).count() == 75
    first, again = (sorted(r.text for r in mixing.mix(docs.repartition(n)).collect()) for n in (2, 5))
    assert first == again
    checked(spark, mixing.report(docs), "op7_mixing", documents=docs)


def test_odds_grow_with_size(spark):
    """Two sources: one with few documents that hold most words, whose odds are certain, one of short and long documents."""
    sizes = [(i, n, "skewed") for i, n in enumerate([5000, 4000, 900] + [10] * 300)]
    sizes += [(1000 + i, 30 if i % 2 else 10, "plain") for i in range(2000)] + [(9000 + i, 0, "plain") for i in range(5)]
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, n, s in sizes], "doc_id bigint, text string, source string")
    got = mixing.report(docs).collect()
    for source_size, low, high, near in ((12900, 5000, 10, 450), (40000, 30, 10, 15)):
        mine = [r for r in got if r.source_size == source_size]
        share = {n: sum(r.taken for r in mine if r.size == n) / sum(r.size for r in mine if r.size == n) for n in (low, high)}
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= near
        assert all(0 <= r.taken <= 2 * r.size for r in mine) and share[low] > share[high]
        whole = int(mine[0].target // source_size)
        extra = sum(r.taken > whole * r.size for r in mine if r.size == low) / sum(r.size == low for r in mine)
        assert extra == 1 if low == 5000 else 1.5 < extra / (share[high] - whole) < 6
    checked(spark, mixing.report(docs), "op7_mixing", documents=docs)


def test_ids_of_other_types(spark):
    rows = [(f"d{i}", f"{LINE}\nown {i}") for i in range(6)] + [(None, LINE), (None, LINE)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {(r.doc_id, r.n_dropped) for r in line_dedup.digests(docs).collect()}
    assert got == {(f"d{i}", 0 if i == 5 else 1) for i in range(6)} | {(None, 1)}
    checked(spark, line_dedup.digests(docs), "op6_line_dedup", documents=docs)


def test_columns_with_clashing_names(spark):
    rows = [(i, f"{LINE}\nown {i}" if i < 6 else None, "s", "r", "k", "d", i, "u", "x", "t", 3, "c") for i in range(8)]
    docs = spark.createDataFrame(rows, CLASHING)
    kept = line_dedup.deduplicated(docs)
    assert {(r["row"].doc_id, r["row"].kept, r["row"].drop, r.n_dropped) for r in kept.collect()} == {
        (i, "k", "d", 1 if i < 5 else 0) for i in range(8)}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert {tuple(r) for r in mixed.collect()} <= set(rows)


def test_many_ties_with_the_last_place(spark):
    """A query whose components are all zero ties with every vector; a block hands on only as many as can matter."""
    r = np.random.default_rng(3)
    rows = [(i, [0.0, 0.0] if i in (20, 40) else [float(x) for x in r.integers(-9, 9, 2) / 8]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    checked(spark, search.top(vectors, lambda v: v % 20 == 0, vectors_in_block=64, queries_in_block=4), "op10_search", embeddings=vectors)
    low = search.searched

    def width(batches, k, shift):
        for batch in low(batches, k, shift):
            assert batch.num_rows <= k
            yield batch

    search.searched = width
    try:
        assert search.top(vectors, lambda v: v % 20 == 0).count() == 300
    finally:
        search.searched = low
