"""Every operator on a small odd table, and against brute force where SQL can't check it."""

import collections
import hashlib
import os
import random
import struct

import duckdb
import pytest
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

import corpus_pipeline
from fleetaudit.llm import bpe, chat, licenses, line_dedup, mixing, quality_rules, rule_ensemble, search, simhash, toxicity
from fleetaudit.llm.catalog import CHECKS, QUERIES, RANKS
from tools.check_queries import compare

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, row string, size int, bpe int"
LINE = "This line is long enough to be counted as one that repeats."


def rows():
    r = random.Random(4)
    words = ["alpha", "beta", "Gamma", "délta", "mit", "license", "x" * 60, "1,5", "#", "!!"]
    out = [(None, None, None, None), (1, None, None, None), (2, "", "en", "a"), (3, "word", "en", "b"), (3, "word", "en", "b"), (None, "no id", "en", "a")]
    for i in range(4, 24):
        lines = [" ".join(r.choice(words) for _ in range(r.randint(1, 12))) for _ in range(r.randint(1, 5))]
        out.append((i, "\n".join(lines + [LINE.upper() if i % 2 else f"  {LINE}\t"] * (i % 3)), "en", r.choice(["a", "b", None])))
    out.append((24, " ".join(["MIT License"] * 30_000), "en", "a"))
    out += [(i, out[10][1], "en", "a") for i in range(30, 33)]
    return [(d, t, lang, s, len(t or ""), "clash", "clash", 1, 2) for d, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(30)], "doc_id bigint, quality int, t boolean").select(
        "doc_id", "quality", F.col("t").cast("int").alias("toxic"))


def checked(spark, df, name, **tables):
    connection = duckdb.connect()
    for table, frame in tables.items():
        connection.register(table, frame.toArrow())
    assert compare(df, CHECKS[name], connection) is None


def test_odd_documents_against_sql(spark, docs):
    checked(spark, quality_rules.report(docs), "op3_quality_rules", documents=docs)
    checked(spark, licenses.report(docs), "op5_licenses", documents=docs)
    checked(spark, mixing.report(docs), "op7_mixing", documents=docs)
    checked(spark, line_dedup.digests(docs), "op6_line_dedup", documents=docs)


def test_empty_tables(spark, docs, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    for df in (quality_rules.report(none), licenses.report(none), mixing.report(none), line_dedup.digests(none), simhash.report(none), bpe.digests(none, RANKS),
               toxicity.report(none, no_labels), rule_ensemble.report(none, no_labels), mixing.mix(none), simhash.representatives(none)):
        assert df.count() == 0
    assert {r.predicted for r in toxicity.report(docs, no_labels).collect()} <= {0, 1}


def test_bpe_is_that_of_the_library(spark, docs):
    with open(RANKS, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for d, text, *_ in rows():
        ids = library.encode_ordinary(text or "")
        want[d, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert collections.Counter(map(tuple, bpe.digests(docs, RANKS).collect())) == want
    coder, r = bpe.TextCoder(ranks), random.Random(2)
    parts = ["a", "the", " ", "\n", "é", "1", "!!", "'s", "日本", "  ", "ing", "=" * 70]
    for _ in range(300):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 30)))
        start = r.randint(0, len(text))
        stop, put = r.randint(start, len(text)), r.choice(parts)
        new, ids, _ = coder.edited(text, start, stop, put)
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(new)
        data = text.encode()
        table = coder.coder.extend(data, [-1])
        assert coder.coder.read(table) == coder.coder.merged(data)
        assert coder.coder.extend(data + b"end", list(table)) == coder.coder.extend(data + b"end", [-1])
        changed, edited, _ = coder.coder.edited(data, table, 0, min(2, len(data)), b"xy")
        assert edited == coder.coder.extend(changed, [-1])


def test_bpe_texts_taken_together(spark):
    with open(RANKS, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    r, coder = random.Random(3), bpe.TextCoder(ranks)
    parts = ["a", "The", "tion", " ", " ", "  ", "\n", "\t ", "\xa0", "\u2028", "\x1c", "\x00", "é", "e\u0301", "日本", "²", "1", "!!", "'s", "<|endoftext|>", "=" * 70, "z" * 300]
    texts = ["", " ", *("".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(3000))]
    groups = list(bpe.together(texts, 500))
    assert [t for g in groups for t in g] == texts and len(groups) > 10 and not list(bpe.together([]))
    got = [ids for g in groups for ids in coder.encode_all(g)]
    assert [list(memoryview(ids).cast("I")) for ids in got] == library.encode_ordinary_batch(texts)
    assert [coder.decode(ids) for ids in got] == [t.encode() for t in texts] and coder.encode_all([]) == []


def test_bpe_work_is_shared(spark, tmp_path):
    with open(RANKS, "rb") as file:
        ranks = bpe.parse_ranks(file.read())
    coder, asked = bpe.PrefixCoder(ranks), 0

    class Heads(dict):
        def __contains__(self, head):
            nonlocal asked
            asked += 1
            return super().__contains__(head)

    coder.heads = Heads(coder.heads)
    long = b"interchangeably" * 40
    pieces = sorted(long + bytes([a, b]) for a in range(97, 107) for b in range(97, 107))
    assert list(coder.pieces(pieces)) == [coder.merged(p) for p in pieces]
    assert asked <= 2 * len(long) + 10 * 100  # each table anew would ask 100 times as often
    parse, log = bpe.parse_ranks, tmp_path / "coders"
    docs = spark.range(64).selectExpr("id AS doc_id", "'some words' AS text").repartition(16)

    def counted(content):
        with open(log, "a") as file:
            file.write(f"{os.getpid()}\n")
        return parse(content)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(bpe, "parse_ranks", counted)
        assert {tuple(row)[1] for row in bpe.digests(docs, RANKS).collect()} == {len(bpe.TextCoder(ranks).encode("some words")) // 4}
    makers = log.read_text().split()
    assert len(makers) == len(set(makers)) < 16  # one coder for each Python worker, not for each of the 16 tasks


def test_simhash_against_all_pairs(spark, docs):
    got = simhash.report(docs).collect()
    prints = {(d, t): simhash.fingerprint(t or "") for d, t, *_ in rows()}
    nodes = list(set(prints.values()))
    root = {f: f for f in nodes}
    for _ in nodes:
        for a in nodes:
            for b in nodes:
                if (a ^ b).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    least = {}
    for (d, _), f in prints.items():
        if d is not None:
            least[root[f]] = min(least.get(root[f], d), d)
    want = collections.Counter((d, f"{prints[d, t]:016x}", least.get(root[prints[d, t]])) for d, t, *_ in rows())
    assert collections.Counter(map(tuple, got)) == want
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(least.values()) | {None}  # one group has no id


def test_near_fingerprints_in_large_buckets(spark):
    r = random.Random(9)
    centre, far = r.getrandbits(64), r.getrandbits(64)
    flip = lambda v, n: v ^ sum(1 << b for b in r.sample(range(64), n))
    values = {centre, far} | {flip(centre, r.randint(1, 6)) for _ in range(150)} | {flip(far, 5) for _ in range(20)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), chunk=16)).collect()
    got = collections.defaultdict(set)
    for node, root in map(tuple, found):
        got[root].add(node % (1 << 64))
    want, left = [], set(values)
    while left:
        group, edge = set(), {left.pop()}
        while edge:
            group |= edge
            near = {v for v in left if any((v ^ e).bit_count() <= 4 for e in edge)}
            left -= near
            edge = near
        want.append(group)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want if len(g) > 1)


def test_every_group_keeps_one_document(spark):
    first, second, third = (" ".join(f"{k}{i}" for i in range(50)) for k in "xyz")
    rows = [(1, first), (1, second), (2, first), (3, second), (3, second), (None, third), (None, third + " end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = {(x.root, x.component_id) for x in simhash.grouped(docs).collect()}
    kept = simhash.representatives(docs).collect()
    assert len(kept) == len(ids) and {(1, first), (1, second)} <= set(map(tuple, kept))


def test_a_long_chain_is_one_component(spark):
    chain = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("a"), ((F.col("id") + 1) * 7919 % 3001).alias("b"))
    found = simhash.components(chain).collect()
    assert len(found) == 3001 and {x.root for x in found} == {0}


def test_toxic_threshold_is_of_all_unseen_texts():
    r = random.Random(8)
    plain = lambda n: " ".join(f"plain{r.randrange(300)}" for _ in range(n))
    marked = lambda: plain(6) + " " + " ".join(r.choice(["venomous", "loathsome", "despicable"]) for _ in range(6))
    ordinary = [marked() if i > 1000 and i % 60 == 0 else plain(12) for i in range(1500)]
    texts = [(marked(), 1) for _ in range(60)] + [(t, 0) for t in ordinary]
    model = toxicity.fit(texts, 0.04)
    a, b = (toxicity.compressor(c) for c in (model.ordinary, model.toxic))
    gains = sorted(len(a(w)) - len(b(w)) for t in ordinary[::3] for w in (toxicity.CARRIER + w for w in toxicity.windows_of(toxicity.words_of(t))))
    assert gains[-1] > 0 and gains[int(0.999 * (len(gains) - 1))] < model.threshold <= gains[int(0.999 * (len(gains) - 1)) + 1] + 1


def test_repeated_ids_train_once(spark, monkeypatch):
    rows = [(i, f"text {i} {k}") for i in range(8) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id bigint, label int")
    assert sorted(x.label for x in rule_ensemble.labelled(docs, labels).collect()) == [0] * 4 + [1] * 4
    monkeypatch.setattr(toxicity, "fit", lambda texts, share: texts)
    texts = toxicity.train(docs, labels)
    assert len(texts) == 8 and texts == toxicity.train(docs.repartition(2), labels)


def test_chat_round_trip(spark):
    r = random.Random(6)
    parts = ["<", "<|", "|turn|>", "<|turn|>", "<|text|>", "<|end|>", "\\", "</s>", "<s>", "[INST]", "[", "/INST]", "<<SYS>>", "\n", "word ", "é", "<\\|end|>"]
    turns = []
    for conv in range(40):
        for turn in range(r.choice([1, 2, 5, 40])):
            role = "system" if turn == 0 and conv % 2 else ["user", "assistant"][turn % 2]
            turns.append((conv, turn, role, r.choice([None, "", "".join(r.choice(parts) for _ in range(30)), "word " * r.choice([20, 900])])))
    turns += [(None, None, None, None), (None, None, "assistant", "tie"), (None, None, "assistant", "tie"), (-7, 0, "<|end|>\n", "x")]
    given = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    hostile = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], given.schema)
    checked(spark, chat.digests(given.unionByName(hostile)), "op4_chat", conversations=given)
    made = chat.windows(given, budget=100, history=30)
    assert made.where("repeated > 1").count() and not made.where(F.contains("text", F.lit("</s>"))).count()


def test_search_odd_vectors(spark):
    r = random.Random(3)
    nan, inf = float("nan"), float("inf")
    data = [(i, [r.choice([-0.5, 0.25, 0.1, 0.9]) for _ in range(3)]) for i in range(120)] + [(i, [0.5, 0.5, 0.5]) for i in range(120, 200)]
    data += [(200, None), (220, [nan, 1.0, 1.0]), (240, [1.0, None, 1.0]), (260, [inf, 0.0, 0.0]), (280, [0.1, 0.2]), (None, [1.0, 1.0, 1.0]), (300, [3.0e4, -3.0e4, 1.0])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>").repartition(3)
    checked(spark, search.report(df), "op10_search", embeddings=df)
    every = search.top(df, lambda v: v % 20 == 0, vectors_in_block=16, queries_in_block=4)
    checked(spark, every, "op10_search", embeddings=df)
    assert search.report(df.limit(0)).count() == 0


def test_labels_are_learned(spark):
    r = random.Random(8)
    plain = lambda n: " ".join("".join(r.choice("aeiontrsh") for _ in range(r.randint(3, 8))) for _ in range(n))
    data = []
    for i in range(400):
        bad, poor = i % 4 == 0, i % 5 == 0
        text = plain(60) + (" vileword " + plain(9) + " foulterm " if bad else " ") + plain(40)
        data.append((i, text.upper() + "!!" * 20 if poor else text, int(not poor), int(bad)))
    df = spark.createDataFrame(data, "doc_id bigint, text string, quality int, toxic int")
    for got, label, least in ((toxicity.report(df, df), "toxic", 0.9), (rule_ensemble.report(df, df), "quality", 0.97)):
        held = got.where("held_out").join(df.select("doc_id", label), "doc_id").collect()
        assert all(0 <= x.score <= 1 for x in held) and sum(x.predicted == x[label] for x in held) >= least * len(held)


def test_line_runs_online(spark):
    runs = line_dedup.LineRuns(spark, fan_out=2)
    frame = lambda rows: line_dedup.hashed_lines(spark.createDataFrame(rows, "doc_id bigint, text string"))
    batches = [[(1, LINE), (2, LINE + " b")], [(3, LINE), (4, LINE + " c")], [(5, LINE + " b"), (6, LINE + " d")]]
    assert [sorted(x.doc_id for x in runs.first_seen(frame(b)).collect()) for b in batches] == [[1, 2], [4], [6]]
    assert [len(level) for level in runs.levels] == [1, 1]
    # Every hash lies in one run; of later batches only the hashes that runs held already leave rows.
    held = [r.h1 for name in runs.runs for r in spark.table(name).collect()]
    assert len(held) == len(set(held)) == 4 and sum(df.count() for df in runs.added) == 2
    assert sorted(r.last for r in runs.frequent(2).collect()) == [3, 5]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = runs.unseen(spark.table(runs.runs[0]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not there")
@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "labels", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    if name in ("op4_chat", "op6_line_dedup", "op7_mixing"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in ("Python", "Arrow", "NestedLoop", "Cartesian"))
    assert compare(df, CHECKS[name], connection) is None


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not there")
def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near dedup", "mixing", "bpe"]
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count()
