"""Periodic runs, sharding and conversation repair: odd tables, brute force, clashing columns."""

import collections
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetaudit.llm import periodic, repair, sharding
from fleetaudit.llm.catalog import CHECKS
from tools.check_queries import compare

SCHEMA = "doc_id bigint, text string, source string, row string, size int, shard string, periodic int, text_hash int, bundle int"


def rows():
    r = random.Random(5)
    out = [(None, None), (1, None), (2, ""), (3, "word"), (3, "word"), (None, "no id no id no id no id"), (4, " \n\t ")]
    for i in range(5, 60):
        words = [r.choice(["a", "b", "é", "Gamma", "x" * 40]) for _ in range(r.randint(1, 40))]
        for _ in range(r.randint(0, 3)):
            at = r.randrange(len(words))
            words[at:at] = words[at : at + r.randint(1, 6)] * r.randint(2, 7)
        out.append((i, r.choice([" ", "\n", " \t"]).join(words)))
    out += [(i, "the same text") for i in range(60, 75)] + [(75, "MIT License " * 3_000), (76, "a " * 5_000)]
    return [(d, t, "s", "clash", 1, "clash", 2, 3, 4) for d, t in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def brute_runs(words):
    best = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in best.items())


def test_runs_against_brute_force(spark, docs):
    short = docs.where("length(text) < 9000 OR text IS NULL")
    found = periodic.periodic_runs(short)
    assert set(found.columns) == set(docs.columns) and dict(found.dtypes)["row"] == "string"
    for x in found.collect():
        words = (x.text or "").split()
        want = brute_runs(words)
        assert [tuple(run) for run in x.periodic.runs] == want and x.periodic.n_words == len(words)
        dropped = {i for start, length, q in want for i in range(start + q, start + length)}
        assert x.periodic.collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)


def test_runs_over_long_texts_and_small_blocks(monkeypatch):
    r = random.Random(2)
    texts = [[b"%d" % r.randrange(k) for _ in range(n)] for k, n in ((2, 400), (3, 300), (50, 300), (1, 500), (2, 7), (9, 0))]
    texts.append([b"%d" % (i % 37) for i in range(900)])
    want = [brute_runs(w) for w in texts]
    for tests in (periodic.BLOCK_TESTS, 10):
        monkeypatch.setattr(periodic, "BLOCK_TESTS", tests)
        assert [[(x["start"], x["length"], x["period"]) for x in one["runs"]] for one in periodic._block(texts)] == want


def test_runs_against_sql(spark, docs):
    connection = duckdb.connect()
    some = docs.where("doc_id IS NULL OR doc_id < 76")
    connection.register("documents", some.toArrow())
    assert compare(periodic.report(some), CHECKS["op11_periodic"], connection) is None
    assert periodic.report(docs.limit(0)).count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert periodic.report(named).count() == docs.count()


def test_differencing_is_tight_and_complete():
    r = random.Random(1)
    for sizes, shards in (([r.randint(1, 10_000) for _ in range(500)], 16), ([5] * 7, 3), ([], 4), ([9], 4), ([1000, 1, 1, 1, 1], 3), ([8, 7, 6, 5, 4], 2)):
        dealt = sharding.differenced(list(enumerate(sizes)), shards)
        assert len(dealt) == shards and sorted(x for part in dealt for x in part) == list(range(len(sizes)))
        sums = [sum(sizes[x] for x in part) for part in dealt]
        assert max(sums) - min(sums) <= max(sizes, default=0)
    assert max(sums) - min(sums) <= 2  # the textbook example: 16 and 14
    assert sharding.differenced([(0, 1000), (1, 1), (2, 1)], 3)[0] == [0]


def test_shards(spark, docs):
    got = sharding.report(docs).collect()
    want = collections.Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows())
    assert collections.Counter((x.doc_id, x["size"], x.text_crc32) for x in got) == want
    shards, groups, slots = collections.Counter(), collections.defaultdict(set), collections.defaultdict(list)
    for x in got:
        shards[x.shard] += x["size"]
        groups[x["size"], x.text_crc32].add(x.shard)
        slots[x.shard].append(x.slot)
    assert all(len(s) == 1 for s in groups.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(shards) <= set(range(16)) and {x.law for x in got} == {"bytes"} and {x.grown_shard for x in got} == {None}
    again = {(x.doc_id, x.text_crc32): x.shard for x in sharding.report(docs.repartition(7)).collect()}
    assert again == {(x.doc_id, x.text_crc32): x.shard for x in got}
    few = sharding.sharded(docs, shards=3, bundles=8)
    assert few.columns == [c for c in docs.columns if c != "shard"] + ["shard"] and few.count() == docs.count()
    assert dict(few.dtypes)["row"] == "string" and few.select("size").distinct().collect() == [(1,)]
    assert sharding.report(docs.limit(0)).count() == 0


def test_equal_documents_over_bundles(spark):
    many = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot text' ELSE repeat('w', int(id % 50)) || id END AS text")
    sums = [x.n for x in sharding.report(many).groupBy("shard").agg(F.sum("size").alias("n")).orderBy(F.desc("n")).collect()]
    assert len(sums) == 16 and sums[0] <= max(9 * 1334, sums[-1] + 60)


def test_shards_are_written(spark, docs, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs.drop("shard"), path, shards=4, tasks_per_shard=2)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and {x.shard for x in back.select("shard").distinct().collect()} <= {0, 1, 2, 3}


def turns():
    r = random.Random(7)
    out = [(None, None, None, None), (None, None, "assistant", "tie."), (None, None, "assistant", "tie."), (None, 3, "system", "last\n")]
    for conv in range(120):
        for turn in range(r.choice([1, 1, 2, 5, 9, 45])):
            role = r.choice(["user", "assistant", "system", "tool", "", "us"]) if r.random() < 0.3 else ["user", "assistant"][turn % 2]
            out.append((conv, r.choice([turn, turn, turn, 1, None]), role, r.choice([None, "", " \t", "yes.", f"{turn}!", f"cut {turn}", "é? ", "word " * 50 + "."])))
    return out


@pytest.fixture(scope="module")
def given(spark):
    return spark.createDataFrame([(*t, "clash", 5) for t in turns()], "conv_id bigint, turn bigint, role string, text string, audit string, gone_by int").repartition(3)


def test_repairs_against_sql(spark, given):
    connection = duckdb.connect()
    connection.register("conversations", given.toArrow())
    assert compare(repair.report(given), CHECKS["op13_repair"], connection) is None
    assert repair.report(given.limit(0)).count() == 0
    named = repair.repairs(given.withColumn("conv_id", F.concat(F.lit("c"), "conv_id")))
    assert named.count() == repair.repairs(given).count() and dict(named.dtypes)["conv_id"] == "string"


def cheapest(found):
    """All ways, step by step: cost, letters and lines by the role before a place."""

    def put_in(ways):
        ways = dict(ways)
        for _ in range(3):
            for state, (cost, letters, lines) in list(ways.items()):
                role = repair.NEXT[state]
                new = (cost + 5, letters + "I", (*lines, (role, "")))
                ways[role[0]] = min(ways.get(role[0], new), new)
        return ways

    ways = {"^": (0, "", ())}
    for role, text, fault in found:
        after = {}

        def to(state, *way):
            after[state] = min(after.get(state, way), way)

        for state, (cost, letters, lines) in put_in(ways).items():
            to(state, cost + 2, letters + "D", lines)
            if fault not in ("b", "d"):
                left, need = 5 if fault else 0, repair.NEXT[state]
                if role[:1] == need[0] or state == "^" and role[:1] == "s":
                    to(role[:1], cost + left, letters + "K", (*lines, (role, text)))
                to(need[0], cost + left + 1, letters + "R", (*lines, (need, text)))
        ways = after
    return min(way for state, way in put_in(ways).items() if state in "^a")


@pytest.mark.parametrize("block", (1, 3, repair.BLOCK))
def test_search_against_all_ways(block):
    r = random.Random(block)
    for _ in range(300):
        found, seen, out = [], set(), []
        talk = repair.Conversation(lambda edit, role, text: out.append((edit, role, text)), block=block)
        for turn in range(r.choice([0, 1, 2, 4, 8, 30])):
            role, text = r.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), r.choice(["yes.", "cut", " ", f"{turn}.", f"{turn}?", f"{turn}"])
            fault = "b" if not text.strip() else "d" if (role, text) in seen else "" if text[-1] in ".!?" else "t"
            seen.add((role, text))
            found.append((role, text, fault))
            talk.add(turn, role, text)
        talk.finish()
        got = (talk.cost, "".join(edit for edit, *_ in out), tuple((role, text) for edit, role, text in out if edit != "D"))
        assert got == cheapest(found)


def test_long_conversations_are_handed_on_early():
    r, most = random.Random(4), 0
    talk = repair.Conversation(lambda *_: None)
    for turn in range(6000):
        talk.add(turn, r.choice(["user", "assistant", "system", "tool"]), r.choice([f"{turn}.", f"{turn}", "hm."]))
        most = max(most, len(talk.waiting))
    talk.finish()
    assert most < 20 and talk.gaps == 0


def test_repaired_turns(spark, given):
    made = collections.defaultdict(list)
    for x in repair.repaired_turns(given).collect():
        made[x.conv_id].append((x.position, x.role, x.text, x.edit))
    for x in repair.repairs(given).collect():
        lines = sorted(made[x.conv_id])
        assert [p for p, *_ in lines] == list(range(len(lines))) and "".join(e for *_, e in lines) == x.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text, _ in lines).encode()).hexdigest() == x.repaired_sha256
