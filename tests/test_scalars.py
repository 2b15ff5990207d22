import random

from pyspark.sql import functions as F

from fleetaudit.functions import scalars as S
from fleetaudit.plans import catalog


def _rows(spark, values, schema="v bigint"):
    return spark.createDataFrame([(v,) for v in values], schema)


def _python_size(value):
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if value < 1024:
            return f"{value:.1f}{unit}"
        value = value / 1024
    return f"{value:.1f}PB"


def test_size_text_agrees_with_python_formatting(spark):
    rng = random.Random(1)
    values = [0, 1, 1023, 1024, 1280, 1536, 2**40, 2**50, 2**60] + [
        rng.randrange(2 ** rng.randrange(1, 62)) for _ in range(3000)
    ]
    out = _rows(spark, values).select("v", S.size_text(F.col("v")).alias("t")).collect()
    assert all(r.t == _python_size(r.v) for r in out)


def test_number_texts_beyond_64_bits(spark, tmp_path):
    """Keys whose product needs more than 64 bits, or more than 38 digits, have a size too; ones that fit keep theirs."""
    keys = [(1, 2, 3), (149_999, 19_999, 999), (8_999_999, 1_199_999, 59_999), (1, 2**61, 7), (None, 5, 1), (5, 5, None)]
    rows = [(*k, n) for n, k in enumerate(keys)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    expected = {n: _python_size(float(i * p * p * 1021 + s)) if None not in (i, p, s) else None for i, p, s, n in rows}
    got = {r.l_linenumber: r.size for r in catalog.QUERIES["number_texts"](spark, str(tmp_path)).collect()}
    del expected[3]  # has more digits than a double holds
    assert float(got.pop(3).removesuffix("PB")) == float(1021 * 2**122 + 7) / 2**50
    assert got == expected


def test_duration_text(spark):
    cases = {
        None: "-", -5: "-5ms", 0: "0ms", 999: "999ms", 1000: "1.0s", 4250: "4.2s", 4350: "4.3s", 59_999: "60.0s",
        60_000: "1m0s", 200_000: "3m20s", 3_600_000: "1h0m", 18_720_000: "5h12m", 86_400_000: "1d0h",
        194_400_000: "2d6h",
    }
    out = _rows(spark, list(cases)).select("v", S.duration_text(F.col("v")).alias("t")).collect()
    assert {r.v: r.t for r in out} == cases


def test_seconds_agree_with_python_formatting(spark):
    out = spark.range(1000, 60_000).select("id", S.duration_text(F.col("id")).alias("t")).collect()
    assert all(r.t == f"{r.id / 1000:.1f}s" for r in out)


def test_text_helpers(spark):
    row = spark.range(1).select(
        S.first_present(F.lit(""), F.lit("b")).alias("second"),
        S.first_present(F.lit(None).cast("string"), F.lit("")).alias("last"),
        S.first_nonzero(F.lit(0), F.lit(None).cast("int"), F.lit(3)).alias("num"),
        S.ellipsis(F.lit("x" * 81), 80).alias("cut"),
        S.ellipsis(F.lit("é" * 80), 80).alias("kept"),
        S.minute_stamp(F.lit("2024-05-06T07:08:09.123Z")).alias("minute"),
        S.parent_path(F.lit("a.b.c")).alias("parent"),
        S.parent_path(F.lit("a")).alias("top"),
        S.parent_path(F.lit(".raw")).alias("blank"),
        S.parens_balanced(F.lit(")a(")).alias("even"),
        S.parens_balanced(F.lit("(()")).alias("odd"),
        S.document_count(F.lit("NONE")).alias("none"),
        S.document_count(F.lit("500")).alias("count"),
        S.document_count(F.lit("5x")).alias("bad"),
        S.dash_if_blank(F.lit("")).alias("dash"),
        S.joined(F.lit(None).cast("array<string>"), ", ").alias("nothing"),
    ).first()
    assert row.asDict() == {
        "second": "b", "last": "", "num": 3, "cut": "x" * 77 + "...", "kept": "é" * 80, "minute": "2024-05-06 07:08",
        "parent": "a.b", "top": None, "blank": None, "even": True, "odd": False, "none": "NONE", "count": "500",
        "bad": None, "dash": "-", "nothing": "",
    }


def test_same_keys(spark):
    row = spark.sql("SELECT map('a', 1, 'b', 2) x, map('b', 0, 'a', 0) y, map('a', 1) z, cast(map() as map<string,int>) e")
    got = row.select(
        S.same_keys(F.col("x"), F.col("y")).alias("equal"),
        S.same_keys(F.col("x"), F.col("z")).alias("subset"),
        S.same_keys(F.lit(None).cast("map<string,int>"), F.col("e")).alias("missing"),
    ).first()
    assert tuple(got) == (True, False, True)
