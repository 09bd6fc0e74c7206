import datetime as dt
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.functions import age_years, calendar_parts, normalize, split_name, surrogate_key
from tessera.functions.keys import PARITY_MODULUS


def test_normalize_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "  casado  "), (4, "SoLteiro"), (5, "viúvo"), (6, "\tpad ")]
    df = spark.createDataFrame(rows, "id int, s string")
    got = dict(df.select("id", normalize("s").alias("n")).collect())
    assert got == {1: "", 2: "", 3: "CASADO", 4: "SOLTEIRO", 5: "VIÚVO", 6: "\tPAD"}


def test_split_name_edge_cases(spark):
    rows = [(1, "ana"), (2, None), (3, ""), (4, "ana maria silva"), (5, "ana   silva"),
            (6, "  joão  souza ")]
    df = spark.createDataFrame(rows, "id int, s string")
    f, r = split_name("s")
    got = {x.id: (x.f, x.r) for x in df.select("id", f.alias("f"), r.alias("r")).collect()}
    assert got == {
        1: ("ANA", None), 2: ("", None), 3: ("", None), 4: ("ANA", "MARIA SILVA"),
        5: ("ANA", "  SILVA"), 6: ("JOÃO", " SOUZA"),
    }


def test_age_years_edge_cases(spark):
    as_of = dt.date(2024, 3, 1)
    rows = [(1, None), (2, dt.date(1984, 3, 1)), (3, dt.date(1984, 3, 2)),
            (4, dt.date(2025, 1, 1)), (5, dt.date(2000, 2, 29)), (6, dt.date(2023, 3, 1))]
    df = spark.createDataFrame(rows, "id int, b date")
    out = df.select("id", age_years("b", F.lit(as_of)).alias("a"))
    # 1984-03-01 -> 2024-03-01 is 14,610 days = 40.0 years; one day less is 39.997.
    # 2023-03-01 -> 2024-03-01 spans a leap day: 366 days -> 1.
    assert dict(out.collect()) == {1: None, 2: 40, 3: 39, 4: -1, 5: 24, 6: 1}
    assert out.schema["a"].dataType.typeName() == "long"


def test_age_anniversary_can_round_down(spark):
    # 2021-01-01 -> 2022-01-01 is 365 days < 365.25: the rule says 0 on the anniversary.
    df = spark.createDataFrame([(dt.date(2021, 1, 1),)], "b date")
    assert df.select(age_years("b", F.lit(dt.date(2022, 1, 1)))).first()[0] == 0


def test_calendar_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    r = df.select(*calendar_parts("d")).first()
    assert (r.date_sk, r.day, r.month, r.year, r.quarter, r.weekday) == (
        20240229, 29, 2, 2024, 1, "Thursday")


def _spark_xxhash64_long(v: int) -> int:
    # Spark hashes a bigint as its 8 little-endian bytes with seed 42.
    h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=42)
    return h - (1 << 64) if h >= (1 << 63) else h


def test_surrogate_key_forms(spark):
    vals = [0, 1, 42, -7, 2**40, 123456789]
    df = spark.createDataFrame([(v,) for v in vals], "k long")
    out = df.select("k", F.xxhash64("k").alias("h"), surrogate_key("k").alias("sk63"),
                    surrogate_key("k", modulus=PARITY_MODULUS).alias("sk10")).collect()
    for r in out:
        assert r.h == _spark_xxhash64_long(r.k)
        assert r.sk63 == (r.h % (1 << 64)) >> 1
        assert r.sk10 == abs(r.h) % PARITY_MODULUS
        assert 0 <= r.sk10 < PARITY_MODULUS and r.sk63 >= 0


def test_surrogate_key_null_and_uniqueness(spark):
    df = spark.range(1_000_000).select(F.col("id").cast("string").alias("k"))
    df = df.union(spark.createDataFrame([(None,)], "k string"))
    now = F.lit("2025-01-01 00:00:00").cast("timestamp")
    keyed = df.select(surrogate_key("k", now).alias("sk"))
    agg = keyed.agg(F.count("*").alias("n"), F.countDistinct("sk").alias("d"),
                    F.min("sk").alias("lo"), F.count(F.when(F.col("sk").isNull(), 1)).alias("nulls")
                    ).first()
    assert agg.n == 1_000_001 and agg.d == 1_000_001
    assert agg.lo >= 0 and agg.nulls == 0


def test_surrogate_key_needs_columns():
    with pytest.raises(ValueError):
        surrogate_key()
