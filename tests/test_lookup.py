import datetime as dt

from tessera.operators import (ChainStep, calendar, calendar_lookup, dim_lookup,
                               lookup_chain, validity_lookup)

D = dt.datetime


def dims(spark):
    return spark.createDataFrame([
        (10, "h1", D(2024, 1, 1), D(2024, 6, 1)),
        (11, "h1", D(2024, 6, 1), None),
        (20, "h2", D(2024, 3, 1), None),
    ], "sk long, holder_id string, valid_from timestamp, valid_to timestamp")


def facts(spark):
    return spark.createDataFrame([
        (1, "h1", D(2023, 12, 31)),   # before the first version
        (2, "h1", D(2024, 6, 1)),     # exactly at the shared boundary
        (3, "h1", D(2024, 3, 5)),     # inside
        (4, "h1", D(2030, 1, 1)),     # open end
        (5, "zz", D(2024, 3, 5)),     # unknown id
        (6, "h2", D(2024, 3, 1)),     # at the start
    ], "m int, holder_id string, ts timestamp")


def pairs(df):
    return sorted((r.m, r.hsk) for r in df.collect())


def test_validity_closed(spark):
    out = validity_lookup(facts(spark), dims(spark), "holder_id", "holder_id", "ts", "sk", "hsk")
    assert pairs(out) == [(1, None), (2, 10), (2, 11), (3, 10), (4, 11), (5, None), (6, 20)]


def test_validity_half_open(spark):
    out = validity_lookup(facts(spark), dims(spark), "holder_id", "holder_id", "ts", "sk",
                          "hsk", upper="half_open")
    assert pairs(out) == [(1, None), (2, 11), (3, 10), (4, 11), (5, None), (6, 20)]


def test_dim_lookup_miss_and_fanout(spark):
    fact = spark.createDataFrame([(1, "c1"), (2, "orphan"), (3, "dup")], "m int, card string")
    dim = spark.createDataFrame([(100, "c1"), (200, "dup"), (201, "dup")], "sk long, card string")
    out = dim_lookup(fact, dim, "card", "card", "sk", "card_sk")
    assert sorted((r.m, r.card_sk) for r in out.collect()) == [
        (1, 100), (2, None), (3, 200), (3, 201)]


def test_chain_drops_orphans(spark):
    mv = spark.createDataFrame([(1, "c1"), (2, "c_orphan"), (3, "c2")], "m int, card_id string")
    card = spark.createDataFrame([("c1", "a1"), ("c2", "a_orphan")], "card_id string, account_id string")
    acct = spark.createDataFrame([("a1", "h1")], "account_id string, holder_id string")
    out = lookup_chain(mv, [ChainStep(card, "card_id", "card_id", ("account_id",)),
                            ChainStep(acct, "account_id", "account_id", ("holder_id",))])
    assert [(r.m, r.holder_id) for r in out.collect()] == [(1, "h1")]


def test_calendar_and_lookup(spark):
    cal = calendar(spark, "2020-01-01", "2026-12-31")
    assert cal.count() == 2557
    r = cal.where("date_sk = 20240101").first()
    assert (r.weekday, r.quarter, r.day) == ("Monday", 1, 1)
    fact = spark.createDataFrame([(1, D(2024, 1, 1, 0, 0, 1)), (2, D(2019, 12, 31, 23, 59))],
                                 "m int, ts timestamp")
    out = calendar_lookup(fact, cal, "ts")
    assert sorted((r.m, r.date_sk) for r in out.collect()) == [(1, 20240101), (2, None)]


def test_type1_upsert(spark):
    from pyspark.sql import functions as F

    from tessera.operators import type1_upsert
    dim = spark.createDataFrame([(1, "a", "old"), (2, "gone", "x"), (3, "dup", "p"),
                                 (4, "dup", "q"), (5, None, "nullkey")],
                                "sk long, id string, attr string")
    src = spark.createDataFrame([("a", "new"), ("dup", "r"), ("fresh", "f"), (None, "n")],
                                "id string, attr string")
    out = type1_upsert(src, dim, "id", now=F.lit("2025-01-01").cast("timestamp"),
                       new_flag="is_new").collect()
    got = sorted((r.id or "", r.attr, r.sk if not r.is_new else "new") for r in out)
    assert got == sorted([("a", "new", 1), ("gone", "x", 2), ("dup", "r", 3), ("dup", "r", 4),
                          ("", "nullkey", 5), ("fresh", "f", "new"), ("", "n", "new")])
    assert all(r.sk is not None and r.sk >= 0 for r in out)


def test_validity_date_bounds_compare_as_midnight(spark):
    dim = spark.createDataFrame([(1, "h", dt.date(2024, 1, 1), dt.date(2024, 6, 1))],
                                "sk long, holder_id string, valid_from date, valid_to date")
    fact = spark.createDataFrame([(1, "h", D(2024, 6, 1, 0, 0, 0)),
                                  (2, "h", D(2024, 6, 1, 0, 0, 1))],
                                 "m int, holder_id string, ts timestamp")
    out = validity_lookup(fact, dim, "holder_id", "holder_id", "ts", "sk", "hsk")
    assert pairs(out) == [(1, 1), (2, None)]
