"""Hot-key splitting must return exactly what the plain join returns."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import (ChainStep, SkewSpec, collect_hot, dim_lookup, hot_keys, lookup_chain,
                               salted_join, validity_lookup)
from tessera.operators.star import star_hot_keys


def multiset(df):
    return Counter(tuple(r) for r in df.collect())


def fixture(spark):
    # key 7 holds 120 of 302 fact rows; one NULL key; key 99 has no dimension row
    rows = [(i, 7 if i % 3 == 0 else i % 10, dt.datetime(2024, 1, 1 + i % 20)) for i in range(300)]
    rows += [(1000, None, dt.datetime(2024, 1, 5)), (1001, 99, dt.datetime(2024, 1, 5))]
    fact = spark.createDataFrame(rows, "m int, k int, ts timestamp")
    dim = spark.createDataFrame(
        [(70, 7, dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 10)),
         (71, 7, dt.datetime(2024, 1, 10), None)]
        + [(k * 10, k, dt.datetime(2023, 1, 1), None) for k in range(10) if k != 7]
        + [(None, None, dt.datetime(2023, 1, 1), None)],
        "sk long, k int, valid_from timestamp, valid_to timestamp")
    return fact, dim


def test_hot_keys_buckets(spark):
    fact, _ = fixture(spark)
    # 120 of 302 rows over 0.1 * 302: 4 buckets; the other keys have at most 20 rows
    assert collect_hot(hot_keys(fact, "k", SkewSpec(0.1))) == {7: 4}
    assert collect_hot(hot_keys(fact.limit(0), "k", SkewSpec(0.1))) == {}
    nulls = fact.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    assert collect_hot(hot_keys(nulls, "k", SkewSpec(0.1))) == {None: 5}


def test_hot_keys_are_bounded_by_the_share(spark):
    hot = collect_hot(hot_keys(spark.range(1000).selectExpr("id % 500 AS k"), "k", SkewSpec(0.001)))
    assert len(hot) <= 1000 and sum(hot.values()) <= 2000


def test_star_keys_are_counted_in_one_pass(spark):
    fact, _ = fixture(spark)
    f = fact.selectExpr("m", "k", "CAST(m % 2 AS INT) AS h", "CAST(k AS STRING) AS s")
    got = star_hot_keys(f, ["k", "h", "s"], SkewSpec(0.25))
    assert got == {"k": {7: 2}, "h": {0: 2, 1: 2}, "s": {"7": 2}}


def test_salted_lookups_equal_plain(spark):
    fact, dim = fixture(spark)
    spec = SkewSpec(share=0.05)
    for how in ("left", "inner"):
        plain = dim_lookup(fact, dim, "k", "k", "sk", "dsk", how=how)
        salted = dim_lookup(fact, dim, "k", "k", "sk", "dsk", how=how, skew=spec)
        assert multiset(plain) == multiset(salted)
    for upper in ("closed", "half_open"):
        plain = validity_lookup(fact, dim, "k", "k", "ts", "sk", "hsk", upper=upper)
        salted = validity_lookup(fact, dim, "k", "k", "ts", "sk", "hsk", upper=upper, skew=spec)
        assert multiset(plain) == multiset(salted)
    chain = [ChainStep(dim.where("k IS NOT NULL"), "k", "k", ("sk",))]
    assert multiset(lookup_chain(fact, chain)) == multiset(lookup_chain(fact, chain, skew=spec))


def test_salted_join_spreads_hot_key_over_tasks(spark):
    fact, dim = fixture(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        right = dim.select(F.col("k").alias("dk"), "sk")
        out = salted_join(fact, right, "k", "dk", SkewSpec(0.03, ("m",)), "left")
        parts = len({r.p for r in out.where("k = 7")
                     .select(F.spark_partition_id().alias("p")).collect()})
        assert parts > 1
        assert out.where("k = 7").count() == 240   # 120 rows x 2 versions
        # NULL keys match nothing, and do not meet in one task either
        nulls = fact.withColumn("k", F.when(F.col("k") == 7, F.col("k")))
        out = salted_join(nulls, right, "k", "dk", SkewSpec(0.03, ("m",)), "left")
        parts = len({r.p for r in out.where("k IS NULL")
                     .select(F.spark_partition_id().alias("p")).collect()})
        assert parts > 1 and out.where("k IS NULL").count() == 182
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=10, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 3)), min_size=1, max_size=40),
       dkeys=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=8),
       share=st.floats(0.01, 0.6))
def test_property_salted_equals_plain(spark, keys, dkeys, share):
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "m int, k int")
    dim = spark.createDataFrame([(j, k) for j, k in enumerate(dkeys)], "sk long, k int")
    spec = SkewSpec(share)
    assert multiset(dim_lookup(fact, dim, "k", "k", "sk", "o")) == multiset(
        dim_lookup(fact, dim, "k", "k", "sk", "o", skew=spec))
