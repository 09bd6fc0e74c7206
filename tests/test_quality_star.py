import pytest

from tessera.operators import (QualityError, StarJoin, duplicate_keys, flatten, gate,
                               incremental, key_uniqueness_report, null_key_report,
                               orphan_report, row_count_report)


def test_count_gate_blind_when_orphan_and_fanout_cancel(spark):
    src = spark.createDataFrame([(1,), (2,), (3,)], "m int")
    fact = spark.createDataFrame([(1,), (2,), (2,)], "m int")   # 3 dropped, 2 doubled
    rc = row_count_report(src, fact).first()
    assert (rc.source_count, rc.target_count, rc.passed) == (3, 3, True)
    uk = key_uniqueness_report(fact, "m").first()
    assert (uk.total_rows, uk.distinct_keys, uk.duplicate_rows, uk.passed) == (3, 2, 1, False)
    with pytest.raises(QualityError) as e:
        gate(row_count=row_count_report(src, fact), unique=key_uniqueness_report(fact, "m"))
    assert [f["check"] for f in e.value.failures] == ["unique"]


def test_null_key_counts_as_one_value(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "k int")
    r = key_uniqueness_report(df, "k").first()
    assert (r.total_rows, r.distinct_keys, r.passed) == (3, 2, False)
    assert sorted((x.k, x.n) for x in duplicate_keys(df, "k").collect()) == [(None, 2)]


def test_empty_input_passes(spark):
    df = spark.createDataFrame([], "k int")
    r = key_uniqueness_report(df, "k").first()
    assert (r.total_rows, r.distinct_keys, r.passed) == (0, 0, True)
    assert gate(u=key_uniqueness_report(df, "k"))[0]["passed"]


def test_flatten_inner_drops_null_keys_left_keeps(spark):
    fact = spark.createDataFrame([(1, 10, 5.0), (2, None, 6.0)], "m int, hsk long, amt double")
    dim = spark.createDataFrame([(10, "ANA")], "sk long, first_name string")
    j = [StarJoin(dim, "hsk", "sk", {"first_name": "name"})]
    inner = flatten(fact, j, {"m": "m", "amt": "amount"})
    assert [tuple(r) for r in inner.collect()] == [(1, 5.0, "ANA")]
    left = flatten(fact, j, {"m": "m", "amt": "amount"}, how="left")
    assert sorted(tuple(r) for r in left.collect()) == [(1, 5.0, "ANA"), (2, 6.0, None)]
    assert null_key_report(fact, ["hsk"]).first().null_hsk == 1


def test_incremental_only_unseen(spark):
    old = spark.createDataFrame([(1, "a")], "m int, v string")
    new = spark.createDataFrame([(1, "a2"), (2, "b")], "m int, v string")
    assert [tuple(r) for r in incremental(old, new, "m").collect()] == [(2, "b")]


def test_orphans_per_hop(spark):
    base = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "x"), (5, None), (6, "c")], "m int, k string")
    card = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", 9)], "card string, acc int")
    acc = spark.createDataFrame([(1, "h"), (2, "gone")], "acc_id int, holder string")
    holder = spark.createDataFrame([("h",)], "hid string")
    hops = [(card, "k", "card"), (acc, "acc", "acc_id"), (holder, "holder", "hid")]
    assert orphan_report(base, hops).first().asDict() == {
        "rows": 6, "orphans_1": 2, "orphans_2": 1, "orphans_3": 1}
    assert orphan_report(base.limit(0), hops).first().rows == 0
