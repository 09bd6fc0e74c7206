"""Loads by mark, co-partitioned keys, rewritten parts, change chains, as-of lookups by sorting,
re-keyed facts and consecutive keys."""

import datetime as dt
import random
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators.asof import overlap_report, validity_lookup_sorted
from tessera.operators.changes import apply_changes
from tessera.operators.load import Watermark, load_since_mark, rows_since_mark
from tessera.operators.lookup import validity_lookup
from tessera.operators.ordered import along
from tessera.operators.parts import LAYOUT, key_part, merge_parts
from tessera.operators.quality import QualityError, key_uniqueness_report
from tessera.operators.rekey import changed_spans, rekey, stale_parts, touched_parts
from tessera.operators.scd2 import Scd2Spec, merge
from tessera.operators.sequence import KeySpaceError, consecutive_keys
from tessera.operators.skew import SkewSpec
from tessera.session import scratch_dir
from tessera.sources import (TableStore, held_keys_report, lacking, read_bucketed, read_jdbc,
                             write_bucketed, write_jdbc)

DAY = dt.datetime(2024, 1, 1)
DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def day(n):
    return DAY + dt.timedelta(days=n)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- loads by mark ---------------------------------------------------------------------------------

def source(spark, rows):
    return spark.createDataFrame([(k, day(n) if n is not None else None, v) for k, n, v in rows],
                                 "id long, stamp timestamp, v string")


def test_loads_by_mark(spark, tmp_path):
    store, wm = TableStore(spark, str(tmp_path)), Watermark("stamp", dt.timedelta(days=10))
    load = lambda rows, **kw: load_since_mark(source(spark, rows), store, "t", "id", wm, **kw)
    held = lambda: sorted((r["id"], r["v"]) for r in store.read("t").collect())
    one = [(1, 0, "a"), (2, 40, "a"), (2, 40, "a"), (3, None, "a")]
    assert load(one) == 1 and held() == [(1, "a"), (2, "a"), (3, "a")]
    assert wm.mark(store, "t") == day(40)
    # 4 is late but within the overlap, 5 too late; 2 and 3 come again; 6 is new
    two = one + [(4, 31, "b"), (5, 29, "b"), (6, 70, "b"), (7, None, "b")]
    assert load(two) == 2 and held() == [(1, "a"), (2, "a"), (3, "a"), (4, "b"), (6, "b"), (7, "b")]
    assert load(two) is None and wm.mark(store, "t") == day(70)
    # 1 is sent again with a new stamp: only a check of all keys knows it
    again = [(1, 71, "c"), (8, 72, "c")]
    assert [r["id"] for r in rows_since_mark(source(spark, again), store, "t", "id", wm, True).collect()] == [8]
    assert load([(9, None, "d")]) == 3 and wm.mark(store, "t") == day(70)


def test_both_reads_of_a_load_are_pruned(spark, tmp_path):
    store, wm = TableStore(spark, f"{tmp_path}/wh"), Watermark("stamp", dt.timedelta(days=3))
    source(spark, [(k, k, "x") for k in range(100)]).write.parquet(f"{tmp_path}/src")
    src = spark.read.parquet(f"{tmp_path}/src")
    load_since_mark(src, store, "t", "id", wm)
    assert len(store.parts("t")) == 4
    text = plan(rows_since_mark(src, store, "t", "id", wm))
    assert text.count("GreaterThanOrEqual(stamp,2024-04-06") == 2
    assert "part=202404" not in text or "InMemoryFileIndex(1 paths)" in text
    assert wm.parts_since(store, "t", wm.mark(store, "t")) == {"202404"}


def test_a_jdbc_source_gets_the_bound(spark, tmp_path):
    url = f"jdbc:derby:memory:w{next(tempfile._get_candidate_names())};create=true"
    write_jdbc(source(spark, [(k, k, "x") for k in range(50)]), url, "M", DERBY)
    read = lambda: read_jdbc(spark, url, "M", DERBY, one_task=True)
    store, wm = TableStore(spark, str(tmp_path)), Watermark("stamp", dt.timedelta(days=3))
    load_since_mark(read(), store, "t", "id", wm)
    write_jdbc(source(spark, [(50, 50, "y")]), url, "M", DERBY, mode="append")
    rows = rows_since_mark(read(), store, "t", "id", wm)
    assert "GreaterThanOrEqual(stamp" in plan(rows) or "stamp >=" in plan(rows)
    assert [r["id"] for r in rows.collect()] == [50]


def test_a_load_that_dies_keeps_its_mark(spark, tmp_path):
    store, wm = TableStore(spark, str(tmp_path)), Watermark("stamp", dt.timedelta(days=1))
    load_since_mark(source(spark, [(1, 0, "a")]), store, "t", "id", wm)

    def die(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        load_since_mark(source(spark, [(1, 0, "a"), (2, 9, "b")]), store, "t", "id", wm, transform=die)
    fresh = TableStore(spark, str(tmp_path))
    assert wm.mark(fresh, "t") == day(0) and fresh.read("t").count() == 1


# -- co-partitioned keys -----------------------------------------------------------------------------

def test_bucketed_keys_need_no_shuffle(spark):
    schema, paths = "id bigint, v string", []
    for lo, hi in ((0, 500), (500, 800)):
        path = scratch_dir(spark, "bucketed")
        write_bucketed(spark.range(lo, hi).selectExpr("id", "'x' AS v"), path, "id", 8)
        paths.append(path)
    for t in spark.catalog.listTables():
        if t.name.startswith("bucketed_"):
            spark.sql(f"DROP TABLE {t.name}")  # as in a new session; the files stay
    stored = [read_bucketed(spark, p, schema, "id", 8) for p in paths]
    batch = spark.range(400, 1000).selectExpr("id", "'y' AS v")
    new = lacking(batch, stored, "id")
    assert plan(new).count("Exchange") == 1
    assert sorted(r["id"] for r in new.collect()) == list(range(800, 1000))
    report = held_keys_report(new, stored, "id", 8)
    assert plan(report).count("Exchange hashpartitioning") == 1
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:  # more partitions than buckets: still no stored row moves
        for df in (lacking(batch, stored, "id"), held_keys_report(batch, stored, "id", 8)):
            df.collect()
            assert plan(df).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert tuple(report.first()) == (200, 0, 0, True)
    assert tuple(held_keys_report(batch.unionByName(new), stored, "id", 8).first()) == (800, 400, 200, False)
    # a union of equally bucketed folders must not be taken as bucketed
    twice = key_uniqueness_report(stored[0].unionByName(stored[0]), "id").first()
    assert not twice["passed"] and twice["duplicate_rows"] == 500


# -- parts of a dimension ------------------------------------------------------------------------------

SPEC = Scd2Spec(key="id", tracked=("state",))


def holders(spark, changed=()):
    return spark.range(300).select("id", F.when(F.col("id").isin(list(changed)), "new").otherwise("old").alias("state"))


@pytest.mark.parametrize("consecutive", [False, True])
def test_a_load_rewrites_only_parts_with_changed_ids(spark, tmp_path, consecutive):
    spec = Scd2Spec(key="id", tracked=("state",), consecutive=consecutive)
    store = TableStore(spark, str(tmp_path))
    first = F.lit("2024-01-01").cast("timestamp")
    merge_parts(store, "d", holders(spark), spec, 64, first)
    before = dict.fromkeys(store.live_paths("d"))
    changed = [7, 100, 222]
    parts = {str(r[0]) for r in spark.range(300).where(F.col("id").isin(changed)).select(key_part("id", 64)).collect()}
    then = F.lit("2024-02-01").cast("timestamp")
    old = store.read("d")
    assert merge_parts(store, "d", holders(spark, changed), spec, 64, then) == parts
    fresh = TableStore(spark, str(tmp_path))
    after = fresh.live_paths("d")
    untouched = [p for p in before if p.rsplit("=", 1)[1] not in parts]
    assert len(untouched) == len(before) - len(parts) > 50 and set(untouched) <= set(after)
    assert len(after) == len(before)
    want = merge(holders(spark, changed), old, spec, then)
    cols = ["id", "state", "valid_from", "valid_to", "is_current"]
    rows = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert rows(fresh.read("d")) == rows(want) and fresh.read("d").select("sk").distinct().count() == 303
    assert merge_parts(fresh, "d", holders(spark, changed), spec, 64, then) == set()
    if consecutive:
        assert sorted(r["sk"] for r in fresh.read("d").select("sk").collect()) == list(range(1, 304))


def test_a_table_of_another_layout_is_rewritten(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write(merge(holders(spark), store_empty(spark), SPEC, F.lit("2024-01-01").cast("timestamp")), "d")
    merge_parts(store, "d", holders(spark, [5]), SPEC, 8, F.lit("2024-02-01").cast("timestamp"))
    assert store.parts("d") == {str(8 * LAYOUT + k) for k in range(8)} and store.read("d").count() == 301
    # another number of parts: no id is looked up in a part it does not lie in
    for n, parts in ((10, 32), (20, 4), (30, 4)):
        merge_parts(store, "d", holders(spark, range(5, n)), SPEC, parts, F.lit(f"2024-03-{n}").cast("timestamp"))
        rows = store.read("d").where("is_current").groupBy("id").count()
        assert rows.count() == 300 and rows.where("count > 1").isEmpty()
        assert {int(p) // LAYOUT for p in store.parts("d")} == {parts}


def store_empty(spark):
    from tessera.operators.scd2 import empty_dimension
    return empty_dimension(spark, holders(spark).schema, SPEC)


def test_colliding_keys_are_not_published(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    spec = Scd2Spec(key="id", tracked=("state",), key_modulus=100)
    with pytest.raises(QualityError):
        merge_parts(store, "d", holders(spark), spec, 4, F.lit("2024-01-01").cast("timestamp"))
    assert not TableStore(spark, str(tmp_path)).exists("d")


# -- looking along a key -------------------------------------------------------------------------------

@pytest.mark.parametrize("share", [None, 0.05])
def test_along_equals_the_window(spark, share):
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, None]), rng.randrange(40), n, rng.choice([None, rng.randrange(9)]))
            for n in range(600)]
    df = spark.createDataFrame(rows, "k int, t int, n int, v int").repartition(4)
    got = along(df, "k", ["t", "n"], {"seen": ("last", "v"), "high": ("top", "v"), "prev": ("before", "v"),
                                      "next": ("after", "v")}, SkewSpec(share) if share else None)
    want, by_key = [], {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for some in by_key.values():
        some.sort(key=lambda r: (r[1], r[2]))
        for i, r in enumerate(some):
            so_far = [x[3] for x in some[:i + 1] if x[3] is not None]
            want.append((*r, so_far[-1] if so_far else None, max(so_far, default=None),
                         some[i - 1][3] if i else None, some[i + 1][3] if i + 1 < len(some) else None))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


# -- change chains ----------------------------------------------------------------------------------------

CHAIN = Scd2Spec(key="id", tracked=("state",))
COLUMNS = ["id", "state", "note", "valid_from", "valid_to", "is_current"]
DIM = "sk long, id int, state string, note string, valid_from timestamp, valid_to timestamp, is_current boolean"
FEED = "id int, seq long, op string, at timestamp, state string, note string"


def chain_by_hand(dim, feed):
    """Rows of the next snapshot, one change after another."""
    out = [list(r[1:]) for r in dim]
    since = {}
    for r in out:
        since[r[0]] = max(since.get(r[0], dt.datetime.min), (r[3] if r[5] else r[4] or r[3]))
    fresh = []
    for k, seq, op, at, state, note in sorted(feed, key=lambda c: (c[0], c[1])):
        at = max(at, since.get(k, dt.datetime.min))
        since[k] = at
        live = next((r for r in out if r[0] == k and r[5]), None)
        if op == "D":
            if live:
                live[4:6] = at, False
        elif live is None or live[1] != state:
            if live:
                live[4:6] = at, False
            row = [k, state, note, at, None, True]
            out.append(row)
            fresh.append(row)
    return [r for r in out if not (any(r is f for f in fresh) and r[3] == r[4])]


def no_null(rows):
    return sorted(map(str, rows))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from("IUD"), st.integers(0, 12),
                          st.sampled_from(["a", "b", None])), max_size=25), st.booleans())
def test_versions_tile_time(spark, feed, split):
    dim = [(1, 1, "a", "n", day(0), day(3), False), (2, 1, "b", "n", day(3), None, True),
           (3, 2, None, "n", day(1), None, True), (4, 3, "a", "n", day(0), day(5), False)]
    changes = [(k, n, op, day(at), s, f"c{n}") for n, (k, op, at, s) in enumerate(feed)]
    out = apply_changes(spark.createDataFrame(dim, DIM),
                        spark.createDataFrame(changes + changes[:3], FEED), CHAIN, "seq", "op", "at",
                        skew=SkewSpec(0.1) if split else None).collect()
    assert no_null([tuple(r[c] for c in COLUMNS) for r in out]) == no_null(
        map(tuple, chain_by_hand(dim, changes)))
    assert len({r["sk"] for r in out}) == len(out)
    for k in {r["id"] for r in out}:
        mine = sorted((r for r in out if r["id"] == k), key=lambda r: (r["valid_from"], r["valid_to"] or dt.datetime.max))
        assert sum(r["is_current"] for r in mine) <= 1
        for a, b in zip(mine, mine[1:]):
            assert a["valid_to"] is not None and a["valid_to"] <= b["valid_from"]
        assert all(r["is_current"] == (r["valid_to"] is None) for r in mine)


def test_changes_need_the_dimensions_columns(spark):
    with pytest.raises(ValueError, match="note"):
        apply_changes(spark.createDataFrame([], DIM), spark.createDataFrame([], FEED).drop("note"), CHAIN,
                      "seq", "op", "at")


# -- as-of by sorting --------------------------------------------------------------------------------------

@pytest.mark.parametrize("upper", ["closed", "half_open"])
@pytest.mark.parametrize("skew", [None, SkewSpec(0.1)])
def test_sorted_lookup_equals_the_join(spark, upper, skew):
    rng, versions, sk = random.Random(8), [], 0
    for k in (1, 2, 3, 4):
        cuts = sorted(rng.choices(range(60), k=9))  # some versions of no length
        for a, b in zip(cuts, cuts[1:] + [None]):
            sk += 1
            if rng.random() < 0.85:  # gaps
                versions.append((sk, k, day(a), None if b is None else day(b)))
    versions += [(900, None, day(0), None), (901, 5, None, day(3))]
    dim = spark.createDataFrame(versions, "sk long, id int, f timestamp, t timestamp")
    moves = [(n, rng.choice([1, 1, 1, 2, 3, 9, None]), rng.choice([day(rng.randrange(-5, 70)), None]), "x") for n in range(400)]
    fact = spark.createDataFrame(moves, "n int, holder int, at timestamp, sk string")
    args = ("holder", "id", "at", "sk", "holder_sk", "f", "t", upper)
    rows = lambda df: sorted(map(str, df.select("n", "holder", "at", "sk", "holder_sk").collect()))
    assert rows(validity_lookup_sorted(fact, dim, *args, skew=skew)) == rows(validity_lookup(fact, dim, *args))
    assert overlap_report(dim, "id", "f", "t", skew).first()["passed"]
    worse = dim.unionByName(spark.createDataFrame([(950, 1, day(-9), day(400))], dim.schema))
    assert overlap_report(worse, "id", "f", "t", skew).first()["overlaps"] >= 1


def test_sorted_lookup_of_a_hot_key_with_many_versions(spark):
    """10,000 versions and 60,000 movements of one id; the join would compare 6 * 10^8 pairs."""
    f = F.timestamp_seconds(F.col("id") * 100)
    dim = spark.range(10_000).select("id", F.lit(1).alias("k"), f.alias("f"),
                                     F.timestamp_seconds(F.col("id") * 100 + 100).alias("t"))
    fact = spark.range(60_000).select(F.col("id").alias("n"), F.lit(1).alias("k"),
                                      F.timestamp_seconds(F.col("id") * 17).alias("at"))
    out = validity_lookup_sorted(fact, dim, "k", "k", "at", "id", "v", "f", "t", "half_open", SkewSpec(0.05))
    wrong = out.where(~F.col("v").eqNullSafe(F.when(F.col("n") * 17 < 1_000_000, F.floor(F.col("n") * 17 / 100))))
    assert out.count() == 60_000 and wrong.count() == 0


def test_sorted_lookup_takes_dates(spark):
    dim = spark.sql("SELECT 1 AS id, 5L AS sk, DATE'2024-01-02' AS f, DATE'2024-01-04' AS t")
    fact = spark.sql("SELECT 1 AS h, explode(array(TIMESTAMP'2024-01-04', TIMESTAMP'2024-01-04 00:00:01')) AS at")
    got = validity_lookup_sorted(fact, dim, "h", "id", "at", "sk", "v", "f", "t").collect()
    assert sorted((r["at"].second, r["v"]) for r in got) == [(0, 5), (1, None)]


# -- late versions --------------------------------------------------------------------------------------------

def test_late_versions_change_only_their_folders(spark, tmp_path):
    dim = spark.createDataFrame([(1, 1, day(40), None), (2, 2, day(0), None), (3, 3, day(200), None)],
                                "sk long, id int, f timestamp, t timestamp")
    moves = spark.createDataFrame([(n, n % 4, day(n)) for n in range(240)], "n int, holder int, at timestamp")
    look = lambda d: lambda rows: validity_lookup(rows.drop("holder_sk"), d, "holder", "id", "at", "sk",
                                                  "holder_sk", "f", "t", "half_open")
    store, part = TableStore(spark, str(tmp_path)), F.date_format("at", "yyyyMM").cast("int")
    store.write(look(dim)(moves), "fact", parts=part)
    before = store.live_paths("fact")
    # holder 1 gets an earlier version, holder 0 appears for some days in May
    later = dim.unionByName(spark.createDataFrame(
        [(11, 1, day(10), day(40)), (12, 0, day(130), day(140))], dim.schema))
    spans = changed_spans(dim, later, "id", "sk", "f", "t")
    touched = {"202401", "202402", "202405"}
    args = (store.read("fact"), "holder", "holder_sk", "at", part, "id", "sk", "f", "t", "half_open")
    for skew in (None, SkewSpec(0.1)):
        assert touched_parts(store.read("fact"), spans, "holder", "at", part, skew) == touched
        assert stale_parts(args[0], later, *args[1:], skew=skew) == touched
    rekey(store, "fact", touched, part, look(later))
    fresh = TableStore(spark, str(tmp_path))
    rows = lambda df: sorted(map(str, df.select("n", "holder", "at", "holder_sk").collect()))
    assert rows(fresh.read("fact")) == rows(look(later)(moves))
    kept = [p for p in before if p.rsplit("=", 1)[1] not in ("202401", "202402", "202405")]
    assert len(kept) == 5 and set(kept) <= set(fresh.live_paths("fact"))
    same = changed_spans(later, later, "id", "sk", "f", "t")
    assert touched_parts(fresh.read("fact"), same, "holder", "at", part) == set()
    assert stale_parts(fresh.read("fact"), later, *args[1:]) == set()
    # back again: holder 0 has no version any more, holder 1 none before its first
    assert stale_parts(fresh.read("fact"), dim, *args[1:]) == touched

    def refuse(staged):
        raise QualityError([{"check": "no"}])

    with pytest.raises(QualityError):
        rekey(fresh, "fact", touched, part, look(dim), check=refuse)
    assert rows(TableStore(spark, str(tmp_path)).read("fact")) == rows(look(later)(moves))


# -- keys -------------------------------------------------------------------------------------------------------

def test_a_million_keys_below_a_small_limit(spark):
    ids = spark.range(0, 1_000_000, 1, 8).select(F.concat(F.lit("id"), F.reverse(F.col("id").cast("string"))).alias("id"))
    keyed = consecutive_keys(ids, ["id"], "sk", after=5, limit=10 ** 7)
    r = keyed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()
    assert tuple(r) == (6, 1_000_005, 1_000_000)
    again = consecutive_keys(ids.repartition(3), ["id"], "sk", after=5, limit=10 ** 7)
    assert keyed.join(again, ["id", "sk"], "left_anti").count() == 0
    with pytest.raises(KeySpaceError):
        consecutive_keys(ids, ["id"], "sk", after=9_000_001, limit=10 ** 7)
    assert consecutive_keys(ids.limit(0), ["id"], "sk").collect() == []
