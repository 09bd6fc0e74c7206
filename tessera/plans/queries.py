"""The query set over the test tables: one entry per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame; ``oracle.py``
holds the equivalent SQL. All run over whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import age_years, normalize, split_name, surrogate_key
from tessera.operators import (CalendarLookup, ChainStep, KeyLookup, SkewSpec, StarJoin,
                               ValidityLookup, build_fact, calendar_for, calendar_lookup,
                               clean, dim_lookup, duplicate_keys, expired_keys,
                               first_load, flatten, incremental, key_uniqueness_report,
                               lookup_chain, merge, new_versions, null_key_report,
                               hot_keys, orphan_report, row_count_report, trusted_holder, type1_upsert,
                               validity_lookup)
from tessera.plans import load_queries
from tessera.plans import scenarios as sc
from tessera.plans.pipeline import PipelineConfig, flat_frame, run
from tessera.plans.scenarios import load, ts
from tessera.session import scratch_dir
from tessera.sources import TableStore, copy_tables, export_csv, read_csv, register_views
from tessera.streaming.ingest import start_dimension_stream

Query = Callable[[SparkSession, str], DataFrame]


# --- sources / projections -------------------------------------------------

def raw_copy(spark, d):
    store = TableStore(spark, scratch_dir(spark, "raw"), prefix="raw_")
    copy_tables(lambda t: load(spark, d, t), store, ["orders"])
    return store.read("orders")


def project_rename(spark, d):
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("movement_id"), F.col("o_custkey").alias("card_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("moved_at"))


# --- scalar cleaning ---------------------------------------------------------

def dirty_segment() -> F.Column:
    """Segment text made dirty by attribute rules: NULL, padded lower case, '',
    a leading tab, accented lower case."""
    seg = F.col("c_mktsegment")
    return (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
            .when(F.col("c_nationkey") < 5, F.concat(F.lit("  "), F.lower(seg), F.lit(" ")))
            .when(F.col("c_nationkey") < 8, F.lit(""))
            .when(F.col("c_nationkey") < 10, F.concat(F.lit("\t"), seg))
            .when(F.col("c_nationkey") < 12, F.concat(F.lower(seg), F.lit(" ação")))
            .otherwise(seg))


def normalize_text(spark, d):
    c = load(spark, d, "customer").select("c_custkey", dirty_segment().alias("raw_text"))
    return c.select("c_custkey", "raw_text", normalize("raw_text").alias("clean_text"))


def dirty_part_name() -> F.Column:
    """Part names in several shapes: three tokens, inner runs of spaces, one token, NULL."""
    return (F.when(F.col("p_size") < 10, F.concat_ws(" ", "p_name", "p_type"))
            .when(F.col("p_size") < 20, F.regexp_replace("p_name", " ", "   "))
            .when(F.col("p_size") < 25, F.col("p_brand"))
            .when(F.col("p_size") >= 48, F.lit(None).cast("string"))
            .otherwise(F.col("p_name")))


def name_split(spark, d):
    p = load(spark, d, "part").select("p_partkey", dirty_part_name().alias("raw_name"))
    first, rest = split_name("raw_name")
    return p.select("p_partkey", "raw_name", first.alias("first_token"),
                    rest.alias("rest_tokens"))


def age_years_q(spark, d):
    return load(spark, d, "orders").select(
        "o_orderkey", "o_orderdate",
        age_years("o_orderdate", F.lit(sc.AS_OF_DATE).cast("date")).alias("age_years"))


# --- trusted layer -------------------------------------------------------------

def trusted_holder_q(spark, d):
    first = (load(spark, d, "orders").groupBy("o_custkey")
             .agg(F.min("o_orderdate").alias("first_order")))
    c = load(spark, d, "customer")
    raw = c.join(first, c.c_custkey == first.o_custkey, "left")
    return trusted_holder(raw, id="c_custkey", name="c_name", birth="first_order",
                          normalized=("c_mktsegment",),
                          as_of=F.lit(sc.AS_OF_DATE).cast("date"))


def trusted_account_q(spark, d):
    return clean(load(spark, d, "supplier"), keep=("s_suppkey", "s_nationkey", "s_acctbal"),
                 normalized=("s_name",))


def trusted_card_q(spark, d):
    return clean(load(spark, d, "customer"), keep=("c_custkey", "c_nationkey", "c_acctbal"),
                 normalized=("c_name", "c_mktsegment"))


def trusted_movement_q(spark, d):
    return clean(load(spark, d, "orders"),
                 keep=("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
                 normalized=("o_orderpriority",))


# --- lookups ----------------------------------------------------------------------

def lookup_chain_q(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = lookup_chain(o, [
        ChainStep(sc.known_customers(spark, d), "o_custkey", "c_custkey", ("c_nationkey",)),
        ChainStep(load(spark, d, "nation"), "c_nationkey", "n_nationkey", ("n_regionkey",)),
        ChainStep(load(spark, d, "region"), "n_regionkey", "r_regionkey", ("r_name",)),
    ])
    return out.select("o_orderkey", "c_custkey", "n_nationkey", "r_regionkey", "r_name",
                      "o_totalprice")


def dim_lookup_left(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return dim_lookup(o, sc.card_dim(spark, d), "o_custkey", "c_custkey", "sk", "card_sk")


def calendar_dim(spark, d):
    return calendar_for(load(spark, d, "orders"), "o_orderdate")


def calendar_lookup_q(spark, d):
    cal = calendar_for(load(spark, d, "lineitem"), "l_shipdate")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return calendar_lookup(o, cal, "o_orderdate")


def _validity(upper, skew=None):
    def q(spark, d):
        o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return validity_lookup(o, sc.holder_dim_validity(spark, d), "o_custkey", "c_custkey",
                               "o_orderdate", "sk", "holder_sk", upper=upper, skew=skew)
    return q


# Hot-key splitting at shares that the busiest customers (and every region, with a
# fifth of all orders each) exceed: results are identical to the unsplit queries, which
# is what their shared oracle checks.
SPLIT_BUSY_CUSTOMERS = SkewSpec(share=sc.BUSY_CUSTOMER, salt_on=("o_orderkey",))
SPLIT_BUSY_HOLDERS = SkewSpec(share=0.05, salt_on=("movement_id",))


def hot_key_report(spark, d):
    return hot_keys(load(spark, d, "orders"), "o_custkey", SPLIT_BUSY_CUSTOMERS).select(
        F.col("__hk").alias("o_custkey"), F.col("__buckets").alias("buckets"))


def dim_lookup_salted(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey")
    return dim_lookup(o, sc.card_dim(spark, d), "o_custkey", "c_custkey", "sk", "card_sk",
                      skew=SPLIT_BUSY_CUSTOMERS)


# --- SCD2 ------------------------------------------------------------------------

def _spec(match):
    return replace(sc.HOLDER_SPEC, match=match)


def _new_versions(match):
    def q(spark, d):
        return new_versions(sc.holder_source(spark, d), sc.holder_dim_prior(spark, d),
                            _spec(match), ts(sc.LOAD_NOW)).drop("sk")
    return q


def _expire(match):
    def q(spark, d):
        return expired_keys(sc.holder_source(spark, d), sc.holder_dim_prior(spark, d),
                            _spec(match))
    return q


def expired_rows_semi(spark, d):
    dim = sc.holder_dim_prior(spark, d)
    exp = expired_keys(sc.holder_source(spark, d), dim, _spec("any"))
    return dim.join(exp, "sk", "left_semi")


def kept_keys(dim, load_time):
    """``sk`` as ``kept_sk`` for versions older than the load, NULL for those it made."""
    return dim.withColumn("kept_sk", F.when(F.col("valid_from") < ts(load_time),
                                            F.col("sk"))).drop("sk")


def _merge(match):
    def q(spark, d):
        return kept_keys(merge(sc.holder_source(spark, d), sc.holder_dim_prior(spark, d),
                               _spec(match), ts(sc.LOAD_NOW)), sc.LOAD_NOW)
    return q


def scd2_first_load(spark, d):
    return first_load(spark, sc.holder_source(spark, d), sc.HOLDER_SPEC,
                      ts(sc.LOAD_NOW)).drop("sk")


def _tier_new(null_safe):
    def q(spark, d):
        spec = replace(sc.TIER_SPEC, null_safe=null_safe)
        return new_versions(sc.tier_source(spark, d), sc.tier_dim(spark, d), spec,
                            ts(sc.LOAD_NOW)).drop("sk")
    return q


def surrogate_key_q(spark, d):
    return load(spark, d, "customer").select(
        "c_custkey", surrogate_key("c_custkey", ts(sc.LOAD_NOW)).alias("sk"))


def surrogate_key_properties(spark, d):
    """What holds for any surrogate key, in both forms."""
    k = load(spark, d, "customer").select(
        surrogate_key("c_custkey", ts(sc.LOAD_NOW)).alias("sk"),
        surrogate_key("c_custkey", ts(sc.LOAD_NOW), modulus=10**10).alias("short"))
    return k.agg(F.count(F.lit(1)).alias("keys"), F.countDistinct("sk").alias("distinct_keys"),
                 (F.min("sk") >= 0).alias("not_negative"),
                 ((F.min("short") >= 0) & (F.max("short") < 10**10)).alias("below_modulus"))


def dim_type1_upsert(spark, d):
    out = type1_upsert(sc.active_source(spark, d), sc.card_dim(spark, d), "c_custkey",
                       now=ts(sc.LOAD_NOW), new_flag="is_new")
    return out.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "is_new",
                      F.when(~F.col("is_new"), F.col("sk")).alias("kept_sk"))


# --- fact, gates, star --------------------------------------------------------------

def fact(spark, d, skew=None):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    chain = [
        ChainStep(load(spark, d, "customer"), "o_custkey", "c_custkey", ("c_nationkey",)),
        ChainStep(load(spark, d, "nation"), "c_nationkey", "n_nationkey", ("n_regionkey",)),
        ChainStep(load(spark, d, "region"), "n_regionkey", "r_regionkey"),
    ]
    lookups = [
        KeyLookup(sc.card_dim(spark, d), "c_custkey", "c_custkey", "sk", "card_sk"),
        KeyLookup(sc.account_dim(spark, d), "c_nationkey", "n_nationkey", "sk", "account_sk"),
        ValidityLookup(sc.region_holder_dim(spark, d), "n_regionkey", "r_regionkey",
                       "o_orderdate", "sk", "holder_sk"),
        CalendarLookup(calendar_for(o, "o_orderdate"), "o_orderdate", "date_sk"),
    ]
    cols = [F.col("o_orderkey").alias("movement_id"), "holder_sk", "card_sk", "account_sk",
            "date_sk", F.col("o_totalprice").alias("amount"),
            F.col("o_orderdate").alias("moved_at")]
    return build_fact(o, chain, lookups, cols, loaded_at=ts(sc.LOAD_NOW), skew=skew)


def fact_salted(spark, d):
    return fact(spark, d, skew=SPLIT_BUSY_CUSTOMERS)


def fact_incremental(spark, d):
    f = fact(spark, d)
    existing = f.where(F.col("moved_at") < ts(sc.INCREMENTAL_CUT))
    return incremental(existing, f, "movement_id")


def dq_row_count(spark, d):
    return row_count_report(load(spark, d, "orders"), fact(spark, d))


def dq_pk_unique(spark, d):
    return key_uniqueness_report(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_duplicate_keys(spark, d):
    return duplicate_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_fact_pk_unique(spark, d):
    return key_uniqueness_report(fact(spark, d), "movement_id")


def dq_null_keys(spark, d):
    return null_key_report(fact(spark, d), ["holder_sk", "card_sk", "account_sk", "date_sk"])


def dq_dim_key_unique(spark, d):
    """The gate on a merged dimension's surrogate keys."""
    return key_uniqueness_report(merge(sc.holder_source(spark, d), sc.holder_dim_prior(spark, d),
                                       _spec("any"), ts(sc.LOAD_NOW)), "sk")


def dq_orphans(spark, d):
    return orphan_report(load(spark, d, "orders"), [
        (sc.known_customers(spark, d), "o_custkey", "c_custkey"),
        (load(spark, d, "nation").where(F.col("n_name") != sc.LOST_NATION), "c_nationkey",
         "n_nationkey"),
        (load(spark, d, "region"), "n_regionkey", "r_regionkey")])


def _star(how, skew=None):
    def q(spark, d):
        joins = [
            StarJoin(sc.region_holder_dim(spark, d), "holder_sk", "sk", {"r_name": "holder_name"}),
            StarJoin(sc.card_dim(spark, d), "card_sk", "sk",
                     {"c_name": "card_name", "c_mktsegment": "card_segment"}),
            StarJoin(sc.account_dim(spark, d), "account_sk", "sk", {"n_name": "account_name"}),
        ]
        f = fact(spark, d)
        if skew is not None:  # counting keys reads the fact once more: from the stored table
            store = TableStore(spark, scratch_dir(spark, "fact"), prefix="fact_")
            store.write(f, "movement")
            f = store.read("movement")
        return flatten(f, joins,
                       {"movement_id": "movement_id", "amount": "amount", "moved_at": "moved_at"},
                       how=how, skew=skew)
    return q


star_flatten = _star("inner")


def sample_rows(spark, d):
    return star_flatten(spark, d).orderBy("movement_id", "holder_name").limit(5)


def star_flatten_sql(spark, d):
    """The star flatten as Spark SQL text over temp views registered from a
    {table: view} map, with a CTE and mixed-case column references (resolution
    is case-insensitive by default)."""
    frames = {"fact": fact(spark, d), "holder": sc.region_holder_dim(spark, d),
              "card": sc.card_dim(spark, d), "account": sc.account_dim(spark, d)}
    register_views(frames.__getitem__, {"fact": "tessera_fact", "holder": "tessera_dim_holder",
                                        "card": "tessera_dim_card",
                                        "account": "tessera_dim_account"})
    return spark.sql("""
        WITH f AS (SELECT movement_id, Holder_SK, card_sk, ACCOUNT_SK, amount, moved_at
                   FROM tessera_fact)
        SELECT f.movement_id, f.amount, f.moved_at, h.r_name AS holder_name,
               c.c_name AS card_name, c.c_mktsegment AS card_segment,
               a.n_name AS account_name
        FROM f
        INNER JOIN tessera_dim_holder AS h ON f.holder_sk = h.SK
        INNER JOIN tessera_dim_card AS c ON f.Card_Sk = c.sk
        INNER JOIN tessera_dim_account AS a ON f.account_sk = a.Sk""")


FLAT_SCHEMA = T.StructType([
    T.StructField("movement_id", T.LongType()), T.StructField("amount", T.DoubleType()),
    T.StructField("moved_at", T.TimestampNTZType()), T.StructField("holder_name", T.StringType()),
    T.StructField("card_name", T.StringType()), T.StructField("card_segment", T.StringType()),
    T.StructField("account_name", T.StringType()),
])


def csv_roundtrip(spark, d):
    path = scratch_dir(spark, "flat")
    export_csv(star_flatten(spark, d), path)
    return read_csv(spark, path, FLAT_SCHEMA)


AWKWARD = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType()),
                        T.StructField("at", T.TimestampNTZType())])


def csv_roundtrip_exact(spark, d):
    """Every order with a text that holds separators, quotes, line breaks and blanks, or is
    empty or NULL, and a time with microseconds; written and read back exactly."""
    p = F.col("o_orderpriority")
    note = (F.when(p.startswith("1"), F.concat(F.lit("a;b \"quoted\" "), p))
            .when(p.startswith("2"), F.concat(F.lit("  two\nlines\r\n"), p, F.lit("  ")))
            .when(p.startswith("3"), F.lit(""))
            .when(p.startswith("4"), F.concat(F.lit('"'), p, F.lit('\\"'))))
    at = F.col("o_orderdate") + F.expr("INTERVAL '0.123456' SECOND")
    path = scratch_dir(spark, "awkward")
    export_csv(load(spark, d, "orders").select("o_orderkey", note.alias("note"), at.alias("at")),
               path, exact=True)
    return read_csv(spark, path, AWKWARD, exact=True)


def card_source(spark, d, later=False):
    """The test tables in the card pipeline's raw input contract.

    ``later`` gives the state of a later load: some holders' marital status has changed.
    """
    day = lambda start, n: F.date_add(F.lit(start).cast("date"), n.cast("int"))
    region, nation = F.col("r_regionkey"), F.col("n_nationkey")
    status = F.when(region < 2, F.lit(" single")).when(region < 4, F.lit("married "))
    if later:
        status = F.when(region >= 3, F.lit("widowed")).otherwise(status)
    frames = {
        "holder": load(spark, d, "region").select(
            region.alias("holder_id"), F.col("r_name").alias("full_name"),
            day("1950-03-09", region * 2500).alias("birth_date"),
            status.alias("marital_status"),
            F.when(region != 2, F.lit("higher ")).alias("education")),
        "account": load(spark, d, "nation").select(
            nation.alias("account_id"), F.col("n_regionkey").alias("holder_id"),
            F.col("n_name").alias("account_type"),
            F.lpad(nation.cast("string"), 4, "0").alias("branch"),
            F.when(nation < 20, F.lit("open")).otherwise(F.lit("closed")).alias("status"),
            day("1985-03-01", nation * 40).alias("opened_on")),
        "card": load(spark, d, "customer").select(
            F.col("c_custkey").alias("card_id"), F.col("c_nationkey").alias("account_id"),
            F.col("c_custkey").cast("string").alias("card_number"),
            F.col("c_name").alias("printed_name"), F.col("c_mktsegment").alias("brand"),
            F.lower("c_mktsegment").alias("card_type"),
            day("1991-01-15", F.col("c_nationkey") * 30).alias("issued_on")),
        "movement": load(spark, d, "orders").select(
            F.col("o_orderkey").alias("movement_id"), F.col("o_custkey").alias("card_id"),
            F.col("o_orderpriority").alias("description"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
            F.col("o_orderdate").alias("moved_at")),
    }
    return frames.__getitem__


def _dated(spark, cfg, rows):
    """``rows`` with the published fact's date key."""
    keys = TableStore(spark, cfg.warehouse_root, prefix="fact_").read("movement")
    return rows.join(keys.select("movement_id", "date_sk"), "movement_id")


def card_pipeline(spark, d):
    """The whole card preset (raw, trusted, dimensions, fact with its gates, CSV
    export) over the test tables; returns the flat rows from the published tables
    with their date key. Holder versions open at PIPELINE_NOW, before every order."""
    root = scratch_dir(spark, "card-wh")
    cfg = PipelineConfig(read_source=card_source(spark, d), warehouse_root=root,
                         export_path=f"{root}/flat", as_of=dt.date.fromisoformat(sc.AS_OF_DATE),
                         now=dt.datetime.fromisoformat(sc.PIPELINE_NOW))
    run(spark, cfg)
    return _dated(spark, cfg, flat_frame(spark, cfg))


def card_pipeline_incremental(spark, d):
    """Three incremental loads of the card preset: the orders before SECOND_LOAD, then all
    orders with some holders changed, then nothing new. Returns the published fact with the
    holder version each row points to."""
    first, later = card_source(spark, d), card_source(spark, d, later=True)
    early = {"movement": first("movement").where(F.col("moved_at") < ts(sc.SECOND_LOAD))}
    cfg = PipelineConfig(
        read_source=lambda t: early.get(t, first(t)), warehouse_root=scratch_dir(spark, "inc-wh"),
        as_of=dt.date.fromisoformat(sc.AS_OF_DATE), fact_mode="incremental",
        validity_upper="half_open", calendar_start=dt.date(1999, 1, 1),
        calendar_end=dt.date(1999, 12, 31), now=dt.datetime.fromisoformat(sc.PIPELINE_NOW))
    stages = ("raw", "trusted", "dimensions", "fact")
    run(spark, cfg, stages)
    for now in (sc.SECOND_LOAD, sc.THIRD_LOAD):
        run(spark, replace(cfg, read_source=later, now=dt.datetime.fromisoformat(now)), stages)
    fact_rows = TableStore(spark, cfg.warehouse_root, prefix="fact_").read("movement")
    holder = TableStore(spark, cfg.warehouse_root, prefix="dim_").read("holder").select(
        F.col("sk").alias("holder_sk"), "holder_id", "marital_status", "age", "is_current",
        F.col("valid_from").cast("timestamp_ntz").alias("valid_from"))
    return fact_rows.drop("holder_id").join(holder, "holder_sk").select(
        "movement_id", "date_sk", "amount", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
        "holder_id", "marital_status", "age", "is_current", "valid_from")


def _stream(spark, landing, schema, store, now, **options):
    q = start_dimension_stream(spark, landing, schema, store, "holder", sc.HOLDER_SPEC,
                               checkpoint=scratch_dir(spark, "stream-ckpt"),
                               now=lambda: ts(now), **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream failed: {q.exception()}")


def stream_first_load(spark, d):
    """Structured Streaming path: the holder source lands as parquet files, a
    file-source stream (availableNow) merges each micro-batch into the dimension
    through foreachBatch. One pass over new files equals a batch first load."""
    landing = scratch_dir(spark, "landing")
    src = sc.holder_source(spark, d)
    src.write.parquet(landing)
    store = TableStore(spark, scratch_dir(spark, "stream-wh"))
    _stream(spark, landing, src.schema, store, sc.LOAD_NOW)
    store.refresh()
    return store.read("holder").drop("sk")


def stream_two_batches(spark, d):
    """Two streams into one dimension, the second with a checkpoint of its own: the known
    customers first, then the whole source, where every customer comes with a stale row and
    the latest one. Equals a two-step merge."""
    store = TableStore(spark, scratch_dir(spark, "stream-wh"))
    known = sc.known_customers(spark, d).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    src = sc.holder_source(spark, d)
    stale = src.withColumn("c_mktsegment", F.lit("STALE")).withColumn("seq", F.lit(1))
    for rows, now, options in ((known, sc.FIRST_VERSION_FROM, {}),
                               (stale.unionByName(src.withColumn("seq", F.lit(2))), sc.LOAD_NOW,
                                {"latest_by": "seq"})):
        landing = scratch_dir(spark, "landing")
        rows.write.parquet(landing)
        _stream(spark, landing, rows.schema, store, now, **options)
    store.refresh()
    return store.read("holder").drop("sk")


QUERIES: dict[str, Query] = {
    "raw_copy": raw_copy,
    "project_rename": project_rename,
    "normalize_text": normalize_text,
    "name_split": name_split,
    "age_years": age_years_q,
    "trusted_holder": trusted_holder_q,
    "trusted_account": trusted_account_q,
    "trusted_card": trusted_card_q,
    "trusted_movement": trusted_movement_q,
    "lookup_chain": lookup_chain_q,
    "dim_lookup_left": dim_lookup_left,
    "calendar_dim": calendar_dim,
    "calendar_lookup": calendar_lookup_q,
    "validity_lookup_closed": _validity("closed"),
    "validity_lookup_half_open": _validity("half_open"),
    "hot_key_report": hot_key_report,
    "validity_lookup_salted": _validity("closed", SPLIT_BUSY_CUSTOMERS),
    "dim_lookup_salted": dim_lookup_salted,
    "scd2_new_any": _new_versions("any"),
    "scd2_new_active": _new_versions("current"),
    "scd2_expire": _expire("any"),
    "scd2_expire_current": _expire("current"),
    "expired_rows_semi": expired_rows_semi,
    "scd2_merge": _merge("any"),
    "scd2_merge_current": _merge("current"),
    "scd2_first_load": scd2_first_load,
    "scd2_null_parity": _tier_new(False),
    "scd2_null_safe": _tier_new(True),
    "surrogate_key": surrogate_key_q,
    "surrogate_key_properties": surrogate_key_properties,
    "dim_type1_upsert": dim_type1_upsert,
    "fact_build": fact,
    "fact_build_salted": fact_salted,
    "fact_incremental": fact_incremental,
    "dq_row_count": dq_row_count,
    "dq_pk_unique": dq_pk_unique,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_fact_pk_unique": dq_fact_pk_unique,
    "dq_null_keys": dq_null_keys,
    "dq_dim_key_unique": dq_dim_key_unique,
    "dq_orphans": dq_orphans,
    "star_flatten": star_flatten,
    "star_flatten_left": _star("left"),
    "star_flatten_salted": _star("inner", SPLIT_BUSY_HOLDERS),
    "star_flatten_sql": star_flatten_sql,
    "sample_rows": sample_rows,
    "csv_roundtrip": csv_roundtrip,
    "csv_roundtrip_exact": csv_roundtrip_exact,
    "card_pipeline": card_pipeline,
    "card_pipeline_incremental": card_pipeline_incremental,
    "stream_first_load": stream_first_load,
    "stream_two_batches": stream_two_batches,
    **load_queries.QUERIES,
}
