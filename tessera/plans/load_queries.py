"""Queries of loads that read, write and repair only what changed, over the test tables.

Like ``queries``: each callable takes ``(spark, sf_dir)``, and ``ORACLE`` holds the same in SQL.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import SkewSpec, merge, validity_lookup
from tessera.operators.asof import overlap_report, validity_lookup_sorted
from tessera.operators.changes import apply_changes
from tessera.operators.load import Watermark, load_since_mark
from tessera.operators.parts import key_part, merge_parts
from tessera.operators.rekey import changed_spans, rekey, touched_parts
from tessera.operators.scd2 import Scd2Spec
from tessera.operators.sequence import consecutive_keys
from tessera.plans import scenarios as sc
from tessera.plans.scenarios import load, ts
from tessera.session import scratch_dir
from tessera.sources import (TableStore, held_keys_report, lacking, read_bucketed,
                             read_csv_checked, rejects_report, run_sql, write_bucketed)

# Fixed values of the scenarios (shared with the SQL below).
LOADS = ("1997-01-01 00:00:00", "1999-06-15 00:00:00", "2002-01-01 00:00:00")
DELAY_DAYS = 9          # an order becomes visible up to this many days after its stamp ...
OVERLAP_DAYS = 15       # ... which the loads' overlap covers
BUCKETS = 8
PARTS = 16
FAR_PAST = "1994-01-01 00:00:00"
BUSY = SkewSpec(share=sc.BUSY_CUSTOMER)


# -- loads by mark ---------------------------------------------------------------------------------

def _delay():
    """Days between an order's stamp and its being visible, by its priority."""
    return (F.substring("o_orderpriority", 1, 1).cast("int") - 1) * F.lit(DELAY_DAYS) / 4


def visible_orders(spark, d, until):
    """The orders a load at ``until`` can see, stamped by ``o_orderdate``; urgent ones come twice."""
    o = load(spark, d, "orders")
    seen = o.where(F.date_add("o_orderdate", F.floor(_delay()).cast("int")) < F.lit(until).cast("date"))
    return seen.unionByName(seen.where(F.col("o_orderpriority").startswith("1")))


def fact_watermark(spark, d):
    """Three loads of the orders by their stamp, late and repeated rows among them: every order
    once, with the load that brought it."""
    store = TableStore(spark, scratch_dir(spark, "marked"), prefix="fact_")
    wm = Watermark("o_orderdate", dt.timedelta(days=OVERLAP_DAYS))
    for n, until in enumerate(LOADS):
        load_since_mark(visible_orders(spark, d, until), store, "orders", "o_orderkey", wm,
                        transform=lambda rows, n=n: rows.withColumn("load", F.lit(n + 1)))
    return store.read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "load")


# -- co-partitioned keys ------------------------------------------------------------------------------

ORDER_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
             "o_orderdate timestamp_ntz, o_orderpriority string")


def _bucketed_orders(spark, d):
    """Two loads of orders before INCREMENTAL_CUT, each a folder in buckets of the order key."""
    o, out = load(spark, d, "orders"), []
    for low, high in ((FAR_PAST, sc.SPLIT_AT), (sc.SPLIT_AT, sc.INCREMENTAL_CUT)):
        path = scratch_dir(spark, "bucketed")
        write_bucketed(o.where((F.col("o_orderdate") >= ts(low)) & (F.col("o_orderdate") < ts(high))),
                       path, "o_orderkey", BUCKETS)
        out.append(read_bucketed(spark, path, ORDER_DDL, "o_orderkey", BUCKETS))
    return out


def fact_incremental_bucketed(spark, d):
    """The orders that two stored, bucketed loads lack; no stored row is shuffled."""
    return lacking(load(spark, d, "orders"), _bucketed_orders(spark, d), "o_orderkey")


def dq_held_keys(spark, d):
    """The uniqueness gate of a load against what is stored: all orders, so the stored ones are held."""
    return held_keys_report(load(spark, d, "orders"), _bucketed_orders(spark, d), "o_orderkey", BUCKETS)


# -- parts of a dimension -------------------------------------------------------------------------------

def _dimension(spark, d, spec=sc.HOLDER_SPEC):
    store = TableStore(spark, scratch_dir(spark, "dim"), prefix="dim_")
    store.write(sc.holder_dim_prior(spark, d), "holder", parts=key_part(spec.key, PARTS))
    return store


def scd2_merge_parts(spark, d):
    """The holder merge into a dimension stored in parts; only parts with a changed id are written."""
    store = _dimension(spark, d)
    merge_parts(store, "holder", sc.holder_source(spark, d), sc.HOLDER_SPEC, PARTS, ts(sc.LOAD_NOW))
    return store.read("holder").withColumn("kept_sk", F.when(
        F.col("valid_from") < ts(sc.LOAD_NOW), F.col("sk"))).drop("sk")


def scd2_consecutive_keys(spark, d):
    """The holder merge with numbers after the largest key in use: the new versions by id."""
    spec = replace(sc.HOLDER_SPEC, consecutive=True)
    return merge(sc.holder_source(spark, d), sc.holder_dim_prior(spark, d), spec, ts(sc.LOAD_NOW))


def keys_in_sequence(spark, d):
    """Every line item numbered by its natural key."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return consecutive_keys(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "sk")


# -- change chains ---------------------------------------------------------------------------------------

CHAIN = Scd2Spec(key="user_id", tracked=("state",), validity_type=T.TimestampNTZType())


def _feed(spark, d):
    """Events as changes: an error deletes its user, any other kind of event is the user's state."""
    e = load(spark, d, "events")
    op = (F.when(F.col("event_type") == "error", "D").when(F.col("event_type") == "signup", "I")
          .otherwise("U"))
    return e.select("user_id", F.col("event_id").alias("seq"), op.alias("op"),
                    F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at"),
                    F.col("event_type").alias("state"), F.col("value").alias("note"))


def scd2_changes(spark, d):
    """All versions that the events make of a dimension that knows the customers' ids: several
    changes of one id at a time, deletes, events at one hour."""
    c = load(spark, d, "customer")
    dim = c.select((F.col("c_custkey") * 2).alias("sk"), F.col("c_custkey").alias("user_id"),
                   F.lit("view").alias("state"), F.col("c_acctbal").alias("note"),
                   ts(FAR_PAST).alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                   F.lit(True).alias("is_current"))
    return apply_changes(dim, _feed(spark, d), CHAIN, "seq", "op", "at", skew=BUSY).withColumn(
        "kept_sk", F.when(F.col("valid_from") == ts(FAR_PAST), F.col("sk"))).drop("sk")


def dq_no_overlap(spark, d):
    """Versions that last beyond the next one's start, in the prior holder dimension."""
    return overlap_report(sc.holder_dim_prior(spark, d), "c_custkey")


# -- as-of lookups by sorting ----------------------------------------------------------------------------

def _sorted(upper):
    def q(spark, d):
        o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return validity_lookup_sorted(o, sc.holder_dim_validity(spark, d), "o_custkey", "c_custkey",
                                      "o_orderdate", "sk", "holder_sk", upper=upper, skew=BUSY)
    return q


# -- late versions ------------------------------------------------------------------------------------------

def fact_rekeyed(spark, d):
    """Facts whose holders got back-dated versions later: customers with a negative balance are
    known from FAR_PAST on, rich ones change at SPLIT_AT. Only folders they touch are rewritten."""
    before = sc.holder_dim_validity(spark, d)
    c = load(spark, d, "customer")
    early = c.where("c_acctbal < 0").select(
        (F.col("c_custkey") * 2 + 1_000_000_000).alias("sk"), "c_custkey", ts(FAR_PAST).alias("valid_from"),
        ts(sc.LOOKUP_VERSION_FROM).alias("valid_to"))
    rich = c.where(F.col("c_acctbal") >= sc.RICH_BALANCE).select(F.col("c_custkey").alias("k"))
    cut = before.join(rich, F.col("c_custkey") == F.col("k"), "left")
    is_rich = F.col("k").isNotNull()
    closed = cut.select("sk", "c_custkey", "valid_from", F.when(is_rich, ts(sc.SPLIT_AT)).otherwise(
        F.col("valid_to")).alias("valid_to"))
    moved = cut.where(is_rich).select((F.col("sk") + 2_000_000_000).alias("sk"), "c_custkey",
                                      ts(sc.SPLIT_AT).alias("valid_from"), "valid_to")
    after = closed.unionByName(early).unionByName(moved)

    def look(dim):
        return lambda rows: validity_lookup(rows.drop("holder_sk"), dim, "o_custkey", "c_custkey", "o_orderdate",
                                            "sk", "holder_sk", upper="half_open")
    store, part = TableStore(spark, scratch_dir(spark, "rekeyed"), prefix="fact_"), F.date_format(
        "o_orderdate", "yyyyMM").cast("int")
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    store.write(look(before)(o), "orders", parts=part)
    spans = changed_spans(before, after, "c_custkey")
    touched = touched_parts(store.read("orders"), spans, "o_custkey", "o_orderdate", part, BUSY)
    rekey(store, "orders", touched, part, look(after))
    return store.read("orders")


# -- files and SQL -------------------------------------------------------------------------------------------

def _broken_file(spark, d):
    """The orders as lines, some cut short, too long or with a price that is no number."""
    o = load(spark, d, "orders")
    p = F.col("o_orderpriority")
    line = F.concat_ws(";", F.col("o_orderkey"), F.col("o_custkey"),
                       F.when(p.startswith("2"), F.lit("12,5x")).otherwise(F.col("o_custkey").cast("string")))
    line = F.when(p.startswith("3"), F.concat(line, F.lit(";more"))).when(
        p.startswith("5"), F.col("o_orderkey").cast("string")).otherwise(line)
    path = scratch_dir(spark, "broken")
    o.select(line.alias("value")).write.text(path)
    return path


LINE_SCHEMA = "o_orderkey bigint, o_custkey bigint, price bigint"


def csv_rejects(spark, d):
    """Good rows of a file with broken lines, and the text of every line that is rejected."""
    good, bad = read_csv_checked(spark, _broken_file(spark, d), LINE_SCHEMA, header=False)
    return good.select("o_orderkey", "o_custkey", F.lit(None).cast("string").alias("rejected_line")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(None).cast("bigint").alias("o_custkey"),
                   "rejected_line"))


def dq_rejects(spark, d):
    """The gate on the share of rejected lines."""
    good, bad = read_csv_checked(spark, _broken_file(spark, d), LINE_SCHEMA, header=False)
    return rejects_report(good, bad, most=0.5)


def sql_with_arguments(spark, d):
    """SQL over frames and values of this call: order totals by segment between two days."""
    return run_sql(spark, """
        SELECT c.c_mktsegment AS segment, count(*) AS orders, CAST(sum(o.o_orderkey) AS BIGINT) AS key_sum
        FROM {orders} AS o JOIN {customer} AS c ON o.o_custkey = c.c_custkey
        WHERE o.o_orderdate >= :low AND o.o_orderdate < :high
        GROUP BY c.c_mktsegment""",
                   {"orders": load(spark, d, "orders"), "customer": load(spark, d, "customer")},
                   {"low": dt.datetime.fromisoformat(sc.SPLIT_AT), "high": dt.datetime.fromisoformat(sc.INCREMENTAL_CUT)})


QUERIES = {
    "fact_watermark": fact_watermark,
    "fact_incremental_bucketed": fact_incremental_bucketed,
    "dq_held_keys": dq_held_keys,
    "scd2_merge_parts": scd2_merge_parts,
    "scd2_consecutive_keys": scd2_consecutive_keys,
    "keys_in_sequence": keys_in_sequence,
    "scd2_changes": scd2_changes,
    "dq_no_overlap": dq_no_overlap,
    "validity_lookup_sorted_closed": _sorted("closed"),
    "validity_lookup_sorted_half_open": _sorted("half_open"),
    "fact_rekeyed": fact_rekeyed,
    "csv_rejects": csv_rejects,
    "dq_rejects": dq_rejects,
    "sql_with_arguments": sql_with_arguments,
}

# -- the same in SQL -----------------------------------------------------------------------------------------

_DAY = "CAST(o_orderdate AS DATE) + CAST(floor((CAST(o_orderpriority[1] AS INTEGER) - 1) * " \
       f"{DELAY_DAYS} / 4.0) AS INTEGER)"
_PRIORITY = "o_orderpriority[1]"


def _sorted_sql(upper: str) -> str:
    return sc.ORACLE_CTES + f"""
SELECT o_orderkey, o_custkey, o_orderdate, sk AS holder_sk
FROM orders o LEFT JOIN holder_dim_validity h ON o.o_custkey = h.c_custkey AND o.o_orderdate >= h.valid_from
     AND (o.o_orderdate {upper} h.valid_to OR h.valid_to IS NULL)"""


_CHANGED = """(SELECT s.* FROM holder_source s WHERE NOT EXISTS (
  SELECT 1 FROM holder_dim_prior d WHERE d.c_custkey = s.c_custkey AND d.c_mktsegment = s.c_mktsegment
    AND d.c_nationkey = s.c_nationkey))"""


def _merged_sql(new_sk: str, sk_name: str) -> str:
    return sc.ORACLE_CTES + f""",
changed AS (SELECT * FROM {_CHANGED} c)
SELECT {{sk_old}} AS {sk_name}, c_custkey, c_name, c_nationkey, c_mktsegment, valid_from,
       CASE WHEN is_current AND c_custkey IN (SELECT c_custkey FROM changed)
            THEN TIMESTAMP '{sc.LOAD_NOW}' ELSE valid_to END AS valid_to,
       is_current AND c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current
FROM holder_dim_prior
UNION ALL
SELECT {new_sk}, c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{sc.LOAD_NOW}',
       CAST(NULL AS TIMESTAMP), TRUE
FROM changed""".replace("{sk_old}", "sk")


ORACLE = {
    "fact_watermark": f"""
SELECT o_orderkey, o_custkey, o_orderdate,
       CASE {' '.join(f"WHEN {_DAY} < DATE '{t[:10]}' THEN {n + 1}" for n, t in enumerate(LOADS))} END AS load
FROM orders""",
    "fact_incremental_bucketed": f"""
SELECT * FROM orders WHERE NOT (o_orderdate >= TIMESTAMP '{FAR_PAST}' AND o_orderdate < TIMESTAMP '{sc.INCREMENTAL_CUT}')""",
    "dq_held_keys": f"""
SELECT rows, held, duplicate_rows, held = 0 AND duplicate_rows = 0 AS passed
FROM (SELECT count(*) AS rows, count(*) - count(DISTINCT o_orderkey) AS duplicate_rows,
             count(CASE WHEN o_orderdate < TIMESTAMP '{sc.INCREMENTAL_CUT}' THEN 1 END) AS held FROM orders) t""",
    "scd2_merge_parts": _merged_sql("NULL", "kept_sk"),
    "scd2_consecutive_keys": _merged_sql(
        "(SELECT max(sk) FROM holder_dim_prior) + row_number() OVER (ORDER BY c_custkey)", "sk"),
    "keys_in_sequence": """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS sk,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem""",
    "scd2_changes": f"""
WITH rows AS (
  SELECT c_custkey AS user_id, CAST(-1 AS BIGINT) AS seq, TIMESTAMP '{FAR_PAST}' AS moment, 'view' AS state,
         c_acctbal AS note, c_custkey * 2 AS kept_sk FROM customer
  UNION ALL
  SELECT user_id, event_id, date_trunc('hour', ts), CASE WHEN event_type <> 'error' THEN event_type END, value, NULL
  FROM events),
seen AS (SELECT *, lag(state) OVER w AS known, max(moment) OVER (PARTITION BY user_id ORDER BY seq) AS since
         FROM rows WINDOW w AS (PARTITION BY user_id ORDER BY seq)),
kept AS (SELECT * FROM seen WHERE seq = -1 OR state IS DISTINCT FROM known),
ends AS (SELECT *, lead(since) OVER (PARTITION BY user_id ORDER BY seq) AS until FROM kept)
SELECT user_id, state, note, since AS valid_from, until AS valid_to, until IS NULL AS is_current, kept_sk
FROM ends WHERE state IS NOT NULL AND (seq = -1 OR until IS NULL OR until > since)""",
    "dq_no_overlap": sc.ORACLE_CTES + """
SELECT count(*) AS versions, count(CASE WHEN valid_to > next OR (valid_to IS NULL AND next IS NOT NULL) THEN 1 END)
       AS overlaps, count(CASE WHEN valid_to > next OR (valid_to IS NULL AND next IS NOT NULL) THEN 1 END) = 0 AS passed
FROM (SELECT valid_to, lead(valid_from) OVER (PARTITION BY c_custkey ORDER BY valid_from) AS next
      FROM holder_dim_prior) t""",
    "validity_lookup_sorted_closed": _sorted_sql("<="),
    "validity_lookup_sorted_half_open": _sorted_sql("<"),
    # the whole fact looked up anew with the versions as they are after the late ones
    "fact_rekeyed": sc.ORACLE_CTES + f""",
after AS (
  SELECT h.sk, h.c_custkey, h.valid_from,
         CASE WHEN c.c_acctbal >= {sc.RICH_BALANCE} THEN TIMESTAMP '{sc.SPLIT_AT}' ELSE h.valid_to END AS valid_to
  FROM holder_dim_validity h JOIN customer c USING (c_custkey)
  UNION ALL
  SELECT c_custkey * 2 + 1000000000, c_custkey, TIMESTAMP '{FAR_PAST}', TIMESTAMP '{sc.LOOKUP_VERSION_FROM}'
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT h.sk + 2000000000, h.c_custkey, TIMESTAMP '{sc.SPLIT_AT}', h.valid_to
  FROM holder_dim_validity h JOIN customer c USING (c_custkey) WHERE c.c_acctbal >= {sc.RICH_BALANCE})
SELECT o_orderkey, o_custkey, o_orderdate, sk AS holder_sk
FROM orders o LEFT JOIN after a ON o.o_custkey = a.c_custkey AND o.o_orderdate >= a.valid_from
     AND (o.o_orderdate < a.valid_to OR a.valid_to IS NULL)""",
    "csv_rejects": f"""
SELECT CASE WHEN {_PRIORITY} IN ('1', '4') THEN o_orderkey END AS o_orderkey,
       CASE WHEN {_PRIORITY} IN ('1', '4') THEN o_custkey END AS o_custkey,
       CASE {_PRIORITY} WHEN '2' THEN o_orderkey || ';' || o_custkey || ';12,5x'
            WHEN '3' THEN o_orderkey || ';' || o_custkey || ';' || o_custkey || ';more'
            WHEN '5' THEN CAST(o_orderkey AS VARCHAR) END AS rejected_line
FROM orders""",
    "dq_rejects": f"""
SELECT rows, rejected, rejected <= 0.5 * rows AS passed
FROM (SELECT count(*) AS rows, count(CASE WHEN {_PRIORITY} IN ('2', '3', '5') THEN 1 END) AS rejected FROM orders) t""",
    "sql_with_arguments": f"""
SELECT c_mktsegment AS segment, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate >= TIMESTAMP '{sc.SPLIT_AT}' AND o_orderdate < TIMESTAMP '{sc.INCREMENTAL_CUT}'
GROUP BY c_mktsegment""",
}
