"""Warehouse inputs derived from the test tables (role map for the query set).

Roles: movement = ``orders``, card = ``customer``, account = ``nation``,
holder = ``region`` for the key chain; the type-2 holder dimension used by the
SCD2 and validity queries is built over ``customer``. Every set is derived by
Spark from the given tables (semi joins, aggregates, CASE rules on attributes),
so its size grows with them; ``ORACLE_CTES`` writes the same sets in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.scd2 import Scd2Spec

# Fixed values of the scenario (shared with the SQL oracle below).
KNOWN_BEFORE = "1996-01-01 00:00:00"   # customers with an order before this were loaded earlier
FIRST_VERSION_FROM = "1995-01-01 00:00:00"
LOOKUP_VERSION_FROM = "1995-06-01 00:00:00"  # validity dims start here: earlier movements miss
SPLIT_AT = "1998-01-01 00:00:00"       # boundary shared by two versions
LOAD_NOW = "2002-01-01 00:00:00"       # the merge / fact load time
AS_OF_DATE = "2002-01-01"              # reference date for ages
PIPELINE_NOW = "1990-01-01 00:00:00"   # load time of the card-pipeline query
SECOND_LOAD = "1998-01-01 00:00:00"    # later loads of the incremental card-pipeline query
THIRD_LOAD = "2001-01-01 00:00:00"
ACTIVE_FROM = "2001-01-01 00:00:00"    # customers still active in the type-1 source
INCREMENTAL_CUT = "2000-01-01 00:00:00"  # facts before this are already loaded
RICH_BALANCE = 9000.0                  # customers at or above had a former 'OLD' segment
DELINQUENT = "DELINQUENT"              # segment of customers with a negative balance
FORMER_SEGMENT = "OLD"
LOST_NATION = "NATION_7"               # a nation missing from the chain of the orphan report
MOVED_SEGMENT = "BUILDING"             # customers whose balance tier changed since the last load
NEW_REGION_SUFFIX = " (RENAMED)"


def ts(s: str) -> Column:
    """A TIMESTAMP_NTZ literal (the test parquet timestamps load as NTZ)."""
    return F.lit(s).cast("timestamp_ntz")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


HOLDER_SPEC = Scd2Spec(key="c_custkey", tracked=("c_mktsegment", "c_nationkey"),
                       sk="sk", validity_type=T.TimestampNTZType())


def holder_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of every customer; negative balance moves them to DELINQUENT."""
    c = load(spark, sf_dir, "customer")
    seg = F.when(F.col("c_acctbal") < 0, F.lit(DELINQUENT)).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", "c_name", "c_nationkey", seg.alias("c_mktsegment"))


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an order before KNOWN_BEFORE (a semi join, customer columns only)."""
    c = load(spark, sf_dir, "customer")
    early = load(spark, sf_dir, "orders").where(F.col("o_orderdate") < ts(KNOWN_BEFORE))
    return c.join(early, c.c_custkey == early.o_custkey, "left_semi")


def holder_dim_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holder dimension as the previous load left it.

    Known customers have a version from FIRST_VERSION_FROM with their original
    segment. Rich ones (balance >= RICH_BALANCE) had it closed at SPLIT_AT and
    carry a current 'OLD' version since, so their source state returns to a
    former one (A -> B -> A).
    """
    k = known_customers(spark, sf_dir)
    rich = F.col("c_acctbal") >= RICH_BALANCE
    v1 = k.select(
        (F.col("c_custkey") * 2).alias("sk"), "c_custkey", "c_name", "c_nationkey",
        "c_mktsegment", ts(FIRST_VERSION_FROM).alias("valid_from"),
        F.when(rich, ts(SPLIT_AT)).alias("valid_to"), (~rich).alias("is_current"))
    v2 = k.where(rich).select(
        (F.col("c_custkey") * 2 + 1).alias("sk"), "c_custkey", "c_name", "c_nationkey",
        F.lit(FORMER_SEGMENT).alias("c_mktsegment"), ts(SPLIT_AT).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    return v1.unionByName(v2)


BUSY_CUSTOMER = 0.001                  # share of all orders above which a customer is split
TIER_WIDTH = 2500.0                    # balance band width of the nullable tier attribute
TIER_SPEC = Scd2Spec(key="c_custkey", tracked=("tier",), sk="sk",
                     validity_type=T.TimestampNTZType())


def tier_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a balance tier that is NULL for negative balances."""
    c = load(spark, sf_dir, "customer")
    tier = F.when(F.col("c_acctbal") >= 0,
                  F.floor(F.col("c_acctbal") / TIER_WIDTH).cast("int"))
    return c.select("c_custkey", "c_name", tier.alias("tier"))


def tier_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One current version per customer: the source state, except that customers of
    MOVED_SEGMENT were a tier higher (in tier 0 where they have none now)."""
    moved = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("__k"), (F.col("c_mktsegment") == MOVED_SEGMENT).alias("__moved"))
    former = F.when(F.col("__moved"), F.coalesce(F.col("tier") + 1, F.lit(0))).otherwise(
        F.col("tier"))
    src = tier_source(spark, sf_dir)
    return src.join(moved, src["c_custkey"] == moved["__k"]).select(
        (F.col("c_custkey") * 2).alias("sk"), "c_custkey", "c_name", former.alias("tier"),
        ts(FIRST_VERSION_FROM).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))


def holder_dim_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions for the point-in-validity queries: every customer from
    LOOKUP_VERSION_FROM; negative-balance ones split at SPLIT_AT."""
    c = load(spark, sf_dir, "customer")
    neg = F.col("c_acctbal") < 0
    v1 = c.select((F.col("c_custkey") * 2).alias("sk"), "c_custkey",
                  ts(LOOKUP_VERSION_FROM).alias("valid_from"),
                  F.when(neg, ts(SPLIT_AT)).alias("valid_to"))
    v2 = c.where(neg).select((F.col("c_custkey") * 2 + 1).alias("sk"), "c_custkey",
                             ts(SPLIT_AT).alias("valid_from"),
                             F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    return v1.unionByName(v2)


def card_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 card dimension: the known customers, key ``2 * c_custkey``."""
    return known_customers(spark, sf_dir).select(
        (F.col("c_custkey") * 2).alias("sk"), "c_custkey", "c_name", "c_nationkey",
        "c_mktsegment")


def active_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type-1 source: current state of customers with an order since ACTIVE_FROM."""
    recent = load(spark, sf_dir, "orders").where(F.col("o_orderdate") >= ts(ACTIVE_FROM))
    src = holder_source(spark, sf_dir)
    return src.join(recent, src.c_custkey == recent.o_custkey, "left_semi")


def account_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    return n.select((F.col("n_nationkey") + 1000).cast("long").alias("sk"), "n_nationkey",
                    "n_name", "n_regionkey")


def region_holder_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned holder dimension for the fact: each region renamed at SPLIT_AT."""
    r = load(spark, sf_dir, "region")
    v1 = r.select((F.col("r_regionkey") * 2).cast("long").alias("sk"), "r_regionkey",
                  "r_name", ts(LOOKUP_VERSION_FROM).alias("valid_from"),
                  ts(SPLIT_AT).alias("valid_to"), F.lit(False).alias("is_current"))
    v2 = r.select((F.col("r_regionkey") * 2 + 1).cast("long").alias("sk"), "r_regionkey",
                  F.concat("r_name", F.lit(NEW_REGION_SUFFIX)).alias("r_name"),
                  ts(SPLIT_AT).alias("valid_from"),
                  F.lit(None).cast("timestamp_ntz").alias("valid_to"),
                  F.lit(True).alias("is_current"))
    return v1.unionByName(v2)


ORACLE_CTES = f"""
WITH holder_source AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_acctbal < 0 THEN '{DELINQUENT}' ELSE c_mktsegment END AS c_mktsegment
  FROM customer),
known AS (
  SELECT * FROM customer c WHERE EXISTS (
    SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
      AND o.o_orderdate < TIMESTAMP '{KNOWN_BEFORE}')),
holder_dim_prior AS (
  SELECT c_custkey * 2 AS sk, c_custkey, c_name, c_nationkey, c_mktsegment,
         TIMESTAMP '{FIRST_VERSION_FROM}' AS valid_from,
         CASE WHEN c_acctbal >= {RICH_BALANCE} THEN TIMESTAMP '{SPLIT_AT}' END AS valid_to,
         NOT (c_acctbal >= {RICH_BALANCE}) AS is_current
  FROM known
  UNION ALL
  SELECT c_custkey * 2 + 1, c_custkey, c_name, c_nationkey, '{FORMER_SEGMENT}',
         TIMESTAMP '{SPLIT_AT}', CAST(NULL AS TIMESTAMP), TRUE
  FROM known WHERE c_acctbal >= {RICH_BALANCE}),
holder_dim_validity AS (
  SELECT c_custkey * 2 AS sk, c_custkey, TIMESTAMP '{LOOKUP_VERSION_FROM}' AS valid_from,
         CASE WHEN c_acctbal < 0 THEN TIMESTAMP '{SPLIT_AT}' END AS valid_to
  FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 1, c_custkey, TIMESTAMP '{SPLIT_AT}', CAST(NULL AS TIMESTAMP)
  FROM customer WHERE c_acctbal < 0),
card_dim AS (
  SELECT c_custkey * 2 AS sk, c_custkey, c_name, c_nationkey, c_mktsegment FROM known),
active_source AS (
  SELECT * FROM holder_source s WHERE EXISTS (
    SELECT 1 FROM orders o WHERE o.o_custkey = s.c_custkey
      AND o.o_orderdate >= TIMESTAMP '{ACTIVE_FROM}')),
tier_source AS (
  SELECT c_custkey, c_name,
         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / {TIER_WIDTH}) AS INTEGER) END AS tier
  FROM customer),
tier_dim AS (
  SELECT t.c_custkey, CASE WHEN c.c_mktsegment = '{MOVED_SEGMENT}' THEN coalesce(t.tier + 1, 0)
                           ELSE t.tier END AS tier
  FROM tier_source t JOIN customer c ON c.c_custkey = t.c_custkey),
account_dim AS (
  SELECT CAST(n_nationkey + 1000 AS BIGINT) AS sk, n_nationkey, n_name, n_regionkey FROM nation),
region_holder_dim AS (
  SELECT CAST(r_regionkey * 2 AS BIGINT) AS sk, r_regionkey, r_name,
         TIMESTAMP '{LOOKUP_VERSION_FROM}' AS valid_from, TIMESTAMP '{SPLIT_AT}' AS valid_to,
         FALSE AS is_current
  FROM region
  UNION ALL
  SELECT CAST(r_regionkey * 2 + 1 AS BIGINT), r_regionkey, r_name || '{NEW_REGION_SUFFIX}',
         TIMESTAMP '{SPLIT_AT}', CAST(NULL AS TIMESTAMP), TRUE
  FROM region)
"""
