"""DuckDB SQL equivalents of ``queries.QUERIES`` (same column names).

``surrogate_key`` has no entry: DuckDB has no xxhash64, so it is checked by
row count here and by range/uniqueness unit tests.
"""

from __future__ import annotations

from tessera.plans import load_queries
from tessera.plans import scenarios as sc
from tessera.plans.scenarios import ORACLE_CTES

_NOW = f"TIMESTAMP '{sc.LOAD_NOW}'"


def _norm(x: str) -> str:
    return f"upper(coalesce(trim({x}), ''))"


def _age(birth: str, as_of: str) -> str:
    return (f"CAST(floor(date_diff('day', CAST({birth} AS DATE), DATE '{as_of}') / 365.25)"
            f" AS BIGINT)")


def _split(x: str, parts: str, first: str, rest: str) -> tuple[str, str]:
    return (f"{parts}[1] AS {first}",
            f"CASE WHEN len({parts}) > 1 THEN array_to_string({parts}[2:], ' ') END AS {rest}")


def _calendar(table: str, col: str) -> str:
    return f"""
  SELECT CAST(strftime(dd, '%Y%m%d') AS INTEGER) AS date_sk, dd AS date,
         CAST(day(dd) AS INTEGER) AS day, CAST(month(dd) AS INTEGER) AS month,
         CAST(year(dd) AS INTEGER) AS year, CAST(quarter(dd) AS INTEGER) AS quarter,
         dayname(dd) AS weekday
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dd
        FROM (SELECT min(CAST({col} AS DATE)) AS lo, max(CAST({col} AS DATE)) AS hi
              FROM {table}) b WHERE lo IS NOT NULL) s"""


def _match(current_only: bool) -> str:
    cur = " AND d.is_current" if current_only else ""
    return ("NOT EXISTS (SELECT 1 FROM holder_dim_prior d WHERE d.c_custkey = s.c_custkey"
            " AND d.c_mktsegment = s.c_mktsegment AND d.c_nationkey = s.c_nationkey"
            f"{cur})")


def _changed(current_only: bool) -> str:
    return f"SELECT s.* FROM holder_source s WHERE {_match(current_only)}"


def _new_versions(current_only: bool) -> str:
    return (ORACLE_CTES + f"""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, {_NOW} AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
FROM ({_changed(current_only)}) c""")


def _expire(current_only: bool) -> str:
    return (ORACLE_CTES + f"""
SELECT sk FROM holder_dim_prior
WHERE is_current AND c_custkey IN (SELECT c_custkey FROM ({_changed(current_only)}) c)""")


def _merge(current_only: bool) -> str:
    return (ORACLE_CTES + f""",
changed AS ({_changed(current_only)})
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, valid_from,
       CASE WHEN is_current AND c_custkey IN (SELECT c_custkey FROM changed)
            THEN {_NOW} ELSE valid_to END AS valid_to,
       CASE WHEN is_current AND c_custkey IN (SELECT c_custkey FROM changed)
            THEN FALSE ELSE is_current END AS is_current, sk AS kept_sk
FROM holder_dim_prior
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, {_NOW}, CAST(NULL AS TIMESTAMP), TRUE, NULL
FROM changed""")


_FACT_CTES = ORACLE_CTES + f""",
cal AS ({_calendar('orders', 'o_orderdate')}),
fact AS (
  SELECT o.o_orderkey AS movement_id, h.sk AS holder_sk, cd.sk AS card_sk,
         ad.sk AS account_sk, cal.date_sk, o.o_totalprice AS amount,
         o.o_orderdate AS moved_at, {_NOW} AS loaded_at
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN card_dim cd ON o.o_custkey = cd.c_custkey
  LEFT JOIN account_dim ad ON c.c_nationkey = ad.n_nationkey
  LEFT JOIN region_holder_dim h ON n.n_regionkey = h.r_regionkey
       AND o.o_orderdate >= h.valid_from
       AND (o.o_orderdate <= h.valid_to OR h.valid_to IS NULL)
  LEFT JOIN cal ON CAST(o.o_orderdate AS DATE) = cal.date)
"""


def _star(join: str) -> str:
    return _FACT_CTES + f"""
SELECT f.movement_id, f.amount, f.moved_at, h.r_name AS holder_name,
       cd.c_name AS card_name, cd.c_mktsegment AS card_segment, ad.n_name AS account_name
FROM fact f
{join} JOIN region_holder_dim h ON f.holder_sk = h.sk
{join} JOIN card_dim cd ON f.card_sk = cd.sk
{join} JOIN account_dim ad ON f.account_sk = ad.sk"""


_DIRTY_SEGMENT = """CASE WHEN c_acctbal < 0 THEN NULL
     WHEN c_nationkey < 5 THEN '  ' || lower(c_mktsegment) || ' '
     WHEN c_nationkey < 8 THEN ''
     WHEN c_nationkey < 10 THEN chr(9) || c_mktsegment
     WHEN c_nationkey < 12 THEN lower(c_mktsegment) || ' ação'
     ELSE c_mktsegment END"""

_DIRTY_PART = """CASE WHEN p_size < 10 THEN p_name || ' ' || p_type
     WHEN p_size < 20 THEN replace(p_name, ' ', '   ')
     WHEN p_size < 25 THEN p_brand
     WHEN p_size >= 48 THEN NULL
     ELSE p_name END"""

_LINE_KEYS = "l_orderkey, l_linenumber"

ORACLE: dict[str, str] = {
    "raw_copy": "SELECT * FROM orders",
    "project_rename": """
SELECT o_orderkey AS movement_id, o_custkey AS card_id, o_totalprice AS amount,
       o_orderdate AS moved_at FROM orders""",
    "normalize_text": f"""
SELECT c_custkey, raw_text, {_norm('raw_text')} AS clean_text
FROM (SELECT c_custkey, {_DIRTY_SEGMENT} AS raw_text FROM customer) t""",
    "name_split": """
SELECT p_partkey, raw_name, {0}, {1}
FROM (SELECT p_partkey, raw_name, string_split({2}, ' ') AS parts
      FROM (SELECT p_partkey, {3} AS raw_name FROM part) a) b""".format(
        *_split("raw_name", "parts", "first_token", "rest_tokens"), _norm("raw_name"),
        _DIRTY_PART),
    "age_years": f"""
SELECT o_orderkey, o_orderdate, {_age('o_orderdate', sc.AS_OF_DATE)} AS age_years
FROM orders""",
    "trusted_holder": """
SELECT c_custkey, {0}, {1}, first_order, {2} AS c_mktsegment, {3} AS age
FROM (SELECT c.*, f.first_order, string_split({4}, ' ') AS parts
      FROM customer c
      LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders
                 GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey) t""".format(
        *_split("c_name", "parts", "first_name", "last_name"), _norm("c_mktsegment"),
        _age("first_order", sc.AS_OF_DATE), _norm("c_name")),
    "trusted_account": f"""
SELECT s_suppkey, {_norm('s_name')} AS s_name, s_nationkey, s_acctbal FROM supplier""",
    "trusted_card": f"""
SELECT c_custkey, {_norm('c_name')} AS c_name, c_nationkey, c_acctbal,
       {_norm('c_mktsegment')} AS c_mktsegment FROM customer""",
    "trusted_movement": f"""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
       {_norm('o_orderpriority')} AS o_orderpriority FROM orders""",
    "lookup_chain": ORACLE_CTES + """
SELECT o.o_orderkey, k.c_custkey, n.n_nationkey, r.r_regionkey, r.r_name, o.o_totalprice
FROM orders o
JOIN known k ON o.o_custkey = k.c_custkey
JOIN nation n ON k.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "dim_lookup_left": ORACLE_CTES + """
SELECT o.o_orderkey, o.o_custkey, d.sk AS card_sk
FROM orders o LEFT JOIN card_dim d ON o.o_custkey = d.c_custkey""",
    "calendar_dim": _calendar("orders", "o_orderdate"),
    "calendar_lookup": f"""
WITH cal AS ({_calendar('lineitem', 'l_shipdate')})
SELECT o.o_orderkey, o.o_orderdate, cal.date_sk
FROM orders o LEFT JOIN cal ON CAST(o.o_orderdate AS DATE) = cal.date""",
    "validity_lookup_closed": ORACLE_CTES + """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, d.sk AS holder_sk
FROM orders o LEFT JOIN holder_dim_validity d ON o.o_custkey = d.c_custkey
  AND o.o_orderdate >= d.valid_from AND (o.o_orderdate <= d.valid_to OR d.valid_to IS NULL)""",
    "validity_lookup_half_open": ORACLE_CTES + """
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, d.sk AS holder_sk
FROM orders o LEFT JOIN holder_dim_validity d ON o.o_custkey = d.c_custkey
  AND o.o_orderdate >= d.valid_from AND (o.o_orderdate < d.valid_to OR d.valid_to IS NULL)""",
    "hot_key_report": f"""
SELECT o_custkey, CAST(ceil(n / least_n) AS INTEGER) AS buckets
FROM (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY o_custkey) g,
     (SELECT count(*) * CAST({sc.BUSY_CUSTOMER} AS DOUBLE) AS least_n FROM orders) t
WHERE n > least_n""",
    "scd2_new_any": _new_versions(False),
    "scd2_new_active": _new_versions(True),
    "scd2_expire": _expire(False),
    "scd2_expire_current": _expire(True),
    "expired_rows_semi": ORACLE_CTES + f"""
SELECT * FROM holder_dim_prior WHERE sk IN (
  SELECT sk FROM holder_dim_prior
  WHERE is_current AND c_custkey IN (SELECT c_custkey FROM ({_changed(False)}) c))""",
    "scd2_merge": _merge(False),
    "scd2_merge_current": _merge(True),
    "scd2_first_load": ORACLE_CTES + f"""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, {_NOW} AS valid_from,
       CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM holder_source""",
    # Where the dimension holds the source's state only the comparison rule decides:
    # '=' never matches a NULL tier, IS NOT DISTINCT FROM does.
    "scd2_null_parity": ORACLE_CTES + f"""
SELECT c_custkey, c_name, tier, {_NOW} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
       TRUE AS is_current
FROM tier_source s WHERE NOT EXISTS (
  SELECT 1 FROM tier_dim d WHERE d.c_custkey = s.c_custkey AND d.tier = s.tier)""",
    "scd2_null_safe": ORACLE_CTES + f"""
SELECT c_custkey, c_name, tier, {_NOW} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to,
       TRUE AS is_current
FROM tier_source s WHERE NOT EXISTS (
  SELECT 1 FROM tier_dim d WHERE d.c_custkey = s.c_custkey
    AND d.tier IS NOT DISTINCT FROM s.tier)""",
    "dim_type1_upsert": ORACLE_CTES + """
SELECT a.c_custkey, a.c_name, a.c_nationkey, a.c_mktsegment, d.sk IS NULL AS is_new,
       d.sk AS kept_sk
FROM active_source a LEFT JOIN card_dim d ON a.c_custkey = d.c_custkey
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, FALSE, sk FROM card_dim d
WHERE NOT EXISTS (SELECT 1 FROM active_source a WHERE a.c_custkey = d.c_custkey)""",
    "fact_build": _FACT_CTES + "SELECT * FROM fact",
    "fact_incremental": _FACT_CTES + f"""
SELECT * FROM fact f WHERE NOT EXISTS (
  SELECT 1 FROM fact e WHERE e.moved_at < TIMESTAMP '{sc.INCREMENTAL_CUT}'
    AND e.movement_id = f.movement_id)""",
    "dq_row_count": _FACT_CTES + """
SELECT source_count, target_count, source_count = target_count AS passed
FROM (SELECT (SELECT count(*) FROM orders) AS source_count,
             (SELECT count(*) FROM fact) AS target_count) t""",
    "dq_pk_unique": f"""
SELECT total_rows, distinct_keys, total_rows - distinct_keys AS duplicate_rows,
       total_rows = distinct_keys AS passed
FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS distinct_keys
      FROM (SELECT {_LINE_KEYS}, count(*) AS n FROM lineitem GROUP BY {_LINE_KEYS}) g) t""",
    "dq_duplicate_keys": f"""
SELECT {_LINE_KEYS}, count(*) AS n FROM lineitem GROUP BY {_LINE_KEYS} HAVING count(*) > 1""",
    "dq_fact_pk_unique": _FACT_CTES + """
SELECT total_rows, distinct_keys, total_rows - distinct_keys AS duplicate_rows,
       total_rows = distinct_keys AS passed
FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total_rows, count(*) AS distinct_keys
      FROM (SELECT movement_id, count(*) AS n FROM fact GROUP BY movement_id) g) t""",
    "dq_null_keys": _FACT_CTES + """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE holder_sk IS NULL) AS null_holder_sk,
       count(*) FILTER (WHERE card_sk IS NULL) AS null_card_sk,
       count(*) FILTER (WHERE account_sk IS NULL) AS null_account_sk,
       count(*) FILTER (WHERE date_sk IS NULL) AS null_date_sk
FROM fact""",
    "dq_dim_key_unique": f"""
SELECT n AS total_rows, n AS distinct_keys, CAST(0 AS BIGINT) AS duplicate_rows, TRUE AS passed
FROM (SELECT count(*) AS n FROM ({_merge(False)}) m) t""",
    "dq_orphans": ORACLE_CTES + f"""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE k.c_custkey IS NULL) AS orphans_1,
       count(*) FILTER (WHERE k.c_custkey IS NOT NULL AND n.n_nationkey IS NULL) AS orphans_2,
       count(*) FILTER (WHERE n.n_nationkey IS NOT NULL AND r.r_regionkey IS NULL) AS orphans_3
FROM orders o LEFT JOIN known k ON o.o_custkey = k.c_custkey
LEFT JOIN (SELECT * FROM nation WHERE n_name <> '{sc.LOST_NATION}') n ON k.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "surrogate_key_properties": """
SELECT count(*) AS keys, count(DISTINCT c_custkey) AS distinct_keys, TRUE AS not_negative,
       TRUE AS below_modulus FROM customer""",
    "csv_roundtrip_exact": """
SELECT o_orderkey, CASE o_orderpriority[1]
         WHEN '1' THEN 'a;b "quoted" ' || o_orderpriority
         WHEN '2' THEN '  two' || chr(10) || 'lines' || chr(13) || chr(10) || o_orderpriority || '  '
         WHEN '3' THEN ''
         WHEN '4' THEN '"' || o_orderpriority || chr(92) || '"' END AS note,
       o_orderdate + INTERVAL 123456 MICROSECOND AS at
FROM orders""",
    "star_flatten": _star("INNER"),
    "star_flatten_left": _star("LEFT"),
    "sample_rows": _star("INNER") + "\nORDER BY movement_id, holder_name LIMIT 5",
    "csv_roundtrip": _star("INNER"),
}
_BIRTH = "(DATE '1950-03-09' + CAST(r_regionkey * 2500 AS INTEGER))"
_DATE_SK = "CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS date_sk"
ORACLE["card_pipeline"] = """
SELECT {0}, {1}, {5} AS age, CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
       o_orderkey AS movement_id, o_orderdate AS moved_at,
       CAST(c_custkey AS VARCHAR) AS card_number, {2} AS printed_name,
       DATE '1991-01-15' + CAST(c_nationkey * 30 AS INTEGER) AS card_issued_on, {3} AS account_type,
       DATE '1985-03-01' + CAST(n_nationkey * 40 AS INTEGER) AS account_opened_on, {6}
FROM (SELECT o.*, c.*, n.*, r.r_regionkey, string_split({4}, ' ') AS parts
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey) t""".format(
    *_split("r_name", "parts", "first_name", "last_name"), _norm("c_name"), _norm("n_name"),
    _norm("r_name"), _age(_BIRTH, sc.AS_OF_DATE), _DATE_SK)
ORACLE["card_pipeline_incremental"] = f"""
SELECT o_orderkey AS movement_id, {_DATE_SK}, CAST(o_totalprice AS DECIMAL(10,2)) AS amount,
       CASE WHEN late THEN TIMESTAMP '{sc.SECOND_LOAD}' ELSE TIMESTAMP '{sc.PIPELINE_NOW}' END AS loaded_at,
       r_regionkey AS holder_id,
       CASE WHEN late AND changed THEN 'WIDOWED' WHEN r_regionkey < 2 THEN 'SINGLE'
            WHEN r_regionkey < 4 THEN 'MARRIED' ELSE '' END AS marital_status,
       {_age(_BIRTH, sc.AS_OF_DATE)} AS age, late OR NOT changed AS is_current,
       CASE WHEN late AND changed THEN TIMESTAMP '{sc.SECOND_LOAD}'
            ELSE TIMESTAMP '{sc.PIPELINE_NOW}' END AS valid_from
FROM (SELECT o.*, r.r_regionkey, o.o_orderdate >= TIMESTAMP '{sc.SECOND_LOAD}' AS late,
             r.r_regionkey >= 3 AS changed
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN nation n ON c.c_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey) t"""
# The known customers' state first, then the whole source: a two-step merge.
ORACLE["stream_two_batches"] = ORACLE_CTES + f""",
changed AS (
  SELECT * FROM holder_source s WHERE NOT EXISTS (
    SELECT 1 FROM known k WHERE k.c_custkey = s.c_custkey
      AND k.c_mktsegment = s.c_mktsegment AND k.c_nationkey = s.c_nationkey))
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{sc.FIRST_VERSION_FROM}' AS valid_from,
       CASE WHEN c_custkey IN (SELECT c_custkey FROM changed) THEN {_NOW} END AS valid_to,
       c_custkey NOT IN (SELECT c_custkey FROM changed) AS is_current
FROM known
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, {_NOW}, CAST(NULL AS TIMESTAMP), TRUE FROM changed"""
# Hot-key split variants return exactly what the unsplit queries return.
ORACLE["validity_lookup_salted"] = ORACLE["validity_lookup_closed"]
ORACLE["dim_lookup_salted"] = ORACLE["dim_lookup_left"]
ORACLE["fact_build_salted"] = ORACLE["fact_build"]
ORACLE["star_flatten_sql"] = ORACLE["star_flatten"]
ORACLE["star_flatten_salted"] = ORACLE["star_flatten"]
# One streamed pass over the landed source equals the batch first load.
ORACLE["stream_first_load"] = ORACLE["scd2_first_load"]

ORACLE.update(load_queries.ORACLE)
