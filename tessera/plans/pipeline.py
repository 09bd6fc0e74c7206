"""Card-domain warehouse pipeline: raw -> trusted -> dimensions -> fact -> flat export.

One job, five stages, each rerunnable on its own against the table store
(``run(..., stages=[...])``). State between stages lives only in committed
snapshots, so a lost executor or a killed driver restarts a stage, never
half-applies it: the holder dimension is written as a new snapshot (no in-place
UPDATE), and the fact is staged, gated, and only then published.

With ``fact_mode="incremental"`` the raw and trusted movements and the fact only
grow: movements whose id is not there yet are appended to each layer, and no
load rewrites what is there. Where the source stamps its movements
(``movement_stamp``) each layer reads the one before it from its own high-water
mark on, less an overlap. The optional stage ``rekey`` looks up again the facts
that holder versions which changed since point elsewhere.

Input contract (raw source tables, see FIXTURES.md):
  holder(holder_id, full_name, birth_date, marital_status, education)
  account(account_id, holder_id, account_type, branch, status, opened_on)
  card(card_id, account_id, card_number, printed_name, brand, card_type, issued_on)
  movement(movement_id, card_id, description, amount decimal(10,2), moved_at)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import (CalendarLookup, ChainStep, KeyLookup, Scd2Spec, SkewSpec,
                               StarJoin, ValidityLookup, build_fact, calendar, calendar_for,
                               validity_lookup,
                               evaluate, flatten, gate, incremental,
                               key_uniqueness_report, orphan_report, require,
                               row_count_report, trusted_account, trusted_card,
                               trusted_holder, trusted_movement, type1_upsert)
from tessera.operators.load import Watermark, load_since_mark, measures, next_mark, rows_since_mark
from tessera.operators.parts import merge_parts
from tessera.operators.rekey import REWRITTEN, rekey, stale_parts
from tessera.sources import TableStore, copy_tables, export_csv, publish, read_jdbc, run_concurrently
from tessera.sources.jdbc import BATCH

SOURCE_TABLES = ("holder", "account", "card", "movement")
STAGES = ("raw", "trusted", "dimensions", "fact", "export")
OPTIONAL_STAGES = ("rekey", "compact", "publish")

# The flat file's column order.
FLAT_COLUMNS = ["first_name", "last_name", "age", "amount", "movement_id", "moved_at",
                "card_number", "printed_name", "card_issued_on", "account_type",
                "account_opened_on"]


@dataclass
class PipelineConfig:
    read_source: Callable[[str], DataFrame]   # table name -> DataFrame (JDBC, parquet, ...)
    warehouse_root: str                       # shared folder of the table store
    export_path: str | None = None
    as_of: dt.date | None = None              # date ages are computed at (default: today)
    now: dt.datetime | None = None            # load time of versions and facts (default: now)
    # The calendar holds these days and, by default, all days between the first and the
    # last movement; each load adds the days that are missing.
    calendar_start: dt.date = dt.date(2020, 1, 1)
    calendar_end: dt.date = dt.date(2029, 12, 31)
    calendar_from_movements: bool = True
    holder_match: str = "any"                 # SCD2 comparison: any version / current only
    null_safe: bool = False
    validity_upper: str = "closed"            # "half_open" avoids double matches on boundaries
    key_modulus: int | None = None            # 10**10 for the short key form
    # Number new dimension rows after the largest key in use (key_modulus is then their limit).
    consecutive_keys: bool = False
    # Hash parts of the holder dimension: a load rewrites those that hold a changed holder.
    holder_parts: int = 16
    fact_mode: str = "full"                   # or "incremental": append unseen movement ids
    flatten_how: str = "inner"
    single_file: bool = False
    holder_tracked: tuple[str, ...] = field(
        default=("marital_status", "education", "age"))
    # Split cards / holders carrying more rows than this across tasks
    # (None: rely on AQE's skew-join handling only).
    skew: SkewSpec | None = field(default_factory=SkewSpec)
    # Folders of the published fact: by default its months, each a part that can be rewritten
    # alone, rows sorted by day within. Columns given here partition it by their values instead.
    fact_partition_by: tuple[str, ...] = ()
    # The source's load stamp of a movement, if it has one, and how late rows may become visible.
    movement_stamp: str | None = None
    movement_overlap: dt.timedelta = dt.timedelta(days=3)
    # The compact stage rewrites a movement table once so many loads were appended to it.
    compact_after: int = 50
    # The publish stage writes dimensions and fact to this database (url, properties).
    publish_url: str | None = None
    publish_properties: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.fact_mode not in ("full", "incremental"):
            raise ValueError("fact_mode must be 'full' or 'incremental'")
        if self.movement_stamp and self.fact_mode != "incremental":
            raise ValueError("movement_stamp is for fact_mode 'incremental'")


def _as_of(cfg: PipelineConfig) -> Column | None:
    return None if cfg.as_of is None else F.lit(cfg.as_of.isoformat()).cast("date")


def _now(cfg: PipelineConfig) -> Column:
    if cfg.now is None:  # a stage called on its own; run() settles one time for all
        return F.current_timestamp()
    return F.lit(cfg.now.isoformat(sep=" ")).cast("timestamp")


def holder_spec(cfg: PipelineConfig) -> Scd2Spec:
    return Scd2Spec(key="holder_id", tracked=cfg.holder_tracked, match=cfg.holder_match,
                    null_safe=cfg.null_safe, key_modulus=cfg.key_modulus,
                    consecutive=cfg.consecutive_keys)


def watermark(cfg: PipelineConfig, by_month: bool = True) -> Watermark | None:
    return Watermark(cfg.movement_stamp, cfg.movement_overlap,
                     by_month=by_month) if cfg.movement_stamp else None


def _append_new(rows: DataFrame, store: TableStore, name: str, key: str,
                wm: Watermark | None = None) -> int:
    """Append the rows whose key the table does not hold yet (all of them on a first load)."""
    if wm is not None:
        version = load_since_mark(rows, store, name, key, wm)
        return store.current_version(name) if version is None else version
    if not store.exists(name):
        return store.write(rows, name)
    return store.write(incremental(store.read(name), rows, key), name, mode="append")


def stage_raw(spark: SparkSession, cfg: PipelineConfig) -> dict:
    raw = TableStore(spark, cfg.warehouse_root, prefix="raw_")
    if cfg.fact_mode == "full":
        return copy_tables(cfg.read_source, raw, SOURCE_TABLES)
    out = copy_tables(cfg.read_source, raw, [t for t in SOURCE_TABLES if t != "movement"])
    out["movement"] = _append_new(cfg.read_source("movement"), raw, "movement", "movement_id",
                                  watermark(cfg))
    return out


def stage_trusted(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Clean every table; the layer must hold as many rows as the raw one, and one per key."""
    raw = TableStore(spark, cfg.warehouse_root, prefix="raw_")
    tr = TableStore(spark, cfg.warehouse_root, prefix="trusted_")
    out = _write_trusted(raw, tr, cfg)
    gate(**{f"{t}_rows": row_count_report(raw.read(t), tr.read(t)) for t in SOURCE_TABLES},
         **{f"{t}_unique": key_uniqueness_report(tr.read(t), f"{t}_id")
            for t in SOURCE_TABLES if t != "movement"})
    return out


def _write_trusted(raw: TableStore, tr: TableStore, cfg: PipelineConfig) -> dict:
    def movement() -> int:
        stamp = [cfg.movement_stamp] if cfg.movement_stamp else []
        rows = trusted_movement(raw.read("movement"), keep=(
            "movement_id", "card_id", "amount", "moved_at", *stamp))
        if cfg.fact_mode == "incremental":
            return _append_new(rows, tr, "movement", "movement_id", watermark(cfg))
        return tr.write(rows, "movement")

    return run_concurrently({
        "holder": lambda: tr.write(trusted_holder(raw.read("holder"), as_of=_as_of(cfg)),
                                   "holder"),
        "account": lambda: tr.write(trusted_account(raw.read("account")), "account"),
        "card": lambda: tr.write(trusted_card(raw.read("card")), "card"),
        "movement": movement,
    })


def _type1(spark, wh: TableStore, name: str, trusted: DataFrame, key: str,
           cfg: PipelineConfig) -> int:
    if wh.exists(name):
        dim = wh.read(name)
    else:
        schema = T.StructType([T.StructField("sk", T.LongType(), False)] + trusted.schema.fields)
        dim = spark.createDataFrame([], schema)
    return _publish_dim(wh, type1_upsert(trusted, dim, key, now=_now(cfg),
                                         modulus=cfg.key_modulus,
                                         consecutive=cfg.consecutive_keys), name)


def _publish_dim(wh: TableStore, dim: DataFrame, name: str) -> int:
    """Stage a dimension and commit it if its surrogate keys are unique: a collision (which a
    small ``key_modulus`` makes likely) would multiply facts."""
    staged = wh.stage(dim, name)
    gate(**{f"{name}_sk_unique": key_uniqueness_report(wh.read_staged(staged), "sk")})
    wh.commit(staged)
    return staged.version


def _extend_calendar(spark: SparkSession, wh: TableStore, tr: TableStore,
                     cfg: PipelineConfig) -> int:
    """Append the days that the calendar lacks."""
    days = calendar(spark, cfg.calendar_start, cfg.calendar_end)
    if cfg.calendar_from_movements:
        days = days.unionByName(calendar_for(tr.read("movement"), "moved_at")).dropDuplicates(
            ["date"])
    if not wh.exists("calendar"):
        return wh.write(days, "calendar")
    missing = days.join(wh.read("calendar").select("date"), "date", "left_anti").select(
        *days.columns)
    if missing.isEmpty():
        return wh.current_version("calendar")
    return wh.write(missing, "calendar", mode="append")


def stage_dimensions(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Holder (type 2), card and account (type 1), calendar."""
    tr = TableStore(spark, cfg.warehouse_root, prefix="trusted_")
    wh = TableStore(spark, cfg.warehouse_root, prefix="dim_")
    merge_parts(wh, "holder", tr.read("holder"), holder_spec(cfg), cfg.holder_parts, _now(cfg))
    out = {"holder": wh.current_version("holder")}
    card = tr.read("card").select("card_id", "card_number", "printed_name", "brand",
                                  "card_type", "issued_on")
    acct = tr.read("account").select("account_id", "account_type", "branch", "status",
                                     "opened_on")
    jobs = {"card": lambda: _type1(spark, wh, "card", card, "card_id", cfg),
            "account": lambda: _type1(spark, wh, "account", acct, "account_id", cfg)}
    jobs["calendar"] = lambda: _extend_calendar(spark, wh, tr, cfg)
    out.update(run_concurrently(jobs))
    return out


def fact_frame(spark: SparkSession, cfg: PipelineConfig, movements: DataFrame) -> DataFrame:
    tr = TableStore(spark, cfg.warehouse_root, prefix="trusted_")
    wh = TableStore(spark, cfg.warehouse_root, prefix="dim_")
    stamp = [cfg.movement_stamp] if cfg.movement_stamp else []
    mv = movements.select("movement_id", "card_id", "amount", "moved_at", *stamp)
    chain = [
        ChainStep(tr.read("card"), "card_id", "card_id", ("account_id",)),
        ChainStep(tr.read("account"), "account_id", "account_id", ("holder_id",)),
        ChainStep(tr.read("holder"), "holder_id", "holder_id"),
    ]
    lookups = [
        KeyLookup(wh.read("card"), "card_id", "card_id", "sk", "card_sk"),
        KeyLookup(wh.read("account"), "account_id", "account_id", "sk", "account_sk"),
        ValidityLookup(wh.read("holder"), "holder_id", "holder_id", "moved_at", "sk",
                       "holder_sk", upper=cfg.validity_upper),
        CalendarLookup(wh.read("calendar"), "moved_at", "date_sk"),
    ]
    cols = ["movement_id", "holder_id", "holder_sk", "card_sk", "account_sk", "date_sk",
            F.col("amount").cast("decimal(10,2)").alias("amount"), "moved_at", *stamp]
    return build_fact(mv, chain, lookups, cols, loaded_at=_now(cfg), skew=cfg.skew)


FACT_KEYS = ("holder_sk", "card_sk", "account_sk", "date_sk")


def fact_measures(wm: Watermark | None) -> dict[str, Column]:
    """What is counted while the fact is written: rows, NULLs per key, movements whose day is in
    no calendar, and the largest stamp."""
    undated = F.col("date_sk").isNull() & F.col("moved_at").isNotNull()
    out = {"rows": F.count(F.lit(1)),
           **{f"null_{c}": F.count(F.when(F.col(c).isNull(), 1)) for c in FACT_KEYS},
           "undated": F.count(F.when(undated, 1))}
    return out if wm is None else {**measures(wm), **out}


def fact_month() -> Column:
    return F.date_format("moved_at", "yyyyMM").cast("int")


def _stage_fact_rows(ft: TableStore, rows: DataFrame, cfg: PipelineConfig, measure: dict):
    if cfg.fact_partition_by:
        return ft.stage(rows, "movement", list(cfg.fact_partition_by), cluster=[], measure=measure)
    return ft.stage(rows, "movement", parts=fact_month(), cluster=["date_sk"], measure=measure)


def stage_fact(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Build, stage, gate, publish. Nothing is published when a check fails.

    The fact is written once to an uncommitted version; its rows, NULL keys and
    undated rows are counted by the tasks that write it, so of the gate only the
    uniqueness of its key reads the staged files, and the orphan count the source.
    """
    tr = TableStore(spark, cfg.warehouse_root, prefix="trusted_")
    ft = TableStore(spark, cfg.warehouse_root, prefix="fact_")
    wm = watermark(cfg, by_month=False)
    mode, source = "overwrite", tr.read("movement")
    if cfg.fact_mode == "incremental" and ft.exists("movement"):
        source = (incremental(ft.read("movement"), source, "movement_id") if wm is None
                  else rows_since_mark(source, ft, "movement", "movement_id", wm))
        mode = "append"
    staged = _stage_fact_rows(ft, fact_frame(spark, cfg, source), cfg, fact_measures(wm))
    measured = staged.measured
    hops = ("card", "account", "holder")
    orphans = orphan_report(source, [(tr.read(h), f"{h}_id", f"{h}_id") for h in hops])
    orphans = orphans.select(
        F.col("rows"), *[F.col(f"orphans_{i + 1}").alias(f"without_{h}") for i, h in enumerate(hops)]
    ).withColumn("passed", sum((F.col(f"without_{h}") for h in hops), F.lit(0)) == 0)
    orphan, unique = evaluate(orphans=orphans, unique_movement=key_uniqueness_report(
        ft.read_staged(staged), "movement_id"))
    report = require([
        orphan,
        {"check": "row_count", "source_count": orphan["rows"], "target_count": measured["rows"],
         "passed": orphan["rows"] == measured["rows"]},
        unique,
        {"check": "calendar", **{k: v for k, v in measured.items() if k != "mark"},
         "passed": measured["undated"] == 0}])
    ft.commit(staged, mode, next_mark(ft, staged, wm) if wm else None)
    # Informational: rows with a NULL key are kept in the fact but an inner
    # star flatten drops them (e.g. a movement before its holder's first version).
    nulls = {k: v for k, v in measured.items() if k == "rows" or k.startswith("null_")}
    return {"version": staged.version, "mode": mode, "checks": report, "null_keys": nulls}


def stage_rekey(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Look up again the facts whose holder version is not the one valid at their time any more
    (it came late, or was closed since), facts without one among them; only the months that
    hold such a fact are rewritten."""
    wh = TableStore(spark, cfg.warehouse_root, prefix="dim_")
    ft = TableStore(spark, cfg.warehouse_root, prefix="fact_")
    if cfg.fact_partition_by:
        raise ValueError("rekey needs the fact in its months (no fact_partition_by)")
    known = wh.read("holder").select("holder_id", "sk", "valid_from", "valid_to")
    touched = stale_parts(ft.read("movement"), known, "holder_id", "holder_sk", "moved_at", fact_month(),
                          "holder_id", upper=cfg.validity_upper, skew=cfg.skew)

    def look(rows: DataFrame) -> DataFrame:
        return validity_lookup(rows.drop("holder_sk"), known, "holder_id", "holder_id", "moved_at", "sk",
                               "holder_sk", upper=cfg.validity_upper, skew=cfg.skew)

    def check(staged: DataFrame) -> None:
        gate(unique_movement=key_uniqueness_report(staged, "movement_id"))

    rekey(ft, "movement", touched, fact_month(), look, check)
    return {"parts": sorted(touched)}


def stage_compact(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Rewrite the movement tables that ``compact_after`` or more loads were appended to, so that a
    table's scan never lists many times that number of folders a part."""
    wm, out = watermark(cfg), {}
    month = fact_month() if not cfg.fact_partition_by else None
    for prefix, by, parts in (("raw_", None, wm.part() if wm else None),
                              ("trusted_", None, wm.part() if wm else None),
                              ("fact_", list(cfg.fact_partition_by) or None, month)):
        store = TableStore(spark, cfg.warehouse_root, prefix=prefix)
        if store.exists("movement") and store.appends_since_overwrite("movement") >= cfg.compact_after:
            cluster = ["date_sk"] if prefix == "fact_" else None
            out[prefix + "movement"] = store.compact("movement", by, parts, cluster)
    return out


def flat_frame(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    wh = TableStore(spark, cfg.warehouse_root, prefix="dim_")
    ft = TableStore(spark, cfg.warehouse_root, prefix="fact_")
    joins = [
        StarJoin(wh.read("holder"), "holder_sk", "sk",
                 {"first_name": "first_name", "last_name": "last_name", "age": "age"}),
        StarJoin(wh.read("card"), "card_sk", "sk",
                 {"card_number": "card_number", "printed_name": "printed_name",
                  "issued_on": "card_issued_on"}),
        StarJoin(wh.read("account"), "account_sk", "sk",
                 {"account_type": "account_type", "opened_on": "account_opened_on"}),
    ]
    return flatten(ft.read("movement"), joins,
                   {"amount": "amount", "movement_id": "movement_id", "moved_at": "moved_at"},
                   how=cfg.flatten_how, order=FLAT_COLUMNS, skew=cfg.skew)


def stage_export(spark: SparkSession, cfg: PipelineConfig) -> dict:
    if not cfg.export_path:
        raise ValueError("export_path is required for the export stage")
    export_csv(flat_frame(spark, cfg), cfg.export_path, single_file=cfg.single_file)
    return {"path": cfg.export_path}


def _published(spark: SparkSession, cfg: PipelineConfig, table: str) -> int | None:
    """The last batch that the database's table holds; None if there is no such table."""
    query = f'(SELECT MAX("{BATCH}") AS b FROM {table}) t'
    try:
        return read_jdbc(spark, cfg.publish_url, query, cfg.publish_properties, one_task=True).first()[0]
    except Exception as e:  # noqa: BLE001 - databases word a missing table differently
        if table.lower() in str(e).lower() and "exist" in str(e).lower():
            return None
        raise


def stage_publish(spark: SparkSession, cfg: PipelineConfig) -> dict:
    """Write the dimensions (replaced) and the fact to a database; it can be run again at any time.

    Every row of the fact carries the version that loaded it. Versions newer than
    the newest one published are added, each in a transaction of its own, which
    also covers loads whose publishing failed; the fact is replaced as a whole
    when there is none published yet or rows published before were rewritten.
    """
    if not cfg.publish_url:
        raise ValueError("publish_url is required for the publish stage")
    wh = TableStore(spark, cfg.warehouse_root, prefix="dim_")
    ft = TableStore(spark, cfg.warehouse_root, prefix="fact_")
    target = (cfg.publish_url,)
    for name in ("holder", "card", "account", "calendar"):
        publish(wh.read(name), *target, f"dim_{name}", cfg.publish_properties, wh.current_version(name))
    versions = ft.versions("movement")
    done = _published(spark, cfg, "fact_movement")
    rewritten = max(versions[0], ft.last_epoch("movement", REWRITTEN) or 0)
    if done is None or rewritten > done:
        publish(ft.read("movement"), *target, "fact_movement", cfg.publish_properties, versions[-1])
        return {"fact": "overwrite"}
    for v in versions:
        if v > done:
            publish(ft.read_version("movement", v), *target, "fact_movement", cfg.publish_properties, v,
                    mode="append")
    return {"fact": "append"}


_RUNNERS = {"raw": stage_raw, "trusted": stage_trusted, "dimensions": stage_dimensions,
            "fact": stage_fact, "rekey": stage_rekey, "compact": stage_compact,
            "export": stage_export, "publish": stage_publish}


def run(spark: SparkSession, cfg: PipelineConfig, stages=STAGES) -> dict:
    """Run the given stages in order; a failed quality gate raises and stops the run.

    The load time is settled once for all stages of the run.
    """
    if unknown := [s for s in stages if s not in _RUNNERS]:
        raise ValueError(f"unknown stages {unknown}; there are {list(_RUNNERS)}")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if cfg.now is None:
        cfg = replace(cfg, now=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    return {s: _RUNNERS[s](spark, cfg) for s in stages}
