"""End-to-end card pipeline on invented rows."""

import datetime as dt
import glob
import math
from decimal import Decimal

import pytest

from tessera.operators import QualityError
from tessera.plans.pipeline import PipelineConfig, run
from tessera.sources import TableStore, read_jdbc

D, TS = dt.date, dt.datetime
AS_OF = D(2031, 4, 6)
FIRST = TS(2031, 2, 3)

HOLDER = [("P-7", " maren  toivola ", D(1971, 4, 7), "widowed ", " doctorate"),
          ("P-8", "idris okafor bello", D(2004, 2, 29), "single", "ensino técnico"),
          ("P-9", "Yun", D(2012, 12, 31), None, "primary")]
ACCOUNT = [("ac-31", "P-7", " savings", "0420", "open", D(2011, 6, 17)),
           ("ac-32", "P-8", "joint", "0007", "open", D(2027, 9, 30)),
           ("ac-33", "P-9", "youth ", "0420", "frozen", D(2026, 1, 1))]
CARD = [("k1", "ac-31", "730011", " m toivola", "lumen", "prepaid", D(2030, 3, 9)),
        ("k2", "ac-31", "730012", "m toivola", "lumen", "charge", D(2029, 12, 24)),
        ("k3", "ac-32", "730013", "i o bello", "orbit", "prepaid", D(2028, 2, 29)),
        ("k4", "ac-33", "730014", "yun", "orbit", "gift", D(2031, 1, 2))]
MOVEMENT = [("t1", "k1", " ferry ", Decimal("8.05"), TS(2031, 2, 11, 6, 5, 4)),
            ("t2", "k2", None, Decimal("4100"), TS(2031, 2, 12, 23, 59, 59)),
            ("t3", "k3", "seed;s", Decimal("17.3"), TS(2031, 3, 1)),
            ("t4", "k4", "kite", Decimal("0.01"), TS(2031, 3, 31, 13)),
            ("t5", "k1", "before", Decimal("66.60"), TS(2031, 2, 2, 22, 22))]  # before first load
SCHEMAS = {
    "holder": "holder_id string, full_name string, birth_date date, marital_status string, "
              "education string",
    "account": "account_id string, holder_id string, account_type string, branch string, "
               "status string, opened_on date",
    "card": "card_id string, account_id string, card_number string, printed_name string, "
            "brand string, card_type string, issued_on date",
    "movement": "movement_id string, card_id string, description string, "
                "amount decimal(10,2), moved_at timestamp",
}


def age(b):
    return math.floor((AS_OF - b).days / 365.25)


def source(spark, tables):
    return lambda name: spark.createDataFrame(tables[name], SCHEMAS[name])


def csv_lines(path):
    lines, header = [], None
    for f in glob.glob(f"{path}/*.csv"):
        rows = open(f, encoding="utf-8").read().splitlines()
        header, body = rows[0], rows[1:]
        lines += body
    return header, sorted(lines)


def cfg_for(spark, tmp_path, tables, now, **kw):
    return PipelineConfig(read_source=source(spark, tables),
                          warehouse_root=str(tmp_path / "wh"),
                          export_path=str(tmp_path / f"flat-{now:%Y%m%d}" if now else "flat"),
                          as_of=AS_OF, now=now, single_file=True, **kw)


@pytest.fixture()
def tables():
    return {"holder": list(HOLDER), "account": list(ACCOUNT), "card": list(CARD),
            "movement": list(MOVEMENT)}


def layer(spark, cfg, prefix):
    return TableStore(spark, cfg.warehouse_root, prefix=prefix)


def test_pipeline_runs(spark, tmp_path, tables):
    """One warehouse through several loads: golden first load, a holder change (new
    version and validity lookup), and a load the gates reject."""
    # 1. first load: golden flat file
    cfg = cfg_for(spark, tmp_path, tables, FIRST)
    out = run(spark, cfg)
    assert {c["check"] for c in out["fact"]["checks"]} == {"orphans", "row_count", "unique_movement",
                                                           "calendar"}
    # t5 predates its holder's first version; every date is in the calendar, past its default end
    assert out["fact"]["null_keys"] == {"rows": 5, "null_holder_sk": 1, "null_card_sk": 0,
                                        "null_account_sk": 0, "null_date_sk": 0}
    header, lines = csv_lines(cfg.export_path)
    assert header == ("first_name;last_name;age;amount;movement_id;moved_at;card_number;"
                      "printed_name;card_issued_on;account_type;account_opened_on")
    # The CSV writer trims leading blanks of unquoted fields (Spark default), so the
    # inner run of blanks in "MAREN  TOIVOLA" leaves "TOIVOLA" in the file.
    maren, bello, yun = (age(h[2]) for h in HOLDER)
    assert lines == sorted([
        f"MAREN;TOIVOLA;{maren};8.05;t1;2031-02-11T06:05:04.000Z;730011;M TOIVOLA;2030-03-09;"
        "SAVINGS;2011-06-17",
        f"MAREN;TOIVOLA;{maren};4100.00;t2;2031-02-12T23:59:59.000Z;730012;M TOIVOLA;2029-12-24;"
        "SAVINGS;2011-06-17",
        f"IDRIS;OKAFOR BELLO;{bello};17.30;t3;2031-03-01T00:00:00.000Z;730013;I O BELLO;2028-02-29;"
        "JOINT;2027-09-30",
        f"YUN;;{yun};0.01;t4;2031-03-31T13:00:00.000Z;730014;YUN;2031-01-02;YOUTH;2026-01-01",
    ])  # t5 happened before the holder's first version: NULL key, dropped by the inner star
    facts = layer(spark, cfg, "fact_")

    # 2. P-8 changes: old version closed at the load time, new one opened
    tables["holder"][1] = ("P-8", "idris okafor bello", D(2004, 2, 29), "married", "ensino técnico")
    tables["movement"].append(("t6", "k3", "loom", Decimal("7.77"), TS(2031, 3, 20, 8, 0)))
    second = TS(2031, 3, 15)
    cfg2 = cfg_for(spark, tmp_path, tables, second)
    run(spark, cfg2)
    dim = layer(spark, cfg2, "dim_").read("holder")
    assert sorted((r.marital_status, r.valid_from, r.valid_to, r.is_current)
                  for r in dim.where("holder_id = 'P-8'").collect()) == [
        ("MARRIED", second, None, True), ("SINGLE", FIRST, second, False)]
    # P-9's NULL status became '' in the trusted layer, so it matches: no new version
    assert dim.where("holder_id IN ('P-7', 'P-9')").count() == 2
    facts.refresh()
    sks = {r.movement_id: r.holder_sk for r in facts.read("movement").collect()}
    current = {r.sk for r in dim.where("holder_id = 'P-8' AND is_current").collect()}
    assert sks["t6"] in current and sks["t3"] not in current and sks["t3"] is not None
    assert len(csv_lines(cfg2.export_path)[1]) == 5
    published = facts.current_version("movement")

    # 3. a duplicate id and an orphan card: the gates raise, nothing is published
    tables["movement"] += [("t1", "k1", "again", Decimal("1.00"), TS(2031, 3, 21)),
                           ("t7", "k-none", "lost", Decimal("1.00"), TS(2031, 3, 21))]
    with pytest.raises(QualityError) as e:
        run(spark, cfg_for(spark, tmp_path, tables, TS(2031, 3, 22)))
    failed = {f["check"]: f for f in e.value.failures}
    assert set(failed) == {"orphans", "row_count", "unique_movement"}
    assert failed["orphans"]["without_card"] == 1 and failed["orphans"]["without_holder"] == 0
    facts.refresh()
    assert facts.current_version("movement") == published

    # 4. the corrected source loads: the rejected staged folder does not get in the way
    del tables["movement"][-2:]
    run(spark, cfg_for(spark, tmp_path, tables, TS(2031, 3, 23)), stages=["raw", "trusted", "fact"])
    facts.refresh()
    assert facts.current_version("movement") == published + 1


def test_incremental_loads(spark, tmp_path, tables):
    """First load, one with new movements, one with nothing new, and reruns of single stages."""
    late = tables["movement"][3:]
    tables["movement"] = tables["movement"][:3]
    stages = ("raw", "trusted", "dimensions", "fact")
    cfg = cfg_for(spark, tmp_path, tables, FIRST, fact_mode="incremental")
    assert run(spark, cfg, stages)["fact"]["mode"] == "overwrite"
    tables["movement"] += late
    run(spark, cfg_for(spark, tmp_path, tables, FIRST, fact_mode="incremental"), stages)
    third = run(spark, cfg_for(spark, tmp_path, tables, FIRST, fact_mode="incremental"), stages)
    assert third["fact"]["mode"] == "append" and third["fact"]["null_keys"]["rows"] == 0
    for s in stages:
        run(spark, cfg_for(spark, tmp_path, tables, FIRST, fact_mode="incremental"), [s])
    facts = layer(spark, cfg, "fact_").read("movement")
    assert sorted(r.movement_id for r in facts.collect()) == ["t1", "t2", "t3", "t4", "t5"]
    assert dict(facts.dtypes)["date_sk"] == "int"
    # every layer of the movements only grew: what the first load wrote is still in place
    for prefix in ("raw_", "trusted_", "fact_"):
        store = layer(spark, cfg, prefix)
        assert "v00000001" in store.live_paths("movement")[0]
        assert store.read("movement").count() == 5


def test_empty_first_load(spark, tmp_path, tables):
    for t in tables:
        tables[t] = []
    cfg = cfg_for(spark, tmp_path, tables, FIRST)
    assert run(spark, cfg)["fact"]["null_keys"]["rows"] == 0
    assert layer(spark, cfg, "fact_").read("movement").count() == 0
    assert layer(spark, cfg, "dim_").read("calendar").count() > 0


def test_calendar_follows_range_and_movements(spark, tmp_path, tables):
    stages = ("raw", "trusted", "dimensions", "fact")
    year = {"calendar_start": D(2030, 1, 1), "calendar_end": D(2030, 12, 31)}
    fixed = cfg_for(spark, tmp_path, tables, FIRST, calendar_from_movements=False, **year)
    with pytest.raises(QualityError) as e:  # movements of 2031 are in no calendar
        run(spark, fixed, stages)
    assert [(f["check"], f["undated"]) for f in e.value.failures] == [("calendar", 5)]
    wider = cfg_for(spark, tmp_path, tables, FIRST, calendar_from_movements=False,
                    calendar_start=D(2030, 12, 1), calendar_end=D(2031, 12, 31))
    assert run(spark, wider, stages)["fact"]["null_keys"]["null_date_sk"] == 0
    cal = layer(spark, wider, "dim_").read("calendar")
    assert cal.count() == cal.select("date_sk").distinct().count() == 730
    tables["movement"].append(("t8", "k1", "far", Decimal("1"), TS(2040, 1, 1)))
    out = run(spark, cfg_for(spark, tmp_path, tables, FIRST, **year), stages)
    assert out["fact"]["null_keys"]["null_date_sk"] == 0


def test_key_collision_is_rejected(spark, tmp_path, tables):
    tables["card"] += [(f"x{k}", "ac-31", "1", "n", "b", "t", D(2030, 1, 1)) for k in range(40)]
    with pytest.raises(QualityError) as e:
        run(spark, cfg_for(spark, tmp_path, tables, FIRST, key_modulus=11))
    assert e.value.failures[0]["check"].endswith("_sk_unique")


def test_run_refuses_unknown_stages_and_settles_one_time(spark, tmp_path, tables):
    cfg = cfg_for(spark, tmp_path, tables, None)
    with pytest.raises(ValueError):
        run(spark, cfg, stages=["facts"])
    with pytest.raises(ValueError):
        cfg_for(spark, tmp_path, tables, FIRST, fact_mode="sometimes")
    run(spark, cfg, stages=("raw", "trusted", "dimensions", "fact"))
    stamps = {r.loaded_at for r in layer(spark, cfg, "fact_").read("movement").collect()}
    starts = {r.valid_from for r in layer(spark, cfg, "dim_").read("holder").collect()}
    assert len(stamps) == 1 and stamps == starts


def test_publish_to_a_database(spark, tmp_path, tables):
    import tempfile

    url = f"jdbc:derby:memory:p{next(tempfile._get_candidate_names())};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    kw = {"fact_mode": "incremental", "publish_url": url, "publish_properties": props}
    stages = ("raw", "trusted", "dimensions", "fact", "publish")
    late = tables["movement"].pop()
    out = run(spark, cfg_for(spark, tmp_path, tables, FIRST, **kw), stages)
    assert out["publish"] == {"fact": "overwrite"}
    tables["movement"].append(late)
    assert run(spark, cfg_for(spark, tmp_path, tables, FIRST, **kw), stages)["publish"] == {"fact": "append"}
    count = {t: read_jdbc(spark, url, t, props, one_task=True).count()
             for t in ("fact_movement", "dim_holder", "dim_card", "dim_account")}
    assert count == {"fact_movement": 5, "dim_holder": 3, "dim_card": 4, "dim_account": 3}


def test_first_load_after_movements_exports_nothing(spark, tmp_path, tables):
    """Holder versions start at the load time, so a first load after every movement
    leaves all holder keys NULL: the inner star join exports no row (parity); the
    left form keeps the movements with empty holder fields."""
    cfg = cfg_for(spark, tmp_path, tables, TS(2031, 4, 5))
    out = run(spark, cfg)
    assert out["fact"]["null_keys"]["null_holder_sk"] == len(MOVEMENT)
    assert csv_lines(cfg.export_path)[1] == []
    cfg.flatten_how = "left"
    cfg.export_path = str(tmp_path / "flat-left")
    run(spark, cfg, stages=["export"])
    lines = csv_lines(cfg.export_path)[1]
    assert len(lines) == len(MOVEMENT) and all(ln.startswith(";;;") for ln in lines)


def test_cli_parquet_source(spark, tmp_path, tables):
    from tessera.plans import cli
    src = tmp_path / "src"
    for name, rows in tables.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(src / name))
    out = cli.main(["--source", f"parquet:{src}", "--warehouse", str(tmp_path / "wh"),
                    "--export", str(tmp_path / "flat"), "--as-of", "2031-04-06",
                    "--now", "2031-02-03T00:00:00", "--single-file", "--calendar-start", "2031-01-01",
                    "--calendar-end", "2031-12-31", "--calendar-fixed", "--skew-share", "0.2",
                    "--fact-partition-by", "date_sk", "--holder-tracked", "education",
                    "--key-modulus", "10000000000"])
    assert all(c["passed"] for c in out["fact"]["checks"])
    assert len(csv_lines(str(tmp_path / "flat"))[1]) == 4
    cal = TableStore(spark, str(tmp_path / "wh"), prefix="dim_").read("calendar")
    assert cal.count() == 365


def test_loads_by_stamp(spark, tmp_path, tables):
    """A stamped source: each layer reads from its own mark on, late rows within the overlap come in."""
    def stamped(rows):
        schema = SCHEMAS["movement"] + ", sent_at timestamp"
        frames = {**{t: spark.createDataFrame(tables[t], SCHEMAS[t]) for t in ("holder", "account", "card")},
                  "movement": spark.createDataFrame(rows, schema)}
        return frames.__getitem__

    stages = ("raw", "trusted", "dimensions", "fact")
    kw = {"fact_mode": "incremental", "movement_stamp": "sent_at", "movement_overlap": dt.timedelta(days=2)}
    one = [(*m, TS(2031, 3, k + 1)) for k, m in enumerate(MOVEMENT[:3])]
    cfg = cfg_for(spark, tmp_path, tables, FIRST, **kw)
    cfg.read_source = stamped(one)
    assert run(spark, cfg, stages)["fact"]["null_keys"]["rows"] == 3
    two = one + [(*MOVEMENT[3], TS(2031, 3, 2)), (*MOVEMENT[4], TS(2031, 2, 1)), one[2]]  # late, too late, again
    cfg.read_source = stamped(two)
    assert run(spark, cfg, stages)["fact"]["null_keys"]["rows"] == 1
    fact = layer(spark, cfg, "fact_").read("movement")
    assert sorted(r.movement_id for r in fact.collect()) == ["t1", "t2", "t3", "t4"]
    assert run(spark, cfg, stages)["fact"]["null_keys"]["rows"] == 0
    assert layer(spark, cfg, "raw_").last_epoch("movement", "watermark") == layer(
        spark, cfg, "fact_").last_epoch("movement", "watermark")
    with pytest.raises(ValueError):
        cfg_for(spark, tmp_path, tables, FIRST, movement_stamp="sent_at")


def test_late_holder_versions_are_looked_up_again(spark, tmp_path, tables):
    """t5 happened before its holder's first version; a version that arrives with an earlier start repairs it."""
    from pyspark.sql import functions as F

    cfg = cfg_for(spark, tmp_path, tables, FIRST)
    stages = ("raw", "trusted", "dimensions", "fact")
    assert run(spark, cfg, stages)["fact"]["null_keys"]["null_holder_sk"] == 1
    facts, dims = layer(spark, cfg, "fact_"), layer(spark, cfg, "dim_")
    paths = facts.live_paths("movement")
    assert {p.rsplit("=", 1)[1] for p in paths} == {"203102", "203103"}
    assert run(spark, cfg, ["rekey"])["rekey"] == {"parts": []}
    holder = dims.read("holder")
    early = holder.where("holder_id = 'P-7'").select(
        (F.col("sk") + 1).alias("sk"), *[c for c in holder.columns if c not in (
            "sk", "valid_from", "valid_to", "is_current")],
        F.lit("2031-01-01").cast("timestamp").alias("valid_from"),
        F.lit("2031-02-03").cast("timestamp").alias("valid_to"), F.lit(False).alias("is_current"))
    dims.write(early, "holder", mode="append")
    assert run(spark, cfg, ["rekey"])["rekey"] == {"parts": ["203102"]}
    facts.refresh()
    sk = {r.movement_id: r.holder_sk for r in facts.read("movement").collect()}
    assert len(sk) == 5 and sk["t5"] == early.first()["sk"] and sk["t1"] == sk["t5"] - 1
    assert [p for p in paths if "203103" in p] == [p for p in facts.live_paths("movement") if "203103" in p]
    assert run(spark, cfg, ["rekey"])["rekey"] == {"parts": []}


def test_consecutive_keys_in_all_dimensions(spark, tmp_path, tables):
    kw = {"consecutive_keys": True, "key_modulus": 50}
    stages = ("raw", "trusted", "dimensions", "fact")
    cfg = cfg_for(spark, tmp_path, tables, FIRST, **kw)
    run(spark, cfg, stages)
    tables["card"] += [(f"x{k}", "ac-31", "1", "n", "b", "t", D(2030, 1, 1)) for k in range(40)]
    tables["holder"][1] = ("P-8", "idris okafor bello", D(2004, 2, 29), "married", "ensino técnico")
    run(spark, cfg_for(spark, tmp_path, tables, TS(2031, 3, 2), **kw), stages)
    dims = layer(spark, cfg, "dim_")
    assert sorted(r.sk for r in dims.read("card").collect()) == list(range(1, 45))
    assert sorted(r.sk for r in dims.read("holder").collect()) == [1, 2, 3, 4]
    cards = {r.card_id: r.sk for r in dims.read("card").collect()}
    assert [cards[k] for k in ("k1", "k2", "k3", "k4")] == [1, 2, 3, 4]
    tables["card"] += [(f"y{k}", "ac-31", "1", "n", "b", "t", D(2030, 1, 1)) for k in range(10)]
    with pytest.raises(Exception, match="limit 50"):
        run(spark, cfg_for(spark, tmp_path, tables, TS(2031, 3, 2), **kw), stages)


def test_publishing_after_a_failure_adds_what_is_missing(spark, tmp_path, tables, monkeypatch):
    """Loads whose publishing failed, or ran twice, or was followed by a rewrite of earlier facts."""
    import tempfile

    from tessera.plans import pipeline

    url = f"jdbc:derby:memory:q{next(tempfile._get_candidate_names())};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    kw = {"fact_mode": "incremental", "publish_url": url, "publish_properties": props}
    stages = ("raw", "trusted", "dimensions", "fact")
    ids = lambda: sorted(r["movement_id"] for r in read_jdbc(
        spark, url, "fact_movement", props, one_task=True).collect())
    later = tables["movement"][2:]
    tables["movement"] = tables["movement"][:2]
    cfg = cfg_for(spark, tmp_path, tables, FIRST, **kw)
    run(spark, cfg, (*stages, "publish"))
    assert ids() == ["t1", "t2"]
    for m in later[:2]:  # two loads, of which none is published
        tables["movement"].append(m)
        run(spark, cfg_for(spark, tmp_path, tables, FIRST, **kw), stages)
    real, calls = pipeline.publish, []

    def die_on_facts(df, url_, table, *a, **k):
        if table == "fact_movement":
            calls.append(table)
            if len(calls) == 2:
                raise RuntimeError("lost")
        return real(df, url_, table, *a, **k)

    monkeypatch.setattr(pipeline, "publish", die_on_facts)
    with pytest.raises(RuntimeError):
        run(spark, cfg, ["publish"])
    assert ids() == ["t1", "t2", "t3"]
    monkeypatch.setattr(pipeline, "publish", real)
    for _ in range(2):
        run(spark, cfg, ["publish"])
        assert ids() == ["t1", "t2", "t3", "t4"]
    facts = layer(spark, cfg, "fact_")
    facts.compact("movement", parts=pipeline.fact_month(), cluster=["date_sk"])
    assert facts.parts("movement") == {"203102", "203103"}
    run(spark, cfg, ["publish"])
    assert ids() == ["t1", "t2", "t3", "t4"]


def test_compaction_after_some_loads(spark, tmp_path, tables):
    rows = tables["movement"]
    tables["movement"] = []
    kw = {"fact_mode": "incremental", "compact_after": 2}
    stages = ("raw", "trusted", "dimensions", "fact")
    for n, m in enumerate(rows[:3]):
        tables["movement"].append(m)
        cfg = cfg_for(spark, tmp_path, tables, FIRST, **kw)
        run(spark, cfg, stages)
        done = run(spark, cfg, ["compact"])["compact"]
        assert set(done) == (set() if n < 2 else {"raw_movement", "trusted_movement", "fact_movement"})
    for prefix in ("raw_", "trusted_", "fact_"):
        store = layer(spark, cfg, prefix)
        assert len(store.versions("movement")) == 1 and store.read("movement").count() == 3
    tables["movement"] = rows
    assert run(spark, cfg_for(spark, tmp_path, tables, FIRST, **kw), stages)["fact"]["null_keys"]["rows"] == 2
    facts = layer(spark, cfg, "fact_")
    assert facts.read("movement").count() == 5 and facts.parts("movement") == {"203102", "203103"}


def test_measures_count_a_retried_task_once(tmp_path):
    """Every writing task fails once; what the write measured is what it wrote."""
    import subprocess
    import sys
    from pathlib import Path

    code = f'''
import os
from pyspark.sql import functions as F, types as T
from tessera.session import build_session
from tessera.sources import TableStore
spark = build_session("local[2,4]", shuffle_partitions=2)
def flaky(batches):
    from pyspark import TaskContext
    for b in batches:
        yield b
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
df = spark.range(0, 1000, 1, 4).mapInPandas(flaky, "id long")
store = TableStore(spark, "{tmp_path}/wh")
staged = store.stage(df, "t", measure={{"rows": F.count(F.lit(1)), "total": F.sum("id")}})
assert staged.measured == {{"rows": 1000, "total": 499500}}, staged.measured
assert store.read_staged(staged).count() == 1000
many = store.stage(df.withColumn("m", F.col("id") % 3), "u", parts=F.col("m"), cluster=["id"],
                   measure={{"rows": F.count(F.lit(1))}})
assert many.measured == {{"rows": 1000}} and len(many.folders) == 3
print("counted once")
'''
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], timeout=300,
                         capture_output=True, text=True)
    assert "counted once" in out.stdout, out.stderr[-2000:]
