import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import QualityError, Scd2Spec
from tessera.sources import TableStore
from tessera.streaming.ingest import scd2_batch_writer, start_dimension_stream

SCHEMA = "id string, status string"
SPEC = Scd2Spec(key="id", tracked=("status",))


def test_stream_into_dimension(spark, tmp_path):
    src = tmp_path / "landing"
    store = TableStore(spark, str(tmp_path / "wh"), prefix="dim_")
    ck = str(tmp_path / "ck")
    clean = lambda df: df.select("id", F.upper("status").alias("status"))
    spark.createDataFrame([("a", "x"), ("b", "y")], SCHEMA).write.parquet(str(src / "f1"))
    q = start_dimension_stream(spark, f"{src}/*", SCHEMA, store, "holder", SPEC, ck, clean)
    q.awaitTermination(120)
    assert sorted((r.id, r.status) for r in store.read("holder").collect()) == [
        ("a", "X"), ("b", "Y")]
    spark.createDataFrame([("a", "z")], SCHEMA).write.parquet(str(src / "f2"))
    q = start_dimension_stream(spark, f"{src}/*", SCHEMA, store, "holder", SPEC, ck, clean)
    q.awaitTermination(120)
    rows = sorted((r.id, r.status, r.is_current) for r in store.read("holder").collect())
    assert rows == [("a", "X", False), ("a", "Z", True), ("b", "Y", True)]


    # another checkpoint counts its batches from 0 again: nothing of it is skipped
    spark.createDataFrame([("c", "w")], SCHEMA).write.parquet(str(tmp_path / "other"))
    before = store.current_version("holder")
    for _ in range(2):  # the second run finds no new file
        q = start_dimension_stream(spark, str(tmp_path / "other"), SCHEMA, store, "holder", SPEC,
                                   str(tmp_path / "ck2"), clean)
        q.awaitTermination(120)
    assert q.exception() is None and store.current_version("holder") == before + 1
    assert [r.status for r in store.read("holder").where("id = 'c'").collect()] == ["W"]


def test_two_updates_of_one_id_in_a_batch(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    batch = spark.createDataFrame([("n", "new", 2), ("n", "old", 1), ("m", None, 1), ("m", "x", None)],
                                  SCHEMA + ", seq int")
    with pytest.raises(QualityError):
        scd2_batch_writer(store, "d", SPEC)(batch.drop("seq"), 0)
    scd2_batch_writer(store, "d", SPEC, latest_by="seq")(batch, 0)
    assert sorted((r.id, r.status, r.is_current) for r in store.read("d").collect()) == [
        ("m", None, True), ("n", "new", True)]


def test_unchanged_batch_writes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    apply = scd2_batch_writer(store, "d", SPEC)
    batch = spark.createDataFrame([("n", "s")], SCHEMA)
    apply(batch, 0)
    apply(batch, 1)
    assert store.current_version("d") == 1


def test_replayed_epoch_is_skipped(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "wh"))
    apply = scd2_batch_writer(store, "d", SPEC,
                              now=lambda: F.lit(dt.datetime(2033, 1, 1)))
    batch = spark.createDataFrame([("n", None)], SCHEMA)  # NULL: would add a version each time
    apply(batch, 0)
    apply(batch, 0)  # replay after a restart
    assert store.read("d").count() == 1
    apply(batch, 1)
    assert store.read("d").count() == 2
