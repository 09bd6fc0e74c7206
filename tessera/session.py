"""Session construction and the shared scratch location.

On a cluster the session comes from spark-submit and is used as is; the
settings here only fill gaps (tests, bench, local runs). Nothing writes to a
machine-local folder unless the session itself names one as its checkpoint dir.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so timestamps compare the same everywhere,
# AQE so join strategy, partition counts and skewed partitions are re-planned
# from runtime sizes instead of guesses.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with the settings above.

    ``master`` is only applied when given (local runs); on a cluster leave it None.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_REQUIRED)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("TESSERA_DRIVER_MEMORY", "8g"),
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; set a local one only if none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    always used. Only an unconfigured local-mode session (tests, bench) gets a
    temp folder; an unconfigured cluster session is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object "
                               "store) for scratch tables on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def keep_shuffles_over_unions(spark: SparkSession) -> None:
    """Turn off, for the session, Spark 4.1's rule that a union of sides partitioned alike is too.

    Planning drops the shuffle above such a union, but the union does not always
    run that way: over shuffles that AQE takes from another branch, and over
    bucketed columnar scans, it puts the partitions of its sides one after another.
    A join by the key above it then fails ("Can't zip RDDs with unequal numbers of
    partitions") and a group by the key misses rows of its groups.
    """
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the session's shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: evaluated once, its lineage cut."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
