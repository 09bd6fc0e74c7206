"""File-source Structured Streaming into a type-2 dimension.

New files landing in ``source_path`` are read as micro-batches; each batch is
cleaned by ``transform``, reduced to the latest row per id, and merged into the
dimension with the same SCD2 merge the batch pipeline uses, then committed. The commit marker records the stream and its batch number,
so a batch replayed after a failure (Spark gives foreachBatch at-least-once
delivery) is recognised and skipped. The stream is known by the query's id,
which lives in its checkpoint: another stream, or one with a new checkpoint,
counts its batches on its own and loses none.

A batch rewrites the hash parts of the dimension that hold a changed id (``operators.parts``),
a batch without a change writes nothing. That fits scheduled loads (``available_now``)
and rare triggers, not a trigger every few seconds on a large dimension.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.parts import merge_parts
from tessera.operators.quality import gate, key_uniqueness_report
from tessera.operators.scd2 import Scd2Spec
from tessera.sources.store import TableStore


def latest_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the largest ``order`` (ties: one of them, the same each time).

    A partial aggregate, so a key with many rows sends one a task.
    """
    rank = F.struct(F.col(order), F.xxhash64(*df.columns))
    return (df.groupBy(F.col(key).alias("__key"))
            .agg(F.max_by(F.struct(*df.columns), rank).alias("__row")).select("__row.*"))


def scd2_batch_writer(store: TableStore, name: str, spec: Scd2Spec,
                      transform: Callable[[DataFrame], DataFrame] = lambda df: df,
                      now: Callable[[], Column] | None = None,
                      stream: str | Callable[[], str] = "stream",
                      latest_by: str | None = None, parts: int = 16):
    """The ``foreachBatch`` function: merge one micro-batch into ``store[name]``.

    ``stream`` names the source of batch numbers. ``latest_by`` orders the rows of
    one id within a batch (the column is dropped before the merge); without it
    a batch that repeats an id is rejected, as both rows would become current. The
    dimension is kept in ``parts`` hash parts of its key.
    """

    def apply(batch: DataFrame, epoch_id: int) -> None:
        own = stream() if callable(stream) else stream
        done = store.last_epoch(name, own)
        if done is not None and epoch_id <= done:
            return  # already applied before a restart
        src = transform(batch)
        if latest_by:
            src = latest_rows(src, spec.key, latest_by).drop(latest_by)
        else:
            gate(one_row_per_id=key_uniqueness_report(src, spec.key))
        merge_parts(store, name, src, spec, parts, now() if now else F.current_timestamp(),
                    epoch=(own, epoch_id), check_keys=False)

    return apply


def start_dimension_stream(spark: SparkSession, source_path: str, schema: T.StructType | str,
                           store: TableStore, name: str, spec: Scd2Spec,
                           checkpoint: str, transform: Callable[[DataFrame], DataFrame]
                           = lambda df: df, fmt: str = "parquet",
                           available_now: bool = True,
                           processing_time: str | None = None,
                           now: Callable[[], Column] | None = None,
                           latest_by: str | None = None,
                           max_files: int | None = None) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops
    (scheduled incremental loads); otherwise it runs on ``processing_time``.
    ``max_files`` bounds the files of one batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    started, query_id = threading.Event(), []

    def stream_id() -> str:
        if not started.wait(300):
            raise RuntimeError("the stream's id is not known")
        return query_id[0]

    w = (reader.load(source_path).writeStream
         .foreachBatch(scd2_batch_writer(store, name, spec, transform, now, stream_id, latest_by))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    query = w.start()
    query_id.append(query.id)
    started.set()
    return query
