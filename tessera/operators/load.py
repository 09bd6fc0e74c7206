"""Incremental loads: by a load stamp with a high-water mark, and by co-partitioned keys.

A source that stamps its rows when it writes them can be read from a mark on:
the largest stamp loaded so far, kept in the target's commit marker together
with the rows it covers. Rows may become visible late, so each load reads an
``overlap`` before the mark again and drops the keys the target already holds
there. Both reads carry the bound as a filter, so a Parquet or JDBC source, and
the target's folders, give up only that window.

A row that becomes visible later than ``overlap`` after its stamp is missed, and a
key sent again after that with a new stamp is loaded again: choose the overlap
longer than the source's delay, or check all keys (``all_keys=True``), for which
the target's key column is read whole. Rows without a stamp are read each time
and compared with the target's rows without one.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.store import NULL_PART, Staged, TableStore

EPOCH = dt.datetime(1970, 1, 1)


@dataclass(frozen=True)
class Watermark:
    """``stamp``: the source's load stamp (date or timestamp), carried into the target.

    ``by_month``: the target's parts are the months of the stamp, so that a load lists
    only those of its window; otherwise its files are pruned by their statistics.
    """
    stamp: str
    overlap: dt.timedelta
    name: str = "watermark"
    by_month: bool = True

    def mark(self, store: TableStore, table: str) -> dt.datetime | None:
        micros = store.last_epoch(table, self.name)
        return None if micros is None else EPOCH + dt.timedelta(microseconds=micros)

    def window(self, df: DataFrame, mark: dt.datetime | None) -> DataFrame:
        """The rows of ``df`` from ``overlap`` before the mark on, and those without a stamp."""
        if mark is None:
            return df
        low = F.lit((mark - self.overlap).isoformat(sep=" ")).cast(df.schema[self.stamp].dataType)
        return df.where((F.col(self.stamp) >= low) | F.col(self.stamp).isNull())

    def part(self) -> Column:
        """The month of the stamp: the target's folders, so that a window lists few of them."""
        return F.date_format(self.stamp, "yyyyMM").cast("int")

    def parts_since(self, store: TableStore, table: str, mark: dt.datetime) -> set[str]:
        low = int((mark - self.overlap).strftime("%Y%m"))
        return {p for p in store.parts(table) if p == NULL_PART or int(p) >= low}


def first_rows(df: DataFrame, key: str, stamp: str) -> DataFrame:
    """One row of each key: the one stamped first (ties: one of them, the same each time)."""
    rank = F.struct(F.col(stamp).isNull(), F.col(stamp), F.xxhash64(*df.columns))
    return (df.groupBy(F.col(key).alias("__key"))
            .agg(F.min_by(F.struct(*df.columns), rank).alias("__row")).select("__row.*"))


def rows_since_mark(source: DataFrame, store: TableStore, table: str, key: str, wm: Watermark,
                    all_keys: bool = False) -> DataFrame:
    """The rows of ``source`` that ``table`` lacks, one for each key."""
    mark = wm.mark(store, table) if store.exists(table) else None
    rows = first_rows(wm.window(source, mark), key, wm.stamp)
    if not store.exists(table):
        return rows
    if all_keys or mark is None:
        held = store.read(table)
    else:
        parts = wm.parts_since(store, table, mark) if wm.by_month else None
        held = wm.window(store.read(table, parts), mark)
    return rows.join(held.select(key), key, "left_anti").select(*source.columns)


def measures(wm: Watermark) -> dict[str, Column]:
    """What a staged write counts for its commit: rows, and the largest stamp in microseconds."""
    return {"rows": F.count(F.lit(1)), "mark": F.unix_micros(F.max(F.col(wm.stamp).cast("timestamp")))}


def next_mark(store: TableStore, staged: Staged, wm: Watermark) -> tuple[str, int] | None:
    """The mark after ``staged``: it never falls, and stays where nothing is stamped."""
    before = store.last_epoch(staged.name, wm.name)
    top = max((m for m in (staged.measured["mark"], before) if m is not None), default=None)
    return None if top is None else (wm.name, top)


def load_since_mark(source: DataFrame, store: TableStore, table: str, key: str, wm: Watermark,
                    all_keys: bool = False, transform=lambda rows: rows) -> int | None:
    """Append what is new and move the mark, in one commit; the version, None if nothing is new.

    ``transform`` makes the target's rows from the source's; it must keep ``key`` and the stamp.
    A load that dies before its commit leaves the old mark, so the next one reads the same window.
    """
    rows = transform(rows_since_mark(source, store, table, key, wm, all_keys))
    staged = store.stage(rows, table, parts=wm.part() if wm.by_month else None, measure=measures(wm))
    if store.exists(table) and not staged.measured["rows"]:
        return None
    store.commit(staged, "append", next_mark(store, staged, wm))
    return staged.version
