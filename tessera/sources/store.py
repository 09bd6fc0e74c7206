"""Parquet table store with immutable snapshots.

Parquet cannot be overwritten while it is being read (the SCD2 merge reads the
dimension it replaces), so each write goes to a fresh folder
``<root>/<table>/v<N>-<id>/`` and is then committed by writing a one-row marker
``<root>/<table>/_commits/c<N>/``. A marker holds the table's whole state: the
folders that make it up, their schema, and the last batch applied of each
stream. A job that dies mid-write, or a load a quality gate rejects, leaves an
unreferenced folder nobody reads; the next run stages into a new folder.

The schema in the marker is the one the table is read with, so types never
depend on the data: an empty load has its columns, an all-NULL partition column
keeps its type, and a text partition value ``0001`` stays text.

One writer per table at a time: a commit checks that its marker is not there
yet, but two writers racing past that check are not told apart (that would need
a transaction log). The root should be a shared folder (object store / HDFS) on
a cluster; old folders and markers are the operator's to expire.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Staged:
    """A written, not yet committed version."""
    name: str
    version: int
    path: str
    schema: str  # as JSON
    folders: tuple[tuple[str, str], ...]  # what a commit makes live
    measured: dict = field(default_factory=dict)  # what the write counted


#: Folder of the rows whose part is NULL.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def part_of(path: str) -> str | None:
    """The part a folder holds (``.../month=199801`` -> ``199801``), None for a whole table."""
    last = path.rstrip("/").rsplit("/", 1)[1]
    return last.split("=", 1)[1] if "=" in last else None


@dataclass(frozen=True)
class State:
    """What a table consists of: live folders (path, schema as JSON), last epoch by stream."""
    version: int
    folders: tuple[tuple[str, str], ...]
    epochs: dict[str, int]


_PART = "part"
_PARTITION = "partition"  # marks a folder's own partition columns in its schema
_MARKER = ("version long, folders array<struct<path: string, schema: string>>, "
           "epochs map<string, long>")


def _missing_path(e: AnalysisException) -> bool:
    cls = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    return (cls() if cls else "") == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


def _version(path: str) -> int:
    """The version that wrote a folder (``.../v00000012-<id>/part=7`` -> 12)."""
    return int(re.search(r"/v(\d{8,})-[0-9a-f]+(/|$)", path).group(1))


@dataclass
class TableStore:
    """Snapshot store under ``root``; ``prefix`` names the layer (``raw_``, ``dim_``...).

    The newest marker of a table is read once per store instance and replaced by
    what this instance commits, so one stage sees one consistent snapshot of
    each table; ``refresh()`` (or a new instance) sees other writers' later commits.
    """
    spark: SparkSession
    root: str
    prefix: str = ""
    _states: dict = field(default_factory=dict, init=False, repr=False)

    def _base(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.prefix}{name}"

    def _state(self, name: str) -> State | None:
        """The newest committed state, or None if the table does not exist.

        Only a missing path counts as "does not exist"; any other error (outage,
        permissions) propagates instead of being mistaken for a first load.
        """
        if name not in self._states:
            self._states[name] = self._read_state(name)
        return self._states[name]

    def _read_state(self, name: str) -> State | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self._base(name)}/_commits")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        if not path.getFileSystem(conf).exists(path):
            return None
        try:
            row = (self.spark.read.schema(_MARKER).option("recursiveFileLookup", "true")
                   .json(f"{self._base(name)}/_commits")
                   .orderBy(F.col("version").desc()).limit(1).collect())
        except AnalysisException as e:
            if _missing_path(e):
                return None
            raise
        if not row:
            return None
        return State(row[0]["version"], tuple((f["path"], f["schema"]) for f in row[0]["folders"]),
                     dict(row[0]["epochs"] or {}))

    def refresh(self, name: str | None = None) -> None:
        """Forget cached states so the next access sees other writers' commits."""
        if name is None:
            self._states.clear()
        else:
            self._states.pop(name, None)

    def current_version(self, name: str) -> int | None:
        s = self._state(name)
        return None if s is None else s.version

    def exists(self, name: str) -> bool:
        return self._state(name) is not None

    def _live(self, name: str) -> tuple[tuple[str, str], ...]:
        s = self._state(name)
        if s is None:
            raise FileNotFoundError(f"table {self.prefix}{name} has no committed version")
        return s.folders

    def live_paths(self, name: str) -> list[str]:
        """Folders that make up the table: the last overwrite and the appends after it."""
        return [p for p, _ in self._live(name)]

    def parts(self, name: str) -> set[str]:
        """The parts that have a live folder."""
        return {p for p in map(part_of, self.live_paths(name)) if p is not None}

    def last_epoch(self, name: str, stream: str) -> int | None:
        """The last batch of ``stream`` that a commit of this table applied."""
        s = self._state(name)
        return None if s is None else s.epochs.get(stream)

    def appends_since_overwrite(self, name: str) -> int:
        return len(self.versions(name)) - 1

    def compact(self, name: str, partition_by: list[str] | None = None,
                parts: Column | None = None, cluster: list[str] | None = None) -> int:
        """Rewrite the live folders (last overwrite + appends) as one overwrite version.

        A maintenance job of its own (no load calls it): it reads and writes the
        whole table. Rows are rebalanced first, so many small files become few; a
        table that is kept in parts needs them named again. Readers keep using the
        old folders until the new commit lands.
        """
        df = self.read(name)
        if parts is None:
            df = df.hint("rebalance", *(partition_by or []))
        staged = self.stage(df, name, partition_by, parts, cluster if parts is None else cluster or [])
        self.commit(staged)
        return staged.version

    def _frame(self, folders) -> DataFrame:
        """Folders of one schema are one scan of many paths; those with partition folders of
        their own are read one by one. The rest is a union by column name."""
        groups: dict[tuple[str, str], list[str]] = {}
        for path, schema in folders:
            partitioned = any(f["metadata"].get(_PARTITION) for f in json.loads(schema)["fields"])
            groups.setdefault((schema, path if partitioned else ""), []).append(path)
        out = None
        for (schema, _), paths in groups.items():
            fields = T.StructType([T.StructField(f.name, f.dataType, f.nullable)
                                   for f in T.StructType.fromJson(json.loads(schema)).fields])
            frame = self.spark.read.schema(fields).parquet(*paths).select(*fields.names)
            out = frame if out is None else out.unionByName(frame)
        return out

    def read(self, name: str, parts: set[str] | None = None) -> DataFrame:
        """The table, or the given parts of it (no other folder is listed or read)."""
        live = self._live(name)
        if parts is not None:
            kept = [f for f in live if part_of(f[0]) in parts]
            if not kept:
                return self._frame(live[:1]).where(F.lit(False))
            live = kept
        return self._frame(live)

    def versions(self, name: str) -> list[int]:
        """The versions whose rows make up the table."""
        return sorted({_version(p) for p in self.live_paths(name)})

    def read_version(self, name: str, version: int) -> DataFrame:
        """The live rows that one version wrote."""
        return self._frame([f for f in self._live(name) if _version(f[0]) == version])

    def read_last(self, name: str) -> DataFrame:
        """What the last commit wrote."""
        return self.read_version(name, self._state(name).version)

    def stage(self, df: DataFrame, name: str, partition_by: list[str] | None = None,
              parts: Column | None = None, cluster: list[str] | None = None,
              measure: dict[str, Column] | None = None) -> Staged:
        """Write ``df`` as the next version without committing it (write-audit-publish).

        ``parts``, a whole number computed from a row, cuts the table into parts: each
        value's rows become a live folder of their own, which a later commit can
        replace alone (``mode="replace"``). ``cluster`` brings a part's rows together
        (large parts over several tasks, small ones into few) and sorts them by these
        columns, so that row groups prune on them. ``measure`` are aggregates counted
        while the rows are written, by the tasks that write them: a task that fails and
        runs again counts once.
        """
        v = (self.current_version(name) or 0) + 1
        path = f"{self._base(name)}/v{v:08d}-{uuid.uuid4().hex[:12]}"
        schema = df.schema.json()
        fields = T.StructType([T.StructField(f.name, f.dataType, f.nullable,
                                             {_PARTITION: True} if f.name in (partition_by or []) else {})
                               for f in df.schema.fields])
        split = list(partition_by or [])
        if parts is not None:
            df, split = df.withColumn(_PART, parts.cast("long")), [_PART]
        if split and cluster is not None:
            df = df.hint("rebalance", *split).sortWithinPartitions(*split, *cluster)
        watch = Observation() if measure else None
        if watch:
            df = df.observe(watch, *[c.alias(n) for n, c in measure.items()])
        w = df.write.mode("errorifexists")
        (w.partitionBy(*split) if split else w).parquet(path)
        measured = watch.get if watch else {}
        if parts is None:
            return Staged(name, v, path, fields.json(), ((path, fields.json()),), measured)
        values = self.spark.read.schema(f"{_PART} long").parquet(path).distinct().collect()
        folders = sorted(f"{path}/{_PART}={NULL_PART if r[0] is None else r[0]}" for r in values)
        if not folders:  # no rows: an empty part that holds the schema
            folders = [f"{path}/{_PART}={NULL_PART}"]
            df.drop(_PART).limit(0).coalesce(1).write.parquet(folders[0])
        return Staged(name, v, path, schema, tuple((f, schema) for f in folders), measured)

    def read_staged(self, staged: Staged) -> DataFrame:
        return self._frame(staged.folders)

    def commit(self, staged: Staged, mode: str = "overwrite",
               epoch: tuple[str, int] | None = None, replaced: set[str] | None = None) -> None:
        """Publish a staged version: ``overwrite`` replaces the table, ``append`` adds to it,
        ``replace`` takes the place of the parts ``replaced`` (all parts that the version
        itself holds, if None) and leaves the folders of the others as they are.
        ``epoch`` records (stream, batch), or (stream, high-water mark), as applied."""
        if mode not in ("overwrite", "append", "replace"):
            raise ValueError("mode must be 'overwrite', 'append' or 'replace'")
        before = self._state(staged.name)
        live = before.folders if before and mode != "overwrite" else ()
        if mode == "replace":
            gone = {part_of(f) for f, _ in staged.folders} if replaced is None else replaced
            live = tuple(f for f in live if part_of(f[0]) not in gone)
        epochs = dict(before.epochs if before else {})
        if epoch:
            epochs[epoch[0]] = epoch[1]
        state = State(staged.version, (*live, *staged.folders), epochs)
        row = (state.version, [{"path": p, "schema": s} for p, s in state.folders], epochs)
        (self.spark.createDataFrame([row], _MARKER).coalesce(1).write.mode("errorifexists")
         .json(f"{self._base(staged.name)}/_commits/c{staged.version:08d}"))
        self._states[staged.name] = state

    def write(self, df: DataFrame, name: str, partition_by: list[str] | None = None,
              mode: str = "overwrite", epoch: tuple[str, int] | None = None,
              parts: Column | None = None) -> int:
        """Write ``df`` as the next version and commit it. Returns the version."""
        staged = self.stage(df, name, partition_by, parts)
        self.commit(staged, mode, epoch)
        return staged.version
