"""Layer copy: source tables into the raw layer, rows unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.store import TableStore


def run_concurrently(jobs: dict[str, Callable[[], object]], max_workers: int = 4) -> dict:
    """Run independent Spark actions from driver threads; Spark schedules their
    jobs side by side, so small tables do not leave executors idle in turn.
    The first failure is raised after all jobs finish."""
    if len(jobs) <= 1 or max_workers <= 1:
        return {k: fn() for k, fn in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(jobs))) as pool:
        futures = {k: pool.submit(fn) for k, fn in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def copy_tables(read: Callable[[str], DataFrame], target: TableStore,
                tables: Iterable[str], max_workers: int = 4) -> dict[str, int]:
    """For each table: read it from the source and write it as the next raw version.

    ``target.prefix`` (e.g. ``raw_``) names the layer. Tables are copied
    concurrently. Returns table -> version.
    """
    return run_concurrently({t: (lambda t=t: target.write(read(t), t)) for t in tables},
                            max_workers)


def register_views(read: Callable[[str], DataFrame], views: dict[str, str]) -> dict[str, DataFrame]:
    """Read each table and register it as a temp view: ``{table: view_name}``.

    Lets SQL text (CTEs, ``NOT EXISTS``) refer to tables by name; Catalyst plans
    it exactly like the DataFrame form.
    """
    out = {}
    for table, view in views.items():
        df = read(table)
        df.createOrReplaceTempView(view)
        out[view] = df
    return out


def run_sql(spark: SparkSession, text: str, frames: dict[str, DataFrame],
            values: dict[str, object] | None = None) -> DataFrame:
    """Spark SQL over the frames of this call only.

    ``text`` refers to frames as ``{name}`` and to values as ``:name``. No view of a fixed
    name is registered, so runs side by side in one session do not see each other's
    tables, and values travel as typed parameters, never as text.
    """
    return spark.sql(text, args=values, **frames)
