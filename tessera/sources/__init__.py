"""Table stores and connectors."""

from tessera.sources.store import TableStore
from tessera.sources.jdbc import publish, read_jdbc, run_in_transaction, write_jdbc
from tessera.sources.csv import export_csv, read_csv, read_csv_checked, rejects_report
from tessera.sources.raw import copy_tables, register_views, run_concurrently, run_sql
from tessera.sources.buckets import held_keys_report, lacking, read_bucketed, write_bucketed

__all__ = ["TableStore", "publish", "read_jdbc", "run_in_transaction", "write_jdbc", "export_csv",
           "read_csv", "read_csv_checked", "rejects_report", "copy_tables", "register_views",
           "run_concurrently", "run_sql", "held_keys_report", "lacking", "read_bucketed", "write_bucketed"]
