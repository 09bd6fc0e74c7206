"""tessera: warehouse-building operators on Spark DataFrames.

Layers:
  functions/  column expressions (text cleaning, ages, surrogate keys, calendar parts)
  operators/  DataFrame -> DataFrame steps (lookups, SCD2, dimensions, facts, gates)
  sources/    table stores, JDBC, CSV, layer copy
  plans/      the card-domain pipeline and the query set run on the test tables
  streaming/  file-source ingestion that feeds the same operators per micro-batch
"""

from tessera.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
