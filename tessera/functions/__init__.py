"""Column-expression helpers. All are built-in Spark expressions (codegen'd, JVM side)."""

from tessera.functions.text import normalize, split_name
from tessera.functions.dates import age_years, calendar_parts, date_key
from tessera.functions.keys import surrogate_key

__all__ = ["normalize", "split_name", "age_years", "calendar_parts", "date_key",
           "surrogate_key"]
