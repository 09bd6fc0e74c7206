"""DataFrame -> DataFrame operators of the warehouse build."""

from tessera.operators.lookup import (ChainStep, calendar_lookup, dim_lookup,
                                      lookup_chain, validity_condition, validity_lookup)
from tessera.operators.scd2 import (Scd2Spec, changed_rows, empty_dimension,
                                    expired_keys, first_load, merge, new_versions)
from tessera.operators.dims import calendar, calendar_for, type1_upsert
from tessera.operators.quality import (QualityError, duplicate_keys, gate,
                                       evaluate, key_uniqueness_report, null_key_report,
                                       orphan_report, require, row_count_report)
from tessera.operators.star import (CalendarLookup, KeyLookup, StarJoin, ValidityLookup,
                                    build_fact, flatten, incremental)
from tessera.operators.skew import (SkewSpec, collect_hot, hot_from_counts, hot_keys,
                                    key_counts, key_counts_of, rollup_counts, salted_join)
from tessera.operators.layers import (clean, trusted_account, trusted_card,
                                      trusted_holder, trusted_movement)

__all__ = [n for n in dir() if not n.startswith("_")]
