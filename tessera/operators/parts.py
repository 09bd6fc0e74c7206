"""Type-2 dimensions stored in hash parts of the natural key: a load rewrites only the parts
that hold a changed id.

Detection reads the source and, of the dimension, the key and the tracked
attributes; the parts to rewrite follow from the ids found changed, and one commit
names their new folders together with the old folders of all other parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.quality import gate, key_uniqueness_report
from tessera.operators.scd2 import Scd2Spec, changed_rows, empty_dimension, merge
from tessera.operators.sequence import largest
from tessera.session import stored
from tessera.sources.store import TableStore


#: A part's number also says how many parts there are, so that a table of another number is
#: recognised (and written anew) instead of looked up in the wrong part.
LAYOUT = 1_000_000


def key_part(key: str, parts: int) -> Column:
    """The part of a key: its hash modulo ``parts``, behind the number of parts."""
    if not 0 < parts < LAYOUT:
        raise ValueError(f"parts must lie between 1 and {LAYOUT - 1}")
    return F.lit(parts * LAYOUT).cast("long") + F.pmod(F.hash(F.col(key)), F.lit(parts))


def merge_parts(store: TableStore, table: str, src: DataFrame, spec: Scd2Spec, parts: int,
                now: Column | None = None, epoch: tuple[str, int] | None = None,
                check_keys: bool = True) -> set[str]:
    """Merge ``src`` into ``store[table]``; the parts rewritten (none if nothing changed).

    A table that does not exist, or is not stored in this number of parts, is written as a whole. The new version is committed only if its surrogate keys
    are unique in the whole dimension (unless ``check_keys`` is off).
    """
    part = key_part(spec.key, parts)
    known = {str(parts * LAYOUT + p) for p in range(parts)}
    exists = store.exists(table)
    dim = store.read(table) if exists else empty_dimension(src.sparkSession, src.schema, spec)
    changed = stored(changed_rows(src, dim, spec), "changed")
    touched = {str(r[0]) for r in changed.select(part).distinct().collect()}  # ``parts`` at most
    laid_out = exists and len(store.parts(table)) > 0 and store.parts(table) <= known
    if exists and not touched:
        return set()
    old = store.read(table, touched) if laid_out else dim
    last = largest(dim, spec.sk) if spec.consecutive else None
    staged = store.stage(merge(changed, old, spec, now, changed=changed, last_key=last), table, parts=part)
    if check_keys:
        whole = store.read_staged(staged).select(spec.sk)
        if laid_out:
            whole = whole.unionByName(store.read(table, store.parts(table) - touched).select(spec.sk))
        gate(**{f"{table}_sk_unique": key_uniqueness_report(whole, spec.sk)})
    store.commit(staged, "replace" if laid_out else "overwrite", epoch,
                 replaced=touched if laid_out else None)
    return touched if laid_out else known
