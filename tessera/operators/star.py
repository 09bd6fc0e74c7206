"""Fact assembly, star flattening and incremental fact loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.lookup import (ChainStep, calendar_lookup, dim_lookup,
                                      lookup_chain, validity_lookup)
from tessera.operators.skew import (SkewSpec, collect_hot, hot_from_counts, key_counts,
                                    key_counts_of, rollup_counts, salted_join)
from tessera.session import scratch_dir


@dataclass(frozen=True)
class KeyLookup:
    """Natural key -> surrogate key (left join)."""
    dim: DataFrame
    fact_key: str
    dim_key: str
    sk: str
    out: str


@dataclass(frozen=True)
class ValidityLookup:
    """Natural key + event time -> surrogate key of the version valid then (left join)."""
    dim: DataFrame
    fact_key: str
    dim_key: str
    ts: str
    sk: str
    out: str
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    upper: str = "closed"


@dataclass(frozen=True)
class CalendarLookup:
    calendar: DataFrame
    ts: str
    out: str = "date_sk"


def build_fact(movements: DataFrame, chain: list[ChainStep], lookups: list,
               columns: list, loaded_at: Column | None = None,
               loaded_at_name: str = "loaded_at", skew: SkewSpec | None = None) -> DataFrame:
    """Key chain (inner), surrogate-key lookups (left), then the fact's columns.

    Movements whose chain breaks drop out (parity); a failed lookup leaves a NULL
    key in the row. ``loaded_at`` defaults to ``current_timestamp()`` (one value
    per query).

    Plan shape: the hops after the first and every ``KeyLookup`` keyed by a
    column the chain brings in are resolved on the dimension side first (a
    "bridge" with one row per first-hop key), so the movements, the big side,
    join once on the first key instead of once per hop and lookup. Lookups that
    need the movement's own columns (validity by event time, calendar) follow.
    ``skew`` splits hot keys in every join the movements take part in.
    """
    remaining = list(lookups)
    bridge, first = None, None
    if chain:
        first = chain[0]
        bridge = first.right.select(first.right_key,
                                    *[c for c in first.keep if c != first.right_key])
        bridge = lookup_chain(bridge, chain[1:])
        remaining = []
        for lk in lookups:
            if isinstance(lk, KeyLookup) and lk.fact_key in bridge.columns:
                bridge = dim_lookup(bridge, lk.dim, lk.fact_key, lk.dim_key, lk.sk, lk.out)
            else:
                remaining.append(lk)

    # Hot keys come from one count per first-hop key on the movements scan,
    # written once; keys further down the chain are rolled up through the bridge
    # (dimension-sized), so the joined fact is never evaluated to find them.
    counts = None
    if skew is not None and chain:
        path = scratch_dir(movements.sparkSession, "key-counts")
        key_counts(movements, first.left_key).write.parquet(path)
        counts = movements.sparkSession.read.parquet(path)

    def hot_for(key: str):
        if skew is None:
            return None
        if chain and key == first.left_key:
            return collect_hot(hot_from_counts(counts, skew))
        if chain and key in bridge.columns:
            return collect_hot(hot_from_counts(
                rollup_counts(counts, bridge, first.right_key, key), skew))
        return None  # counted on the frame itself

    if chain:
        if skew is None:
            if first.left_key == first.right_key:
                df = movements.join(bridge, on=first.left_key, how="inner")
            else:
                df = movements.join(bridge, movements[first.left_key] == bridge[first.right_key],
                                    "inner")
        else:
            hot = hot_for(first.left_key)
            if first.left_key == first.right_key:
                b2 = bridge.withColumnRenamed(first.right_key, "__bridge_key")
                df = salted_join(movements, b2, first.left_key, "__bridge_key", skew,
                                 "inner", hot=hot).drop("__bridge_key")
            else:
                df = salted_join(movements, bridge, first.left_key, first.right_key, skew,
                                 "inner", hot=hot)
    else:
        df = movements
    for lk in remaining:
        if isinstance(lk, KeyLookup):
            df = dim_lookup(df, lk.dim, lk.fact_key, lk.dim_key, lk.sk, lk.out, skew=skew,
                            hot=hot_for(lk.fact_key))
        elif isinstance(lk, ValidityLookup):
            df = validity_lookup(df, lk.dim, lk.fact_key, lk.dim_key, lk.ts, lk.sk,
                                 lk.out, lk.valid_from, lk.valid_to, lk.upper, skew=skew,
                                 hot=hot_for(lk.fact_key))
        elif isinstance(lk, CalendarLookup):
            # One row per day: always under the broadcast size check, so a busy
            # day never concentrates in one task and needs no salting.
            df = calendar_lookup(df, lk.calendar, lk.ts, lk.out)
        else:
            raise TypeError(f"unknown lookup {lk!r}")
    ts = F.current_timestamp() if loaded_at is None else loaded_at
    return df.select(*columns, ts.alias(loaded_at_name))


@dataclass(frozen=True)
class StarJoin:
    """Join ``dim`` on ``fact[fact_sk] = dim[dim_sk]``; ``columns`` maps dim column -> output name."""
    dim: DataFrame
    fact_sk: str
    dim_sk: str
    columns: dict[str, str]


def star_hot_keys(fact: DataFrame, keys: list[str], skew: SkewSpec) -> dict[str, dict]:
    """Hot keys and their buckets for each of ``keys``; keys of one type share a pass."""
    by_type: dict[str, list[str]] = {}
    for k, kind in fact.select(*dict.fromkeys(keys)).dtypes:
        by_type.setdefault(kind, []).append(k)
    out: dict[str, dict] = {k: {} for k in keys}
    for same in by_type.values():
        counts = key_counts_of(fact, same)
        total = counts.agg((F.coalesce(F.sum("__n"), F.lit(0)) / len(same)).alias("t")).scalar()
        limit = total * F.lit(skew.share)
        for r in counts.where(F.col("__n") > limit).select(
                "__at", "__hk", F.ceil(F.col("__n") / limit).cast("int").alias("b")).collect():
            out[same[r["__at"]]][r["__hk"]] = r["b"]
    return out


def flatten(fact: DataFrame, joins: list[StarJoin], fact_columns: dict[str, str],
            how: str = "inner", order: list[str] | None = None,
            skew: SkewSpec | None = None) -> DataFrame:
    """Fact joined to its dimensions on surrogate keys, renamed to a flat layout.

    ``how='inner'`` (parity) silently drops fact rows with a NULL or unknown key;
    ``null_key_report`` counts them, ``how='left'`` keeps them.
    Each dimension is pruned to its key plus exported columns before the join;
    ``skew`` splits hot surrogate keys (a holder with a third of the movements);
    all keys of one type are counted in one pass over ``fact``, which should be a
    stored table, since that pass evaluates it.
    """
    df = fact.select(*[F.col(c).alias(c) for c in
                       dict.fromkeys(list(fact_columns) + [j.fact_sk for j in joins])])
    hot = star_hot_keys(df, [j.fact_sk for j in joins], skew) if skew is not None else {}
    out = [F.col(c).alias(a) for c, a in fact_columns.items()]
    for i, j in enumerate(joins):
        k = f"__star_k{i}"
        right = j.dim.select(F.col(j.dim_sk).alias(k),
                             *[F.col(c).alias(a) for c, a in j.columns.items()])
        if skew is not None:
            df = salted_join(df, right, j.fact_sk, k, skew, how, hot=hot[j.fact_sk]).drop(k)
        else:
            df = df.join(right, df[j.fact_sk] == right[k], how).drop(k)
        out += [F.col(a) for a in j.columns.values()]
    res = df.select(*out)
    if order:
        res = res.select(*order)
    return res


def incremental(existing: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not yet in ``existing``: what an append may add.

    A left anti join; only the key column of the existing fact is read.
    """
    return batch.join(existing.select(key), key, "left_anti")
