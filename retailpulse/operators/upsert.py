"""Key-based write semantics over DataFrames (file tables have no MERGE).

All three are anti-join + union plans: one shuffle on the key per side, no per-key
Python, and the batch is deduplicated by an aggregate (partial aggregation bounds hot
keys). Rows of the target that the batch does not touch keep their old audit stamp;
nothing is ever deleted except by an explicit replace_by_key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dedupe_last(batch: DataFrame, keys: list[str], order: list[str] | None) -> DataFrame:
    """One row per key; the row with the greatest ``order`` wins (all columns break ties)."""
    cols = batch.columns
    rest = [c for c in cols if c not in keys]
    order_cols = [F.col(c) for c in (order or [])]
    packed = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c).alias(c) for c in rest])
    out = batch.groupBy(*keys).agg(F.max(packed).alias("_m"))
    return out.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in rest]).select(*cols)


def _absent(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key ``other`` does not have; NULL key parts equal each other, so a row with
    one is found again by the next load."""
    o = other.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return rows.join(o, same, "left_anti")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[str] | None = None,
           stamp_col: str | None = None, stamp: Column | None = None) -> DataFrame:
    """Insert new keys, replace every non-key column of existing keys (ON CONFLICT DO
    UPDATE). Duplicate keys inside the batch: the last by ``order`` wins. When
    ``stamp_col`` is given, batch rows get ``stamp`` (default: current_timestamp())."""
    b = dedupe_last(batch, keys, order)
    if stamp_col:
        b = b.withColumn(stamp_col, stamp if stamp is not None else F.current_timestamp())
    kept = _absent(target, b, keys)
    return kept.unionByName(b.select(*target.columns))


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str],
                     order: list[str] | None = None) -> DataFrame:
    """Insert only keys the target lacks (ON CONFLICT DO NOTHING)."""
    b = dedupe_last(batch, keys, order)
    new = _absent(b, target, keys)
    return target.unionByName(new.select(*target.columns))


def replace_by_key(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Delete every target row whose key appears in the batch, then insert all batch
    rows (several rows per key allowed: e.g. replace whole days)."""
    kept = _absent(target, batch, keys)
    return kept.unionByName(batch.select(*target.columns))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Add absent columns with a default value (an explicit NULL is kept, like a DB
    column default); ``'now'`` means the load time."""
    for name, value in defaults.items():
        if name in df.columns:
            continue
        if isinstance(value, Column):
            col = value
        else:
            col = F.current_timestamp() if value == "now" else F.lit(value)
        df = df.withColumn(name, col)
    return df
