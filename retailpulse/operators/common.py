"""Shared operator helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Redistribute a scan that arrives in fewer than ``partitions`` partitions (a few large
    files or row groups), so that CPU-heavy work per row (regex tokenizing, JSON and CSV
    parsing) has that many tasks. It changes the plan only, never a result; the caller names
    the number. On a widely split input it adds no shuffle."""
    try:
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access (e.g. Spark Connect)
        return df
    return df.repartition(partitions) if current < partitions else df


def pick_first(df: DataFrame, keys: list, order: list, cols: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the one with the smallest ``order`` tuple (remaining columns
    break ties, so the pick is deterministic). An aggregate, not a window: map-side
    partial aggregation keeps a hot key from landing whole in one task."""
    cols = cols or [c for c in df.columns]
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                      *[F.col(c).alias(c) for c in cols])
    out = df.groupBy(*key_cols).agg(F.min(packed).alias("_m"))
    return out.select(*[F.col(f"_m.{c}").alias(c) for c in cols])
