"""Ranks inside groups of any size.

A window over a group sorts all its rows in one task. Here the rows are dealt by ranges of
(group, order), so that a large group lies in many slices and equal rows in one; every slice is
ranked on its own, and the ranks used up by the slices before (one number per slice and group)
are added. The dealt rows are checkpointed, since both steps must see the same slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage


def sliced_dense_rank(df: DataFrame, group: list[str], order: list[Column], name: str,
                      slices: int | None = None) -> DataFrame:
    """``df`` with the dense rank of each row in its group by ``order`` (NULL keys form groups).
    ``slices``: how many ranges; by default as many as the session shuffles into."""
    keys = [F.col(k) for k in group]
    dealt = df.repartitionByRange(slices, *keys, *order) if slices else df.repartitionByRange(*keys, *order)
    dealt = cut_lineage(dealt.withColumn("_slice", F.spark_partition_id()))
    inside = dealt.withColumn("_rank", F.dense_rank().over(
        Window.partitionBy("_slice", *group).orderBy(*order)))
    used = inside.groupBy("_slice", *group).agg(F.max("_rank").alias("_used"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    names = {k: f"_g{i}" for i, k in enumerate(group)}
    before = used.select(F.col("_slice").alias("_s"), *[F.col(k).alias(a) for k, a in names.items()],
                         F.coalesce(F.sum("_used").over(earlier), F.lit(0)).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(a)) for k, a in names.items()]
    out = inside.join(before, [F.col("_slice") == F.col("_s"), *same])
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      (F.col("_rank") + F.col("_before")).cast("int").alias(name))
