"""Data quality and profiling as distributed aggregates (one pass per check)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import safe_pct


def violations(df: DataFrame, rules: dict[str, Column], key_cols: list[str],
               value_col: str) -> DataFrame:
    """rule, key, value for rows where a CHECK-style rule is FALSE (NULL passes, as in
    SQL constraints). ``key`` joins the key columns with '|'."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    parts = [df.where(cond == F.lit(False))
             .select(F.lit(name).alias("rule"), key.alias("key"),
                     F.col(value_col).cast("string").alias("value"))
             for name, cond in rules.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicates(df: DataFrame, keys: list) -> DataFrame:
    """Key groups that occur more than once: keys..., n."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1))


def _unpivot(agg_row: DataFrame, names: list[str], value_name: str) -> DataFrame:
    return agg_row.unpivot([], names, "column_name", value_name)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """column_name, n_null: NULL count of each column (one aggregate pass)."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot(agg, cols, "n_null")


def profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """column_name, ordinal, n_rows, blank_pct: share of NULL-or-blank values per column
    (2 decimals). ``top`` keeps the most incomplete columns (ties by position)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[
        F.count_if(F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) == "")
        .alias(f"c{i}") for i, c in enumerate(cols)])
    stacked = agg.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i + 1).alias("ordinal"),
                 F.col(f"c{i}").alias("blank")) for i, c in enumerate(cols)])).alias("s"))
    out = stacked.select("s.column_name", "s.ordinal", F.col("_n").alias("n_rows"),
                         F.coalesce(safe_pct("s.blank", "_n"), F.lit(0.0)).alias("blank_pct"))
    if top:
        out = out.orderBy(F.col("blank_pct").desc(), "ordinal").limit(top)
    return out


def sanity_counts(datasets: dict[str, DataFrame]) -> DataFrame:
    """dataset, n_rows for every named DataFrame (UNION ALL of labelled counts)."""
    parts = [d.agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(name).alias("dataset"), "n_rows") for name, d in datasets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_n(df: DataFrame, order: list[Column], n: int = 5) -> DataFrame:
    """Report of the newest ``n`` rows (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int = 5, max_cols: int = 8) -> DataFrame:
    """A peek at up to ``n`` rows with at least one non-blank value, first ``max_cols``
    columns (a sampling report: the limit is the feature)."""
    cols = df.columns[:max_cols]
    nonblank = F.lit(False)
    for c in cols:
        nonblank = nonblank | (F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) != "")
    return df.where(nonblank).select(*[F.col(f"`{c}`") for c in cols]).limit(n)


def file_inventory(df: DataFrame) -> DataFrame:
    """file_path, file_size, n_rows for a file-based DataFrame (from hidden metadata)."""
    return (df.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("n_rows")))
