"""Sinks: full refresh tables and CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ROWS_PER_FILE = 2_000_000
FILES_PER_TASK = 32


def clustered(df: DataFrame, partition_by: list[str], rows_per_file: int = ROWS_PER_FILE) -> tuple[DataFrame, int]:
    """The rows dealt out for a write by ``partition_by``, and their number: all rows of a small
    partition value lie in one task (one file), those of a large one in a task for every
    ``rows_per_file``, and a task holds the rows of some ``FILES_PER_TASK`` files. One job counts
    the rows per value; it reads the partition columns only."""
    files = F.ceil(F.col("_n") / rows_per_file)
    sizes = df.groupBy(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(partition_by)]).agg(
        F.count(F.lit(1)).alias("_n"))
    total = sizes.agg(F.sum("_n").alias("rows"), F.sum(files).alias("files")).first()
    n_files = int(total["files"] or 0)
    if n_files <= 1:
        return df.coalesce(1), int(total["rows"] or 0)
    tasks = max(-(-n_files // FILES_PER_TASK), min(n_files, df.sparkSession.sparkContext.defaultParallelism))
    large = sizes.where(files > 1).withColumn("_files", files)
    same = [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(partition_by)]
    # by what the row holds, so that a task that runs again deals its rows alike
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce("_files", F.lit(1)))
    dealt = df.join(large, same, "left").withColumn("_part", part)
    return dealt.repartition(tasks, *partition_by, "_part").select(*[F.col(f"`{c}`") for c in df.columns]), int(total["rows"])


def write_full_refresh(df: DataFrame, path: str, partition_by: list[str] | None = None,
                       fmt: str = "parquet") -> None:
    """TRUNCATE + INSERT: replace the whole table (optionally partitioned, e.g. by day,
    so later reads prune partitions). Empty input writes an empty table, not an error."""
    if partition_by:
        clustered(df, partition_by)[0].write.mode("overwrite").format(fmt).partitionBy(*partition_by).save(path)
    else:
        df.write.mode("overwrite").format(fmt).save(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header line; an empty DataFrame still yields a header-only file.
    ``single_file`` coalesces to one file for small exports only."""
    d = df.coalesce(1) if single_file else df
    d.write.mode("overwrite").option("header", True).csv(path)


def register_views(datasets: dict[str, DataFrame], columns: dict[str, list[str]] | None = None) -> None:
    """Named datasets for SQL users: each DataFrame (optionally projected) becomes a
    temporary view, e.g. {'v_sales_daily': sales_daily(bills)}."""
    for name, df in datasets.items():
        cols = (columns or {}).get(name)
        (df.select(*cols) if cols else df).createOrReplaceTempView(name)


def read_if_exists(spark, path: str, schema=None) -> DataFrame | None:
    """The Parquet table below ``path``; None if there is no such path. Any other error is
    raised: a table that cannot be read must not be taken for a missing one."""
    from pyspark.errors import AnalysisException

    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def upsert_partitions(spark, path: str, batch: DataFrame, keys: list[str],
                      partition_col: str = "day", order: list[str] | None = None) -> int:
    """Key upsert into a table stored under ``path`` and partitioned by ``partition_col``,
    rewriting only the partitions the batch touches (the rest are never read or
    written). The touched partitions are merged (``operators.upsert.upsert``), the result
    is checkpointed (the path is also the source) and written with dynamic partition
    overwrite. A missing table is created, from one row per key as well. Returns the number
    of rows written.

    ``keys`` must contain the partition column: a row can then not move to another partition
    and leave its old self behind."""
    from ..operators.upsert import dedupe_last, upsert
    from ..session import cut_lineage

    if partition_col not in keys:
        raise ValueError(f"the keys {keys} must contain the partition column {partition_col!r}")
    target = read_if_exists(spark, path)
    if target is None:
        merged = dedupe_last(batch, keys, order)
    else:
        touched = batch.select(F.col(partition_col).alias("_p")).distinct()
        current = target.join(touched, F.col(partition_col).eqNullSafe(F.col("_p")), "left_semi")
        merged = upsert(current, batch.select(*target.columns), keys, order)
    dealt, rows = clustered(cut_lineage(merged), [partition_col])
    (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return rows
