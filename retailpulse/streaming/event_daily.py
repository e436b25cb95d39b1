"""Incremental daily web facts (events, funnel, search terms) on Structured Streaming.

Funnel and search-term counts are streaming aggregates: state per key, events accepted up to
``watermark`` late, changed groups emitted in update mode through ``foreachBatch``:

* each micro-batch writes its changed rows into ``<target>/batch_id=<id>`` with
  overwrite, so a replayed batch (after a failure) rewrites the same folder
  (idempotent: exactly-once output together with the checkpoint);
* readers take, per key, the row of the highest batch id (``read_latest``); ``compact``
  folds the folders into one.

Distinct users and sessions cannot be kept by a streaming aggregate. ``run_event_daily_stream``
keeps them as one set of bitmaps per day (``operators.bitmaps``): a micro-batch is merged into the
bitmaps of the days it touches, however late, and only those days' bitmaps and counts are read
again. Its size follows the days and ids, not the events or the number of batches.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import bitmaps
from ..operators.upsert import dedupe_last
from ..session import cut_lineage
from ..sources.writers import clustered, read_if_exists

EVENT_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                "value DOUBLE, props STRING")
KEYS = ["day", "event_name"]
_STARTING = threading.Lock()


def wall_clock_instant(ts_ntz: Column) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP whose UTC wall clock equals it (independent of the
    session time zone), so 1-day windows are calendar days of the event time."""
    secs = (F.datediff(F.to_date(ts_ntz), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
            + F.hour(ts_ntz) * 3600 + F.minute(ts_ntz) * 60 + F.second(ts_ntz))
    return F.timestamp_seconds(secs)


def _day_of_window() -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"),
                      (F.unix_seconds(F.col("w.start")) / 86400).cast("int"))


def daily_funnel(events: DataFrame, watermark: str = "30 days") -> DataFrame:
    """Funnel steps per day as conditional counts (streaming or batch)."""
    from ..operators.web import FUNNEL_COLUMNS, FUNNEL_STEPS
    e = (events.where(F.col("event_name").isin(*FUNNEL_STEPS))
         .withColumn("_t", wall_clock_instant(F.col("ts"))).withWatermark("_t", watermark))
    agg = e.groupBy(F.window("_t", "1 day").alias("w")).agg(*[
        F.count_if(F.col("event_name") == s).alias(c) for s, c in zip(FUNNEL_STEPS, FUNNEL_COLUMNS)])
    return agg.select(_day_of_window().alias("day"), *FUNNEL_COLUMNS)


def daily_search_terms(search_events: DataFrame, watermark: str = "30 days") -> DataFrame:
    """Cleaned search terms per day (streaming or batch); rows need ts and search_term."""
    from ..functions.text import clean_search_term
    e = (search_events.select("ts", clean_search_term("search_term").alias("search_term"))
         .where(F.col("search_term").isNotNull())
         .withColumn("_t", wall_clock_instant(F.col("ts"))).withWatermark("_t", watermark))
    agg = e.groupBy(F.window("_t", "1 day").alias("w"), "search_term").agg(
        F.count(F.lit(1)).alias("event_count"))
    return agg.select(_day_of_window().alias("day"), "search_term", "event_count")


def _start(spark: SparkSession, writer, state_partitions: int | None):
    """Start a stateful query with ``state_partitions`` state-store partitions. Spark
    takes that number from ``spark.sql.shuffle.partitions`` when a query first starts
    (and keeps it in the checkpoint afterwards), so it is set only around ``start``.
    Default: the cluster's parallelism — the state here is bounded by the watermark
    (days x keys), not by the input volume."""
    if state_partitions is None:
        try:
            state_partitions = spark.sparkContext.defaultParallelism
        except Exception:  # noqa: BLE001 - no driver-side context
            return writer.start()
    key = "spark.sql.shuffle.partitions"
    with _STARTING:                    # the setting is the session's: one start at a time
        before = spark.conf.get(key)
        spark.conf.set(key, str(state_partitions))
        try:
            return writer.start()
        finally:
            spark.conf.set(key, before)


def run_daily_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                     build, keys: list[str], glob: str | None = None,
                     state_partitions: int | None = None) -> DataFrame:
    """Generic form: ``build(raw_stream) -> aggregated stream``; changed rows are upserted
    by ``keys`` through idempotent per-batch folders; returns the current table."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    built = build(reader.parquet(source_dir))
    w = (built.writeStream.outputMode("update")
         .foreachBatch(upsert_batch_writer(target))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    _start(spark, w, state_partitions).awaitTermination()
    return read_latest(spark, target, keys, built.schema)


def upsert_batch_writer(target: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}"))
    return write


def read_latest(spark: SparkSession, target: str, keys: list[str] = KEYS,
                schema=None) -> DataFrame:
    """Current table: per key, the row written by the highest micro-batch. A sink with no
    batch yet (no input so far) is an empty table with ``schema``."""
    df = read_if_exists(spark, target)
    if df is None:
        if schema is None:
            raise FileNotFoundError(target)
        return spark.createDataFrame([], schema)
    cols = [c for c in df.columns if c != "batch_id"]
    latest = dedupe_last(df, keys, ["batch_id"])
    return latest.select(*cols)


def compact(spark: SparkSession, target: str, keys: list[str] = KEYS) -> None:
    """Fold the batch folders of a sink into that of its highest batch, so that reading does
    not grow with the number of micro-batches. Run it while no batch is being written. If it
    stops half-way, ``read_latest`` still sees the same table: older folders only go after the
    whole table stands in the newest one."""
    df = read_if_exists(spark, target)
    if df is None:
        return
    batches = sorted(r["batch_id"] for r in df.select("batch_id").distinct().collect())
    current = cut_lineage(read_latest(spark, target, keys))
    current.write.mode("overwrite").parquet(f"{target}/batch_id={batches[-1]}")
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for old in batches[:-1]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/batch_id={old}"), True)


def daily_bitmaps_writer(target: str):
    """foreachBatch: number the batch's new ids, merge its bitmaps into those of its days, keep its
    event counts, then write the facts of its days. Every step overwrites what a replayed batch
    had written, and merging the same bitmaps twice changes nothing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = cut_lineage(batch.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")))
        seen = cut_lineage(bitmaps.seen_ids(batch))
        before = read_if_exists(spark, f"{target}/ids", bitmaps.IDS + ", batch_id BIGINT")
        known = before.where(F.col("batch_id") < batch_id).drop("batch_id") if before is not None else None
        fresh = cut_lineage(bitmaps.new_ids(seen, known))
        fresh.write.mode("overwrite").parquet(f"{target}/ids/batch_id={batch_id}")
        counts.write.mode("overwrite").parquet(f"{target}/counts/batch_id={batch_id}")
        ids = fresh if known is None else known.unionByName(fresh)
        days = counts.select(F.col("day").alias("_day")).distinct()
        touched = F.col("day").eqNullSafe(F.col("_day"))
        sets = bitmaps.bitmaps_of(seen, ids)
        held = read_if_exists(spark, f"{target}/bitmaps", bitmaps.BITMAPS)
        if held is not None:
            sets = held.join(days, touched, "left_semi").unionByName(sets)
        sets = cut_lineage(bitmaps.merged(sets))
        total = spark.read.schema("day DATE, event_name STRING, n BIGINT, batch_id BIGINT").parquet(f"{target}/counts")
        facts = cut_lineage(bitmaps.daily_facts(total.join(days, touched, "left_semi"), sets))
        for rows, name in ((sets, "bitmaps"), (facts, "facts")):
            (clustered(rows, ["day"])[0].write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("day").parquet(f"{target}/{name}"))
    return write


FACTS = "event_name STRING, event_count BIGINT, total_users BIGINT, sessions BIGINT, day DATE"


def run_event_daily_stream(spark: SparkSession, source_dir: str, target: str, checkpoint: str,
                           prepare, glob: str | None = None,
                           files_per_batch: int | None = None) -> DataFrame:
    """Process every file available under ``source_dir`` (availableNow trigger), then return
    the table of exact daily facts, equal to ``operators.web.event_daily`` over all events.
    ``prepare`` maps raw events to (day, event_name, user_id, session_id)."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = prepare(reader.parquet(source_dir))
    (stream.writeStream.foreachBatch(daily_bitmaps_writer(target))
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
     .awaitTermination())
    facts = read_if_exists(spark, f"{target}/facts", FACTS)
    if facts is None:
        facts = spark.createDataFrame([], FACTS)
    return facts.select("day", "event_name", "event_count", "total_users", "sessions")
