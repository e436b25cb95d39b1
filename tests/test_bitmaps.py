import datetime as dt
import random

from pyspark.sql import functions as F

from retailpulse.operators import bitmaps as B, web
from retailpulse.streaming.event_daily import FACTS, daily_bitmaps_writer

COLS = ["day", "event_name", "event_count", "total_users", "sessions"]


def events(spark, n=4000, seed=1):
    rng = random.Random(seed)
    day = lambda: rng.choice([None, *[dt.date(2026, 1, d) for d in range(1, 6)]])
    some = lambda: rng.choice([None, 7, -3, 0, 10 ** 15, rng.randint(1, 40_000)])
    rows = [(day(), rng.choice(["a", "b", None]), some(), some()) for _ in range(n)]
    rows += [(dt.date(2026, 1, 1), "hot", 5, 6)] * (n // 2)
    return spark.createDataFrame(rows, "day date, event_name string, user_id long, session_id long")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=str)


def test_bitmaps_equal_distinct_counts(spark):
    ev = events(spark)
    assert rows_of(B.event_daily_bitmap(ev)) == rows_of(web.event_daily(ev))
    assert rows_of(B.event_daily_bitmap(ev.limit(0))) == []


def test_numbers_are_dense_and_go_on(spark):
    seen = B.seen_ids(events(spark))
    first = B.new_ids(seen.where("id < 20000")).cache()
    more = B.new_ids(seen, first).cache()
    both = first.unionByName(more)
    for kind in B.KINDS:
        numbers = sorted(r["dense"] for r in both.where(F.col("kind") == kind).collect())
        assert numbers == list(range(1, len(numbers) + 1))
    assert both.select("kind", "id").distinct().count() == both.count() == seen.select("kind", "id").distinct().count()


def test_batches_late_days_and_replays(spark, tmp_dir):
    """Every batch holds rows of every day; one is replayed after the next has begun."""
    ev = events(spark).withColumn("part", F.pmod(F.xxhash64("user_id", "session_id", F.rand(3)), F.lit(3))).cache()
    ev.count()
    write = daily_bitmaps_writer(f"{tmp_dir}/t")
    for batch_id in (0, 1, 1, 2, 2):
        write(ev.where(F.col("part") == batch_id).drop("part"), batch_id)
    facts = spark.read.schema(FACTS).parquet(f"{tmp_dir}/t/facts")
    assert rows_of(facts) == rows_of(web.event_daily(ev))
    sets = spark.read.schema(B.BITMAPS).parquet(f"{tmp_dir}/t/bitmaps")
    assert sets.groupBy("day", "event_name", "kind", "bucket").count().where("count > 1").count() == 0
