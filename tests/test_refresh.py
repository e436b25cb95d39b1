import datetime as dt
import os

from pyspark.sql import functions as F

from retailpulse.plans import queries as Q
from retailpulse.sources.refresh import in_weeks, refresh_weeks, touched_weeks

SF = "/root/testdata/sf0.001"
D = dt.date


def test_touched_weeks_and_ranges(spark):
    days = spark.createDataFrame([(D(2024, 1, 7),), (D(2024, 1, 8),), (None,), (D(2024, 1, 30),)], "day date")
    weeks = touched_weeks(days)
    assert weeks == [D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 29)]
    all_days = spark.sql("SELECT explode(sequence(DATE'2023-12-25', DATE'2024-02-10')) AS day")
    got = {r["day"] for r in in_weeks(all_days, weeks).collect()}
    assert got == {D(2024, 1, 1) + dt.timedelta(days=i) for i in (*range(14), *range(28, 35))}
    assert in_weeks(all_days, []).count() == 0


def test_refresh_rewrites_touched_weeks_only(spark, tmp_dir):
    path = f"{tmp_dir}/mart"
    rows = [(D(2024, 1, 1), "a", 1), (D(2024, 1, 8), "b", 2), (D(2024, 1, 15), "c", 3)]
    schema = "week_start date, k string, n int"
    df = spark.createDataFrame(rows, schema)
    assert refresh_weeks(spark, path, lambda weeks: df, [r[0] for r in rows]) == 3
    kept = set(os.listdir(f"{path}/week_start=2024-01-01"))
    new = spark.createDataFrame([(D(2024, 1, 8), "b2", 9), (D(2024, 1, 1), "not asked for", 0)], schema)
    assert refresh_weeks(spark, path, lambda weeks: new, [D(2024, 1, 8), D(2024, 1, 15)]) == 1
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(path).select("week_start", "k", "n").collect())
    assert got == [(D(2024, 1, 1), "a", 1), (D(2024, 1, 8), "b2", 9)]          # the week of the 15th is gone
    assert set(os.listdir(f"{path}/week_start=2024-01-01")) == kept
    assert refresh_weeks(spark, path, lambda weeks: new, []) == 0


def test_the_scan_reads_the_weeks_only(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    terms = Q.Inputs(spark, SF, in_weeks(events, [D(2024, 1, 8)], "ts")).terms
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = terms._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line and "event_type" in line]
    assert scans and all("GreaterThanOrEqual(ts,2024-01-08" in s and "LessThan(ts,2024-01-15" in s for s in scans)
    assert {r["day"] for r in terms.select("day").distinct().collect()} <= {D(2024, 1, 8) + dt.timedelta(days=i) for i in range(7)}
    assert terms.where(F.col("day").isNull()).count() == 0
