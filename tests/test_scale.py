"""Plans that must not grow with the tables: no large broadcast, nothing sorted or parsed twice."""

import os

import pytest
from pyspark.sql import functions as F

from retailpulse.operators import bitmaps, signals
from retailpulse.plans import adapters as A, queries as Q
from retailpulse.sources import csv as CSV, lines, refresh

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_id_dictionary_is_not_broadcast(spark):
    seen = spark.createDataFrame([("2024-01-01", "a", "user", 7), ("2024-01-01", "a", "user", 9),
                                  ("2024-01-02", "a", "user", 7)], "day string, event_name string, kind string, id long")
    seen = seen.withColumn("day", F.to_date("day"))
    known = spark.createDataFrame([("user", 7, 1)], bitmaps.IDS)
    fresh = bitmaps.new_ids(seen, known)
    assert [tuple(r) for r in fresh.collect()] == [("user", 9, 2)]
    sets = bitmaps.bitmaps_of(seen, known.unionByName(fresh))
    assert "ShuffledHashJoin" in plan(sets) and "[kind#" in plan(sets)
    counts = {str(r["day"]): r["n"] for r in sets.select("day", F.bitmap_count("bits").alias("n")).collect()}
    assert counts == {"2024-01-01": 2, "2024-01-02": 1}


@pytest.mark.parametrize("rows", [A.price_rows, A.search_events, A.interest_points, A.calendar])
def test_part_is_not_broadcast(spark, rows):
    p = plan(rows(spark, SF))
    assert "ShuffledHashJoin" in p and "BroadcastExchange" not in p


def test_first_lines_are_taken_without_a_sort(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/x/shop")
    body = "".join(f"line {i}\n" for i in range(4000))
    with open(f"{tmp_dir}/x/shop/a.csv", "w") as f:
        f.write("\n  \nhead a\n" + body)
    with open(f"{tmp_dir}/x/shop/b.csv", "w") as f:
        f.write("head b\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = lines.raw_lines(spark, f"{tmp_dir}/x", "*.csv").where("trim(value) <> ''")
        first = lines.first_lines(raw, 2)
        assert "Sort" not in plan(first)
        rows = first.collect()
        starts = sorted(r["block"] for r in rows if r["path"].endswith("a.csv"))
        assert len(set(starts)) > 5 and all(starts.count(b) <= 2 for b in starts)
        assert [r["value"] for r in sorted(rows, key=lambda r: (r["block"], r["n"]))
                if r["path"].endswith("a.csv")][:2] == ["head a", "line 0"]
        heads = CSV.header_lines(spark, f"{tmp_dir}/x")
        assert "MapInArrow" in plan(heads)
        assert sorted((r["source"], r["header"]) for r in heads.collect()) == [("shop", "head a"), ("shop", "head b")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lots_are_sorted_by_many_tasks(spark, tmp_dir):
    rows = [(i * 7 + lot, i % 3, "A", float(i), "1995-01-02") for lot in (0, 3) for i in range(300, 0, -1)]
    os.makedirs(f"{tmp_dir}/sf")
    (spark.createDataFrame([*rows, (None, 1, "A", 1.0, "1995-01-02")],
                           "l_orderkey long, l_linenumber int, l_returnflag string, l_extendedprice double, l_shipdate string")
     .withColumn("l_shipdate", F.to_date("l_shipdate")).write.parquet(f"{tmp_dir}/sf/lineitem.parquet"))
    root = A.write_csv_sample_drop(spark, f"{tmp_dir}/sf")
    for lot, sep in ((0, ","), (3, "^")):
        folder = f"{root}/lot={lot}"
        files = [f for f in os.listdir(folder) if f.endswith(".csv")]
        assert len(files) == 1
        with open(f"{folder}/{files[0]}") as f:
            keys = [line.split(sep)[0] for line in f]
        assert keys == ["l_orderkey", *[str(i * 7 + lot) for i in range(1, 301)]]
    runs = [d for d in os.listdir(os.path.dirname(root)) if d.startswith("csv-runs")]
    assert runs                                   # sorted there, the tasks that write a file only string them together


def test_refresh_works_its_rows_out_once(spark, tmp_dir):
    import datetime as dt
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    weeks = [dt.date(2024, 1, 1), dt.date(2024, 1, 8)]
    rows = spark.createDataFrame([(weeks[0], 1), (weeks[1], 2)], "week_start date, n int")
    build = lambda w: rows.mapInArrow(count, rows.schema)
    assert refresh.refresh_weeks(spark, f"{tmp_dir}/t", build, weeks) == 2
    assert seen.value == 2
    assert sorted(r["n"] for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [1, 2]


def test_readings_are_parsed_once(spark):
    points = spark.createDataFrame(
        [("2024-01-02", "a", ' "<1" '), ("2024-01-03", "a", "50.9"), ("2024-01-04", "a", "x"),
         ("2024-01-02", "b", "x"), ("2024-01-02", "c", "250")], "day string, keyword string, value_text string")
    weekly = signals.interest_weekly(points.withColumn("day", F.to_date("day")))
    assert plan(weekly).count("regexp_replace(") == 1
    assert {r["keyword_canonica"]: r["interest"] for r in weekly.collect()} == {"a": 25, "c": 100}


def test_dashboard_reads_the_search_events_once(spark):
    assert "events.parquet" not in plan(Q._dashboard(spark, SF, True))
