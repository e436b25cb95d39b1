"""Radix percentiles, the LIKE index, ranks over slices, the calendar sweep, clustered writes."""

import datetime as dt
import os
import random
import re
import struct

import numpy as np
from pyspark.sql import functions as F

from retailpulse.operators import benchmark, radar, signals
from retailpulse.operators.like_index import like_join, like_matches, pattern_pieces
from retailpulse.operators.quantiles import MOST, exact_percentiles, narrowed, value_code, value_counts, value_of
from retailpulse.operators.ranks import sliced_dense_rank
from retailpulse.sources.writers import clustered, write_full_refresh


def bits(v):
    """The IEEE bits of a double as an ordered signed integer."""
    n = struct.unpack("<q", struct.pack("<d", v))[0]
    return n if n >= 0 else -(n & (2 ** 63 - 1))


def test_value_codes_are_the_bits(spark):
    rng = random.Random(1)
    values = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"),
              1.0, 0.9999999999999999, 1.0000000000000002, 1.7e9, 8.0, 7.999999999999999]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(63)))[0] for _ in range(3000)]
    values += [2.0 ** k for k in range(-1074, 1024)] + [np.nextafter(2.0 ** k, 0) for k in range(-1022, 1024, 7)]
    values = [float(v) for v in values if v == v]
    df = spark.createDataFrame([(s * v,) for v in values for s in (1.0, -1.0)], "v double")
    rows = df.select("v", value_code(F.col("v")).alias("c")).withColumn("back", value_of(F.col("c"))).collect()
    assert all(r["c"] == bits(r["v"] + 0.0) and r["back"] == r["v"] for r in rows)


def test_percentiles_of_a_narrow_dense_range(spark):
    """200,000 different values of one group share their first 30 bits; no window holds them all."""
    n = 200_000
    df = spark.range(n).select(F.lit("g").alias("g"), (F.lit(1.7e9) + F.col("id") / 1024).alias("v"))
    r = exact_percentiles(df, ["g"], "v", (0.25, 0.5, 0.99)).first()
    want = np.percentile(1.7e9 + np.arange(n) / 1024, [25, 50, 99])
    assert [r["n"], r["p_0"], r["p_1"], r["p_2"]] == [n, *map(float, want)]
    ranks = {"_at0": F.col("n") - 1, "_at1": F.floor(F.col("n") / 2)}
    for most, bits_left in ((MOST, 16), (100, 16), (0, 0)):
        wanted, shift = narrowed(value_counts(df, ["g"], "v"), ["g"], ranks, most)
        rows = wanted.collect()
        assert shift == bits_left and len(rows) == 2 and all(r["_d"] <= max(most, 1) or shift == 0 for r in rows)


def test_percentiles_at_every_depth(spark):
    """The same results whether values are ranked at once or after all levels."""
    rng = random.Random(6)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1), rng.randint(-3, 3) * 1.0, 1e300, -1e-310, None]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    for most in (MOST, 20, 0):
        got = {r["g"]: [r["n"], r["p_0"], r["p_1"]] for r in exact_percentiles(df, ["g"], "v", (0.1, 0.5), most).collect()}
        for g in ("a", "b", None):
            v = sorted(x for k, x in rows if k == g and x is not None)
            lo = [v[int((len(v) - 1) * p)] for p in (0.1, 0.5)]
            assert got[g][0] == len(v)
            assert [abs(a - float(np.percentile(v, p))) <= 1e-9 or a == b for a, b, p in zip(got[g][1:], lo, (10, 50))] == [True, True]


def like(value, pattern):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.fullmatch(out, value, re.S) is not None


def test_like_index_equals_every_pair(spark):
    rng = random.Random(2)
    make = lambda letters, n: "".join(rng.choice(letters) for _ in range(rng.randint(0, n)))
    values = sorted({make("abcd.", 9) for _ in range(150)} | {"", "a_b", "100%", "é"})
    patterns = sorted({make("abcd.%%_", 7) for _ in range(150)} | {"%", "_", "___", "%bc%", "a\\_b", "100\\%", "%é"})
    rows = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)] + [(None, 0), (values[3], 9)], "c string, n int")
    pats = spark.createDataFrame([(p,) for p in patterns] + [(None,), (patterns[5],)], "p string")
    got = sorted((r["c"], r["n"], r["p"]) for r in like_join(rows, "c", pats, "p").collect())
    want = sorted((v, n, p) for v, n in [(v, i % 3) for i, v in enumerate(values)] + [(values[3], 9)]
                  for p in patterns + [patterns[5]] if like(v, p))
    assert got == want


def test_like_index_meets_few_values(spark):
    """Patterns that begin with a wildcard: each meets the values that hold its rarest piece."""
    words = [f"w{i:05d}x" for i in range(3000)]
    rows = spark.createDataFrame([(f"shop.{w}.end",) for w in words], "value string")
    pats = spark.createDataFrame([(f"%{w}%",) for w in words[::10]], "pattern string")
    assert like_matches(rows, pats).count() == 300
    plan = like_matches(rows, pats)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    pieces = pats.select(F.explode(pattern_pieces(F.col("pattern"))).alias("p")).where("length(p) < 3")
    assert pieces.count() == 0


def test_ranks_of_a_large_week_in_slices(spark):
    """One week of a million keywords, a third of them with one score."""
    n = 1_000_000
    df = spark.range(n).select(F.lit("w1").alias("week"), F.when(F.col("id") % 3 == 0, 0).otherwise(
        (F.col("id") * 48271) % 1009).alias("score"), (F.col("id") % 500_000).alias("kw"))
    df = df.unionByName(spark.createDataFrame([(None, 5, 1), (None, 5, 1), (None, 7, 2)], "week string, score bigint, kw bigint"))
    out = sliced_dense_rank(df, ["week"], [F.col("score").desc(), F.col("kw").asc()], "rank", slices=16)
    got = {(r["week"], r["score"], r["kw"]): r["rank"] for r in out.where("week is null").collect()}
    assert got == {(None, 7, 2): 1, (None, 5, 1): 2}
    big = out.where("week = 'w1'").toPandas()
    order = big[["score", "kw"]].drop_duplicates().sort_values(["score", "kw"], ascending=[False, True]).reset_index(drop=True)
    order["want"] = np.arange(1, len(order) + 1)
    assert len(big) == n and (big.merge(order, on=["score", "kw"]).eval("rank == want")).all()


def test_radar_has_no_window_over_a_week(spark):
    day = dt.date(2026, 2, 16)
    kw = spark.createDataFrame([(day, "Moda", f"k{i:04d}", i % 50) for i in range(500)],
                               "week_start date, categoria string, keyword_canonica string, searches long")
    interest = spark.createDataFrame([(day, "k0001", 40)], "week_start date, keyword_norm string, trends_interest int")
    cal = spark.createDataFrame([(day, "moda", 1, "x")], "week_start date, categoria_norm string, is_campaign_week int, events string")
    bench = spark.createDataFrame([("moda", 9.5, 3)], "categoria_norm string, kaggle_price_p50 double, kaggle_n_prices long")
    out = radar.radar_keyword(kw, interest, cal, bench)
    plan = out._jdf.queryExecution().analyzed().toString()
    windows = re.findall(r"windowspecdefinition\(([^)]*?)(?:ASC|DESC)", plan)
    assert windows and all("_slice" in w for w in windows)
    rows = sorted(out.collect(), key=lambda r: r["rank_week"])
    assert [r["rank_week"] for r in rows] == list(range(1, 501))
    assert rows[0]["keyword_canonica"] == "k0049" and rows[0]["score_total"] == 65.0
    key = [(-(0.55 * r["searches"] / 49 + 0.35 * r["trends_interest"] / 40), r["keyword_canonica"]) for r in rows]
    assert [round(k[0], 12) for k in key] == sorted(round(k[0], 12) for k in key)


def test_calendar_sweep_equals_a_row_per_week(spark):
    rng = random.Random(4)
    first = dt.date(1950, 1, 3)
    rows = [(f"e{i % 15}", first + dt.timedelta(days=rng.randint(0, 900)), rng.randint(-3, 400),
             [rng.choice(["Moda", "moda", "Hogar", "Té", None]) for _ in range(rng.randint(0, 3))], rng.choice([1, 2, 3, None]))
            for i in range(40)] + [("long", first, 7 * 5000, ["Moda"], 2)]
    rows = [(n, a, a + dt.timedelta(days=d), t, p) for n, a, d, t, p in rows]
    cal = spark.createDataFrame(rows, "event_name string, start_date date, end_date date, tags array<string>, prioridad int")
    for align in ("monday", "start"):
        anchor = min(r[1] for r in rows)
        want = {}
        for name, a, b, tags, p in rows:
            if a > b:
                continue
            at = a - dt.timedelta(days=a.weekday()) if align == "monday" else anchor
            while at <= b:
                if at + dt.timedelta(days=6) >= a:
                    for t in tags:
                        key = (at, {"Té": "te", None: ""}.get(t, (t or "").lower()))
                        have = want.setdefault(key, (set(), set()))
                        have[0].add(name)
                        have[1].update([p] if p is not None else [])
                at += dt.timedelta(days=7)
        got = {(r["week_start"], r["categoria_norm"]): (r["events"], r["best_priority"], r["is_campaign_week"])
               for r in signals.calendar_weekly(cal, align).collect()}
        assert got == {k: (" | ".join(sorted(n)), min(p) if p else None, 1) for k, (n, p) in want.items()}


def test_clustered_writes(spark, tmp_dir):
    """Small days are one file each; a large day is split by its rows."""
    df = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("d"), (F.col("id") % 200).cast("string"))).alias("day"), "id").repartition(7)
    dealt, rows = clustered(df, ["day"], rows_per_file=5000)
    assert rows == 50_000
    dealt.write.partitionBy("day").parquet(f"{tmp_dir}/t")
    files = {d: len([f for f in os.listdir(f"{tmp_dir}/t/{d}") if f.endswith(".parquet")])
             for d in os.listdir(f"{tmp_dir}/t") if d.startswith("day=")}
    assert files.pop("day=hot") in (4, 5) and set(files.values()) == {1} and len(files) == 100
    assert spark.read.parquet(f"{tmp_dir}/t").select("id").distinct().count() == 50_000
    nulls = df.withColumn("day", F.when(F.col("id") % 3 == 0, F.col("day")))
    write_full_refresh(nulls, f"{tmp_dir}/n", ["day"])
    assert spark.read.parquet(f"{tmp_dir}/n").count() == 50_000
    write_full_refresh(nulls.limit(0), f"{tmp_dir}/n", ["day"])
    assert spark.read.schema(nulls.schema).parquet(f"{tmp_dir}/n").count() == 0
