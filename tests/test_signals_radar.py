import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailpulse.operators import benchmark, radar, signals

CAL = "event_name string, event_type string, start_date date, end_date date, city string, " \
      "tags array<string>, prioridad int, notes string"
D = dt.date
# The reference's commercial calendar seed (8 events).
SEED = [
    ("Verano", "SEASON", D(2026, 1, 1), D(2026, 3, 31), "Lima", ["Belleza", "Moda", "Hogar"], 2, None),
    ("Regreso a clases (aprox)", "SEASON", D(2026, 2, 1), D(2026, 3, 31), "Lima", ["Escolar", "Bebes"], 1, None),
    ("Cyber (ventana aprox)", "CAMPAIGN", D(2026, 4, 1), D(2026, 4, 30), "Lima", ["Tecnologia", "Hogar", "Moda"], 1, None),
    ("Dia de la Madre", "HOLIDAY", D(2026, 5, 1), D(2026, 5, 10), "Lima", ["Moda", "Belleza", "Hogar"], 1, None),
    ("Invierno", "SEASON", D(2026, 6, 1), D(2026, 8, 31), "Lima", ["Moda", "Hogar"], 2, None),
    ("Dia del Padre", "HOLIDAY", D(2026, 6, 8), D(2026, 6, 21), "Lima", ["Tecnologia", "Moda", "Automotriz"], 2, None),
    ("Fiestas Patrias", "HOLIDAY", D(2026, 7, 20), D(2026, 7, 29), "Lima", ["Hogar", "Tecnologia", "Moda"], 1, None),
    ("Navidad", "HOLIDAY", D(2026, 12, 1), D(2026, 12, 25), "Lima", ["Tecnologia", "Hogar", "Moda", "Bebes"], 1, None),
]


def test_calendar_weekly_goldens(spark):
    cal = spark.createDataFrame(SEED, CAL)
    start = signals.calendar_weekly(cal, align="start").collect()
    # The grid spans 52 weeks; the weeks that carry events are a subset of it.
    weeks = sorted({r["week_start"] for r in start})
    assert (len(start), weeks[0], weeks[-1]) == (133, D(2026, 1, 1), D(2026, 12, 24))
    assert (weeks[-1] - weeks[0]).days // 7 + 1 == 52
    monday = signals.calendar_weekly(cal, align="monday").collect()
    weeks = sorted({r["week_start"] for r in monday})
    assert (len(monday), weeks[0], weeks[-1]) == (129, D(2025, 12, 29), D(2026, 12, 21))
    assert (weeks[-1] - weeks[0]).days // 7 + 1 == 52
    # Start-aligned weeks never meet Monday weeks (the reference's silent mismatch).
    assert not ({r["week_start"] for r in start} & {r["week_start"] for r in monday})
    row = [r for r in monday if r["week_start"] == D(2026, 2, 2) and r["categoria_norm"] == "bebes"][0]
    assert row["events"] == "Regreso a clases (aprox)" and row["best_priority"] == 1


def test_calendar_empty(spark):
    assert signals.calendar_weekly(spark.createDataFrame([], CAL)).count() == 0
    assert signals.calendar_weekly(spark.createDataFrame([], CAL), align="start").count() == 0


def test_interest_weekly_half_even(spark):
    pts = [(D(2026, 3, 2), "tv", "2"), (D(2026, 3, 3), "tv", "3"), (D(2026, 2, 16), "celular", "<1"),
           (D(2026, 2, 17), "celular", "7.9"), (D(2026, 2, 18), "celular", "140"),
           (D(2026, 2, 19), "celular", "bad")]
    df = spark.createDataFrame(pts, "day date, keyword string, value_text string")
    got = {(r["keyword_canonica"], r["week_start"]): r["interest"]
           for r in signals.interest_weekly(df).collect()}
    assert got == {("tv", D(2026, 3, 2)): 2, ("celular", D(2026, 2, 16)): 36}


def test_interest_norm_and_dedupe(spark):
    rows = [(D(2026, 2, 16), "Celular", "PE", None, 60), (D(2026, 2, 16), "celular", "PE", "", 69),
            (D(2026, 2, 16), "celular", "PE", "ALL", 50), (None, "x", "PE", "", 1)]
    df = spark.createDataFrame(rows, "week_start date, keyword_canonica string, geo string, region string, interest int")
    n = {r["keyword_norm"]: r["trends_interest"] for r in signals.interest_norm(df).collect()}
    assert n["celular"] == 69
    d = {(r["keyword_canonica"], r["region"]): r["interest"] for r in signals.interest_dedupe(df).collect()}
    assert d == {("Celular", "ALL"): 60, ("celular", "ALL"): 69}


def test_keyword_pick_and_seeds(spark):
    dim = spark.createDataFrame([("a", 2), ("b", 1), ("b", 1), ("c", 1)], "keyword_canonica string, prioridad int")
    assert [r[0] for r in signals.keyword_pick(dim, 2).collect()] == ["b", "c"]
    seeds = spark.createDataFrame([(" Celular ", 1), ("CELULAR", 2), ("", 3), ("tv", 4)], "k string, p int")
    assert [r[0] for r in signals.seed_keywords(seeds, "k", "p", 10).collect()] == ["Celular", "tv"]


def test_percentiles_and_min_samples(spark):
    rows = [("s", "c", float(v)) for v in (1, 2, 4, 8)]
    df = spark.createDataFrame(rows, "source string, category_norm string, price double")
    p = benchmark.grouped_percentiles(df, ["source", "category_norm"], "price").first()
    assert (p["p_0"], p["p_1"], p["p_2"]) == (1.75, 3.0, 5.0)
    assert benchmark.price_benchmark(df, min_samples=30).count() == 0
    assert benchmark.price_benchmark(df, min_samples=4).first()["price_p25"] == 1.75


def test_category_weekly_zero_revenue_is_null(spark):
    rows = [("s", "c", 5.0, D(2026, 1, 5)), ("s", "c", -5.0, D(2026, 1, 6)), ("s", "d", None, D(2026, 1, 6)),
            ("s", "", 1.0, D(2026, 1, 6)), ("s", "c", 1.0, None)]
    df = spark.createDataFrame(rows, "source string, category_norm string, price double, day date")
    got = {r["category_norm"]: (r["n_events"], r["revenue_proxy"]) for r in benchmark.category_weekly(df).collect()}
    assert got == {"c": (2, None), "d": (1, None)}


def test_benchmark_category_like_semantics(spark):
    bench = spark.createDataFrame([("electronics.audio", 10.0, 10), ("electronics", 99.0, 5),
                                   ("computers.x", 20.0, 30)], "category_norm string, price_p50 double, n_prices long")
    cmap = spark.createDataFrame([("Tecnología", "electronics.%"), ("Tecnología", "computers.%"),
                                  ("Hogar", "appliances.%")], "internal_categoria string, kaggle_pattern string")
    got = {r["categoria_norm"]: (r["kaggle_price_p50"], r["kaggle_n_prices"])
           for r in benchmark.benchmark_category(bench, cmap).collect()}
    assert got == {"tecnologia": (17.5, 40)}


def test_text_terms_top_k_ties(spark):
    docs = spark.createDataFrame([("s", "<b>alpha</b> beta beta gamma"), ("s", "alpha delta"),
                                  ("t", "only 12345 word")], "source string, text string")
    got = [(r["source"], r["term"], r["term_count"]) for r in
           benchmark.text_terms(docs, top=2).orderBy("source", F.col("term_count").desc(), "term").collect()]
    assert got == [("s", "alpha", 2), ("s", "beta", 2), ("t", "only", 1), ("t", "word", 1)]


def test_radar_score_and_rank(spark):
    kw = spark.createDataFrame([(D(2026, 2, 16), "Moda", "zapatillas", 10), (D(2026, 2, 16), "Tecnología", "celular", 5),
                                (D(2026, 2, 16), "Hogar", "sofa", 0)],
                               "week_start date, categoria string, keyword_canonica string, searches long")
    interest = spark.createDataFrame([(D(2026, 2, 16), "celular", 80)], "week_start date, keyword_norm string, trends_interest int")
    cal = spark.createDataFrame([(D(2026, 2, 16), "moda", 1, "Verano")],
                                "week_start date, categoria_norm string, is_campaign_week int, events string")
    bench = spark.createDataFrame([("tecnologia", 100.0, 5)], "categoria_norm string, kaggle_price_p50 double, kaggle_n_prices long")
    out = {r["keyword_canonica"]: r for r in radar.radar_keyword(kw, interest, cal, bench).collect()}
    assert out["zapatillas"]["score_total"] == 65.0      # 0.55 * 1 + 0.10 * 1
    assert out["celular"]["score_total"] == 62.5         # 0.55 * 0.5 + 0.35 * 1
    assert out["sofa"]["score_total"] == 0.0
    assert [out[k]["rank_week"] for k in ("zapatillas", "celular", "sofa")] == [1, 2, 3]
    assert out["celular"]["kaggle_price_p50"] == 100.0 and out["sofa"]["events"] is None
    cat = {r["categoria"]: r for r in radar.radar_category(radar.radar_keyword(kw, interest, cal, bench)).collect()}
    assert cat["Moda"]["rank_categoria"] == 1 and cat["Hogar"]["rank_categoria"] == 3


def test_like_join_equi_and_wildcard_paths(spark):
    rows = spark.createDataFrame([("electronics.audio",), ("electronics",), ("small.rod",), ("small.gear",),
                                  ("computers.x",)], "c string")
    pats = spark.createDataFrame([("electronics.%",), ("sm_ll.%",), ("small._o%",), ("computers.x",),
                                  ("%.gear",)], "p string")
    got = sorted((r["c"], r["p"]) for r in benchmark.like_join(rows, "c", pats, "p").collect())
    assert got == [("computers.x", "computers.x"), ("electronics.audio", "electronics.%"),
                   ("small.gear", "%.gear"), ("small.gear", "sm_ll.%"), ("small.rod", "sm_ll.%"),
                   ("small.rod", "small._o%")]


def test_exact_percentile_paths_agree_on_hot_group(spark):
    from retailpulse.operators.quantiles import exact_percentiles
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 20).cast("string")).alias("g"),
        (F.col("id") * 7919 % 1000).cast("double").alias("v"))
    ref = {r[0]: (r[1], [round(x, 9) for x in r[2]]) for r in df.groupBy("g").agg(
        F.count("v"), F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).collect()}
    got = {r["g"]: (r["n"], [round(r["p_0"], 9), round(r["p_1"], 9), round(r["p_2"], 9)])
           for r in exact_percentiles(df, ["g"], "v", (0.1, 0.5, 0.9)).collect()}
    assert got == ref


@pytest.mark.parametrize("setting", ["spark.sql.exchange.reuse", "spark.sql.adaptive.enabled"])
def test_percentiles_do_not_depend_on_the_plan(spark, setting):
    from retailpulse.operators.quantiles import exact_percentiles
    df = spark.range(300_000).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
        ((F.col("id") * 48271) % 300_007 - 1000).cast("double").alias("v"))
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        got = {r["g"]: [r["n"], r["p_0"], r["p_1"], r["p_2"]]
               for r in exact_percentiles(df, ["g"], "v", (0.25, 0.5, 0.75)).collect()}
    finally:
        spark.conf.set(setting, before)
    rows = {}
    for r in df.collect():
        rows.setdefault(r["g"], []).append(r["v"])
    assert got == {g: [len(v), *map(float, np.percentile(v, [25, 50, 75]))] for g, v in rows.items()}


def test_percentiles_of_awkward_values(spark):
    from retailpulse.operators.quantiles import exact_percentiles
    values = [0.0, -0.0, 1e-300, -1e-300, 5e-324, 1.0, 0.9999999999999999, 2.0, -2.0, 1e300, -1e300,
              3.0, 2.9999999999999996, float("nan"), None]
    df = spark.createDataFrame([(None, v) for v in values] + [("one", 4.5)], "g string, v double")
    got = {r["g"]: [r["n"], r["p_0"], r["p_1"], r["p_2"]]
           for r in exact_percentiles(df, ["g"], "v", (0.0, 0.5, 1.0)).collect()}
    assert got == {None: [13, -1e300, 5e-324 if sorted(v for v in values if v == v and v is not None)[6] == 5e-324
                          else sorted(v for v in values[:13])[6], 1e300], "one": [1, 4.5, 4.5, 4.5]}
