"""Weekly opportunity score ("radar") per keyword and per category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import round_half_up
from ..functions.text import norm_txt
from .ranks import sliced_dense_rank

# Score weights (searches, interest, campaign week).
WEIGHTS = (0.55, 0.35, 0.10)

def radar_keyword(kw_weeks: DataFrame, interest: DataFrame, calendar: DataFrame,
                  bench: DataFrame, weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """Score each (week, category, keyword): weighted sum of searches and interest, each
    divided by its weekly maximum over the joined rows, plus a campaign flag.

    No window holds a week: the weekly maxima are aggregates, and the week is ranked in slices
    (``ranks.sliced_dense_rank``, which runs a job)."""
    kw = kw_weeks
    if "categoria_norm" not in kw.columns:
        kw = kw.withColumn("categoria_norm", norm_txt("categoria"))
    if "keyword_norm" not in kw.columns:
        kw = kw.withColumn("keyword_norm", norm_txt("keyword_canonica"))
    t = interest.select("week_start", "keyword_norm", "trends_interest")
    c = calendar.select("week_start", "categoria_norm", "is_campaign_week", "events")
    b = bench.select("categoria_norm", "kaggle_price_p50", "kaggle_n_prices")
    kw = (kw.join(t, ["week_start", "keyword_norm"], "left")
          .withColumn("trends_interest", F.coalesce("trends_interest", F.lit(0))))
    tops = kw.groupBy("week_start").agg(F.max("searches").alias("_max_s"),
                                        F.max("trends_interest").alias("_max_t"))
    s = (kw.join(tops, ["week_start"], "left").join(c, ["week_start", "categoria_norm"], "left")
         .join(b, ["categoria_norm"], "left")
         .withColumn("is_campaign_week", F.coalesce("is_campaign_week", F.lit(0))))
    sn = F.coalesce(F.col("searches").cast("double") / F.nullif(F.col("_max_s").cast("double"), F.lit(0.0)), F.lit(0.0))
    tn = F.coalesce(F.col("trends_interest").cast("double") / F.nullif(F.col("_max_t").cast("double"), F.lit(0.0)), F.lit(0.0))
    w1, w2, w3 = weights
    raw = F.lit(w1) * sn + F.lit(w2) * tn + F.lit(w3) * F.col("is_campaign_week")
    scored = s.withColumn("_raw", raw).select(
        "week_start", "categoria", "keyword_canonica", "searches", "trends_interest",
        "is_campaign_week", "events", "kaggle_price_p50", "kaggle_n_prices",
        round_half_up(F.lit(100.0) * F.col("_raw"), 2).alias("score_total"),
        # rounded, so that scores that differ by float noise alone tie
        F.round("_raw", 12).alias("_order"))
    order = [F.col("_order").desc(), F.col("categoria").asc(), F.col("keyword_canonica").asc()]
    return sliced_dense_rank(scored, ["week_start"], order, "rank_week").drop("_order")


def radar_category(radar: DataFrame) -> DataFrame:
    """week_start, categoria, searches, trends_interest_avg, is_campaign_week,
    score_total_avg, rank_categoria (mean of the already rounded keyword scores)."""
    g = (radar.groupBy("week_start", "categoria")
         .agg(F.sum("searches").alias("searches"), F.avg("trends_interest").alias("_ti"),
              F.max("is_campaign_week").alias("is_campaign_week"),
              F.avg("score_total").alias("_avg")))
    w = Window.partitionBy("week_start").orderBy(
        F.round(F.col("_avg").cast("decimal(38,10)"), 10).desc(), "categoria")
    return g.select("week_start", "categoria", "searches",
                    round_half_up("_ti").alias("trends_interest_avg"), "is_campaign_week",
                    round_half_up("_avg").alias("score_total_avg"),
                    F.dense_rank().over(w).alias("rank_categoria"))


def dashboard_weekly(radar: DataFrame, coverage_before: DataFrame,
                     coverage_after: DataFrame) -> DataFrame:
    """One flat table: radar rows plus both weekly unmapped percentages."""
    b = coverage_before.select("week_start", F.col("unmapped_pct").alias("unmapped_pct_before"))
    a = coverage_after.select("week_start", F.col("unmapped_pct").alias("unmapped_pct_after"))
    return dashboard_from_shares(radar, b.join(a, "week_start", "full_outer"))


def dashboard_from_shares(radar: DataFrame, shares: DataFrame) -> DataFrame:
    """The same from ``dictionary.coverage_shares``."""
    return (radar.join(shares, "week_start", "left")
            .select("week_start", "categoria", "keyword_canonica", "searches",
                    "trends_interest", "is_campaign_week",
                    F.coalesce("events", F.lit("")).alias("events"), "kaggle_price_p50",
                    "score_total", "rank_week", "unmapped_pct_before", "unmapped_pct_after"))
