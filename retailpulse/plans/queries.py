"""Registry of runnable queries over the benchmark tables: name -> fn(spark, sf_dir).

Each query composes adapters (plans/adapters.py) and operators; outputs expose money as
DOUBLE and counts as BIGINT so that they compare 1:1 with the oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import adapters as A
from ..functions.dates import parse_date_any, parse_yyyymmdd, resolve_range
from ..functions.numbers import price_value, safe_float
from ..functions.schema import conform, normalize_category
from ..functions.text import norm_txt
from ..operators import benchmark, bitmaps, dictionary as D, marketplace as M, quality as Q, radar
from ..operators import sales, signals, upsert as U, web
from ..session import cut_lineage, scratch_path, table
from ..sources import csv as CSV
from ..sources.interest_export import read_interest_exports
from ..streaming.event_daily import (daily_funnel, daily_search_terms, run_daily_stream,
                                     run_event_daily_stream)

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def _as(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c)
                       for c in df.columns])


MONEY_SALES = {c: "double" for c in
               ["revenue_total", "base_total", "vat_total", "discount_total"]}


# ---------------------------------------------------------------- sales ----
@query("sales_daily")
def q_sales_daily(spark, sf):
    return _as(sales.sales_daily(A.bills(spark, sf)), MONEY_SALES)


@query("product_daily")
def q_product_daily(spark, sf):
    df = sales.product_daily(A.bills(spark, sf), A.details(spark, sf), A.products(spark, sf))
    return _as(df, {"qty_sold": "double", "revenue": "double"})


@query("revenue_column_pick")
def q_revenue_column_pick(spark, sf):
    df = sales.product_daily(A.bills(spark, sf), A.details(spark, sf, revenue="unit_price"),
                             A.products(spark, sf))
    return _as(df, {"qty_sold": "double", "revenue": "double"})


@query("date_dimension_sales")
def q_date_dimension_sales(spark, sf):
    df = sales.sales_by_date_dimension(sales.sales_daily(A.bills(spark, sf)))
    return _as(df, {"revenue_total": "double", "year": "int", "month": "int"})


# ------------------------------------------------------------------ web ----
@query("event_daily")
def q_event_daily(spark, sf):
    return web.event_daily(A.raw_events(spark, sf))


@query("event_daily_bitmap")
def q_event_daily_bitmap(spark, sf):
    """Distinct users and sessions as bitmaps over dense ids; equals ``event_daily``."""
    return bitmaps.event_daily_bitmap(A.raw_events(spark, sf))


@query("funnel_daily")
def q_funnel_daily(spark, sf):
    return web.funnel_daily(A.raw_events(spark, sf))


@query("search_term_daily")
def q_search_term_daily(spark, sf):
    return web.search_term_daily(A.search_events(spark, sf))


@query("funnel_sales_daily")
def q_funnel_sales_daily(spark, sf):
    f = web.funnel_daily(A.raw_events(spark, sf))
    s = sales.sales_daily(A.bills(spark, sf, paid_day="web"))
    return _as(sales.funnel_sales_daily(f, s), {"revenue_total": "double"})


# ----------------------------------------------------------- dictionary ----



class Inputs:
    """Per-query inputs, each built once: consumers share the same DataFrame objects,
    so every shared subtree is planned once and its exchanges are reused."""

    def __init__(self, spark, sf, events=None):
        self.spark, self.sf, self.events = spark, sf, events

    @cached_property
    def dim(self):
        return D.dedupe_dictionary(A.dictionary_stage(self.spark, self.sf), trim=True)

    @cached_property
    def sdict(self):
        return D.search_dictionary(self.dim)

    @cached_property
    def terms(self):
        return web.search_term_daily(A.search_events(self.spark, self.sf, self.events))

    @cached_property
    def mapped(self):
        return D.map_terms_daily(self.terms, self.sdict)

    @cached_property
    def mapped_after(self):
        return D.map_terms_daily_after(self.terms, self.sdict, A.aliases(self.spark, self.sf))

    @cached_property
    def interest(self):
        return signals.interest_weekly(A.interest_points(self.spark, self.sf, self.events))

    @cached_property
    def interest_norm(self):
        return signals.interest_norm(self.interest)

    @cached_property
    def calendar_weekly(self):
        return signals.calendar_weekly(A.calendar(self.spark, self.sf))

    @cached_property
    def bench(self):
        return benchmark.price_benchmark(A.price_rows(self.spark, self.sf), 30)

    @cached_property
    def bench_category(self):
        return benchmark.benchmark_category(self.bench, A.category_map(self.spark))

    def radar(self, after: bool = False):
        kw = (D.mapped_weekly_after(self.mapped_after) if after
              else D.mapped_weekly(self.terms, self.sdict))
        return radar.radar_keyword(kw, self.interest_norm, self.calendar_weekly,
                                   self.bench_category)


@query("norm_text")
def q_norm_text(spark, sf):
    t = A.search_events(spark, sf).select("search_term").distinct()
    return t.select("search_term", norm_txt("search_term").alias("norm"))


@query("dictionary_dedupe")
def q_dictionary_dedupe(spark, sf):
    return D.dedupe_dictionary(A.dictionary_stage(spark, sf), trim=False)


@query("dictionary_dedupe_trimmed")
def q_dictionary_dedupe_trimmed(spark, sf):
    return Inputs(spark, sf).dim


@query("search_dictionary")
def q_search_dictionary(spark, sf):
    return Inputs(spark, sf).sdict


@query("terms_mapped_daily")
def q_terms_mapped_daily(spark, sf):
    return Inputs(spark, sf).mapped


@query("terms_mapped_weekly")
def q_terms_mapped_weekly(spark, sf):
    i = Inputs(spark, sf)
    return D.mapped_weekly(i.terms, i.sdict)


@query("terms_unmapped_weekly")
def q_terms_unmapped_weekly(spark, sf):
    i = Inputs(spark, sf)
    return D.unmapped_weekly(i.terms, i.sdict)


@query("terms_mapped_daily_after")
def q_terms_mapped_daily_after(spark, sf):
    return Inputs(spark, sf).mapped_after


@query("terms_mapped_weekly_after")
def q_terms_mapped_weekly_after(spark, sf):
    return D.mapped_weekly_after(Inputs(spark, sf).mapped_after)


@query("coverage_before")
def q_coverage_before(spark, sf):
    return D.coverage_weekly(Inputs(spark, sf).mapped)


@query("coverage_after")
def q_coverage_after(spark, sf):
    return D.coverage_after_weekly(Inputs(spark, sf).mapped_after)


@query("top_typos")
def q_top_typos(spark, sf):
    return D.top_typos_weekly(Inputs(spark, sf).mapped)


# -------------------------------------------------------------- signals ----
@query("interest_from_points")
def q_interest_from_points(spark, sf):
    return Inputs(spark, sf).interest


@query("interest_weekly_norm")
def q_interest_weekly_norm(spark, sf):
    return Inputs(spark, sf).interest_norm


@query("interest_dedupe")
def q_interest_dedupe(spark, sf):
    return signals.interest_dedupe(Inputs(spark, sf).interest)


@query("calendar_weekly")
def q_calendar_weekly(spark, sf):
    return _as(signals.calendar_weekly(A.calendar(spark, sf), align="monday"),
               {"is_campaign_week": "int"})


@query("calendar_weekly_start")
def q_calendar_weekly_start(spark, sf):
    return _as(signals.calendar_weekly(A.calendar(spark, sf), align="start"),
               {"is_campaign_week": "int"})


@query("keyword_pick")
def q_keyword_pick(spark, sf):
    return signals.keyword_pick(Inputs(spark, sf).dim, 10)


@query("seed_keywords")
def q_seed_keywords(spark, sf):
    return signals.seed_keywords(A.seed_list(spark, sf), "keyword", "position", 10)


# ------------------------------------------------------------ benchmark ----
@query("price_benchmark")
def q_price_benchmark(spark, sf):
    return Inputs(spark, sf).bench


@query("price_benchmark_wide")
def q_price_benchmark_wide(spark, sf):
    """One group per source: as many distinct prices in a group as the table has."""
    rows = A.price_rows(spark, sf).withColumn("category_norm", F.lit("all"))
    return benchmark.price_benchmark(rows)


@query("price_benchmark_dense")
def q_price_benchmark_dense(spark, sf):
    """Values that share their first 20 bits and more: the seconds of the events."""
    return benchmark.price_benchmark(A.event_seconds(spark, sf))


@query("category_weekly")
def q_category_weekly(spark, sf):
    return benchmark.category_weekly(A.price_rows(spark, sf))


@query("text_terms")
def q_text_terms(spark, sf):
    return benchmark.text_terms(A.text_docs(spark, sf), 200)


@query("benchmark_category")
def q_benchmark_category(spark, sf):
    return Inputs(spark, sf).bench_category


@query("benchmark_category_infix")
def q_benchmark_category_infix(spark, sf):
    """Category patterns that begin with a wildcard, thousands of them."""
    return benchmark.benchmark_category(Inputs(spark, sf).bench, A.infix_map(spark, sf))


# ---------------------------------------------------------------- radar ----
RADAR_CASTS = {"trends_interest": "bigint", "is_campaign_week": "bigint", "rank_week": "bigint"}


@query("radar_keyword")
def q_radar_keyword(spark, sf):
    return _as(Inputs(spark, sf).radar(), RADAR_CASTS)


@query("radar_keyword_after")
def q_radar_keyword_after(spark, sf):
    return _as(Inputs(spark, sf).radar(after=True), RADAR_CASTS)


@query("radar_category")
def q_radar_category(spark, sf):
    return _as(radar.radar_category(Inputs(spark, sf).radar()),
               {"is_campaign_week": "bigint", "rank_categoria": "bigint"})


def _dashboard(spark, sf, after: bool, events=None, calendar_weekly=None, bench_category=None):
    """``calendar_weekly`` and ``bench_category``: those of ``Inputs``, if the caller has them."""
    i = Inputs(spark, sf, events)
    if calendar_weekly is not None:
        i.calendar_weekly, i.bench_category = calendar_weekly, bench_category
    i.terms = cut_lineage(i.terms)       # the radar, which runs a job, and the shares both read them
    shares = D.coverage_shares(i.terms, i.sdict, A.aliases(spark, sf))
    return _as(radar.dashboard_from_shares(i.radar(after), shares), RADAR_CASTS)


@query("dashboard")
def q_dashboard(spark, sf):
    return _dashboard(spark, sf, after=False)


@query("dashboard_after")
def q_dashboard_after(spark, sf):
    return _dashboard(spark, sf, after=True)


@query("dashboard_refresh")
def q_dashboard_refresh(spark, sf):
    """A first load that ends mid-week, then the re-sync: only the weeks that its days touch are
    computed again and written. The table read back equals ``dashboard``."""
    from ..sources.refresh import in_weeks, refresh_weeks, touched_weeks
    from ..sources.writers import write_full_refresh
    path = scratch_path(spark, "dashboard-weeks")
    events = table(spark, sf, "events")
    inputs = Inputs(spark, sf)           # both loads score against the same calendar and prices
    small = cut_lineage(inputs.calendar_weekly), cut_lineage(inputs.bench_category)
    first = events.where(F.col("ts") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz"))
    write_full_refresh(_dashboard(spark, sf, False, first, *small), path, ["week_start"])
    late = events.where(F.col("ts") >= F.lit(RESYNC_START).cast("timestamp_ntz"))
    build = lambda weeks: _dashboard(spark, sf, False, in_weeks(events, weeks, "ts"), *small)
    refresh_weeks(spark, path, build, touched_weeks(late.select(F.to_date("ts").alias("day"))))
    columns = ["week_start", "categoria", "keyword_canonica", "searches", "trends_interest", "is_campaign_week",
               "events", "kaggle_price_p50", "score_total", "rank_week", "unmapped_pct_before", "unmapped_pct_after"]
    return spark.read.parquet(path).select(*columns)


# --------------------------------------------------------- write / upsert ----

# A first load that ends mid-day, and a re-sync window that overlaps it: the re-sync
# must correct the partial day (upsert) or leave it (insert-if-absent).
FIRST_LOAD_END = "2024-01-18 12:00:00"
RESYNC_START = "2024-01-15 00:00:00"
EVENT_KEYS = ["day", "event_name"]


def _event_window(spark, sf, label, start=None, end=None):
    ev = A.raw_events(spark, sf)
    if start:
        ev = ev.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        ev = ev.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return web.event_daily(ev).withColumn("source_batch", F.lit(label))


@query("upsert_replace")
def q_upsert_replace(spark, sf):
    target = _event_window(spark, sf, "initial", end=FIRST_LOAD_END)
    batch = _event_window(spark, sf, "resync", start=RESYNC_START)
    return U.upsert(target, batch, EVENT_KEYS)


@query("insert_if_absent")
def q_insert_if_absent(spark, sf):
    target = _event_window(spark, sf, "initial", end=FIRST_LOAD_END)
    batch = _event_window(spark, sf, "resync", start=RESYNC_START)
    return U.insert_if_absent(target, batch, EVENT_KEYS)


@query("delete_insert")
def q_delete_insert(spark, sf):
    terms = A.search_events(spark, sf)
    target = (web.search_term_daily(terms.where(F.col("day") < F.lit("2024-01-18").cast("date")))
              .withColumn("source_batch", F.lit("initial")))
    batch = (web.search_term_daily(terms.where(F.col("day") >= F.lit("2024-01-15").cast("date")))
             .withColumn("source_batch", F.lit("resync")))
    return U.replace_by_key(target, batch, ["day"])


# -------------------------------------------------------------- quality ----
@query("quality_domain")
def q_quality_domain(spark, sf):
    ev = table(spark, sf, "events")
    v = Q.violations(ev, {"interest_range": F.col("value").between(0, 100)}, ["event_id"], "value")
    stg = A.dictionary_stage(spark, sf)
    p = Q.violations(stg, {"priority_set": F.col("prioridad").isin(1, 2, 3)},
                     ["keyword_raw"], "prioridad")
    cal = A.calendar(spark, sf)
    c = Q.violations(cal, {"calendar_priority": F.col("prioridad").between(1, 5),
                           "calendar_range": F.col("start_date") <= F.col("end_date"),
                           "calendar_type": F.col("event_type").isin(
                               "SEASON", "CAMPAIGN", "HOLIDAY", "OTHER")},
                     ["event_name"], "prioridad")
    return v.unionByName(p).unionByName(c)


@query("quality_unique")
def q_quality_unique(spark, sf):
    stg = A.dictionary_stage(spark, sf)
    return Q.duplicates(stg, [F.lower("keyword_raw").alias("keyword_key")])


@query("quality_nulls")
def q_quality_nulls(spark, sf):
    return Q.null_counts(A.dictionary_stage(spark, sf))


@query("column_profile")
def q_column_profile(spark, sf):
    return Q.profile(A.dictionary_stage(spark, sf))


SANITY_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


@query("sanity_counts")
def q_sanity_counts(spark, sf):
    ds = {t: table(spark, sf, t) for t in SANITY_TABLES}
    ds["sales_daily"] = sales.sales_daily(A.bills(spark, sf))
    return Q.sanity_counts(ds)


@query("latest_n")
def q_latest_n(spark, sf):
    sd = _as(sales.sales_daily(A.bills(spark, sf)), MONEY_SALES)
    return Q.latest_n(sd, [F.col("day").desc()], 5)


# -------------------------------------------------------------- parsing ----
@query("category_normalize")
def q_category_normalize(spark, sf):
    p = table(spark, sf, "part")
    parts = [p.select(F.lit(kind).alias("kind"),
                      normalize_category(F.concat(F.lit("\t"), F.col(c).cast("string"), F.lit("\u00a0")),
                                         kind).alias("category_norm"))
             for c, kind in (("p_type", "category"), ("p_brand", "category_code"),
                             ("p_size", "category_id"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.where(F.col("category_norm") != "").distinct()


def _k_text():
    return F.get_json_object("props", "$.k")


@query("safe_float")
def q_safe_float(spark, sf):
    ev = table(spark, sf, "events")
    k = _k_text()
    v = F.col("event_id") % 4
    raw = (F.when(v == 0, F.concat(k, F.lit(",5")))
           .when(v == 1, F.concat(F.lit("\t"), k, F.lit("\u00a0\r\n")))
           .when(v == 2, F.lit(" \n")).when(F.col("event_id") % 8 == 3, F.concat(k, F.lit("e30")))
           .otherwise(F.concat(k, F.lit("x"))))
    t = ev.select("event_id", raw.alias("raw_text"))
    return t.select("event_id", "raw_text", safe_float("raw_text").alias("value"))


@query("parse_date_any")
def q_parse_date_any(spark, sf):
    ev = table(spark, sf, "events")
    v = F.col("event_id") % 5
    ts = F.col("ts")
    raw = (F.when(v == 0, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
           .when(v == 1, F.concat(F.lit("order on "), F.date_format(ts, "yyyy-MM-dd")))
           .when(v == 2, F.lit("no date"))
           .when(v == 3, F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("T10:00:00Z")))
           .otherwise(F.concat(F.date_format(ts, "yyyy"), F.lit("-13-"), F.date_format(ts, "dd"))))
    t = ev.select("event_id", raw.alias("raw_text"))
    return t.select("event_id", "raw_text", parse_date_any("raw_text").alias("parsed"))


# ---------------------------------------------------------------- files ----


@query("csv_messy_text")
def q_csv_messy_text(spark, sf):
    """Cells with doubled quotes, delimiters and line breaks."""
    drop = A.csv_messy_drop(spark, sf)
    return CSV.build_curated(spark, drop, kinds=("text_terms",), multi_line=True)["text_terms"]


@query("csv_mixed_headers")
def q_csv_mixed_headers(spark, sf):
    """Files of one folder with different delimiters and column orders."""
    drop = A.csv_mixed_drop(spark, sf)
    return CSV.build_curated(spark, drop, kinds=("price_benchmark",))["price_benchmark"]


@query("csv_same_source")
def q_csv_same_source(spark, sf):
    """One source name in two folders."""
    drop = A.csv_mixed_drop(spark, sf)
    return CSV.build_curated(spark, drop, kinds=("category_weekly",))["category_weekly"]


@query("csv_price_benchmark")
def q_csv_price_benchmark(spark, sf):
    return CSV.build_curated(spark, A.csv_drop(spark, sf), kinds=("price_benchmark",))["price_benchmark"]


@query("csv_category_weekly")
def q_csv_category_weekly(spark, sf):
    return CSV.build_curated(spark, A.csv_drop(spark, sf), kinds=("category_weekly",))["category_weekly"]


@query("csv_text_terms")
def q_csv_text_terms(spark, sf):
    return CSV.build_curated(spark, A.csv_drop(spark, sf), kinds=("text_terms",))["text_terms"]


@query("interest_export_files")
def q_interest_export_files(spark, sf):
    weekly, _status = read_interest_exports(spark, A.interest_exports(spark, sf))
    return weekly


MARKET_COLUMNS = ["week_start", "keyword_canonica", "site_id", "results_total", "price_median",
                  "price_p25", "price_p75", "top_category_id", "top_category_name"]


@query("marketplace_weekly")
def q_marketplace_weekly(spark, sf):
    raw = M.latest_responses(A.marketplace_search_json(spark, sf),
                             ["week_start", "keyword_canonica", "site_id"], "fetch_order")
    return M.parse_search_responses(raw).select(*MARKET_COLUMNS)


@query("marketplace_trends")
def q_marketplace_trends(spark, sf):
    ranked = M.parse_trend_responses(A.marketplace_trends_json(spark, sf))
    ranked = ranked.withColumn("url", F.nullif(F.col("url"), F.lit("")))
    latest = U.dedupe_last(ranked, ["week_start", "site_id", "category_id", "rank"], ["fetch_order"])
    return latest.select("week_start", "site_id", "category_id", "rank", "keyword", "url")


# ------------------------------------------------------------ streaming ----


@query("event_daily_stream")
def q_event_daily_stream(spark, sf):
    """The events replayed as a stream of files in which every day comes again, late; the
    exact facts equal ``event_daily``."""
    return run_event_daily_stream(spark, A.event_files(spark, sf), scratch_path(spark, "event-daily"),
                                  scratch_path(spark, "event-daily-ckpt"), A.web_events,
                                  files_per_batch=1)


@query("funnel_daily_stream")
def q_funnel_daily_stream(spark, sf):
    """Funnel steps from the events table replayed as a file stream (exact counts)."""
    return run_daily_stream(spark, sf, scratch_path(spark, "funnel-daily"),
                            scratch_path(spark, "funnel-daily-ckpt"),
                            lambda raw: daily_funnel(A.web_events(raw)), ["day"],
                            glob="events.parquet")


@query("search_term_daily_stream")
def q_search_term_daily_stream(spark, sf):
    """Search terms per day from the events stream joined to the static part table."""
    part = table(spark, sf, "part")
    return run_daily_stream(spark, sf, scratch_path(spark, "terms-daily"),
                            scratch_path(spark, "terms-daily-ckpt"),
                            lambda raw: daily_search_terms(A.search_events_from(raw, part)),
                            ["day", "search_term"], glob="events.parquet")


@query("upsert_duplicate_batch")
def q_upsert_duplicate_batch(spark, sf):
    """A batch that holds a key twice, and keys with a NULL day, upserted twice over."""
    first = _event_window(spark, sf, "initial", end=FIRST_LOAD_END)
    late = _event_window(spark, sf, "resync", start=RESYNC_START)
    batch = first.unionByName(late)
    batch = batch.withColumn("day", F.when(F.col("event_name") != "purchase", F.col("day")))
    batch = batch.groupBy(*EVENT_KEYS, "source_batch").agg(
        *[F.sum(c).alias(c) for c in ("event_count", "total_users", "sessions")])
    batch = batch.select("day", "event_name", "event_count", "total_users", "sessions", "source_batch")
    once = U.upsert(batch.limit(0), batch, EVENT_KEYS, ["source_batch"])
    return U.upsert(once, batch, EVENT_KEYS, ["source_batch"])


@query("upsert_partitions_first_load")
def q_upsert_partitions_first_load(spark, sf):
    """The first load of a missing table, from a batch with repeated keys."""
    from ..sources.writers import upsert_partitions
    path = scratch_path(spark, "event-first-load")
    batch = _event_window(spark, sf, "initial", end=FIRST_LOAD_END).unionByName(
        _event_window(spark, sf, "resync", start=RESYNC_START))
    upsert_partitions(spark, path, batch, EVENT_KEYS, order=["source_batch"])
    return spark.read.parquet(path).select("day", "event_name", "event_count", "total_users",
                                           "sessions", "source_batch")


@query("upsert_partitions")
def q_upsert_partitions(spark, sf):
    """First load written partitioned by day, then the re-sync window upserted into only
    the day partitions it touches; the table read back equals ``upsert_replace``."""
    from ..sources.writers import upsert_partitions
    path = scratch_path(spark, "event-daily-table")
    upsert_partitions(spark, path, _event_window(spark, sf, "initial", end=FIRST_LOAD_END), EVENT_KEYS)
    upsert_partitions(spark, path, _event_window(spark, sf, "resync", start=RESYNC_START), EVENT_KEYS)
    return spark.read.parquet(path).select("day", "event_name", "event_count", "total_users",
                                           "sessions", "source_batch")


# ------------------------------------------------- loaders, sinks, parsing ----
@query("full_refresh")
def q_full_refresh(spark, sf):
    """A table replaced twice (partitioned by day), then read."""
    from ..sources.writers import write_full_refresh
    path = scratch_path(spark, "full-refresh")
    daily = _as(sales.sales_daily(A.bills(spark, sf)), MONEY_SALES)
    write_full_refresh(daily.limit(0), path, ["day"])
    write_full_refresh(daily, path, ["day"])
    return spark.read.parquet(path).select(*daily.columns)


@query("csv_export")
def q_csv_export(spark, sf):
    """Written as CSV with a header, read with types."""
    from ..sources.writers import write_csv
    path = scratch_path(spark, "csv-export")
    daily = _as(sales.sales_daily(A.bills(spark, sf)), MONEY_SALES)
    write_csv(daily, path)
    return CSV.read_typed_csv(spark, path, dict(daily.dtypes))


@query("named_views")
def q_named_views(spark, sf):
    from ..sources.writers import register_views
    register_views({"v_sales_daily": _as(sales.sales_daily(A.bills(spark, sf)), MONEY_SALES)})
    return spark.sql("SELECT * FROM v_sales_daily")


@query("keyword_load")
def q_keyword_load(spark, sf):
    """The keyword staging file, loaded and deduplicated."""
    path = scratch_path(spark, "keyword-stage")
    A.dictionary_stage(spark, sf).write.option("header", True).csv(path)
    return D.dedupe_dictionary(CSV.read_keyword_staging(spark, path), trim=True)


@query("interest_load")
def q_interest_load(spark, sf):
    path = scratch_path(spark, "interest-csv")
    Inputs(spark, sf).interest.write.option("header", True).csv(path)
    return CSV.read_interest_csv(spark, path).fillna("", ["region"])


@query("marketplace_weekly_import")
def q_marketplace_weekly_import(spark, sf):
    """Weekly samples from a CSV file whose site is blank: the default site is filled in."""
    path = scratch_path(spark, "market-csv")
    (q_marketplace_weekly(spark, sf).withColumn("site_id", F.lit(" "))
     .write.option("header", True).csv(path))
    out = CSV.import_marketplace_weekly(spark, path)
    return _as(out, {"results_total": "bigint"})


@query("marketplace_trends_import")
def q_marketplace_trends_import(spark, sf):
    path = scratch_path(spark, "trends-csv")
    (q_marketplace_trends(spark, sf).withColumn("site_id", F.lit(None).cast("string"))
     .write.option("header", True).csv(path))
    return CSV.import_marketplace_trends(spark, path)


@query("csv_inventory")
def q_csv_inventory(spark, sf):
    """Files of a drop by source and header: rows and delimiter."""
    files = CSV.inventory(spark, A.csv_drop(spark, sf))
    return (files.where("header IS NOT NULL").groupBy("source", "delimiter", "header")
            .agg(F.sum("n_rows").alias("n_rows")))


# The drop's own list of delimiters: one of them is no usual one.
LOT_DELIMITERS = [",", ";", "^"]


@query("csv_inventory_files")
def q_csv_inventory_files(spark, sf):
    """Every file of a drop: size, rows, delimiter, header and columns; files without a line or
    with a header alone too."""
    files = CSV.inventory(spark, A.csv_sample_drop(spark, sf))
    return files.select("source", "size", "n_rows", F.coalesce("delimiter", F.lit("")).alias("delimiter"),
                        F.coalesce("header", F.lit("")).alias("header"),
                        F.coalesce("columns", F.lit("")).alias("columns"))


@query("csv_samples")
def q_csv_samples(spark, sf):
    """The first five data lines of every file, in file order."""
    files = CSV.inventory(spark, A.csv_sample_drop(spark, sf))
    return CSV.sample_lines(files).drop("path")


@query("csv_candidates")
def q_csv_candidates(spark, sf):
    """A drop whose delimiters are named by the caller."""
    drop = A.csv_sample_drop(spark, sf)
    return CSV.build_curated(spark, drop, kinds=("category_weekly",), candidates=LOT_DELIMITERS)["category_weekly"]


@query("events_in_range")
def q_events_in_range(spark, sf):
    """Both ends of the range are included."""
    return web.event_daily(web.in_range(A.raw_events(spark, sf), "2024-01-05", "2024-01-12"))


@query("resync_daily")
def q_resync_daily(spark, sf):
    """The look-back window recomputed from all events and upserted over the first load."""
    target = _event_window(spark, sf, "initial", end=FIRST_LOAD_END).drop("source_batch")
    start, end = resolve_range("2024-01-15", "2024-12-31")
    return web.resync_daily(A.raw_events(spark, sf), target, start, end)


@query("parse_yyyymmdd")
def q_parse_yyyymmdd(spark, sf):
    ev = table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 5 == 0, "20241341").otherwise(F.date_format("ts", "yyyyMMdd"))
    return ev.select("event_id", raw.alias("raw_text")).withColumn("parsed", parse_yyyymmdd("raw_text"))


@query("price_value")
def q_price_value(spark, sf):
    """Prices as numbers, text, JSON scalars and JSON objects."""
    p = table(spark, sf, "part")
    text, v = F.col("p_retailprice").cast("string"), F.col("p_partkey") % 5
    raw = (F.when(v == 0, F.concat(F.lit('{"price": '), text, F.lit("}")))
           .when(v == 1, F.concat(F.lit('"'), text, F.lit('"')))
           .when(v == 2, F.concat(F.lit("\t"), text)).when(v == 3, F.lit("n/a")).otherwise(text))
    return p.select("p_partkey", raw.alias("raw_text")).withColumn("price", price_value("raw_text"))


@query("conform_columns")
def q_conform_columns(spark, sf):
    """A legacy column renamed, one whose new name exists left alone, absent ones added."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("nombre"),
                                        F.col("p_brand").alias("marca"), F.col("p_type").alias("brand"))
    out = conform(p, {"nombre": "name", "marca": "brand"}, {"site": "MPE", "name": "unused"})
    return U.with_defaults(out, {"priority": F.lit(2), "site": F.lit("other")})


@query("profile_top")
def q_profile_top(spark, sf):
    return Q.profile(A.dictionary_stage(spark, sf), top=3)
