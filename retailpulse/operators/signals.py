"""External demand signals: weekly search interest, commercial calendar, keyword picks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import clamp, interest_number, interest_reading, interest_text
from ..functions.text import norm_txt, strip
from .common import pick_first


def interest_weekly(points: DataFrame, keyword_col: str = "keyword",
                    value_col: str = "value_text", geo: str = "PE", region: str = "") -> DataFrame:
    """Daily/hourly interest points -> week_start, keyword_canonica, geo, region, interest.

    Readings are parsed ('<1' -> 0, truncated, clamped 0..100; unparseable skipped), then
    averaged per Monday week and rounded half-to-even.

    The steps of ``interest_value`` are columns of their own, so that each is worked out once a
    row; a mean skips the points without a value, and a week of such points alone has none."""
    pts = (points.select("day", F.col(keyword_col).alias("keyword_canonica"),
                         interest_text(value_col).alias("_text"))
           .withColumn("_number", interest_number("_text")))
    return (pts.groupBy(F.trunc("day", "week").alias("week_start"), "keyword_canonica")
            .agg(F.avg(interest_reading("_number")).alias("avg_v"))
            .where(F.col("avg_v").isNotNull())
            .select("week_start", "keyword_canonica", F.lit(geo).alias("geo"),
                    F.lit(region).alias("region"),
                    clamp(F.bround("avg_v", 0), 0.0, 100.0).cast("int").alias("interest")))


def interest_norm(weekly: DataFrame) -> DataFrame:
    """week_start, keyword_norm, trends_interest = max interest over geo/region."""
    return (weekly.groupBy("week_start", norm_txt("keyword_canonica").alias("keyword_norm"))
            .agg(F.max("interest").alias("trends_interest")))


def interest_dedupe(weekly: DataFrame) -> DataFrame:
    """One row per (week, keyword, geo, region with blank -> 'ALL'), highest interest;
    rows with a NULL key part are dropped."""
    region = F.coalesce(F.nullif(F.col("region"), F.lit("")), F.lit("ALL"))
    return (weekly.where(F.col("week_start").isNotNull() & F.col("keyword_canonica").isNotNull()
                         & F.col("geo").isNotNull())
            .groupBy("week_start", "keyword_canonica", "geo", region.alias("region"))
            .agg(F.max("interest").alias("interest")))


def interest_last_file_wins(weekly: DataFrame, file_col: str = "file_name") -> DataFrame:
    """When several export files carry the same (week, lower(keyword), geo, region), the
    row of the file that sorts last wins."""
    cols = [c for c in weekly.columns if c != file_col]
    # An aggregate (max_by), not a window: partial aggregation bounds hot keys.
    packed = F.struct(*[F.col(c) for c in cols])
    out = (weekly.groupBy("week_start", F.lower("keyword_canonica").alias("_kw"), "geo", "region")
           .agg(F.max_by(packed, F.col(file_col)).alias("_m")))
    return out.select(*[F.col(f"_m.{c}").alias(c) for c in cols])


def calendar_weekly(calendar: DataFrame, align: str = "monday") -> DataFrame:
    """week_start, categoria_norm, is_campaign_week, best_priority, events.

    A week w counts for an event if w <= end and w + 6 >= start. ``align='monday'`` uses Monday
    weeks; ``align='start'`` anchors the grid at the earliest start date (the reference's literal
    grid). The events of a category are swept along the grid: between two weeks at which one of
    them begins or has ended the same events run, so names and priorities are gathered once per
    such stretch, and only the finished rows are spread over its weeks. An event of thousands of
    weeks costs as much as one of a day."""
    cal = calendar.where(F.col("start_date") <= F.col("end_date"))
    if align == "monday":
        first, last = F.trunc("start_date", "week"), F.trunc("end_date", "week")
        cal = cal.select("*", first.alias("_first"), last.alias("_last"))
    else:
        # The grid anchor (earliest start) is a scalar subquery, evaluated once into a
        # column and referenced from there.
        cal = cal.withColumn("_a", calendar.select(F.min("start_date")).scalar())
        d0 = F.datediff("start_date", "_a")
        d1 = F.datediff("end_date", "_a")
        k0 = F.ceil((d0 - 6) / 7).cast("int")
        k1 = F.floor(d1 / 7).cast("int")
        cal = (cal.select("*", F.date_add("_a", k0 * 7).alias("_first"),
                          F.date_add("_a", k1 * 7).alias("_last"))
               .where(F.col("_first") <= F.col("_last")))
    runs = (cal.select("_first", F.date_add("_last", 7).alias("_after"), "event_name", "prioridad",
                       F.explode("tags").alias("tag"))
            .groupBy("_first", "_after", "event_name", norm_txt("tag").alias("categoria_norm"))
            .agg(F.min("prioridad").alias("prioridad")))
    stretches = _stretches(runs)
    name = ["categoria_norm", "_nth"]
    begins = stretches.select(F.col("categoria_norm").alias("_c"), F.col("_from").alias("_f"), F.col("_nth").alias("_i"))
    ends = stretches.select(F.col("categoria_norm").alias("_d"), F.col("_to").alias("_t"), F.col("_nth").alias("_j"))
    held = (runs.join(begins, F.col("categoria_norm").eqNullSafe(F.col("_c")) & (F.col("_first") == F.col("_f")))
            .join(ends, F.col("categoria_norm").eqNullSafe(F.col("_d")) & (F.col("_after") == F.col("_t"))))
    running = (held.select("categoria_norm", "event_name", "prioridad", F.explode(F.sequence("_i", "_j")).alias("_nth"))
               .groupBy(*name).agg(F.min("prioridad").alias("best_priority"), F.array_join(
                   F.array_sort(F.collect_set("event_name")), " | ").alias("events")))
    at = stretches.select(F.col("categoria_norm").alias("_c"), F.col("_nth").alias("_i"), "_from", "_to")
    weeks = running.join(at, F.col("categoria_norm").eqNullSafe(F.col("_c")) & (F.col("_nth") == F.col("_i")))
    return weeks.select(
        F.explode(F.sequence("_from", F.date_sub("_to", 7), F.expr("INTERVAL 7 DAYS"))).alias("week_start"),
        "categoria_norm", F.lit(1).alias("is_campaign_week"), "best_priority", "events")


def _stretches(runs: DataFrame) -> DataFrame:
    """categoria_norm, _nth, _from, _to: the stretches of a category's grid in which at least one
    run goes on, by a running sum of +1 where a run begins and -1 where it has ended."""
    steps = (runs.select("categoria_norm", F.explode(F.array(
        F.struct(F.col("_first").alias("at"), F.lit(1).alias("by")),
        F.struct(F.col("_after").alias("at"), F.lit(-1).alias("by")))).alias("s"))
        .groupBy("categoria_norm", F.col("s.at").alias("_from")).agg(F.sum("s.by").alias("_by")))
    along = Window.partitionBy("categoria_norm").orderBy("_from")
    return (steps.select("categoria_norm", "_from", F.lead("_from").over(along).alias("_to"),
                         F.row_number().over(along).alias("_nth"),
                         F.sum("_by").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_open"))
            .where(F.col("_open") > 0).drop("_open"))


def keyword_pick(dim: DataFrame, n: int = 10) -> DataFrame:
    """Canonical keywords to sample: best priority, most rows, then name; first ``n``."""
    return (dim.groupBy("keyword_canonica")
            .agg(F.min("prioridad").alias("_p"), F.count(F.lit(1)).alias("_n"))
            .orderBy(F.col("_p").asc_nulls_last(), F.col("_n").desc(), F.col("keyword_canonica"))
            .limit(n).select("keyword_canonica"))


def seed_keywords(df: DataFrame, keyword_col: str, position_col: str, n: int = 10) -> DataFrame:
    """Seed list: strip, drop blanks, case-insensitive distinct keeping the first spelling,
    first ``n`` by position."""
    t = (df.select(strip(keyword_col).alias("keyword"), F.col(position_col).alias("position"))
         .where(F.col("keyword") != ""))
    first = pick_first(t, [F.lower("keyword").alias("_k")], [F.col("position")],
                       ["keyword", "position"])
    return first.orderBy("position").limit(n)
