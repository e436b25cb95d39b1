"""Daily web facts from raw events: per-event counts, the funnel pivot, search terms.

Raw event columns: day (date), event_name, user_id, session_id; search events carry
``search_term``. The date range and event list filters are plain predicates, so they
reach the Parquet scan (and partition pruning when the events are laid out by day).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions.text import clean_search_term

# The funnel steps, in funnel order; the first one counts sessions.
FUNNEL_STEPS = ["session_start", "view_item", "add_to_cart", "begin_checkout", "purchase"]
FUNNEL_COLUMNS = ["sessions", "view_item", "add_to_cart", "begin_checkout", "purchase"]


def in_range(events: DataFrame, start: dt.date | str | None = None,
             end: dt.date | str | None = None, day_col: str = "day") -> DataFrame:
    if start is not None:
        events = events.where(F.col(day_col) >= F.lit(str(start)).cast("date"))
    if end is not None:
        events = events.where(F.col(day_col) <= F.lit(str(end)).cast("date"))
    return events


def event_daily(events: DataFrame, approx_users: bool = False, rsd: float = 0.01) -> DataFrame:
    """day, event_name, event_count, total_users, sessions.

    Users and sessions are distinct counts (not additive across days). Events collapse to one
    row per (day, event, user, session) before anything else; users and sessions are then
    counted from those rows, each on its own, and joined: no row is copied per aggregate, and
    no group is ever held whole. ``approx_users`` switches to HyperLogLog sketches instead.
    """
    key = ["day", "event_name"]
    if approx_users:
        return events.groupBy(*key).agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("user_id", rsd).alias("total_users"),
            F.approx_count_distinct("session_id", rsd).alias("sessions"))
    return daily_from_pairs(events.groupBy(*key, "user_id", "session_id")
                            .agg(F.count(F.lit(1)).alias("n")))


def daily_from_pairs(pairs: DataFrame) -> DataFrame:
    """day, event_name, event_count, total_users, sessions from (day, event_name, user_id,
    session_id, n) rows; several rows of one combination add up."""
    key = ["day", "event_name"]
    users = (pairs.groupBy(*key, "user_id").agg(F.sum("n").alias("n"))
             .groupBy(*key).agg(F.sum("n").alias("event_count"),
                                F.count("user_id").alias("total_users")))
    sessions = (pairs.select(*key, "session_id").distinct()
                .groupBy(*[F.col(k).alias(f"_{k}") for k in key])
                .agg(F.count("session_id").alias("sessions")))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    return users.join(sessions, same).select(*key, "event_count", "total_users", "sessions")


def funnel_daily(events: DataFrame, steps: list[str] = FUNNEL_STEPS,
                 columns: list[str] = FUNNEL_COLUMNS) -> DataFrame:
    """day, sessions, view_item, add_to_cart, begin_checkout, purchase (missing = 0).

    The step list is pushed to the scan as an IN filter; the pivot is a set of
    conditional counts in one aggregate (no pivot value discovery pass)."""
    ev = events.where(F.col("event_name").isin(*steps))
    return ev.groupBy("day").agg(*[
        F.count_if(F.col("event_name") == s).alias(c) for s, c in zip(steps, columns)])


def search_term_daily(search_events: DataFrame, count_col: str | None = None) -> DataFrame:
    """day, search_term, event_count: cleaned terms (trim; blank / (not set) dropped),
    summed per day and term. ``count_col`` holds pre-counted rows; else each row is 1."""
    n = F.col(count_col) if count_col else F.lit(1)
    return (search_events
            .select("day", clean_search_term("search_term").alias("search_term"),
                    n.cast("bigint").alias("n"))
            .where(F.col("search_term").isNotNull())
            .groupBy("day", "search_term")
            .agg(F.sum("n").alias("event_count")))


def resync_daily(events: DataFrame, target: DataFrame, start, end,
                 keys: list[str] | None = None) -> DataFrame:
    """Batch re-sync: recompute the daily event facts of [start, end] (late events up to
    the look-back are thus corrected) and upsert them into ``target`` by key."""
    from .upsert import upsert
    fresh = event_daily(in_range(events, start, end))
    return upsert(target, fresh.select(*target.columns), keys or ["day", "event_name"])
