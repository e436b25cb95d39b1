"""Marts kept by week, of which only the weeks that new events touch are computed again.

Everything in the weekly marts (terms, radar, dashboard) depends on the events of its own week
and on small inputs without events (dictionary, aliases, calendar, benchmark). The days of a
batch therefore name the weeks to be computed from all events of those weeks; the other weeks'
partitions are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from .writers import clustered

WEEK = dt.timedelta(days=7)


def touched_weeks(days: DataFrame, day_col: str = "day") -> list[dt.date]:
    """The Mondays of the weeks that hold these days, in order (one value per week)."""
    weeks = days.select(F.trunc(day_col, "week").alias("week")).where("week IS NOT NULL").distinct()
    return sorted(r["week"] for r in weeks.collect())


def in_weeks(df: DataFrame, weeks: list[dt.date], column: str = "day") -> DataFrame:
    """Rows whose date or time lies in one of the weeks. Neighbouring weeks are one range, and a
    range is two comparisons with constants, which reach the scan."""
    ranges: list[list[dt.date]] = []
    for week in sorted(weeks):
        if ranges and ranges[-1][1] == week:
            ranges[-1][1] = week + WEEK
        else:
            ranges.append([week, week + WEEK])
    kind = df.schema[column].dataType.simpleString()
    at = lambda day: F.lit(str(day)).cast(kind)
    wanted = F.lit(False)
    for first, end in ranges:
        wanted = wanted | ((F.col(column) >= at(first)) & (F.col(column) < at(end)))
    return df.where(wanted)


def refresh_weeks(spark: SparkSession, path: str, build: Callable[[list[dt.date]], DataFrame],
                  weeks: list[dt.date], week_col: str = "week_start") -> int:
    """Replaces the partitions ``week_col`` of ``weeks`` below ``path`` by the rows of
    ``build(weeks)``; a week that has no rows any more loses its partition. Run again after a
    failure it writes the same. Returns the number of rows written."""
    if not weeks:
        return 0
    rows = cut_lineage(build(weeks).where(F.col(week_col).isin(weeks)))      # counted, written and listed
    dealt, n = clustered(rows, [week_col])
    if n:
        (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(week_col).parquet(path))
    left = {r[0] for r in rows.select(week_col).distinct().collect()}
    for week in set(weeks) - left:
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{week_col}={week}")
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return n
