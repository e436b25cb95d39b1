"""Search-interest export files -> weekly interest rows.

File layout: free preamble, then a header whose first cell is a date/time label, then
``date<delim>value`` rows. The sequential rules of the format are expressed as per-file
aggregates over (file, line position):

* header   = first non-blank line containing ';' (preferred) or ',' whose first cell
             is a header label; its delimiter is used for the whole file;
* keyword  = second header cell up to the first ':';
* a row with fewer than two cells is skipped; a row whose first cell is not a date
  ends the block once at least one point was read (later rows are ignored); a row
  with a bad value is skipped without ending the block;
* points are averaged per Monday week (half-to-even) per file; when several files
  carry the same (week, keyword), the file whose path sorts last wins.

The rules depend on the order of the lines of a file, not on who reads them: files are read as
numbered lines (``lines.numbered_lines``), so a long file is shared by as many tasks as it has
splits, and header, first point and end of block are the least numbers of their kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import parse_export_date
from ..functions.numbers import interest_value
from ..functions.text import keyword_header_clean
from ..operators.signals import interest_last_file_wins
from .lines import numbered_lines

# First header cells that open the data block (compared lower-cased).
HEADER_LABELS = ["semana", "week", "date", "time", "hora"]


def _strip_py(c):
    """Whitespace strip, then quotes, then a leading BOM (the order matters)."""
    s = F.regexp_replace(c, r"^\s+|\s+$", "")
    s = F.regexp_replace(s, '^"+|"+$', "")
    return F.regexp_replace(s, "^﻿+", "")


def _cells(line, delim: str):
    return F.from_csv(line, "c0 STRING, c1 STRING", {"sep": delim})


def export_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, line for every line of every *.csv export below ``path``."""
    return numbered_lines(spark, path, "*.csv").withColumnRenamed("path", "file")


def parse_export_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points, status): points = file, keyword, day, interest; status per file."""
    stripped = F.regexp_replace(F.col("line"), r"^\s+|\s+$", "")
    delim = (F.when(F.instr(stripped, ";") > 0, F.lit(";"))
             .when(F.instr(stripped, ",") > 0, F.lit(",")))
    head = (F.when(delim == ";", F.substring_index(stripped, ";", 1))
            .otherwise(F.substring_index(stripped, ",", 1)))
    first_cell = F.lower(_strip_py(head))
    marked = lines.select("file", "pos", "line", delim.alias("delim"),
                          (delim.isNotNull() & first_cell.isin(*HEADER_LABELS)).alias("is_header"))
    headers = (marked.where("is_header").groupBy("file")
               .agg(F.min_by(F.struct("pos", "delim", "line"), "pos").alias("h"))
               .select("file", F.col("h.pos").alias("header_pos"), F.col("h.delim").alias("sep"),
                       F.col("h.line").alias("header_line")))
    second = F.when(F.col("sep") == ";", _cells(F.col("header_line"), ";")["c1"]) \
              .otherwise(_cells(F.col("header_line"), ",")["c1"])
    headers = headers.withColumn("keyword", keyword_header_clean(second))

    body = marked.join(headers, "file").where(F.col("pos") > F.col("header_pos"))
    cells = F.when(F.col("sep") == ";", _cells(F.col("line"), ";")).otherwise(_cells(F.col("line"), ","))
    body = body.select("file", "pos", "keyword", cells.alias("c"),
                       (F.instr("line", F.col("sep")) > 0).alias("has_two"))
    body = body.select("file", "pos", "keyword", "has_two",
                       parse_export_date(F.col("c.c0")).alias("day"),
                       interest_value(F.coalesce(F.col("c.c1"), F.lit(""))).alias("interest"))
    body = body.where("has_two")
    valid = F.col("day").isNotNull() & F.col("interest").isNotNull()
    first_point = (body.where(valid).groupBy("file").agg(F.min("pos").alias("first_pos")))
    ends = (body.join(first_point, "file")
            .where((F.col("pos") > F.col("first_pos")) & F.col("day").isNull())
            .groupBy("file").agg(F.min("pos").alias("end_pos")))
    points = (body.where(valid).join(ends, "file", "left")
              .where(F.col("end_pos").isNull() | (F.col("pos") < F.col("end_pos")))
              .select("file", "keyword", "day", "interest"))

    files = lines.select("file").distinct()
    counts = points.groupBy("file").agg(F.count(F.lit(1)).alias("n_points"))
    status = (files.join(headers.select("file", "header_pos", "keyword"), "file", "left")
              .join(counts, "file", "left")
              .select("file", "header_pos", "keyword",
                      F.coalesce("n_points", F.lit(0)).alias("n_points"),
                      F.when(F.col("header_pos").isNull(), "NO_HEADER")
                       .when(F.col("keyword").isNull() | (F.col("keyword") == ""), "BAD_HEADER")
                       .when(F.col("n_points").isNull(), "NO_POINTS").otherwise("OK")
                       .alias("status")))
    ok = points.where(F.col("keyword").isNotNull() & (F.col("keyword") != ""))
    return ok, status


def weekly_from_points(points: DataFrame, geo: str = "PE", region: str = "") -> DataFrame:
    """Per file weekly mean (half-to-even, clamped), then last file wins per key."""
    wk = (points.groupBy("file", "keyword", F.trunc("day", "week").alias("week_start"))
          .agg(F.avg("interest").alias("_avg"))
          .select("week_start", F.col("keyword").alias("keyword_canonica"),
                  F.lit(geo).alias("geo"), F.lit(region).alias("region"),
                  F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.bround("_avg", 0)))
                  .cast("int").alias("interest"),
                  F.col("file").alias("file_name")))
    return interest_last_file_wins(wk, "file_name")


def read_interest_exports(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(weekly interest rows, per-file status report)."""
    points, status = parse_export_lines(export_lines(spark, path))
    return weekly_from_points(points), status
