"""Marketplace responses landed as JSON: search sampling and trending terms.

One response is one row (a bounded document), so everything below is a per-row array
transformation on the JVM: no explode-and-regroup, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import strip
from .quantiles import array_percentile

SEARCH_SCHEMA = ("paging STRUCT<total: BIGINT>, "
                 "results ARRAY<STRUCT<price: DOUBLE, category_id: STRING>>, "
                 "filters ARRAY<STRUCT<id: STRING, values: ARRAY<STRUCT<id: STRING, name: STRING>>>>")
TRENDS_SCHEMA = "ARRAY<STRUCT<keyword: STRING, url: STRING>>"


def _truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def parse_search_responses(df: DataFrame, json_col: str = "json", pick: str = "last") -> DataFrame:
    """Adds results_total, price_p25, price_median, price_p75, top_category_id,
    top_category_name. Prices: numeric item prices only. Top category: first item's
    category, overridden by the 'category' filter (``pick='last'``: every matching
    filter overrides in turn, field by field, when its value is non-blank;
    ``pick='first'``: the first matching filter only, without the item fallback)."""
    # Parse once into a column; every derived value reads that column (referencing
    # the from_json expression itself would re-parse the document per use).
    parsed = df.withColumn("_r", F.from_json(F.col(json_col), SEARCH_SCHEMA))
    r = F.col("_r")
    # results.price projects the field over the array; compact + sort_array are
    # compiled built-ins (lambda-based array functions are interpreted per element).
    prices = F.sort_array(F.array_compact(r["results"]["price"]))
    cat_filters = F.filter(r["filters"], lambda f: (f["id"] == "category")
                           & (F.coalesce(F.size(f["values"]), F.lit(0)) > 0))
    if pick == "first":
        first = F.try_element_at(cat_filters, F.lit(1))
        top = F.struct(first["values"][0]["id"].alias("id"), first["values"][0]["name"].alias("name"))
    else:
        start = F.struct(F.try_element_at(r["results"], F.lit(1))["category_id"].alias("id"),
                         F.lit(None).cast("string").alias("name"))
        top = F.aggregate(cat_filters, start, lambda acc, f: F.struct(
            F.coalesce(_truthy(f["values"][0]["id"]), acc["id"]).alias("id"),
            F.coalesce(_truthy(f["values"][0]["name"]), acc["name"]).alias("name")))
    staged = parsed.select(*df.columns, F.coalesce(r["paging"]["total"], F.lit(0)).alias("results_total"),
                           prices.alias("_prices"), top.alias("_top"))
    s = F.col("_prices")
    return staged.select(*df.columns, "results_total",
                         array_percentile(s, 0.5).alias("price_median"),
                         array_percentile(s, 0.25).alias("price_p25"),
                         array_percentile(s, 0.75).alias("price_p75"),
                         F.col("_top.id").alias("top_category_id"),
                         F.col("_top.name").alias("top_category_name"))


def parse_trend_responses(df: DataFrame, json_col: str = "json",
                          max_entries: int | None = None) -> DataFrame:
    """One row per entry: rank (1-based position; blank keywords are skipped but keep their
    rank slot), keyword, url. ``max_entries`` keeps the first so many of each response."""
    arr = F.from_json(F.col(json_col), TRENDS_SCHEMA)
    rest = [c for c in df.columns if c != json_col]
    e = df.select(*rest, F.posexplode(arr).alias("_pos", "_e"))
    kw = strip(F.coalesce(F.col("_e.keyword"), F.lit("")))
    if max_entries is not None:
        e = e.where(F.col("_pos") < max_entries)
    return (e.where(kw != "")
            .select(*rest, (F.col("_pos") + 1).cast("smallint").alias("rank"), kw.alias("keyword"),
                    strip(F.coalesce(F.col("_e.url"), F.lit(""))).alias("url")))


def latest_responses(df: DataFrame, keys: list[str], order: str, json_col: str = "json") -> DataFrame:
    """keys and the raw document fetched last for each (NULL documents and orders come first);
    choosing before parsing leaves one document per key to parse."""
    last = F.max(F.struct(F.col(order).alias("o"), F.col(json_col).alias("j")))
    return df.groupBy(*keys).agg(last.alias("_l")).select(*keys, F.col("_l.j").alias(json_col))
