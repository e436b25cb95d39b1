"""Plan-time schema helpers: column resolution over headers, conform, defaults.

These run on the driver over ``df.columns`` only (no job is started).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip

# ---------------------------------------------------------------------------
# Header keys of the CSV-drop column resolver, in priority order.
HEADER_KEYS = {
    "price": ["totalamount", "total_amount", "price"],
    "date": ["event_time", "orderdate", "order_date", "purchase_date", "date", "datetime",
             "timestamp", "time"],
    "category": ["category_code", "category", "category_name", "department", "type",
                 "category_id"],
    "text": ["description", "product"],
}
# What a category header stands for; any other key is a plain category name.
CATEGORY_KINDS = {"category_code": "category_code", "category_id": "category_id"}
# Revenue candidates of a bill-detail table, in priority order; the last two are
# quantity * unit price products.
REVENUE_COLUMNS = ["total_amount", "total", "line_total", "subtotal", "amount"]
REVENUE_PRODUCTS = ["unit_price", "price"]
# ---------------------------------------------------------------------------

# Scale of quantities and unit prices; their product keeps every digit.
EXACT = "decimal(18,6)"


def ranked_headers(columns: list[str]) -> list[tuple[str, int, int, str]]:
    """(role, rank of the key, place of the header, header) of every header that holds a key of
    the role, whatever its case."""
    return sorted((role, rank, place, header)
                  for place, header in enumerate(columns)
                  for role, keys in HEADER_KEYS.items()
                  for rank, key in enumerate(keys) if key in header.strip().lower())


def resolve_columns(columns: list[str]) -> dict:
    """The price, date, category and text columns of a CSV drop (None where there is none):
    the best-ranked key decides, then the order of the headers. ``category_kind`` says what
    the category column holds."""
    best: dict = dict.fromkeys([*HEADER_KEYS, "category_kind"])
    for role, rank, _, header in reversed(ranked_headers(columns)):
        best[role] = header
        if role == "category":
            key = HEADER_KEYS[role][rank]
            best["category_kind"] = CATEGORY_KINDS.get(key, "category")
    return best


def normalize_category(c, kind: str) -> Column:
    """category_code / category -> lower(strip); category_id -> 'id:' + strip; blank -> ''."""
    v = strip(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")))
    if kind == "category_id":
        return F.when(v == "", F.lit("")).otherwise(F.concat(F.lit("id:"), v))
    return F.lower(v)


def revenue_expr(columns: list[str], prefix: str = "") -> Column:
    """First existing revenue column, else quantity * unit price (every digit kept), else 0."""
    cols = {c.lower(): c for c in columns}
    for name in REVENUE_COLUMNS:
        if name in cols:
            return F.col(prefix + cols[name]).cast(EXACT)
    for name in REVENUE_PRODUCTS:
        if name in cols and "quantity" in cols:
            return F.col(prefix + cols["quantity"]).cast(EXACT) * F.col(prefix + cols[name]).cast(EXACT)
    return F.lit(0).cast(EXACT)


def conform(df: DataFrame, renames: dict[str, str] | None = None,
            defaults: dict[str, object] | None = None) -> DataFrame:
    """Rename a legacy column only when the new one is absent; add absent columns with a
    default value (an explicit NULL in an existing column is kept, like a DB default)."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    for name, value in (defaults or {}).items():
        if name not in df.columns:
            df = df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
    return df


def clean_header(columns: list[str]) -> list[str]:
    return [c.strip().lstrip("﻿").strip() for c in columns]
