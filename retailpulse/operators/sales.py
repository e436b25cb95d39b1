"""Sales marts: paid bills per day, product revenue per day, funnel + sales, day grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.schema import EXACT, revenue_expr
from ..functions.numbers import round_half_up


def paid_filter(paid_at: str = "paid_at", status: str = "payment_status") -> Column:
    """Paid bill: a payment time and status NULL or 'PAID'."""
    return F.col(paid_at).isNotNull() & (F.col(status).isNull() | (F.col(status) == "PAID"))


def sales_daily(bills: DataFrame) -> DataFrame:
    """day, bills_paid, revenue_total, base_total, vat_total, discount_total."""
    zero = F.lit(0)
    return (bills.where(paid_filter())
            .groupBy(F.to_date("paid_at").alias("day"))
            .agg(F.count(F.lit(1)).alias("bills_paid"),
                 F.coalesce(F.sum("total_amount"), zero).alias("revenue_total"),
                 F.coalesce(F.sum("total"), zero).alias("base_total"),
                 F.coalesce(F.sum("vat"), zero).alias("vat_total"),
                 F.coalesce(F.sum("discount"), zero).alias("discount_total")))


def product_daily(bills: DataFrame, details: DataFrame, products: DataFrame) -> DataFrame:
    """day, product_id, product_name, qty_sold, revenue.

    The revenue expression is chosen from the detail columns at plan time. Lines are
    summed per (day, detail product) *before* the product lookup, so the lookup join sees
    one row per product and day instead of one per line; the final regroup reproduces
    the reference grain, where product_id is the product-side id (all orphan lines of a
    day share the NULL group).
    """
    rev = revenue_expr(details.columns, prefix="d.")
    paid = (bills.where(paid_filter())
            .select(F.col("code").alias("bill_code"), F.to_date("paid_at").alias("day")))
    lines = (details.alias("d")
             .join(paid.alias("b"), F.col("d.bill_code") == F.col("b.bill_code"))
             .groupBy(F.col("b.day").alias("day"), F.col("d.product").alias("product"))
             .agg(F.sum(F.col("d.quantity").cast(EXACT)).alias("qty"),
                  F.sum(rev).alias("rev")))
    prod = products.select(F.col("id").alias("product_id"), F.col("name").alias("product_name"))
    joined = lines.join(prod, lines.product == prod.product_id, "left")
    return (joined.groupBy("day", "product_id", "product_name")
            .agg(F.coalesce(F.sum("qty"), F.lit(0)).alias("qty_sold"),
                 F.coalesce(F.sum("rev"), F.lit(0)).alias("revenue")))


def funnel_sales_daily(funnel: DataFrame, sales: DataFrame) -> DataFrame:
    """Full outer join of the web funnel and paid sales per day, with purchase rate %."""
    f = funnel.select(F.col("day").alias("f_day"), "sessions", "view_item", "add_to_cart",
                      "begin_checkout", "purchase")
    s = sales.select(F.col("day").alias("s_day"), "bills_paid", "revenue_total")
    j = f.join(s, f.f_day == s.s_day, "full_outer")
    z = F.lit(0)
    sessions = F.coalesce(F.col("sessions"), z)
    bills = F.coalesce(F.col("bills_paid"), z)
    return j.select(
        F.coalesce("f_day", "s_day").alias("day"),
        sessions.alias("ga4_sessions"),
        F.coalesce("view_item", z).alias("ga4_view_item"),
        F.coalesce("add_to_cart", z).alias("ga4_add_to_cart"),
        F.coalesce("begin_checkout", z).alias("ga4_begin_checkout"),
        F.coalesce("purchase", z).alias("ga4_purchase"),
        bills.alias("bills_paid"),
        F.coalesce("revenue_total", z).alias("revenue_total"),
        F.when(sessions > 0, round_half_up(F.lit(100.0) * bills / sessions, 2))
         .otherwise(F.lit(0.0)).alias("purchase_rate_pct"))


def date_dimension(start: Column, end: Column, spark_df: DataFrame) -> DataFrame:
    """One row per day in [start, end] with calendar attributes; ``start``/``end`` are
    scalar columns (literals or scalar subqueries) evaluated over ``spark_df``'s session."""
    spark = spark_df.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(start, end)).alias("day"))
    return days.select("day", F.year("day").alias("year"), F.month("day").alias("month"),
                       F.trunc("day", "week").alias("week_start"),
                       F.dayofweek("day").alias("day_of_week"))


def sales_by_date_dimension(sales: DataFrame) -> DataFrame:
    """Every day between the first and last sales day, zero-filled (BI date table)."""
    dim = date_dimension(sales.select(F.min("day")).scalar(),
                         sales.select(F.max("day")).scalar(), sales)
    z = F.lit(0)
    return (dim.join(sales, "day", "left")
            .select("day", "year", "month", "week_start",
                    F.coalesce("bills_paid", z).alias("bills_paid"),
                    F.coalesce("revenue_total", z).alias("revenue_total")))
