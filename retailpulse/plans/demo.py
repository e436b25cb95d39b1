"""Demo transactions for tests: n days back from an anchor date, two bills per day.

Per day: bill 1 = 100 base + 18 VAT - 0 discount = 118 with lines A x2, B x1;
bill 2 = 150 base + 27 VAT - 10 discount = 167 with lines B x3, C x1. Built with
``spark.range`` (a fixture generator; no registry query runs on it alone).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

# The two daily demo bills (base, vat, discount, total) and their lines.
BILLS = [(1, 100, 18, 0, 118), (2, 150, 27, 10, 167)]
LINES = [(1, "A", 2), (1, "B", 1), (2, "B", 3), (2, "C", 1)]
PRODUCTS = [("A", "Producto A", 10.0), ("B", "Producto B", 25.0), ("C", "Producto C", 40.0)]


def demo_transactions(spark: SparkSession, anchor: dt.date, n_days: int = 14
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bills, details, products) for ``n_days`` days ending at ``anchor``."""
    days = spark.range(n_days).select(
        F.col("id").alias("d"), F.date_sub(F.lit(anchor.isoformat()).cast("date"),
                                           F.col("id").cast("int")).alias("day"))
    bill_structs = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(t).alias("total"),
                                      F.lit(v).alias("vat"), F.lit(d).alias("discount"),
                                      F.lit(a).alias("total_amount")) for n, t, v, d, a in BILLS])
    b = days.select("d", "day", F.explode(bill_structs).alias("b"))
    bills = b.select(
        (F.col("d") * 10 + F.col("b.n")).alias("code"), F.lit(1).alias("user_id"),
        *[F.col(f"b.{c}").cast("decimal(18,2)").alias(c)
          for c in ("total", "discount", "vat", "total_amount")],
        F.to_timestamp(F.concat(F.col("day").cast("string"), F.lit(" 12:00:00"))).alias("paid_at"),
        F.lit("PAID").alias("payment_status"))
    line_structs = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(p).alias("product"),
                                      F.lit(q).alias("quantity")) for n, p, q in LINES])
    ln = days.select("d", F.explode(line_structs).alias("l"))
    details = ln.select((F.col("d") * 10 + F.col("l.n")).alias("bill_code"),
                        F.col("l.product").alias("product"),
                        F.col("l.quantity").cast("decimal(18,2)").alias("quantity"))
    products = spark.createDataFrame(PRODUCTS, "id string, name string, price double")
    return bills, details, products
