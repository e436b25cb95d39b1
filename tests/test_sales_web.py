import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from retailpulse.operators import sales, web
from retailpulse.plans.demo import demo_transactions

ANCHOR = dt.date(2026, 2, 20)


def test_sales_daily_demo_goldens(spark):
    bills, _, _ = demo_transactions(spark, ANCHOR, 14)
    rows = sales.sales_daily(bills).collect()
    assert len(rows) == 14
    for r in rows:
        assert r["bills_paid"] == 2
        assert (r["revenue_total"], r["base_total"], r["vat_total"], r["discount_total"]) == \
            (Decimal("285.00"), Decimal("250.00"), Decimal("45.00"), Decimal("10.00"))


def test_paid_filter_cases(spark):
    rows = [(1, Decimal("10"), None, "PAID"), (2, Decimal("20"), dt.datetime(2026, 1, 1, 5), None),
            (3, Decimal("30"), dt.datetime(2026, 1, 1, 6), "PENDING"),
            (4, Decimal("40"), dt.datetime(2026, 1, 1, 7), "PAID")]
    b = spark.createDataFrame(rows, "code long, total_amount decimal(18,2), paid_at timestamp, payment_status string")
    b = b.select("*", F.col("total_amount").alias("total"), F.lit(0).cast("decimal(18,2)").alias("vat"),
                 F.lit(0).cast("decimal(18,2)").alias("discount"))
    r = sales.sales_daily(b).collect()
    assert len(r) == 1 and r[0]["bills_paid"] == 2 and r[0]["revenue_total"] == Decimal("60.00")


def test_product_daily_demo_and_orphans(spark):
    bills, details, products = demo_transactions(spark, ANCHOR, 14)
    pd_ = sales.product_daily(bills, details, products).collect()
    assert len(pd_) == 42
    qty = {r["product_id"]: r["qty_sold"] for r in pd_ if r["day"] == ANCHOR}
    assert qty == {"A": Decimal("2.00"), "B": Decimal("4.00"), "C": Decimal("1.00")}
    assert all(r["revenue"] == 0 for r in pd_)  # the seed has no revenue column
    # An orphan product id lands in the NULL product group of its day.
    orphans = details.where(F.col("product") == "C").withColumn("product", F.lit("ZZ"))
    out = sales.product_daily(bills, details.where(F.col("product") != "C").unionByName(orphans), products)
    assert {r["product_id"] for r in out.where(F.col("day") == ANCHOR).collect()} == {"A", "B", None}


def test_revenue_column_alternatives(spark):
    bills, details, products = demo_transactions(spark, ANCHOR, 1)
    with_amount = details.withColumn("line_total", F.col("quantity") * 10)
    r = sales.product_daily(bills, with_amount, products).agg(F.sum("revenue")).first()[0]
    assert r == Decimal("70.00")
    with_price = details.withColumn("unit_price", F.lit(2))
    r = sales.product_daily(bills, with_price, products).agg(F.sum("revenue")).first()[0]
    assert r == Decimal("14.0000")


def events(spark):
    t = lambda d, h: dt.datetime(2026, 2, d, h)
    rows = [(t(16, 9), "session_start", 1, 100), (t(16, 9), "view_item", 1, 100),
            (t(16, 10), "session_start", 2, 200), (t(16, 10), "purchase", 2, 200),
            (t(17, 9), "add_to_cart", 1, 101), (t(17, 9), "scroll", 3, 300)]
    df = spark.createDataFrame(rows, "ts timestamp, event_name string, user_id long, session_id long")
    return df.withColumn("day", F.to_date("ts"))


def test_event_and_funnel_daily(spark):
    ev = {(r["day"].day, r["event_name"]): r for r in web.event_daily(events(spark)).collect()}
    assert ev[(16, "session_start")]["event_count"] == 2
    assert ev[(16, "session_start")]["total_users"] == 2
    f = {r["day"].day: r for r in web.funnel_daily(events(spark)).collect()}
    assert (f[16]["sessions"], f[16]["view_item"], f[16]["purchase"], f[16]["add_to_cart"]) == (2, 1, 1, 0)
    assert (f[17]["sessions"], f[17]["add_to_cart"]) == (0, 1)
    # Date range filter is inclusive.
    assert web.in_range(events(spark), "2026-02-17", "2026-02-17").count() == 2


def test_funnel_sales_full_outer(spark):
    f = web.funnel_daily(events(spark))
    s = spark.createDataFrame([(dt.date(2026, 2, 16), 1, Decimal("5")), (dt.date(2026, 2, 18), 2, Decimal("7"))],
                              "day date, bills_paid long, revenue_total decimal(18,2)")
    out = {r["day"].day: r for r in sales.funnel_sales_daily(f, s).collect()}
    assert set(out) == {16, 17, 18}
    assert out[16]["purchase_rate_pct"] == 50.0
    assert out[17]["purchase_rate_pct"] == 0.0 and out[18]["ga4_sessions"] == 0


def test_date_dimension_fills_gaps(spark):
    s = spark.createDataFrame([(dt.date(2026, 1, 1), 1, Decimal("5")), (dt.date(2026, 1, 4), 2, Decimal("7"))],
                              "day date, bills_paid long, revenue_total decimal(18,2)")
    out = sales.sales_by_date_dimension(s).orderBy("day").collect()
    assert [r["bills_paid"] for r in out] == [1, 0, 0, 2]
    assert out[0]["week_start"] == dt.date(2025, 12, 29)


def test_resync_daily_corrects_window(spark):
    ev = events(spark)
    first = web.event_daily(ev.where(F.col("ts") < dt.datetime(2026, 2, 16, 10)))
    fixed = web.resync_daily(ev, first, "2026-02-16", "2026-02-17")
    got = {(r["day"].day, r["event_name"]): r["event_count"] for r in fixed.collect()}
    assert got[(16, "session_start")] == 2 and got[(17, "scroll")] == 1
