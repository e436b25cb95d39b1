import datetime as dt

from pyspark.sql import functions as F

from retailpulse.functions import dates, numbers, schema, text


def one(spark, col, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).first()["r"]


def test_norm_txt_folds_accents_and_keeps_spaces(spark):
    assert one(spark, text.norm_txt, "CÁMARA de Ñandú ") == "camara de nandu "
    assert one(spark, text.norm_txt, None) == ""


def test_clean_search_term(spark):
    vals = ["  Celular ", "(not set)", "Not Set", "", "   ", "Xyz"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(text.clean_search_term("v")).collect()]
    assert got == ["Celular", None, None, None, None, "Xyz"]


def test_tokenize_rules(spark):
    s = "<p>The Samsung Galaxy 2024 phone, recycled cotton & ñandú details!</p> ab abc"
    toks = one(spark, text.tokenize, s)
    # 'ñandú' splits into 'and' (a stopword): the tokenizer is ASCII-only.
    assert toks == ["samsung", "galaxy", "phone", "abc"]
    assert "2024" not in toks and "the" not in toks and "recycled" not in toks


def test_keyword_header_clean(spark):
    assert one(spark, text.keyword_header_clean, '"celular: (Perú)"') == "celular"
    assert one(spark, text.keyword_header_clean, "tv") == "tv"


def test_safe_float(spark):
    cases = {" 12,5 ": 12.5, "": None, "1,234.56": None, "abc": None, "1.5d": None,
             "7": 7.0, "-3.25": -3.25, "1e3": 1000.0}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r[0]: r[1] for r in df.select("v", numbers.safe_float("v")).collect()}
    assert got == cases


def test_interest_value(spark):
    cases = {"<1": 0, "7.9": 7, "140": 100, "-5": 0, "x": None, "NaN": None, '"55"': 55}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r[0]: r[1] for r in df.select("v", numbers.interest_value("v")).collect()}
    assert got == cases


def test_round_half_up_avoids_binary_noise(spark):
    assert one(spark, lambda c: numbers.round_half_up(c, 2), 1.005, "double") == 1.01
    assert one(spark, lambda c: numbers.round_half_up(c, 2), 2.675, "double") == 2.68


def test_safe_pct_zero_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    got = [r[0] for r in df.select(numbers.safe_pct("a", "b")).collect()]
    assert got == [None, 33.33]


def test_parse_date_any(spark):
    cases = {"2024-11-11": dt.date(2024, 11, 11), "2020-04-24 11:50:39 UTC": dt.date(2020, 4, 24),
             "2021-01-02T03:04:05Z": dt.date(2021, 1, 2), "order on 2022-05-06 x": dt.date(2022, 5, 6),
             "2020-13-01": None, "nothing": None, "": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r[0]: r[1] for r in df.select("v", dates.parse_date_any("v")).collect()}
    assert got == cases


def test_parse_export_date(spark):
    cases = {"2026-02-16": dt.date(2026, 2, 16), "﻿2026-02-16": dt.date(2026, 2, 16),
             '"2026-02-21T16:32:00Z"': dt.date(2026, 2, 21),
             "2026-02-21T23:59:00-05:00": dt.date(2026, 2, 21), "16/02/2026": None, "texto": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r[0]: r[1] for r in df.select("v", dates.parse_export_date("v")).collect()}
    assert got == cases


def test_parse_yyyymmdd_and_week_start(spark):
    df = spark.createDataFrame([("20240103",), ("2024013",)], "v string")
    got = [r[0] for r in df.select(dates.parse_yyyymmdd("v")).collect()]
    assert got == [dt.date(2024, 1, 3), None]
    assert one(spark, dates.week_start, dt.date(2026, 1, 1), "date") == dt.date(2025, 12, 29)


def test_resolve_range():
    today = dt.date(2026, 2, 20)
    assert dates.resolve_range(today=today, lookback_days=30) == (dt.date(2026, 1, 21), today)
    assert dates.resolve_range("2026-01-01", "2026-01-05") == (dt.date(2026, 1, 1), dt.date(2026, 1, 5))
    assert dates.resolve_range(today=today, lookback_days=-3) == (today, today)


def test_resolve_columns_goldens():
    purchases = ["event_time", "order_id", "product_id", "category_id", "category_code", "brand",
                 "price", "user_id"]
    r = schema.resolve_columns(purchases)
    assert (r["price"], r["date"], r["category"], r["category_kind"], r["text"]) == \
        ("price", "event_time", "category_code", "category_code", "product_id")
    orders = ["OrderID", "Product", "Category", "Brand", "Platform", "City", "Price", "Quantity",
              "TotalAmount", "Rating", "Reviews", "OrderDate"]
    r = schema.resolve_columns(orders)
    assert (r["price"], r["date"], r["category"], r["text"]) == \
        ("TotalAmount", "OrderDate", "Category", "Product")
    r = schema.resolve_columns(["id", "description"])
    assert r["text"] == "description" and r["category"] is None


def test_normalize_category(spark):
    df = spark.createDataFrame([(" Electronics.Audio ", "7", "")], "a string, b string, c string")
    row = df.select(schema.normalize_category("a", "category_code"),
                    schema.normalize_category("b", "category_id"),
                    schema.normalize_category("c", "category")).first()
    assert tuple(row) == ("electronics.audio", "id:7", "")


def test_conform_rename_and_defaults(spark):
    df = spark.createDataFrame([("x", None)], "keyword_canonicca string, region string")
    out = schema.conform(df, {"keyword_canonicca": "keyword_canonica"}, {"region": "ALL", "geo": "PE"})
    assert out.columns == ["keyword_canonica", "region", "geo"]
    assert tuple(out.first()) == ("x", None, "PE")


def test_price_value(spark):
    cases = {"12.5": 12.5, '"7"': 7.0, '{"price": 3.25}': 3.25, "{}": None, "abc": None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r[0]: r[1] for r in df.select("v", numbers.price_value("v")).collect()}
    assert got == cases


def test_blank_default(spark):
    df = spark.createDataFrame([("  ",), (None,), (" x ",)], "v string")
    got = [r[0] for r in df.select(text.blank_default("v", "ALL")).collect()]
    assert got == ["ALL", "ALL", "x"]
    got = [r[0] for r in df.select(text.blank_default("v", "ALL", trim=False)).collect()]
    assert got == ["  ", "ALL", " x "]
