from pyspark.sql import functions as F

from retailpulse.operators import quality as Q, upsert as U

SCHEMA = "k string, v long, note string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_replaces_and_inserts(spark):
    t = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], SCHEMA)
    b = spark.createDataFrame([("b", 20, "new"), ("c", 3, "new"), ("c", 4, "newer")], SCHEMA)
    out = U.upsert(t, b, ["k"], order=["v"])
    assert rows(out) == [("a", 1, "old"), ("b", 20, "new"), ("c", 4, "newer")]
    # Idempotent: applying the same batch again changes nothing.
    assert rows(U.upsert(out, b, ["k"], order=["v"])) == rows(out)


def test_upsert_stamps_only_batch_rows(spark):
    t = spark.createDataFrame([("a", 1, "old")], SCHEMA).withColumn("loaded_at", F.lit("t0"))
    b = spark.createDataFrame([("b", 2, "new")], SCHEMA)
    out = U.upsert(t, b.withColumn("loaded_at", F.lit(None).cast("string")), ["k"],
                   stamp_col="loaded_at", stamp=F.lit("t1"))
    assert {r["k"]: r["loaded_at"] for r in out.collect()} == {"a": "t0", "b": "t1"}


def test_insert_if_absent_and_replace_by_key(spark):
    t = spark.createDataFrame([("a", 1, "old"), ("b", 2, "old")], SCHEMA)
    b = spark.createDataFrame([("b", 20, "new"), ("c", 3, "new")], SCHEMA)
    assert rows(U.insert_if_absent(t, b, ["k"])) == [("a", 1, "old"), ("b", 2, "old"), ("c", 3, "new")]
    day = spark.createDataFrame([("d1", 1, "x"), ("d1", 2, "y"), ("d2", 3, "z")], SCHEMA)
    nb = spark.createDataFrame([("d1", 9, "n")], SCHEMA)
    assert rows(U.replace_by_key(day, nb, ["k"])) == [("d1", 9, "n"), ("d2", 3, "z")]


def test_empty_batch_keeps_target(spark):
    t = spark.createDataFrame([("a", 1, "old")], SCHEMA)
    e = spark.createDataFrame([], SCHEMA)
    assert rows(U.upsert(t, e, ["k"])) == rows(t)
    assert rows(U.insert_if_absent(t, e, ["k"])) == rows(t)
    assert rows(U.replace_by_key(t, e, ["k"])) == rows(t)


def test_with_defaults_only_absent(spark):
    df = spark.createDataFrame([("x", None)], "k string, geo string")
    out = U.with_defaults(df, {"geo": "PE", "currency": ""})
    assert tuple(out.first()) == ("x", None, "")


def test_violations_null_passes(spark):
    df = spark.createDataFrame([("a", 1), ("b", 4), ("c", None)], "k string, p int")
    v = Q.violations(df, {"priority_set": F.col("p").isin(1, 2, 3)}, ["k"], "p").collect()
    assert [(r["rule"], r["key"], r["value"]) for r in v] == [("priority_set", "b", "4")]


def test_duplicates_nulls_profile(spark):
    df = spark.createDataFrame([("A", ""), ("a", "x"), ("b", None)], "k string, s string")
    d = Q.duplicates(df, [F.lower("k").alias("key")]).collect()
    assert [(r["key"], r["n"]) for r in d] == [("a", 2)]
    n = {r["column_name"]: r["n_null"] for r in Q.null_counts(df).collect()}
    assert n == {"k": 0, "s": 1}
    p = {r["column_name"]: (r["ordinal"], r["n_rows"], r["blank_pct"]) for r in Q.profile(df).collect()}
    assert p == {"k": (1, 3, 0.0), "s": (2, 3, 66.67)}
    assert [r["column_name"] for r in Q.profile(df, top=1).collect()] == ["s"]


def test_sanity_counts_latest_sample(spark):
    a = spark.createDataFrame([(i,) for i in range(7)], "day int")
    out = {r["dataset"]: r["n_rows"] for r in Q.sanity_counts({"a": a, "e": a.limit(0)}).collect()}
    assert out == {"a": 7, "e": 0}
    assert [r["day"] for r in Q.latest_n(a, [F.col("day").desc()], 5).collect()] == [6, 5, 4, 3, 2]
    s = spark.createDataFrame([("", None), (" ", "x")], "a string, b string")
    assert Q.sample_rows(s).count() == 1


def test_register_views(spark):
    from retailpulse.sources.writers import register_views
    df = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    register_views({"v_demo": df}, {"v_demo": ["k", "v"]})
    assert spark.sql("SELECT * FROM v_demo").columns == ["k", "v"]


def test_writers_full_refresh_and_empty_csv(spark, tmp_dir):
    import datetime as dt
    import glob
    from retailpulse.sources.writers import write_csv, write_full_refresh
    df = spark.createDataFrame([(dt.date(2026, 1, 1), "a", 1), (dt.date(2026, 1, 2), "b", 2)],
                               "day date, k string, v long")
    write_full_refresh(df, f"{tmp_dir}/t", partition_by=["day"])
    write_full_refresh(df.where("v = 2"), f"{tmp_dir}/t", partition_by=["day"])  # full replace
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert [(r["k"], r["day"]) for r in back.collect()] == [("b", dt.date(2026, 1, 2))]
    write_csv(df.limit(0), f"{tmp_dir}/empty", single_file=True)
    files = [f for f in glob.glob(f"{tmp_dir}/empty/*.csv")]
    assert len(files) == 1 and open(files[0]).read().strip() == "day,k,v"


def test_file_inventory(spark, tmp_dir):
    df = spark.createDataFrame([(i,) for i in range(10)], "v long")
    df.repartition(2).write.parquet(f"{tmp_dir}/inv")
    inv = Q.file_inventory(spark.read.parquet(f"{tmp_dir}/inv")).collect()
    assert len(inv) == 2 and sum(r["n_rows"] for r in inv) == 10 and all(r["file_size"] > 0 for r in inv)


def test_upsert_partitions_touches_only_batch_days(spark, tmp_dir):
    import datetime as dt
    import os
    from retailpulse.sources.writers import upsert_partitions
    d1, d2, d3 = dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2026, 1, 3)
    schema = "day date, event_name string, event_count long"
    path = f"{tmp_dir}/facts"
    first = spark.createDataFrame([(d1, "a", 1), (d2, "a", 2), (d2, "b", 3)], schema)
    upsert_partitions(spark, path, first, ["day", "event_name"])
    untouched = sorted(os.listdir(f"{path}/day=2026-01-01"))
    batch = spark.createDataFrame([(d2, "a", 20), (d3, "c", 5)], schema)
    upsert_partitions(spark, path, batch, ["day", "event_name"])
    got = sorted((r["day"], r["event_name"], r["event_count"]) for r in spark.read.parquet(path).collect())
    assert got == [(d1, "a", 1), (d2, "a", 20), (d2, "b", 3), (d3, "c", 5)]
    assert sorted(os.listdir(f"{path}/day=2026-01-01")) == untouched  # day 1 never rewritten


def test_null_keys_are_found_again(spark):
    from retailpulse.operators.upsert import insert_if_absent, upsert
    batch = spark.createDataFrame([(None, "a", 1), (2, "a", 2)], "day int, k string, n int")
    once = upsert(batch.limit(0), batch, ["day", "k"])
    assert upsert(once, batch, ["day", "k"]).count() == 2
    assert insert_if_absent(once, batch, ["day", "k"]).count() == 2


def test_partition_upsert_rules(spark, tmp_dir):
    import pytest
    from retailpulse.sources.writers import read_if_exists, upsert_partitions
    batch = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, "b", 3)], "day int, k string, n int")
    path = f"{tmp_dir}/t"
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, batch, ["k"])
    assert read_if_exists(spark, path) is None
    upsert_partitions(spark, path, batch, ["day", "k"], order=["n"])
    assert sorted((r["day"], r["n"]) for r in spark.read.parquet(path).collect()) == [(1, 2), (2, 3)]
    import os
    os.makedirs(f"{tmp_dir}/bad")
    with open(f"{tmp_dir}/bad/x.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        upsert_partitions(spark, f"{tmp_dir}/bad", batch, ["day", "k"])
    assert os.listdir(f"{tmp_dir}/bad") == ["x.parquet"]


def test_whitespace_numbers_and_revenue(spark):
    from pyspark.sql import functions as F
    from retailpulse.functions.numbers import round_half_up, safe_float
    from retailpulse.functions.schema import normalize_category, resolve_columns, revenue_expr
    from retailpulse.functions.text import clean_search_term
    df = spark.createDataFrame([("\t12,5",), (" (not set)\n",), ("\tzapatos\xa0",), ("1e30",)], "x string")
    assert [r[0] for r in df.select(safe_float("x")).collect()] == [12.5, None, None, 1e30]
    assert [r[0] for r in df.select(clean_search_term("x")).collect()] == ["12,5", None, "zapatos", "1e30"]
    assert df.select(normalize_category("x", "category_id")).collect()[2][0] == "id:zapatos"
    assert [r[0] for r in df.select(round_half_up(safe_float("x"))).collect()] == [12.5, None, None, 1e30]
    line = spark.createDataFrame([(3, 0.125)], "quantity int, unit_price double")
    assert float(line.select(revenue_expr(line.columns)).first()[0]) == 0.375
    assert resolve_columns(["ID", " Category_ID", "Category Name", "Total_Amount ", "price", "Order_Date"]) == {
        "price": "Total_Amount ", "date": "Order_Date", "category": " Category_ID",
        "category_kind": "category", "text": None}
