import datetime as dt
import json
import os

from pyspark.sql import functions as F

from retailpulse.operators import marketplace as M, web
from retailpulse.sources import csv as CSV
from retailpulse.sources.interest_export import read_interest_exports
from retailpulse.streaming.event_daily import run_event_daily_stream

D = dt.date


def test_search_response_goldens(spark):
    docs = [json.dumps({"paging": {"total": 120},
                        "results": [{"price": 10.5, "category_id": "C1"}, {"price": None},
                                    {"price": 20}, {"price": "12"}],
                        "filters": [{"id": "category", "values": [{"id": "C9", "name": "Audio"}]}]}),
            json.dumps({"paging": {"total": 0}, "results": [], "filters": []}),
            json.dumps({"results": [{"price": 5, "category_id": "C2"}],
                        "filters": [{"id": "category", "values": [{"id": "C3", "name": ""}]},
                                    {"id": "category", "values": [{"id": "", "name": "Last"}]}]})]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, json string")
    out = {r["i"]: r for r in M.parse_search_responses(df).collect()}
    r = out[0]
    assert (r["results_total"], r["price_p25"], r["price_median"], r["price_p75"]) == (120, 12.875, 15.25, 17.625)
    assert (r["top_category_id"], r["top_category_name"]) == ("C9", "Audio")
    r = out[1]
    assert (r["price_median"], r["top_category_id"], r["top_category_name"]) == (None, None, None)
    r = out[2]
    assert (r["results_total"], r["price_median"]) == (0, 5.0)
    assert (r["top_category_id"], r["top_category_name"]) == ("C3", "Last")   # field-wise last wins
    first = {r["i"]: r for r in M.parse_search_responses(df, pick="first").collect()}
    assert (first[2]["top_category_id"], first[2]["top_category_name"]) == ("C3", "")


def test_trend_response_ranks(spark):
    doc = json.dumps([{"keyword": "a", "url": "u"}, {"keyword": ""}, {"keyword": " b "}])
    df = spark.createDataFrame([(D(2026, 2, 16), doc)], "week_start date, json string")
    got = [(r["rank"], r["keyword"], r["url"]) for r in M.parse_trend_responses(df).orderBy("rank").collect()]
    assert got == [(1, "a", "u"), (3, "b", "")]
    many = json.dumps([{"keyword": f"k{i}"} for i in range(60)])
    df = spark.createDataFrame([(D(2026, 2, 16), many)], "week_start date, json string")
    assert M.parse_trend_responses(df).count() == 60
    assert M.parse_trend_responses(df, max_entries=50).count() == 50


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_interest_export_files(spark, tmp_dir):
    write(f"{tmp_dir}/a_celular.csv",
          "Categoría: Todas\n\n﻿Semana;celular: (Perú)\n2026-02-16;<1\n2026-02-17;7.9\n\n"
          "2026-02-18;140\n2026-02-21T16:32:00Z;50\n2026-02-19;x\ntexto;1\n2026-02-23;99\n")
    write(f"{tmp_dir}/b_tv.csv", "Week,tv: (Peru)\n2026-03-02,2\n2026-03-03,3\n")
    write(f"{tmp_dir}/c_celular.csv", "Date,Celular\n2026-02-16,80\n")
    write(f"{tmp_dir}/d_nohead.csv", "foo bar\n1 2\n")
    weekly, status = read_interest_exports(spark, tmp_dir)
    got = {(r["week_start"], r["keyword_canonica"]): r["interest"] for r in weekly.collect()}
    assert got == {(D(2026, 2, 16), "Celular"): 80, (D(2026, 3, 2), "tv"): 2}
    st = {os.path.basename(r["file"]): r["status"] for r in status.collect()}
    assert st == {"a_celular.csv": "OK", "b_tv.csv": "OK", "c_celular.csv": "OK", "d_nohead.csv": "NO_HEADER"}
    pts = {os.path.basename(r["file"]): r["n_points"] for r in status.collect()}
    assert pts["a_celular.csv"] == 4


def test_interest_export_single_file_mean(spark, tmp_dir):
    write(f"{tmp_dir}/a.csv", "Semana;celular: (Perú)\n2026-02-16;<1\n2026-02-17;7.9\n2026-02-18;140\n"
                              "2026-02-21T16:32:00Z;50\ntexto;1\n2026-02-23;99\n")
    weekly, _ = read_interest_exports(spark, tmp_dir)
    assert [(r["week_start"], r["interest"]) for r in weekly.collect()] == [(D(2026, 2, 16), 39)]


def test_csv_sniff_and_curated(spark, tmp_dir):
    lines = ["event_time;order_id;product_id;category_id;category_code;brand;price;user_id"]
    for i in range(40):
        lines.append(f"2020-04-{(i % 20) + 1:02d} 11:50:39 UTC;{i};{1000 + i};7;electronics.tablet;s;{i + 1},5;9")
    lines.append("bad;1;2;3;;s;5;9")
    write(f"{tmp_dir}/shop/part1.csv", "\n".join(lines) + "\n")
    write(f"{tmp_dir}/desc/d.csv", "id,description\n1,<p>Wireless headphones</p>\n2,headphones case\n")
    heads = {r["source"]: r["header"] for r in CSV.header_lines(spark, tmp_dir).collect()}
    assert CSV.sniff_delimiter(heads["shop"]) == ";" and CSV.sniff_delimiter(heads["desc"]) == ","
    out = CSV.build_curated(spark, tmp_dir)
    b = out["price_benchmark"].collect()
    assert [(r["source"], r["category_norm"], r["n_prices"], r["price_p50"]) for r in b] == \
        [("shop", "electronics.tablet", 40, 21.0)]
    terms = {(r["source"], r["term"]): r["term_count"] for r in out["text_terms"].collect()}
    assert terms[("desc", "headphones")] == 2
    assert sum(r["n_events"] for r in out["category_weekly"].collect()) == 40


def test_typed_csv_booleans(spark, tmp_dir):
    write(f"{tmp_dir}/k.csv", "keyword_raw,keyword_canonica,categoria,subcategoria,sinonimo_de,es_error_ortografico,prioridad\n"
                              "celu,celular,Tecnología,Celulares,celular,0,1\nsamsng,samsung,T,C,,1,\n")
    df = CSV.read_keyword_staging(spark, f"{tmp_dir}/k.csv").collect()
    assert [(r["es_error_ortografico"], r["prioridad"], r["sinonimo_de"]) for r in df] == \
        [(False, 1, "celular"), (True, None, None)]


def test_stream_matches_batch_counts(spark, tmp_dir):
    from retailpulse.plans import adapters as A
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.repartition(3).write.parquet(f"{tmp_dir}/events")
    out = run_event_daily_stream(spark, f"{tmp_dir}/events", f"{tmp_dir}/target", f"{tmp_dir}/ckpt",
                                 A.web_events)
    batch = web.event_daily(A.web_events(ev))
    cols = ["day", "event_name", "event_count", "total_users", "sessions"]
    s = {tuple(r) for r in out.select(*cols).collect()}
    b = {tuple(r) for r in batch.select(*cols).collect()}
    assert s == b
    # A second run with no new files keeps the table unchanged (checkpointed progress).
    again = run_event_daily_stream(spark, f"{tmp_dir}/events", f"{tmp_dir}/target", f"{tmp_dir}/ckpt",
                                   A.web_events)
    assert {tuple(r) for r in again.select(*cols).collect()} == b


def test_stream_late_events_correct_earlier_day(spark, tmp_dir):
    from retailpulse.plans import adapters as A
    from retailpulse.streaming.event_daily import daily_funnel, run_daily_stream
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    early = ev.where(F.to_date("ts") <= F.lit("2024-01-10").cast("date"))
    late = ev.where(F.to_date("ts") > F.lit("2024-01-10").cast("date"))
    # First run sees days up to the 10th, minus the events of the 5th that arrive late.
    early.where(F.to_date("ts") != F.lit("2024-01-05").cast("date")).write.parquet(f"{tmp_dir}/src/a")
    build = lambda raw: daily_funnel(A.web_events(raw))
    os.makedirs(f"{tmp_dir}/landing")                                 # empty landing folder
    empty = run_daily_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t0", f"{tmp_dir}/c0", build, ["day"])
    assert empty.count() == 0 and "sessions" in empty.columns     # empty input is success
    first = run_daily_stream(spark, f"{tmp_dir}/src/*", f"{tmp_dir}/t", f"{tmp_dir}/c", build, ["day"])
    assert D(2024, 1, 5) not in {r["day"] for r in first.collect()}
    # Second file: the late events of the 5th (inside the 30-day watermark) and later days.
    early.where(F.to_date("ts") == F.lit("2024-01-05").cast("date")).unionByName(late) \
        .write.parquet(f"{tmp_dir}/src/b")
    second = run_daily_stream(spark, f"{tmp_dir}/src/*", f"{tmp_dir}/t", f"{tmp_dir}/c", build, ["day"])
    batch = web.funnel_daily(A.web_events(ev))
    cols = ["day", "sessions", "view_item", "add_to_cart", "begin_checkout", "purchase"]
    assert sorted(tuple(r) for r in second.select(*cols).collect()) == \
        sorted(tuple(r) for r in batch.select(*cols).collect())


def test_marketplace_csv_imports(spark, tmp_dir):
    write(f"{tmp_dir}/ml.csv",
          "week_start,keyword_canonica,site_id,results_total,price_median,price_p25,price_p75,top_category_id,top_category_name\n"
          "2026-02-16, celular ,  ,120,15.25,12.875,17.625, ,Audio\n")
    r = CSV.import_marketplace_weekly(spark, f"{tmp_dir}/ml.csv").first()
    assert (r["keyword_canonica"], r["site_id"], r["results_total"], r["top_category_id"], r["top_category_name"]) == \
        ("celular", "MPE", 120, None, "Audio")
    write(f"{tmp_dir}/tr.csv", "week_start,site_id,category_id,rank,keyword,url\n2026-02-16,,,1, a ,\n")
    t = CSV.import_marketplace_trends(spark, f"{tmp_dir}/tr.csv").first()
    assert (t["site_id"], t["category_id"], t["rank"], t["keyword"], t["url"]) == ("MPE", "", 1, "a", None)


def test_compacted_sink_reads_the_same(spark, tmp_dir):
    from retailpulse.streaming.event_daily import compact, read_latest
    target = f"{tmp_dir}/sink"
    for batch_id, rows in enumerate([[(1, "a", 1), (2, "a", 1)], [(1, "a", 5)], [(3, "b", 2)]]):
        spark.createDataFrame(rows, "day int, event_name string, n int").write.parquet(
            f"{target}/batch_id={batch_id}")
    before = sorted(map(tuple, read_latest(spark, target).collect()))
    compact(spark, target)
    assert sorted(map(tuple, read_latest(spark, target).collect())) == before
    assert os.listdir(target) == ["batch_id=2"]
    compact(spark, f"{tmp_dir}/none")


def test_csv_cells_and_headers(spark, tmp_dir):
    write(f"{tmp_dir}/shop/a.csv", "category_code;price\n" + "aa;1,5\n" * 35)
    write(f"{tmp_dir}/shop/b.csv", "price,category_code\n" + "2.5,bb\n" * 35)
    write(f"{tmp_dir}/other/Shop/c d+.csv", "\n\ufeffPrice|Category\n" + "3|aa\n" * 5)
    write(f"{tmp_dir}/shop/notes.txt", "not;a;csv\n")
    write(f"{tmp_dir}/shop/empty.csv", "")
    out = CSV.build_curated(spark, tmp_dir, kinds=("price_benchmark",))["price_benchmark"].collect()
    assert sorted((r["source"], r["category_norm"], r["n_prices"]) for r in out) == [
        ("shop", "aa", 40), ("shop", "bb", 35)]
    write(f"{tmp_dir}/q/q.csv", 'id,description\n1,"said ""hi"", ok"\n2,"line1\nline2"\n3\n')
    df = CSV.read_csv_files(spark, [f"{tmp_dir}/q/q.csv"], ["id", "description"], ",", multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", 'said "hi", ok'), ("2", "line1\nline2"), ("3", "")]
    assert CSV.build_curated(spark, f"{tmp_dir}/shop", kinds=("text_terms",))["text_terms"].count() == 0
