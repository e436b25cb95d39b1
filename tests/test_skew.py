"""Operators on inputs where one key holds a third of all rows (results must stay whole)."""

from pyspark.sql import functions as F

from retailpulse.operators import benchmark, dictionary as D, upsert as U, web
from retailpulse.operators.common import pick_first

N = 30000


def hot(spark):
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        F.col("id").alias("v"))


def test_pick_first_hot_key(spark):
    out = {r["k"]: r["v"] for r in pick_first(hot(spark), ["k"], [F.col("v")], ["k", "v"]).collect()}
    assert out["hot"] == 0 and len(out) == 98


def test_upsert_dedupe_hot_key(spark):
    df = hot(spark).withColumn("note", F.lit("b"))
    t = spark.createDataFrame([("hot", -1, "t")], "k string, v long, note string")
    out = {r["k"]: r["v"] for r in U.upsert(t, df, ["k"], order=["v"]).collect()}
    assert out["hot"] == N - 3 and len(out) == 98


def test_dictionary_dedupe_hot_raw(spark):
    stg = hot(spark).select(
        F.when(F.col("k") == "hot", F.lit("zapatillas")).otherwise(F.col("k")).alias("keyword_raw"),
        F.lit("zapatillas").alias("keyword_canonica"), F.lit("Moda").alias("categoria"),
        F.lit("Calzado").alias("subcategoria"), F.lit(None).cast("string").alias("sinonimo_de"),
        F.lit(False).alias("es_error_ortografico"),
        (F.lit(1) + F.col("v") % 3).cast("smallint").alias("prioridad"))
    dim = D.dedupe_dictionary(stg)
    assert dim.count() == 98
    assert dim.where("keyword_raw = 'zapatillas'").first()["prioridad"] == 1


def test_search_terms_and_text_terms_hot_key(spark):
    ev = hot(spark).select(F.current_date().alias("day"), F.col("k").alias("search_term"))
    st = {r["search_term"]: r["event_count"] for r in web.search_term_daily(ev).collect()}
    assert st["hot"] == N // 3 and sum(st.values()) == N
    docs = hot(spark).select(F.col("k").alias("source"), F.lit("alpha beta beta").alias("text"))
    tt = {(r["source"], r["term"]): r["term_count"] for r in benchmark.text_terms(docs, top=1).collect()}
    assert tt[("hot", "beta")] == 2 * (N // 3) and len(tt) == 98
