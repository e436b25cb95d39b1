import datetime as dt

from pyspark.sql import functions as F

from retailpulse.operators import dictionary as D, web

STAGE = "keyword_raw string, keyword_canonica string, categoria string, subcategoria string, " \
        "sinonimo_de string, es_error_ortografico boolean, prioridad smallint"

# Rows shaped like the reference's committed dictionary (see FIXTURES.md section 1).
ROWS = [
    ("celu", "celular", "Tecnología", "Celulares", "celular", False, 1),
    ("celular", "celular", "Tecnología", "Celulares", None, False, 1),
    ("samsng", "samsung", "Tecnología", "Celulares", "samsung", True, 2),
    ("zapatillas", "zapatillas", "Moda", "Calzado", "zapatillas", False, 1),
    ("zapatillas", "zapatillas", "Moda", "Calzado", "", False, 1),
    ("raton ", "mouse", "Tecnología", "PC", "mouse", False, 1),
    ("tecla ", "teclaso", "Tecnología", "PC", "teclado", True, 1),
    ("monitor", "monitor", "Tecnología", "Computación", "pantalla", False, 1),
    ("cámara de seguridad", "camara", "Hogar", "Seguridad", None, None, None),
    ("Monitor", "monitor", "Tecnología", "Computación", None, False, 3),
    (None, "x", "y", "z", None, False, 1),
]


def stage(spark):
    return spark.createDataFrame(ROWS, STAGE)


def test_dedupe_trimmed(spark):
    dim = {r["keyword_raw"]: r for r in D.dedupe_dictionary(stage(spark), trim=True).collect()}
    assert set(dim) == {"celu", "celular", "samsng", "zapatillas", "raton", "tecla", "monitor",
                        "cámara de seguridad"}
    # Full tie on the priority keys: a non-NULL synonym beats the blank (NULL) one.
    assert dim["zapatillas"]["sinonimo_de"] == "zapatillas"
    # Priority 1 row wins over the priority 3 'Monitor'.
    assert dim["monitor"]["sinonimo_de"] == "pantalla"
    # Defaults: NULL flag -> false, NULL priority -> 2.
    assert dim["cámara de seguridad"]["es_error_ortografico"] is False
    assert dim["cámara de seguridad"]["prioridad"] == 2


def test_dedupe_untrimmed_keeps_padded_keys(spark):
    raws = {r["keyword_raw"] for r in D.dedupe_dictionary(stage(spark), trim=False).collect()}
    assert "raton " in raws and "tecla " in raws


def test_search_dictionary_types(spark):
    sd = {r["raw_norm"]: r for r in D.search_dictionary(D.dedupe_dictionary(stage(spark))).collect()}
    assert sd["celu"]["mapping_type"] == "SYNONYM"
    assert sd["samsng"]["mapping_type"] == "TYPO"
    assert sd["tecla"]["keyword_canonica"] == "teclado"       # synonym overrides canonical
    assert sd["monitor"]["keyword_canonica"] == "pantalla"
    assert sd["celular"]["mapping_type"] == "CANON"
    assert sd["camara de seguridad"]["keyword_canonica"] == "camara"


def terms(spark):
    d1, d2, d3 = dt.date(2026, 2, 16), dt.date(2026, 2, 17), dt.date(2026, 2, 23)
    rows = [(d1, "  Celular ", 5), (d1, "(not set)", 9), (d1, "Not Set", 1), (d1, "", 2),
            (d1, "CÁMARA de seguridad", 3), (d1, "nike", 4), (d1, "xyz", 6), (d2, "Celular", 2),
            (d2, "samsng", 7), (d3, "xyz", 1)]
    raw = spark.createDataFrame(rows, "day date, search_term string, n long")
    return web.search_term_daily(raw, count_col="n")


def test_mapping_and_coverage_conservation(spark):
    sd = D.search_dictionary(D.dedupe_dictionary(stage(spark)))
    t = terms(spark)
    mapped = D.map_terms_daily(t, sd)
    cov = {r["week_start"]: r for r in D.coverage_weekly(mapped).collect()}
    w1 = cov[dt.date(2026, 2, 16)]
    # Cleaned terms only: (not set) / blank rows are gone.
    assert w1["searches_total"] == 5 + 3 + 4 + 6 + 2 + 7
    assert w1["searches_unmapped"] == 4 + 6
    assert w1["unmapped_pct"] == round(100 * 10 / 27, 2)
    assert w1["top_unmapped_terms"] == "xyz (6) | nike (4)"
    weekly = {(r["keyword_canonica"]): r["searches"]
              for r in D.mapped_weekly(t, sd).where(F.col("week_start") == "2026-02-16").collect()}
    assert weekly == {"celular": 7, "camara": 3, "samsung": 7}
    assert sum(weekly.values()) + w1["searches_unmapped"] == w1["searches_total"]
    un = {(r["week_start"], r["search_term"]): r["searches"]
          for r in D.unmapped_weekly(t, sd).collect()}
    assert un == {(dt.date(2026, 2, 16), "nike"): 4, (dt.date(2026, 2, 16), "xyz"): 6,
                  (dt.date(2026, 2, 23), "xyz"): 1}
    typos = D.top_typos_weekly(mapped).collect()
    assert [(r["typo_term"], r["searches"]) for r in typos] == [("samsng", 7)]


def test_after_aliases(spark):
    sd = D.search_dictionary(D.dedupe_dictionary(stage(spark)))
    aliases = spark.createDataFrame([("Nike", "nike", "brand")], "raw_term_norm string, canonical_term string, reason string")
    after = D.map_terms_daily_after(terms(spark), sd, aliases)
    src = {r["search_term"]: r["mapping_source"] for r in after.collect()}
    assert src["nike"] == "ALIAS" and src["xyz"] == "UNMAPPED" and src["Celular"] == "DICT"
    wk = {r["keyword_canonica"]: r for r in D.mapped_weekly_after(after).collect()}
    assert wk["nike"]["categoria"] == "SinCategoria"
    cov = {r["week_start"]: r["searches_unmapped"] for r in D.coverage_after_weekly(after).collect()}
    assert cov[dt.date(2026, 2, 16)] == 6


def test_empty_inputs(spark):
    empty_terms = spark.createDataFrame([], "day date, search_term string, event_count long")
    sd = D.search_dictionary(D.dedupe_dictionary(spark.createDataFrame([], STAGE)))
    assert D.coverage_weekly(D.map_terms_daily(empty_terms, sd)).count() == 0
    assert D.mapped_weekly(empty_terms, sd).count() == 0


def test_dedupe_on_norm_prevents_fan_out(spark):
    rows = [("ratón", "mouse", "Tecnología", "PC", None, False, 1),
            ("raton", "mouse", "Tecnología", "PC", None, False, 2)]
    stg = spark.createDataFrame(rows, STAGE)
    terms = web.search_term_daily(spark.createDataFrame(
        [(dt.date(2026, 2, 16), "Raton", 5)], "day date, search_term string, n long"), count_col="n")
    by_lower = D.search_dictionary(D.dedupe_dictionary(stg, dedupe_on="lower"))
    assert D.map_terms_daily(terms, by_lower).agg(F.sum("searches")).first()[0] == 10   # fan-out
    from retailpulse.operators import quality as Q
    assert Q.duplicates(by_lower, ["raw_norm"]).count() == 1                           # Q6 on raw_norm
    by_norm = D.search_dictionary(D.dedupe_dictionary(stg, dedupe_on="norm"))
    assert by_norm.count() == 1 and by_norm.first()["keyword_raw"] == "ratón"          # priority 1 wins
    assert D.map_terms_daily(terms, by_norm).agg(F.sum("searches")).first()[0] == 5


def test_coverage_shares_equal_both_reports(spark):
    from retailpulse.plans import adapters as A
    from retailpulse.plans.queries import Inputs
    sf = "/root/testdata/sf0.001"
    i = Inputs(spark, sf)
    before = {r["week_start"]: r["unmapped_pct"] for r in D.coverage_weekly(i.mapped).collect()}
    after = {r["week_start"]: r["unmapped_pct"] for r in D.coverage_after_weekly(i.mapped_after).collect()}
    shares = D.coverage_shares(i.terms, i.sdict, A.aliases(spark, sf)).collect()
    assert {r["week_start"]: r["unmapped_pct_before"] for r in shares} == before
    assert {r["week_start"]: r["unmapped_pct_after"] for r in shares} == after
