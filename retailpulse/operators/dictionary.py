"""Keyword dictionary: priority dedupe, search dictionary, term mapping, coverage.

Search-term facts are large; the dictionary and alias tables are dimensions derived by
aggregates, so their joins are left to adaptive execution (broadcast when the measured
shuffle output is small, sort-merge with skew splitting otherwise). Weekly marts
aggregate the facts to (week, term) before any join, so joins see distinct terms, not
raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.text import canonical_choice, label_with_count, mapping_type, norm_txt
from ..functions.numbers import safe_pct
from .common import pick_first

DICT_COLUMNS = ["keyword_raw", "keyword_canonica", "categoria", "subcategoria", "sinonimo_de",
                "es_error_ortografico", "prioridad"]
REQUIRED = ["keyword_raw", "keyword_canonica", "categoria", "subcategoria"]
NO_CATEGORY = "SinCategoria"


def dedupe_dictionary(stg: DataFrame, trim: bool = True, dedupe_on: str = "lower") -> DataFrame:
    """One row per lower(keyword_raw) (or per normalized raw with ``dedupe_on='norm'``):
    priority asc (NULL = 2), misspelling flag asc (NULL = false), raw == canonical first,
    longest canonical first; remaining columns break full ties deterministically.
    ``trim=True`` trims every text column and turns a blank synonym into NULL."""
    s = stg.dropna(subset=REQUIRED)
    if trim:
        s = s.select(*[F.trim(c).alias(c) for c in REQUIRED],
                     F.nullif(F.trim(F.coalesce("sinonimo_de", F.lit(""))), F.lit("")).alias("sinonimo_de"),
                     "es_error_ortografico", "prioridad")
    s = s.select(*REQUIRED, "sinonimo_de",
                 F.coalesce("es_error_ortografico", F.lit(False)).alias("es_error_ortografico"),
                 F.coalesce("prioridad", F.lit(2)).cast("smallint").alias("prioridad"))
    raw, canon = F.col("keyword_raw"), F.col("keyword_canonica")
    key = norm_txt(raw) if dedupe_on == "norm" else F.lower(raw)
    order = [F.col("prioridad"), F.col("es_error_ortografico"),
             F.lower(raw) != F.lower(canon), -F.length(canon), F.col("sinonimo_de").isNull()]
    return pick_first(s, [key.alias("_key")], order, DICT_COLUMNS)


def search_dictionary(dim: DataFrame) -> DataFrame:
    """raw_norm, keyword_raw, keyword_canonica (synonym wins), categoria, mapping_type, prioridad."""
    return dim.select(norm_txt("keyword_raw").alias("raw_norm"), "keyword_raw",
                      canonical_choice("sinonimo_de", "keyword_canonica").alias("keyword_canonica"),
                      "categoria",
                      mapping_type("es_error_ortografico", "sinonimo_de").alias("mapping_type"),
                      "prioridad")


def normalize_aliases(aliases: DataFrame) -> DataFrame:
    """Alias keys are stored normalized; one row per key (first canonical wins)."""
    a = aliases.select(norm_txt("raw_term_norm").alias("raw_term_norm"), "canonical_term")
    return pick_first(a, ["raw_term_norm"], [F.col("canonical_term")],
                      ["raw_term_norm", "canonical_term"])


def map_terms_daily(terms: DataFrame, sdict: DataFrame) -> DataFrame:
    """day, search_term, searches, keyword_canonica, categoria, mapping_type, prioridad,
    is_unmapped (left join on the normalized term)."""
    d = sdict.select("raw_norm", "keyword_canonica", "categoria", "mapping_type", "prioridad")
    t = terms.select("day", "search_term", F.col("event_count").alias("searches"),
                     norm_txt("search_term").alias("_norm"))
    j = t.join(d, t._norm == d.raw_norm, "left")
    return j.select("day", "search_term", "searches", "keyword_canonica", "categoria",
                    "mapping_type", "prioridad",
                    F.when(F.col("keyword_canonica").isNull(), 1).otherwise(0).alias("is_unmapped"))


def map_terms_daily_after(terms: DataFrame, sdict: DataFrame, aliases: DataFrame) -> DataFrame:
    """Dictionary first, then manual aliases: mapping_source DICT / ALIAS / UNMAPPED."""
    d = sdict.select("raw_norm", F.col("keyword_canonica").alias("d_kw"), "categoria")
    a = normalize_aliases(aliases)
    t = terms.select("day", "search_term", F.col("event_count").alias("searches"),
                     norm_txt("search_term").alias("_norm"))
    j = (t.join(d, t._norm == d.raw_norm, "left")
         .join(a, t._norm == a.raw_term_norm, "left"))
    dk, ak = F.col("d_kw"), F.col("canonical_term")
    return j.select(
        "day", "search_term", "searches", F.coalesce(dk, ak).alias("keyword_canonica"),
        "categoria",
        F.when(dk.isNotNull(), "DICT").when(ak.isNotNull(), "ALIAS").otherwise("UNMAPPED")
         .alias("mapping_source"),
        F.when(dk.isNull() & ak.isNull(), 1).otherwise(0).alias("is_unmapped"))


def _weekly_terms(terms: DataFrame) -> DataFrame:
    """(week_start, search_term, searches): the fact pre-aggregated to weekly grain."""
    return (terms.groupBy(F.trunc("day", "week").alias("week_start"), "search_term")
            .agg(F.sum("event_count").alias("searches")))


def _weekly_normalized(terms: DataFrame) -> DataFrame:
    """(week_start, _norm, searches): one row per week and normalized term."""
    return (terms.groupBy(F.trunc("day", "week").alias("week_start"),
                          norm_txt("search_term").alias("_norm"))
            .agg(F.sum("event_count").alias("searches")))


def coverage_shares(terms: DataFrame, sdict: DataFrame, aliases: DataFrame) -> DataFrame:
    """week_start, unmapped_pct_before, unmapped_pct_after: the percentages of
    ``coverage_weekly`` and ``coverage_after_weekly`` from one aggregate over the weekly term
    table that ``mapped_weekly`` uses, too. A term that several dictionary rows stand for
    counts once for each, as it does in the mapped facts."""
    rows = sdict.groupBy("raw_norm").agg(F.count(F.lit(1)).alias("_rows"))
    known = normalize_aliases(aliases).select("raw_term_norm", F.lit(1).alias("_alias"))
    wk = _weekly_normalized(terms)
    j = (wk.join(rows, wk._norm == rows.raw_norm, "left")
         .join(known, F.col("_norm") == F.col("raw_term_norm"), "left"))
    n, missed = F.col("searches"), F.col("_rows").isNull()
    week = j.groupBy("week_start").agg(
        F.sum(n * F.coalesce("_rows", F.lit(1))).alias("_all"),
        F.sum(F.when(missed, n).otherwise(0)).alias("_before"),
        F.sum(F.when(missed & F.col("_alias").isNull(), n).otherwise(0)).alias("_after"))
    return week.select("week_start", safe_pct("_before", "_all").alias("unmapped_pct_before"),
                       safe_pct("_after", "_all").alias("unmapped_pct_after"))


def mapped_weekly(terms: DataFrame, sdict: DataFrame) -> DataFrame:
    """week_start, keyword_canonica, categoria, searches (inner join; unmapped dropped).
    Terms are summed per (week, normalized term) before the join."""
    wk = _weekly_normalized(terms)
    d = sdict.select("raw_norm", "keyword_canonica", "categoria")
    return (wk.join(d, wk._norm == d.raw_norm)
            .groupBy("week_start", "keyword_canonica", "categoria")
            .agg(F.sum("searches").alias("searches")))


def unmapped_weekly(terms: DataFrame, sdict: DataFrame) -> DataFrame:
    """week_start, search_term, searches for terms no dictionary key matches (anti join)."""
    wk = _weekly_terms(terms).withColumn("_norm", norm_txt("search_term"))
    keys = sdict.select("raw_norm")
    return (wk.join(keys, wk._norm == keys.raw_norm, "left_anti")
            .select("week_start", "search_term", "searches"))


def mapped_weekly_after(mapped_after: DataFrame) -> DataFrame:
    """week_start, keyword_canonica, categoria ('SinCategoria' for alias-only terms),
    searches, categoria_norm, keyword_norm — mapped rows only."""
    m = mapped_after.where(F.col("is_unmapped") == 0)
    cat = F.coalesce("categoria", F.lit(NO_CATEGORY))
    kw = F.coalesce("keyword_canonica", norm_txt("search_term"))
    return (m.groupBy(F.trunc("day", "week").alias("week_start"), kw.alias("keyword_canonica"),
                      cat.alias("categoria"), norm_txt(cat).alias("categoria_norm"),
                      norm_txt(F.coalesce("keyword_canonica", "search_term")).alias("keyword_norm"))
            .agg(F.sum("searches").alias("searches"))
            .select("week_start", "keyword_canonica", "categoria", "searches",
                    "categoria_norm", "keyword_norm"))


def _coverage_base(mapped: DataFrame) -> DataFrame:
    un = F.col("is_unmapped") == 1
    return (mapped.groupBy(F.trunc("day", "week").alias("week_start"))
            .agg(F.sum("searches").alias("searches_total"),
                 F.sum(F.when(un, F.col("searches")).otherwise(F.lit(0))).alias("searches_unmapped")))


def coverage_weekly(mapped: DataFrame, top_n: int = 10) -> DataFrame:
    """week_start, searches_total, searches_unmapped, unmapped_pct, top_unmapped_terms
    ("term (n) | ..." for the top ``top_n`` unmapped terms, ties by term).

    The mapped facts are aggregated once to (week, term) — a term's mapping does not
    change within a week — and both the weekly totals and the top unmapped terms are
    derived from that one aggregate (its shuffle is shared by both branches)."""
    per_term = (mapped.groupBy(F.trunc("day", "week").alias("week_start"), "search_term")
                .agg(F.sum("searches").alias("searches"),
                     F.max("is_unmapped").alias("is_unmapped")))
    un = F.col("is_unmapped") == 1
    base = (per_term.groupBy("week_start")
            .agg(F.sum("searches").alias("searches_total"),
                 F.sum(F.when(un, F.col("searches")).otherwise(F.lit(0))).alias("searches_unmapped")))
    w = Window.partitionBy("week_start").orderBy(F.col("searches").desc(), F.col("search_term"))
    top = (per_term.where(un).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top_n)
           .groupBy("week_start")
           .agg(F.sort_array(F.collect_list(F.struct(
               (-F.col("searches")).alias("o"), F.col("search_term").alias("t"),
               label_with_count("search_term", "searches").alias("label")))).alias("items"))
           .select("week_start",
                   F.array_join(F.transform("items", lambda x: x["label"]), " | ")
                   .alias("top_unmapped_terms")))
    return (base.join(top, "week_start", "left")
            .select("week_start", "searches_total", "searches_unmapped",
                    safe_pct("searches_unmapped", "searches_total").alias("unmapped_pct"),
                    F.coalesce("top_unmapped_terms", F.lit("")).alias("top_unmapped_terms")))


def coverage_after_weekly(mapped_after: DataFrame) -> DataFrame:
    """week_start, searches_total, searches_unmapped, unmapped_pct (dictionary + aliases)."""
    return _coverage_base(mapped_after).select(
        "week_start", "searches_total", "searches_unmapped",
        safe_pct("searches_unmapped", "searches_total").alias("unmapped_pct"))


def top_typos_weekly(mapped: DataFrame) -> DataFrame:
    """week_start, keyword_canonica, categoria, typo_term, searches for TYPO mappings."""
    return (mapped.where(F.col("mapping_type") == "TYPO")
            .groupBy(F.trunc("day", "week").alias("week_start"), "keyword_canonica",
                     "categoria", F.col("search_term").alias("typo_term"))
            .agg(F.sum("searches").alias("searches")))
