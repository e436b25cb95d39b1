"""Price and demand benchmarks from e-commerce rows, product-text term counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import round_half_up
from ..functions.text import keep_token, norm_txt, token_text
from .like_index import like_join
from .quantiles import exact_percentiles

PROBS = (0.25, 0.5, 0.75)


def grouped_percentiles(df: DataFrame, keys: list[str], value: str,
                        probs: tuple[float, ...] = PROBS, method: str = "exact",
                        accuracy: int = 10000) -> DataFrame:
    """keys, n, p_<i>: linear-interpolated percentiles ((n - 1) * p rule).

    ``exact``: radix selection over value counts (operators/quantiles.py): exact, and a hot
    group is spread over many tasks however close its values lie.
    ``aggregate``: Spark's ``percentile`` aggregate; exact and fewer stages, but the
    value->count map of a group is merged in one task (fine for narrow groups).
    ``approx``: ``percentile_approx`` with a bounded sketch per group.
    """
    if method == "exact":
        return exact_percentiles(df, keys, value, probs)
    v = F.col(value)
    if method == "approx":
        p = F.percentile_approx(v, list(probs), accuracy)
    else:
        p = F.percentile(v, F.array(*[F.lit(x) for x in probs]))
    out = df.groupBy(*keys).agg(F.count(v).alias("n"), p.alias("_p"))
    return out.select(*keys, "n", *[F.col("_p")[i].alias(f"p_{i}") for i in range(len(probs))])


def price_benchmark(rows: DataFrame, min_samples: int = 30, method: str = "exact") -> DataFrame:
    """source, category_norm, currency, n_prices, price_p25, price_p50, price_p75 for
    categories with at least ``min_samples`` parsed prices (values rounded to cents).
    Every row counts: the reference's per-category sample cap is a memory guard that
    Spark does not need (aggregation spills), so it is not reproduced."""
    r = rows.where(F.col("price").isNotNull() & (F.col("category_norm") != ""))
    p = grouped_percentiles(r, ["source", "category_norm"], "price", PROBS, method)
    return (p.where(F.col("n") >= min_samples)
            .select("source", "category_norm", F.lit("").alias("currency"),
                    F.col("n").alias("n_prices"),
                    round_half_up("p_0").alias("price_p25"),
                    round_half_up("p_1").alias("price_p50"),
                    round_half_up("p_2").alias("price_p75")))


def category_weekly(rows: DataFrame) -> DataFrame:
    """source, week_start, category_norm, n_events (dated rows), revenue_proxy (sum of
    parsed prices, rounded to cents; NULL when the unrounded sum is 0 or absent). Prices are
    summed as decimals, so neither the cents nor the zero depend on the order of tasks."""
    r = rows.where(F.col("day").isNotNull() & (F.col("category_norm") != ""))
    g = (r.groupBy("source", F.trunc("day", "week").alias("week_start"), "category_norm")
         .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("price").try_cast("decimal(28,10)")).alias("_rev")))
    return g.select("source", "week_start", "category_norm", "n_events",
                    F.when(F.col("_rev") != 0, F.round("_rev", 2).cast("double")).alias("revenue_proxy"))


def text_terms(docs: DataFrame, top: int = 200, text_col: str = "text") -> DataFrame:
    """source, term, term_count: the ``top`` most frequent tokens per source (ties by
    term). Whole texts are tokenized; the per-source top-k runs as a window group limit,
    which Spark applies partially before the shuffle."""
    toks = (docs.select("source", F.explode(F.split(token_text(text_col), " ")).alias("term"))
            .where(keep_token("term")))
    counts = toks.groupBy("source", "term").agg(F.count(F.lit(1)).alias("term_count"))
    w = Window.partitionBy("source").orderBy(F.col("term_count").desc(), F.col("term"))
    return (counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top)
            .drop("_rn"))


def benchmark_category(bench: DataFrame, category_map: DataFrame) -> DataFrame:
    """categoria_norm, kaggle_price_p50 (n-weighted mean of p50), kaggle_n_prices.

    The map is joined on ``category_norm LIKE pattern`` (``like_index.like_join``) against the
    already aggregated benchmark. Two patterns of one category matching a row count it
    twice, as in the reference."""
    m = category_map.select("internal_categoria", "kaggle_pattern")
    j = like_join(bench, "category_norm", m, "kaggle_pattern")
    g = (j.groupBy(norm_txt("internal_categoria").alias("categoria_norm"))
         .agg(F.sum(F.col("price_p50") * F.col("n_prices")).alias("_w"),
              F.sum("n_prices").alias("kaggle_n_prices")))
    return g.select("categoria_norm",
                    round_half_up(F.col("_w") / F.nullif(F.col("kaggle_n_prices").cast("double"),
                                                         F.lit(0.0))).alias("kaggle_price_p50"),
                    "kaggle_n_prices")
