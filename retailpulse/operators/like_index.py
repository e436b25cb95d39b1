"""LIKE as an equi-join, by an inverted index over the patterns' literal text.

A value can match a pattern only if it holds every run of literal characters between the
pattern's wildcards. Each pattern is therefore filed under one short piece of its literal text
(three characters where a run is that long, else two, one or none): the piece that the fewest
values hold. Values are looked up by their own pieces, as far as any pattern asks for them, and
LIKE decides among the few patterns found. Where a wildcard stands does not matter, so patterns
that begin with one are as cheap as others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SIZE = 3            # characters of a piece at most


def _pieces(text: Column, size: int) -> Column:
    """All pieces of ``size`` characters of a text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1)))
    return F.coalesce(F.transform(starts, lambda i: F.substr(text, i, F.lit(size))),
                      F.array().cast("array<string>"))


def pattern_pieces(pattern: Column) -> Column:
    """The pieces of the longest size (up to ``SIZE``) that the pattern's literal runs have; one
    empty piece for a pattern of wildcards alone. An escaped character ends a run."""
    runs = F.split(F.regexp_replace(pattern, r"\\.", "%"), "[%_]+")

    def of_size(n: int) -> Column:
        return F.array_distinct(F.flatten(F.transform(runs, lambda run: _pieces(run, n))))

    out = F.array(F.lit(""))
    for n in range(1, SIZE + 1):
        out = F.when(F.size(of_size(n)) > 0, of_size(n)).otherwise(out)
    return out


def like_matches(values: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct (value, pattern) pairs with ``value LIKE pattern`` from the columns ``value`` and
    ``pattern``; NULLs match nothing."""
    values = values.select("value").where("value IS NOT NULL").distinct()
    patterns = patterns.select("pattern").where("pattern IS NOT NULL").distinct()
    asked = patterns.select("pattern", F.explode(pattern_pieces(F.col("pattern"))).alias("piece"))
    own = F.concat(F.array(F.lit("")), *[_pieces(F.col("value"), n) for n in range(1, SIZE + 1)])
    held = values.select("value", F.explode(F.array_distinct(own)).alias("piece"))
    held = held.join(asked.select("piece").distinct(), "piece", "left_semi")
    often = held.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    # the piece that the fewest values hold; one that no value holds rules the pattern out
    rare = (asked.join(often, "piece", "left").groupBy("pattern")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("k"))
            .where("k.n > 0").select("pattern", F.col("k.piece").alias("piece")))
    return held.join(rare, "piece").where("value LIKE pattern").select("value", "pattern")


def like_join(rows: DataFrame, value_col: str, patterns: DataFrame, pattern_col: str) -> DataFrame:
    """rows x patterns where ``value LIKE pattern``: pairs are found on distinct values and
    patterns (``like_matches``) and joined back on both."""
    pairs = like_matches(rows.select(F.col(value_col).alias("value")),
                         patterns.select(F.col(pattern_col).alias("pattern")))
    pairs = pairs.select(F.col("value").alias("_value"), F.col("pattern").alias("_pattern"))
    return (rows.join(pairs, F.col(value_col) == F.col("_value"))
            .join(patterns, F.col("_pattern") == F.col(pattern_col)).drop("_value", "_pattern"))
