"""Exact grouped percentiles by radix selection.

1. ``(keys, code) -> c``: distinct values with their counts (map-side partial aggregation, so
   repeated values of a hot group collapse before the shuffle), checkpointed. ``code`` is a long
   that orders as the double does, so nothing is lost by it;
2. a group with many distinct values is narrowed from the top bits of the code downwards,
   ``DIGIT`` bits a level: a histogram over the next digit of the values that share a wanted
   beginning, running sums over it, and the digits that hold the ranks around ``(n - 1) * p``.
   Only beginnings that hold a wanted rank go on. Levels end once no beginning holds more than
   ``MOST`` distinct values, at the latest when it is a whole code;
3. the values of the wanted beginnings are ranked, each beginning on its own, and the linear
   interpolation ``v_f + (v_c - v_f) * (k - f)`` is taken.

A window therefore holds at most 2^16 rows, whatever the values are: all of them may lie in a
range as narrow as the doubles allow. The checkpoint and a look at the largest beginning per
level are jobs that run while the plan is built; nothing depends on partition numbers, on reused
exchanges or on the size of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

DIGIT = 16          # bits of a histogram's digit
MOST = 1 << 16      # distinct values that are ranked together
_BITS = 64
_FRACTION = 52      # fraction bits of a double
_BIAS = 1023


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, _code, _c: distinct values per group with their counts; NULL and NaN are left out."""
    v = F.col(value).cast("double")
    # the code uses the value many times, so it is worked out behind the aggregate
    return (df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, (v + 0.0).alias("_v"))
            .agg(F.count(F.lit(1)).alias("_c"))
            .select(*keys, value_code(F.col("_v")).alias("_code"), "_c"))


def value_code(v: Column) -> Column:
    """The bits of a double as a long that orders as the doubles do. The logarithm may come out
    one off near a power of two, which the halved or doubled fraction part makes up for; all
    steps on the fraction are exact."""
    size = F.abs(v)
    near = F.greatest(F.floor(F.log2(size)), F.lit(-_BIAS + 1).cast("long"))
    near = F.least(near, F.lit(_BIAS).cast("long")).cast("int")
    part = size / F.pow(F.lit(2.0), near)
    exponent = F.when(part >= 2, near + 1).when((part < 1) & (near > -_BIAS + 1), near - 1).otherwise(near)
    part = size / F.pow(F.lit(2.0), F.least(exponent, F.lit(_BIAS)))
    scale = F.lit(float(1 << _FRACTION))
    # below the least exponent there is no leading one
    level = F.when(part < 1, (part * scale).cast("long")).otherwise(
        F.shiftleft((exponent + _BIAS).cast("long"), _FRACTION) + ((part - 1) * scale).cast("long"))
    level = F.when(size == float("inf"), F.lit((2 * _BIAS + 1) << _FRACTION)).otherwise(level)
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, level).otherwise(-level)


def value_of(code: Column) -> Column:
    """The double of a code."""
    size = F.abs(code)
    exponent = F.shiftright(size, _FRACTION).cast("int")
    part = size.bitwiseAND(F.lit((1 << _FRACTION) - 1)).cast("double")
    value = F.when(exponent == 0, part * F.lit(2.0 ** (1 - _BIAS - _FRACTION))).when(
        exponent == 2 * _BIAS + 1, F.lit(float("inf"))).otherwise(
        (F.lit(1.0) + part * F.lit(2.0 ** -_FRACTION)) * F.pow(F.lit(2.0), exponent - _BIAS))
    return F.when(code < 0, -value).otherwise(value)


def _same(names: dict[str, str]) -> list[Column]:
    return [F.col(a).eqNullSafe(F.col(b)) for a, b in names.items()]


def _begin(shift: int) -> Column:
    """The bits of a code above ``shift``. The shift is arithmetic: the top digit is signed, the
    others are not."""
    return F.shiftright("_code", shift) if shift < _BITS else F.lit(0).cast("long")


def _inside(counts: DataFrame, wanted: DataFrame, keys: list[str], shift: int) -> DataFrame:
    """The values of the wanted beginnings, with the beginning, n and the wanted ranks."""
    renamed = {k: f"_k{i}" for i, k in enumerate(keys)}
    rest = [c for c in wanted.columns if c not in (*keys, "_begin", "_d")]
    begin = wanted.select(*[F.col(k).alias(a) for k, a in renamed.items()], "_begin", *rest)
    return counts.join(begin, [_begin(shift) == F.col("_begin"), *_same(renamed)]).drop(*renamed.values())


def _held(before: Column, size: Column, ranks: list[str]) -> list[Column]:
    """The wanted ranks that lie in a run of ``size`` values behind ``before``, counted from its
    start; NULL for the others."""
    at = [F.col(r) - before for r in ranks]
    return [F.when((x >= 0) & (x < size), x).alias(r) for x, r in zip(at, ranks)]


def narrowed(counts: DataFrame, keys: list[str], ranks: dict[str, Column], most: int = MOST) -> tuple[DataFrame, int]:
    """(keys, n, _begin, _d, one column for each rank): the beginnings that hold a wanted rank, none
    with more than ``most`` distinct values (_d), and the number of bits below a beginning."""
    wanted = counts.groupBy(*keys).agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("_d")).withColumns(ranks)
    wanted = wanted.withColumn("_begin", F.lit(0).cast("long"))
    names, shift = list(ranks), _BITS
    while shift > 0 and (wanted.agg(F.max("_d")).first()[0] or 0) > most:
        inside = _inside(counts, wanted, keys, shift)
        shift -= DIGIT
        digits = inside.groupBy(*keys, "_begin", _begin(shift).alias("_top")).agg(
            F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d"), F.max("n").alias("n"),
            *[F.max(r).alias(r) for r in names])
        upto = Window.partitionBy(*keys, "_begin").orderBy("_top").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        digits = digits.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        wanted = cut_lineage(digits.select(
            *keys, "n", F.col("_top").alias("_begin"), "_d", *_held(F.col("_before"), F.col("_n"), names)).where(
            F.coalesce(*names).isNotNull()))
    return wanted, shift


def exact_percentiles(df: DataFrame, keys: list[str], value: str,
                      probs: tuple[float, ...], most: int = MOST) -> DataFrame:
    """keys, n, p_0 .. p_{len(probs)-1}; NULL and NaN values are ignored (n counts the rest).
    Keys that are NULL form a group."""
    n = F.col("n")

    def rank(i: int) -> tuple[Column, Column, Column]:
        k = (n - 1).cast("double") * F.lit(float(probs[i]))
        f = F.floor(k).cast("long")
        return k, f, F.least(f + 1, n - 1)

    ranks = {f"_at{2 * i + side}": rank(i)[1 + side] for i in range(len(probs)) for side in (0, 1)}
    counts = cut_lineage(value_counts(df, keys, value))
    wanted, shift = narrowed(counts, keys, ranks, most)
    values = _inside(counts, wanted, keys, shift)
    upto = Window.partitionBy(*keys, "_begin").orderBy("_code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
    found = values.select(*keys, "n", "_code", *_held(F.col("_before"), F.col("_c"), list(ranks))).where(
        F.coalesce(*ranks).isNotNull())
    at = found.groupBy(*keys, "n").agg(*[value_of(F.max(F.when(F.col(r).isNotNull(), F.col("_code")))).alias(f"_v{j}")
                                         for j, r in enumerate(ranks)])

    def interpolated(i: int) -> Column:
        k, f, _ = rank(i)
        lo, hi = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
        return lo + (hi - lo) * (k - f)
    return at.select(*keys, "n", *[interpolated(i).alias(f"p_{i}") for i in range(len(probs))])


def array_percentile(ascending: Column, p: float) -> Column:
    """The same rule over a short ascending array; NULL when it is empty."""
    rank = F.greatest(F.size(ascending) - 1, F.lit(0)) * F.lit(float(p))
    below = F.get(ascending, F.floor(rank).cast("int"))
    above = F.get(ascending, F.ceil(rank).cast("int"))
    return below + (above - below) * (rank - F.floor(rank))
