"""Text files as ordered lines, and CSV records with line breaks, read by any number of tasks.

A split of a file yields its lines in order but knows neither how many lines stand before it nor
whether it begins inside a quoted cell. Both are states that combine over splits: a count, and a
map of two states (outside or inside a cell). Each split is summed up by itself, the few sums of
a file are run through in order, and what comes out in front of a split is joined back to it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

BLOCK = ["path", "block"]


def raw_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """path, block (where its split begins), n (grows along a split), value."""
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("n"), "value")


def first_lines(lines: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of ``raw_lines`` in each split (of those left, if some were filtered out).
    A split's lines come in order, one split after the other, so a task passes over them and holds
    nothing; a limit per file sorts all of a task's lines first."""
    def firsts(batches):
        taken: dict[tuple[str, int], int] = {}
        for batch in batches:
            paths = batch.column(0).dictionary_encode()
            code, block = paths.indices.to_numpy(), batch.column(1).to_numpy()
            starts = np.flatnonzero((np.diff(code, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
            picked = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(code)]):
                key = (paths.dictionary[int(code[a])].as_py(), int(block[a]))
                n = min(most - taken.get(key, 0), b - a)
                taken[key] = taken.get(key, 0) + n
                picked.extend(range(a, a + n))
            if picked:
                yield batch.take(pa.array(picked, pa.int64()))

    lines = lines.select("path", "block", "n", "value")
    return lines.mapInArrow(firsts, lines.schema)


def _earlier(partition: list[str], order: str) -> WindowSpec:
    return Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def numbered_lines(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """path, pos (0, 1, ... along the file), line."""
    lines = raw_lines(spark, paths, glob)
    blocks = lines.groupBy(*BLOCK).agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("first"))
    before = blocks.select("path", "block", (F.coalesce(F.sum("size").over(_earlier(["path"], "block")), F.lit(0))
                                             - F.col("first")).alias("shift"))
    return lines.join(before, BLOCK).select("path", (F.col("n") + F.col("shift")).alias("pos"),
                                            F.col("value").alias("line"))


def _ends_inside(text: Column, sep: str) -> Column:
    """Whether a text that begins outside a quoted cell ends inside one: an opening quote is left
    once the whole quoted cells are gone."""
    s = re.escape(sep)
    rest = F.regexp_replace(text, rf'(^|{s})\s*+"(?:[^"]++|"")*+"(?={s}|$)', "$1")
    return rest.rlike(rf'(?:^|{s})\s*+"')


def _odd(c: Column) -> Column:
    return F.pmod(c, F.lit(2)) == 1


def _state(last: Column, flips: Column, start: Column) -> Column:
    """The state behind some maps: the last constant one (its value and the flips up to it), turned
    by the flips since; the state in front of all, where there is no constant one."""
    return F.when(last.isNull(), start != _odd(flips)).otherwise(last["value"] != _odd(flips - last["flips"]))


def quoted_records(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """path, pos (of its first line: it orders the records of a file), record: lines, joined while
    a quoted cell is open. A cell is quoted if it begins with a quote; two quotes inside are one."""
    value = F.col("value")
    closing = r'^(?:[^"]++|"")*+"'
    after = F.regexp_replace(F.regexp_replace(value, closing, ""), f"^[^{re.escape(sep)}]*+", "")
    lines = raw_lines(spark, paths).select(
        "path", "block", "n", "value", _ends_inside(value, sep).alias("from_out"),
        F.when(value.rlike(closing), _ends_inside(after, sep)).otherwise(F.lit(True)).alias("from_in"))
    lines = lines.withColumns({"same": F.col("from_out") == F.col("from_in"),
                               "flip": (F.col("from_out") & ~F.col("from_in")).cast("int")})

    # in front of each line of a split, from the split's own lines
    inside, earlier = Window.partitionBy(*BLOCK).orderBy("n"), _earlier(BLOCK, "n")
    lines = lines.withColumn("flips", F.sum("flip").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    const = F.when(F.col("same"), F.struct(F.col("from_out").alias("value"), F.col("flips").alias("flips")))
    lines = lines.withColumn("const", const).withColumns({
        "own_last": F.last("const", ignorenulls=True).over(earlier),
        "own_flips": F.coalesce(F.sum("flip").over(earlier), F.lit(0))})

    # in front of each split, from the splits before it
    blocks = lines.groupBy(*BLOCK).agg(
        F.sum("flip").alias("b_flips"), F.max_by("const", F.when(F.col("const").isNotNull(), F.col("n"))).alias("b_last"))
    blocks = blocks.withColumn("all_flips", F.sum("b_flips").over(
        Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
    b_const = F.when(F.col("b_last").isNotNull(), F.struct(
        _state(F.col("b_last"), F.col("b_flips"), F.lit(False)).alias("value"), F.col("all_flips").alias("flips")))
    first = _earlier(["path"], "block")
    blocks = blocks.withColumn("b_const", b_const).select(
        *BLOCK, _state(F.last("b_const", ignorenulls=True).over(first),
                       F.coalesce(F.sum("b_flips").over(first), F.lit(0)), F.lit(False)).alias("opened"))

    lines = lines.join(blocks, BLOCK).select(
        "path", "block", "n", "value",
        (~_state(F.col("own_last"), F.col("own_flips"), F.col("opened"))).alias("starts"))
    at = F.struct("block", "n")
    lines = lines.withColumns({
        "begin": F.last(F.when(F.col("starts"), at), ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, 0)),
        "alone": F.col("starts") & F.coalesce(F.lead("starts").over(inside), F.lit(False))})
    # a split that begins inside a cell goes on with the last record of a split before it
    lasts = lines.groupBy(*BLOCK).agg(F.max("begin").alias("last"))
    lasts = lasts.select(*BLOCK, F.last("last", ignorenulls=True).over(first).alias("carried"))
    single = lines.where("alone").select("path", F.col("begin").alias("pos"), F.col("value").alias("record"))
    rest = lines.where("not alone").join(lasts, BLOCK).select(
        "path", F.coalesce("begin", "carried").alias("pos"), F.struct("block", "n", "value").alias("part"))
    joined = rest.groupBy("path", "pos").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        "path", "pos", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    return single.unionByName(joined)
