"""CSV drops: per-file header and delimiter, tolerant reads, curated benchmarks.

Everything is read as strings (no schema inference pass); typed values come from the
tolerant parsers in ``functions``. One job lists the header line of every file; files with
the same source, delimiter and header are then read together, and all rows of a kind are
brought together before anything is aggregated, so a source that lies in several folders
has one result. What comes back to the driver is one row per distinct header.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.dates import parse_date_any
from ..functions.numbers import safe_float
from ..functions.schema import clean_header, normalize_category, resolve_columns
from ..functions.text import strip
from ..operators import benchmark
from .lines import first_lines, quoted_records, raw_lines

SAMPLE_LINES = 5    # a report shows the first lines of a file

# Delimiter candidates, in tie-break order.
DELIMITERS = [",", ";", "\t", "|"]


def header_lines(spark: SparkSession, root: str) -> DataFrame:
    """path, source (lower-cased parent folder), header (first non-blank line) of every *.csv
    file below ``root`` that has one."""
    lines = first_lines(raw_lines(spark, root, "*.csv").where(strip(F.col("value")) != ""), 1)
    # lines of one block are numbered in order, and blocks by where they start
    first = lines.groupBy("path").agg(F.min_by("value", F.struct("block", "n")).alias("header"))
    name = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))      # the metadata are encoded
    return first.select(name.alias("path"), "header").select(
        "path", F.lower(F.element_at(F.split("path", "/"), -2)).alias("source"), "header")


def sniff_delimiter(header: str, candidates: list[str] = DELIMITERS) -> str:
    """The candidate that occurs most often in the header line (ties: the earliest)."""
    return max(candidates, key=lambda d: (header.count(d), -candidates.index(d)))


def header_cells(header: str, delimiter: str) -> list[str]:
    return clean_header(next(csv.reader([header.lstrip("\ufeff")], delimiter=delimiter), []))


def read_csv_files(spark: SparkSession, paths: list[str], columns: list[str], delimiter: str,
                   multi_line: bool = False, blank_as_empty: bool = True) -> DataFrame:
    """Files that share a header: all-string columns by position, named ``columns`` (of equal
    names the later ones get a number); doubled quotes are one quote; short rows are padded
    (NULL, or '' when ``blank_as_empty``), extra cells dropped, undecodable bytes replaced.

    ``multi_line`` lets quoted cells hold line breaks (``lines.quoted_records``; a file is read by
    as many tasks as it has splits, and its rows come in file order)."""
    names: list[str] = []
    for c in columns:
        name, n = c, 2
        while name.lower() in {x.lower() for x in names}:
            name, n = f"{c}_{n}", n + 1
        names.append(name)
    schema = ", ".join(f"`{n.replace('`', '``') or f'column_{i}'}` string" for i, n in enumerate(names))
    options = {"sep": delimiter, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "encoding": "UTF-8"}
    if multi_line:
        records = quoted_records(spark, paths, delimiter).where(strip(F.col("record")) != "")
        heads = records.groupBy(F.col("path").alias("_path")).agg(F.min("pos").alias("_head"))
        records = records.join(heads, F.col("path") == F.col("_path")).where("pos > _head").orderBy("path", "pos")
        df = records.select(F.from_csv("record", F.lit(schema), options).alias("r")).select("r.*")
    else:
        df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
              .options(**options).csv(paths))
    return df.fillna("") if blank_as_empty else df


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """path, source, size, n_rows (data lines, blank ones left out), delimiter, header, columns and
    sample (the first ``SAMPLE_LINES`` data lines, in file order) of every *.csv file below
    ``root``, empty files included."""
    path = F.regexp_replace("path", "^file:/+", "/")
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.csv").load(root))
    sizes = found.select(path.alias("path"), F.col("length").alias("size"))
    # a scan leaves files without a byte out; the listing has them
    listed = spark.createDataFrame([(f,) for f in found.inputFiles()], "path string").select(
        F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path")).select(path.alias("path"))
    files = listed.join(sizes, "path", "left").select("path", F.coalesce("size", F.lit(0)).alias("size"))
    name = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))      # the metadata are encoded
    lines = raw_lines(spark, root, "*.csv").where(strip(F.col("value")) != "")
    named = lambda df: df.withColumn("path", name).withColumn("path", path)
    counts = named(lines.groupBy("path").agg(F.count(F.lit(1)).alias("lines")))
    nth = F.row_number().over(Window.partitionBy("path").orderBy("block", "n"))
    first = (named(first_lines(lines, SAMPLE_LINES + 1)).withColumn("nth", nth).where(F.col("nth") <= SAMPLE_LINES + 1).groupBy("path")
             .agg(F.array_sort(F.collect_list(F.struct("nth", "value"))).alias("first")))
    texts = F.transform("first", lambda x: x["value"])
    per_file = counts.join(first, "path").select(
        "path", "lines", F.ltrim(texts[0], F.lit("\ufeff")).alias("header"), F.slice(texts, 2, SAMPLE_LINES).alias("sample"))
    ticks = [F.length("header") - F.length(F.replace("header", F.lit(d), F.lit("")))
             for d in DELIMITERS]
    best = F.lit(DELIMITERS[-1])
    for d, n in reversed([*zip(DELIMITERS, ticks)][:-1]):
        best = F.when(n >= F.greatest(*ticks), F.lit(d)).otherwise(best)
    out = files.join(per_file, "path", "left").withColumn(
        "delimiter", F.when(F.col("header").isNotNull(), best))
    cells = F.transform(F.split("header", F.concat(F.lit("\\Q"), F.col("delimiter"), F.lit("\\E")), -1),
                        lambda c: strip(F.regexp_replace(c, '^\\s*"|"\\s*$', "")))
    return out.select(
        "path", F.lower(F.element_at(F.split("path", "/"), -2)).alias("source"), "size",
        F.coalesce(F.col("lines") - 1, F.lit(0)).cast("long").alias("n_rows"), "delimiter", "header",
        F.array_join(cells, " | ").alias("columns"), F.coalesce("sample", F.array().cast("array<string>")).alias("sample"))


def sample_lines(files: DataFrame) -> DataFrame:
    """path, source, line_no (from 1) and line: the samples of an ``inventory``."""
    return files.select("path", "source", F.posexplode("sample").alias("at", "line")).select(
        "path", "source", (F.col("at") + 1).alias("line_no"), "line")


CURATED_KINDS = ("price_benchmark", "category_weekly", "text_terms")


def drop_rows(df: DataFrame, source: str, text_only: bool = False) -> DataFrame:
    """source, category_norm, price, day, text of one file group; what its header does not
    offer is NULL (the category: '')."""
    cols = resolve_columns(df.columns)

    def col(role):
        return F.col(f"`{cols[role]}`") if cols[role] is not None else None

    none = F.lit(None)
    plain = not text_only and cols["category"] is not None
    return df.select(
        F.lit(source).alias("source"),
        (normalize_category(col("category"), cols["category_kind"]) if plain else F.lit(""))
        .alias("category_norm"),
        (safe_float(col("price")) if plain and cols["price"] else none.cast("double")).alias("price"),
        (parse_date_any(col("date")) if plain and cols["date"] else none.cast("date")).alias("day"),
        (col("text") if cols["text"] else none.cast("string")).alias("text"))


def read_drop(spark: SparkSession, root: str, text_only_sources: tuple[str, ...] = (),
              multi_line: bool = False, candidates: list[str] = DELIMITERS) -> DataFrame | None:
    """``drop_rows`` of all files below ``root``; None when no file has a header. ``candidates``:
    the delimiters that a file may have, in tie-break order."""
    groups = (header_lines(spark, root)
              .groupBy("source", "header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
              .orderBy("source", "header").collect())         # one row per distinct header
    out = None
    for g in groups:
        sep = sniff_delimiter(g["header"], candidates)
        df = read_csv_files(spark, g["paths"], header_cells(g["header"], sep), sep, multi_line)
        rows = drop_rows(df, g["source"], g["source"] in text_only_sources)
        out = rows if out is None else out.unionByName(rows)
    return out


def build_curated(spark: SparkSession, root: str, text_only_sources: tuple[str, ...] = (),
                  min_samples: int = 30, kinds: tuple[str, ...] = CURATED_KINDS,
                  top_terms: int = 200, multi_line: bool = False,
                  candidates: list[str] = DELIMITERS) -> dict[str, DataFrame]:
    """The curated tables of all sources below ``root``: price benchmark, weekly category
    demand, text terms (only ``kinds`` are built)."""
    rows = read_drop(spark, root, text_only_sources, multi_line, candidates)
    if rows is None:
        rows = spark.createDataFrame([], "source string, category_norm string, price double, "
                                         "day date, text string")
    build = {"price_benchmark": lambda: benchmark.price_benchmark(rows, min_samples),
             "category_weekly": lambda: benchmark.category_weekly(rows),
             "text_terms": lambda: benchmark.text_terms(rows.where("text IS NOT NULL"), top_terms)}
    return {kind: build[kind]() for kind in kinds}


def read_typed_csv(spark: SparkSession, path: str, columns: dict[str, str],
                   null_value: str = "") -> DataFrame:
    """Header CSV read as strings, then typed with ``try_cast`` (booleans accept 0/1;
    the CSV reader's own boolean parsing would turn them into NULL)."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = (spark.read.option("header", True).option("nullValue", null_value)
          .schema(schema).csv(path))
    out = []
    for c, t in columns.items():
        col = F.col(f"`{c}`")
        if t == "boolean":
            low = F.lower(F.trim(col))
            col = (F.when(low.isin("1", "t", "true", "y", "yes"), F.lit(True))
                   .when(low.isin("0", "f", "false", "n", "no"), F.lit(False)))
        elif t == "date":
            col = F.call_function("try_to_date", F.trim(col), F.lit("yyyy-MM-dd"))
        elif t != "string":
            col = F.trim(col).try_cast(t)
        out.append(col.alias(c))
    return df.select(*out)


KEYWORD_STAGE_COLUMNS = {"keyword_raw": "string", "keyword_canonica": "string",
                         "categoria": "string", "subcategoria": "string",
                         "sinonimo_de": "string", "es_error_ortografico": "boolean",
                         "prioridad": "smallint"}
INTEREST_CSV_COLUMNS = {"week_start": "date", "keyword_canonica": "string", "geo": "string",
                        "region": "string", "interest": "int"}
MARKETPLACE_WEEKLY_COLUMNS = {"week_start": "date", "keyword_canonica": "string",
                              "site_id": "string", "results_total": "int",
                              "price_median": "double", "price_p25": "double",
                              "price_p75": "double", "top_category_id": "string",
                              "top_category_name": "string"}
MARKETPLACE_TRENDS_COLUMNS = {"week_start": "date", "site_id": "string", "category_id": "string",
                              "rank": "smallint", "keyword": "string", "url": "string"}


def read_keyword_staging(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, KEYWORD_STAGE_COLUMNS)


def read_interest_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_typed_csv(spark, path, INTEREST_CSV_COLUMNS)


def import_marketplace_weekly(spark: SparkSession, path: str, default_site: str = "MPE") -> DataFrame:
    """Trim keys, blank site -> default, blank category fields -> NULL."""
    df = read_typed_csv(spark, path, MARKETPLACE_WEEKLY_COLUMNS)
    blank_null = lambda c: F.nullif(F.trim(c), F.lit(""))
    return df.select("week_start", F.trim("keyword_canonica").alias("keyword_canonica"),
                     F.coalesce(blank_null("site_id"), F.lit(default_site)).alias("site_id"),
                     "results_total", "price_median", "price_p25", "price_p75",
                     blank_null("top_category_id").alias("top_category_id"),
                     blank_null("top_category_name").alias("top_category_name"))


def import_marketplace_trends(spark: SparkSession, path: str, default_site: str = "MPE") -> DataFrame:
    """Trim, blank site -> default, category NULL -> '', blank url -> NULL."""
    df = read_typed_csv(spark, path, MARKETPLACE_TRENDS_COLUMNS)
    return df.select("week_start",
                     F.coalesce(F.nullif(F.trim("site_id"), F.lit("")), F.lit(default_site)).alias("site_id"),
                     F.coalesce(F.trim("category_id"), F.lit("")).alias("category_id"), "rank",
                     F.trim("keyword").alias("keyword"),
                     F.nullif(F.trim("url"), F.lit("")).alias("url"))
