"""Adapters: reference-shaped inputs derived from the benchmark tables.

Every adapter is a lazy DataFrame over the given tables, so its size grows with them.
``plans/oracle.py`` defines the very same derivations in SQL (the ``*_CTE`` strings);
keep both sides in step when changing either.

Derivations (fixed, deterministic):
  bills        orders: code=o_orderkey, total_amount=o_totalprice (cents), vat=18/118 of
               it, 5% discount for customers with key % 10 = 0, base = total - vat +
               discount; paid_at = o_orderdate, NULL for priority '5-LOW'; status
               F -> 'PAID', P -> 'PENDING', O -> NULL. ``paid_day='web'`` moves the paid
               day to 2024-01-01 + (o_orderkey % 40) so sales overlap the event days.
  details      lineitem: bill_code=l_orderkey, product=l_partkey (negative, i.e. unknown, for
               order key % 50 = 0), quantity and unit price with three decimals, amount.
  products     part: id=p_partkey, name=p_name, price=p_retailprice.
  raw events   events: day=date(ts), event_name via EVENT_NAME_MAP, user_id,
               session_id = user_id * 100 + hour(ts) (a user's hour of activity).
  search       'view' events; the term is the name of part k (k from props) written in
               one of several raw forms chosen by event_id % 8 (upper, padded, accented,
               '(not set)', 'Not Set', blank, plain; padding has tabs, line ends
               and no-break spaces).
  dictionary   one staging row per part except adjectives 'hot' (left unmapped) and
               'old' (covered by aliases only): raw = p_name (upper-cased or padded for
               some keys), canonical = noun or full name, category from p_type,
               subcategory = p_brand (NULL for key % 17 = 0), synonym / typo / priority
               from the key ('cold' names are all misspellings).
  aliases      distinct normalized names with adjective 'old' -> noun.
  interest     one point per event: keyword = noun of part k (upper-cased when
               event_id % 3 = 0), value = events.value as the interest reading.
  calendar     one commercial event per event_type: window from the first day of that
               type, tags = categories of the parts seen with value < 1.
  price rows   lineitem x part: source = 'flag_' + lower(l_returnflag), category =
               lower(p_type) + '.' + noun, price = l_extendedprice, date = l_shipdate.
  text docs    documents (source, text) and pages ('pages', html).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import table
from ..functions.text import first_word, last_word
from ..operators.common import spread

# Map from the benchmark event types to web funnel event names.
EVENT_NAME_MAP = {"signup": "session_start", "view": "view_item", "click": "add_to_cart",
                  "error": "begin_checkout", "purchase": "purchase"}
# Internal category -> price-category LIKE patterns (category map).
CATEGORY_MAP_ROWS = [
    ("Economy", "economy.%", "economy lines"),
    ("Promoción", "promo.%", "promotions"),
    ("Standard", "standard.%", "standard lines"),
    ("Standard", "standard.g%", "overlapping pattern: counted twice"),
    ("Small", "small._o%", "single-char wildcard"),
    ("Large", "large", "no match: needs a dot suffix"),
]


def scan(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table for heavy work per row, in as many partitions as the cluster has cores."""
    return spread(table(spark, sf, name), spark.sparkContext.defaultParallelism)


def _cents_to_money(c: Column) -> Column:
    return (c / 100).cast("decimal(18,2)")


def category_of_type(p_type: Column) -> Column:
    """p_type -> display category ('PROMO' -> 'Promoción', else capitalized)."""
    cap = F.concat(F.upper(F.substring(p_type, 1, 1)), F.lower(F.substring(p_type, 2, 1000)))
    return F.when(p_type == "PROMO", F.lit("Promoción")).otherwise(cap)


def bills(spark: SparkSession, sf: str, paid_day: str = "order") -> DataFrame:
    o = table(spark, sf, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    o = o.select("*", cents.alias("cents"))
    vat = F.expr("(cents * 18) div 118")
    disc = F.when(F.col("o_custkey") % 10 == 0, F.expr("cents div 20")).otherwise(F.lit(0))
    if paid_day == "web":
        when_paid = F.date_add(F.lit("2024-01-01").cast("date"),
                               (F.col("o_orderkey") % 40).cast("int")).cast("timestamp_ntz")
    else:
        when_paid = F.col("o_orderdate")
    status = (F.when(F.col("o_orderstatus") == "F", F.lit("PAID"))
              .when(F.col("o_orderstatus") == "P", F.lit("PENDING")))
    return o.select(
        F.col("o_orderkey").alias("code"), F.col("o_custkey").alias("user_id"),
        _cents_to_money(F.col("cents") - vat + disc).alias("total"),
        _cents_to_money(disc).alias("discount"),
        _cents_to_money(vat).alias("vat"),
        _cents_to_money(F.col("cents")).alias("total_amount"),
        F.when(F.col("o_orderpriority") != "5-LOW", when_paid).alias("paid_at"),
        status.alias("payment_status"))


def details(spark: SparkSession, sf: str, revenue: str = "amount") -> DataFrame:
    li = table(spark, sf, "lineitem")
    # some lines name a product that does not exist
    product = F.when(F.col("l_orderkey") % 50 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    cols = [F.col("l_orderkey").alias("bill_code"), product.alias("product"),
            (F.col("l_quantity").cast("decimal(18,3)")
             + (F.col("l_linenumber") % 8).cast("decimal(18,3)") / 8).cast("decimal(18,3)").alias("quantity")]
    if revenue == "amount":
        cols.append(F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    elif revenue == "unit_price":
        unit = (F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(38,10)")
        cols.append(F.round(unit, 3).cast("decimal(18,3)").alias("unit_price"))
    return li.select(*cols)


def products(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"),
                                           F.col("p_name").alias("name"),
                                           F.col("p_retailprice").alias("price"))


def _event_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _with_part(rows: DataFrame, key: str, part: DataFrame, how: str = "inner") -> DataFrame:
    """rows and the part that ``key`` names. Both sides are shuffled by it: part grows with the
    tables, and a broadcast would take it whole through the driver."""
    return rows.join(part.hint("shuffle_hash"), F.col(key) == F.col("p_partkey"), how)


def raw_events(spark: SparkSession, sf: str) -> DataFrame:
    return web_events(table(spark, sf, "events"))


def web_events(ev: DataFrame) -> DataFrame:
    """Benchmark events (batch or streaming) -> web events with funnel names."""
    name = F.lit(None).cast("string")
    for src, dst in EVENT_NAME_MAP.items():
        name = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(name)
    return ev.select(F.to_date("ts").alias("day"), name.alias("event_name"), "user_id",
                     (F.col("user_id") * 100 + F.hour("ts")).alias("session_id"), "ts")


def search_events(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    """``events``: some rows of the events table instead of all."""
    events = scan(spark, sf, "events") if events is None else events
    return search_events_from(events, table(spark, sf, "part")).drop("ts")


def search_events_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """Search terms of 'view' events (batch or streaming events; part is static)."""
    ev = (events.where(F.col("event_type") == "view")
          .select("event_id", "ts", F.to_date("ts").alias("day"), _event_k().alias("k")))
    j = _with_part(ev, "k", part.select("p_partkey", "p_name"))
    v = F.col("event_id") % 8
    name = F.col("p_name")
    term = (F.when(v == 0, F.upper(name))
            .when(v == 1, F.concat(F.lit(" \t"), name, F.lit("\u00a0")))
            .when(v == 2, F.lit(" (not set)\n"))
            .when(v == 3, F.translate(name, "ao", "áó"))
            .when(v == 4, F.lit("Not Set"))
            .when(v == 5, F.lit(""))
            .otherwise(name))
    return j.select("day", "ts", term.alias("search_term"))


def dictionary_stage(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").where(~first_word("p_name").isin("hot", "old"))
    key = F.col("p_partkey")
    noun = last_word("p_name")
    raw = (F.when(key % 5 == 0, F.upper("p_name"))
           .when(key % 7 == 0, F.concat("p_name", F.lit(" ")))
           .otherwise(F.col("p_name")))
    canon = F.when(key % 4 == 0, F.col("p_name")).otherwise(noun)
    synonym = (F.when(key % 6 == 1, F.concat(noun, F.lit("s")))
               .when(key % 6 == 2, F.lit("")))
    typo = (F.when(first_word("p_name") == "cold", F.lit(True))
            .when(key % 13 == 0, F.lit(None)).otherwise(key % 9 == 0))
    prio = F.when(key % 11 != 0, (F.lit(1) + key % 3)).cast("smallint")
    return p.select(raw.alias("keyword_raw"), canon.alias("keyword_canonica"),
                    category_of_type(F.col("p_type")).alias("categoria"),
                    F.when(key % 17 != 0, F.col("p_brand")).alias("subcategoria"),
                    synonym.alias("sinonimo_de"), typo.cast("boolean").alias("es_error_ortografico"),
                    prio.alias("prioridad"))


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.text import norm_txt
    p = table(spark, sf, "part").where(first_word("p_name") == "old")
    return (p.select(norm_txt("p_name").alias("raw_term_norm"),
                     last_word("p_name").alias("canonical_term"),
                     F.lit("MANUAL").alias("reason"))
            .distinct())


def interest_points(spark: SparkSession, sf: str, events: DataFrame | None = None) -> DataFrame:
    events = scan(spark, sf, "events") if events is None else events
    ev = events.select("event_id", "ts", "value", _event_k().alias("k"))
    part = table(spark, sf, "part").select("p_partkey", last_word("p_name").alias("noun"))
    j = _with_part(ev, "k", part)
    kw = F.when(F.col("event_id") % 3 == 0, F.upper("noun")).otherwise(F.col("noun"))
    return j.select(F.to_date("ts").alias("day"), kw.alias("keyword"),
                    F.col("value").cast("string").alias("value_text"),
                    F.col("value").alias("value"))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    ev = scan(spark, sf, "events").select("event_type", "ts", "value", _event_k().alias("k"))
    # summed up per part before they are shuffled
    ev = ev.groupBy("event_type", "k").agg(F.min(F.to_date("ts")).alias("day"), F.count(F.lit(1)).alias("n"),
                                           F.bool_or(F.col("value") < 1).alias("low"))
    j = _with_part(ev, "k", table(spark, sf, "part").select("p_partkey", "p_type"), "left")
    kind = (F.when(F.col("event_type") == "purchase", "CAMPAIGN")
            .when(F.col("event_type") == "signup", "SEASON")
            .when(F.col("event_type") == "view", "HOLIDAY").otherwise("OTHER"))
    g = j.groupBy("event_type").agg(
        F.min("day").alias("first_day"),
        F.sum("n").alias("n"),
        F.array_sort(F.collect_set(F.when(F.col("low"), category_of_type(F.col("p_type")))))
         .alias("tags"))
    start = F.date_add("first_day", F.length("event_type"))
    return g.select(
        F.concat(F.lit("Campaign "), F.col("event_type")).alias("event_name"),
        kind.alias("event_type"),
        start.alias("start_date"),
        F.date_add(start, (F.col("n") % 11).cast("int")).alias("end_date"),
        F.lit("Lima").alias("city"), "tags",
        (F.lit(1) + F.col("n") % 5).cast("int").alias("prioridad"),
        F.lit(None).cast("string").alias("notes"))


def price_rows(spark: SparkSession, sf: str) -> DataFrame:
    li = scan(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_extendedprice",
                                             "l_shipdate")
    category = F.concat(F.lower("p_type"), F.lit("."), F.lower(last_word("p_name")))
    part = table(spark, sf, "part").select("p_partkey", category.alias("category_norm"))
    return _with_part(li, "l_partkey", part).select(
        F.concat(F.lit("flag_"), F.lower("l_returnflag")).alias("source"), "category_norm",
        F.col("l_extendedprice").alias("price"),
        F.to_date("l_shipdate").alias("day"))


def category_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_MAP_ROWS,
                                 "internal_categoria string, kaggle_pattern string, notes string")


def infix_map(spark: SparkSession, sf: str) -> DataFrame:
    """A category map of patterns that begin with a wildcard, several for every part noun."""
    noun, key = F.lower(last_word("p_name")), F.col("p_partkey") % 4
    pattern = (F.when(key == 0, F.concat(F.lit("%"), noun, F.lit("%")))
               .when(key == 1, F.concat(F.lit("_%"), F.substring(noun, 2, 100), F.lit("%")))
               .when(key == 2, F.concat(F.lit("%."), F.substring(noun, 1, 2), F.lit("%")))
               .otherwise(F.concat(F.lit("%"), F.substring(noun, 1, 1), F.lit("%"))))
    return table(spark, sf, "part").select(category_of_type(F.col("p_type")).alias("internal_categoria"),
                                           pattern.alias("kaggle_pattern")).distinct()


def event_seconds(spark: SparkSession, sf: str) -> DataFrame:
    """Event times as seconds: values of one narrow range, all of them different."""
    day = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = day * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    return table(spark, sf, "events").select(F.lit("events").alias("source"),
                                             F.col("event_type").alias("category_norm"),
                                             seconds.cast("double").alias("price"))


def text_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = scan(spark, sf, "documents").select("source", "text")
    pages = scan(spark, sf, "pages").select(F.lit("pages").alias("source"),
                                                     F.col("html").alias("text"))
    return docs.unionByName(pages)


def seed_list(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword seed file: one line per part, position = p_partkey, written upper-case,
    padded or blank for some keys."""
    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    kw = (F.when(key % 3 == 0, F.upper("p_name"))
          .when(key % 5 == 1, F.concat(F.lit("\t"), F.col("p_name"), F.lit("\u00a0")))
          .when(key % 7 == 2, F.lit(" \r\n"))
          .otherwise(F.col("p_name")))
    return p.select(kw.alias("keyword"), key.alias("position"))


# ------------------------------------------------------------------------------------
# File drops written from the tables (under the shared checkpoint folder), so that the
# file readers run over data that grows with the tables. A drop is landing data: it is
# written once per (session, tables folder) and then read by every query that needs it.

_DROPS: dict[tuple[int, str, str], tuple[SparkSession, str]] = {}


def _landed(spark: SparkSession, sf: str, kind: str, write) -> str:
    key = (id(spark), sf, kind)
    hit = _DROPS.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    path = write(spark, sf)
    _DROPS[key] = (spark, path)
    return path

def csv_drop(spark: SparkSession, sf: str) -> str:
    return _landed(spark, sf, "csv", write_csv_drop)


def interest_exports(spark: SparkSession, sf: str) -> str:
    return _landed(spark, sf, "exports", write_interest_exports)


def write_csv_drop(spark: SparkSession, sf: str) -> str:
    """Two CSV sources: 'purchases' (';'-separated, all text: event_time with ' UTC',
    comma decimals on line 4, 'n/a' price on line 5, blank category on line 3, blank
    time on line 6) and 'descriptions' (',' separated, HTML-ish product text)."""
    from ..session import scratch_path
    root = scratch_path(spark, "csv-drop")
    li = scan(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    j = _with_part(li, "l_partkey", part)
    ln = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("string")
    code = F.concat(F.lower("p_type"), F.lit("."), F.lower(last_word("p_name")))
    purchases = j.select(
        F.when(ln == 6, F.lit("")).otherwise(
            F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))).alias("event_time"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_size").cast("string").alias("category_id"),
        F.when(ln == 3, F.lit("")).otherwise(code).alias("category_code"),
        F.col("p_brand").alias("brand"),
        F.when(ln == 4, F.replace(price, F.lit("."), F.lit(",")))
         .when(ln == 5, F.lit("n/a")).otherwise(price).alias("price"),
        F.col("l_suppkey").cast("string").alias("user_id"))
    purchases.write.option("header", True).option("sep", ";").csv(f"{root}/purchases")
    desc = part.select(F.col("p_partkey").cast("string").alias("id"),
                       F.concat(F.lit("<p>"), F.col("p_name"), F.lit(" &amp; "), F.col("p_brand"),
                                F.lit("</p>")).alias("description"))
    desc.write.option("header", True).csv(f"{root}/descriptions")
    return root


def csv_messy_drop(spark: SparkSession, sf: str) -> str:
    return _landed(spark, sf, "csv-messy", write_csv_messy_drop)


def csv_mixed_drop(spark: SparkSession, sf: str) -> str:
    return _landed(spark, sf, "csv-mixed", write_csv_mixed_drop)


def event_files(spark: SparkSession, sf: str) -> str:
    return _landed(spark, sf, "event-files", write_event_files)


def write_csv_messy_drop(spark: SparkSession, sf: str) -> str:
    """Product texts with doubled quotes, delimiters and a line break in the cell."""
    from ..session import scratch_path
    root = scratch_path(spark, "csv-messy")
    text = F.concat(F.lit('said "'), F.col("p_name"), F.lit('", ok; then\n'), F.col("p_brand"),
                    F.lit(' "quoted" '), F.col("p_type"))
    (table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"),
                                     text.alias("description"), F.lit("tail").alias("note"))
     .write.option("header", True).option("escape", '"').csv(f"{root}/messy"))
    return root


def csv_sample_drop(spark: SparkSession, sf: str) -> str:
    return _landed(spark, sf, "csv-samples", write_csv_sample_drop)


def write_csv_sample_drop(spark: SparkSession, sf: str) -> str:
    """One file in each of the folders lot=0 .. lot=6, lines in the order of their keys, with
    commas in three folders, and the delimiter '^' in the others; lot=7 holds a header alone and
    lot=8 an empty file."""
    from ..session import scratch_path
    root = scratch_path(spark, "csv-samples")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        F.concat(F.lit("flag_"), F.lower("l_returnflag")).alias("category_code"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("event_time"),
        (F.col("l_orderkey") % 7).alias("lot"))
    columns = ["l_orderkey", "l_linenumber", "category_code", "price", "event_time", "lot"]
    # ranges are sorted and written by many tasks; the one that writes a file strings them together
    runs = scratch_path(spark, "csv-runs")
    (rows.where("lot IS NOT NULL").select(*columns).repartitionByRange("lot", *columns[:5])
     .sortWithinPartitions("lot", *columns[:5]).write.partitionBy("lot").parquet(runs))
    kinds = rows.select(*columns[:5]).schema
    sorted_runs: dict[str, list[str]] = {}
    for file in sorted(spark.read.schema(kinds).parquet(runs).inputFiles()):     # part-<number of the range>
        sorted_runs.setdefault(file.split("/")[-2], []).append(file)

    def write_lot(lot: str) -> None:
        in_order = reduce(DataFrame.unionAll, [spark.read.schema(kinds).parquet(f) for f in sorted_runs[lot]])
        (in_order.coalesce(1).write.option("header", True)
         .option("sep", "," if int(lot.split("=")[1]) < 3 else "^").csv(f"{root}/{lot}"))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write_lot, sorted_runs))
    rows.limit(0).select(*columns).drop("lot").coalesce(1).write.option("header", True).csv(f"{root}/lot=7")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/lot=8/empty.csv")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    return root


def write_csv_mixed_drop(spark: SparkSession, sf: str) -> str:
    """The source 'shop' in two folders; one of them holds files of two headers, with another
    delimiter and another order of columns. Lines are dealt by their number."""
    from ..session import scratch_path
    root = scratch_path(spark, "csv-mixed")
    rows = price_rows(spark, sf).select(
        F.col("category_norm").alias("category_code"), F.col("price").cast("string").alias("price"),
        F.date_format("day", "yyyy-MM-dd").alias("event_time"),
        F.pmod(F.xxhash64("category_norm", "price", "day"), F.lit(3)).alias("n"))
    for n, folder, sep, names in ((0, "a/shop", ";", ["category_code", "price", "event_time"]),
                                  (1, "a/shop", ",", ["price", "event_time", "category_code"]),
                                  (2, "b/shop", "|", ["event_time", "category_code", "price"])):
        (rows.where(F.col("n") == n).select(*names).write.mode("append").option("header", True)
         .option("sep", sep).csv(f"{root}/{folder}"))
    return root


def write_event_files(spark: SparkSession, sf: str) -> str:
    """Three loads of event files, each with a third of the events of every day."""
    from ..session import scratch_path
    root = scratch_path(spark, "event-files")
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    for n in range(3):
        third = F.pmod(F.xxhash64("event_id", "ts", "user_id"), F.lit(3))
        ev.where(third == n).write.mode("append").parquet(root)
    return root


def write_interest_exports(spark: SparkSession, sf: str) -> str:
    """One export file per keyword (noun): preamble, blank line, header
    ('Semana;<kw>: (Perú)' or 'Week,<kw>: (Peru)'), one row per day with the floor of
    the day's mean event value ('<1' for 0), a blank line inside the block, a text row
    that ends the block, and a date row after it that must be ignored."""
    from ..session import scratch_path
    root = scratch_path(spark, "interest-exports")
    ev = table(spark, sf, "events").select("ts", "value", _event_k().alias("k"))
    j = _with_part(ev, "k", table(spark, sf, "part").select("p_partkey", "p_name"))
    daily = (j.groupBy(last_word("p_name").alias("kw"), F.to_date("ts").alias("day"))
             .agg(F.floor(F.avg("value")).cast("bigint").alias("v")))
    sep = F.when(F.length("kw") % 2 == 0, F.lit(";")).otherwise(F.lit(","))
    # some days are written with a time
    day_txt = F.concat(F.date_format("day", "yyyy-MM-dd"),
                       F.when(F.dayofmonth("day") % 3 == 0, F.lit("T16:32:00Z")).otherwise(F.lit("")))
    val_txt = F.when(F.col("v") == 0, F.lit("<1")).otherwise(F.col("v").cast("string"))
    rows = daily.select("kw", (F.datediff("day", F.lit("2000-01-01").cast("date")) * 2 + 10)
                        .alias("ord"), F.concat(day_txt, sep, val_txt).alias("line"))
    kws = daily.select("kw").distinct()
    header = F.when(F.length("kw") % 2 == 0, F.concat(F.lit("Semana;"), F.col("kw"), F.lit(": (Perú)"))) \
              .otherwise(F.concat(F.lit("Week,"), F.col("kw"), F.lit(": (Peru)")))
    extra = kws.select("kw", F.explode(F.array(
        F.struct(F.lit(0).alias("ord"), F.lit("Category: All categories").alias("line")),
        F.struct(F.lit(1).alias("ord"), F.lit("").alias("line")),
        F.struct(F.lit(2).alias("ord"), header.alias("line")),
        F.struct(F.lit(11).alias("ord"), F.lit("").alias("line")),
        F.struct(F.lit(10 ** 9).alias("ord"), F.concat(F.lit("Notes"), sep, F.lit("end of data")).alias("line")),
        F.struct(F.lit(10 ** 9 + 1).alias("ord"), F.concat(F.lit("2030-01-07"), sep, F.lit("99")).alias("line")),
    )).alias("e")).select("kw", "e.ord", "e.line")
    lines = rows.unionByName(extra)
    # an older file for each keyword, whose path sorts first: its readings lose
    old = lines.where((F.col("ord") < 10) | (F.col("ord") % 4 == 0)).withColumn(
        "line", F.when((F.col("ord") >= 10) & (F.col("ord") < 10 ** 9),
                       F.regexp_replace("line", "[0-9<]+$", "77")).otherwise(F.col("line")))
    (old.repartition("kw").sortWithinPartitions("kw", "ord").select("kw", "line")
     .write.partitionBy("kw").option("sep", "\t").option("quote", "").option("emptyValue", "")
     .option("header", False).csv(f"{root}/0_old"))
    (lines.repartition("kw").sortWithinPartitions("kw", "ord").select("kw", "line")
     .write.partitionBy("kw").option("sep", "\t").option("quote", "").option("emptyValue", "")
     .option("header", False)
     .csv(f"{root}/1_new"))
    return root


def marketplace_search_json(spark: SparkSession, sf: str) -> DataFrame:
    """One landed search response per line item (keyword = noun, week of the ship
    date): three numeric prices and a null one; category filters vary with the line
    number (none / one / a blank-id one after a brand filter)."""
    li = scan(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    j = _with_part(li, "l_partkey", part)
    p = F.col("l_extendedprice")
    item = lambda price, cat: F.struct(price.alias("price"), cat.alias("category_id"))
    results = F.array(item(p, F.col("p_type")), item(F.lit(None).cast("double"), F.lit("X")),
                      item(p * (1 - F.col("l_discount")), F.col("p_type")),
                      item(p * (1 + F.col("l_tax")), F.col("p_type")))
    val = lambda i, n: F.struct(i.alias("id"), n.alias("name"))
    flt = lambda fid, vals: F.struct(F.lit(fid).alias("id"), vals.alias("values"))
    cat_filter = flt("category", F.array(val(F.concat(F.lit("C"), F.col("p_size").cast("string")),
                                             category_of_type(F.col("p_type")))))
    blank_filter = flt("category", F.array(val(F.lit(""), F.lit("ZZ"))))
    brand_filter = flt("brand", F.array(val(F.col("p_brand"), F.col("p_brand"))))
    ln = F.col("l_linenumber") % 3
    filters = (F.when(ln == 0, F.array_remove(F.array(brand_filter), brand_filter))
               .when(ln == 1, F.array(cat_filter))
               .otherwise(F.array(brand_filter, blank_filter)))
    doc = F.to_json(F.struct(F.struct(F.col("l_quantity").cast("bigint").alias("total")).alias("paging"),
                             results.alias("results"), filters.alias("filters")))
    return j.select(F.trunc(F.to_date("l_shipdate"), "week").alias("week_start"),
                    last_word("p_name").alias("keyword_canonica"), F.lit("MPE").alias("site_id"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fetch_order"),
                    doc.alias("json"))


def marketplace_trends_json(spark: SparkSession, sf: str) -> DataFrame:
    """One landed trending response per line item: [noun with url, blank, padded brand], and
    for every 50th order more entries up to the 60th."""
    li = scan(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    j = _with_part(li, "l_partkey", part)
    noun = last_word("p_name")
    e = lambda k, u: F.struct(k.alias("keyword"), u.alias("url"))
    arr = F.array(e(noun, F.concat(F.lit("https://trends.example/"), noun)),
                  e(F.lit(""), F.lit(None).cast("string")),
                  e(F.concat(F.lit("\t"), F.col("p_brand"), F.lit("\u00a0")), F.lit("")))
    more = F.transform(F.sequence(F.lit(4), F.lit(60)), lambda n: e(
        F.concat(F.lit("extra "), n.cast("string")), F.lit("")))
    arr = F.when(F.col("l_orderkey") % 50 == 0, F.concat(arr, more)).otherwise(arr)
    return j.select(F.trunc(F.to_date("l_shipdate"), "week").alias("week_start"),
                    F.lit("MPE").alias("site_id"), F.lit("").alias("category_id"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fetch_order"),
                    F.to_json(arr).alias("json"))
