"""Exact distinct users and sessions as bitmaps that can be merged.

Ids get dense numbers (1, 2, ... per kind), kept in a dictionary that only grows; the ids seen on
a day are then the bits of a few bitmaps of 32,768 numbers each. Merging two sets is a bitwise
OR, so a day's state can be stored, added to in any order and as often as a batch is replayed,
and counted without the events. A bitmap takes 4 kB for up to 32,768 ids, where a set of rows
takes at least eight bytes an id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ranks import sliced_dense_rank

KEY = ["day", "event_name"]
KINDS = {"user": "user_id", "session": "session_id"}
IDS = "kind STRING, id BIGINT, dense BIGINT"
BITMAPS = "day DATE, event_name STRING, kind STRING, bucket BIGINT, bits BINARY"


def seen_ids(events: DataFrame) -> DataFrame:
    """day, event_name, kind, id: the distinct users and sessions of each day and event."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("id")) for k, c in KINDS.items()])
    return (events.select(*KEY, *KINDS.values()).distinct().select(*KEY, F.explode(each).alias("e"))
            .select(*KEY, "e.kind", "e.id").where("id IS NOT NULL").distinct())


def new_ids(seen: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """kind, id, dense for the ids that ``known`` does not have, numbered by id after its highest
    numbers: the same input gives the same numbers again."""
    ids = seen.select("kind", "id").distinct()
    if known is None:
        top = None
    else:
        ids = ids.join(known.select("kind", "id").hint("shuffle_hash"), ["kind", "id"], "left_anti")
        top = known.groupBy("kind").agg(F.max("dense").alias("top"))
    ranked = sliced_dense_rank(ids, ["kind"], [F.col("id").asc()], "nth")
    if top is None:
        return ranked.select("kind", "id", F.col("nth").cast("long").alias("dense"))
    return ranked.join(top, "kind", "left").select(
        "kind", "id", (F.coalesce("top", F.lit(0)) + F.col("nth")).cast("long").alias("dense"))


def bitmaps_of(seen: DataFrame, ids: DataFrame) -> DataFrame:
    """``BITMAPS`` of (day, event_name, kind, id) rows by the dictionary ``ids``. The dictionary grows
    with the ids: it is shuffled, never broadcast through the driver."""
    numbered = seen.join(ids.hint("shuffle_hash"), ["kind", "id"])
    return (numbered.groupBy(*KEY, "kind", F.bitmap_bucket_number("dense").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("dense")).alias("bits")))


def merged(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of one day, event, kind and bucket as one."""
    return bitmaps.groupBy(*KEY, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def daily_facts(counts: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """day, event_name, event_count, total_users, sessions from event counts (day, event_name, n;
    several rows of a key add up) and merged bitmaps."""
    held = bitmaps.groupBy(*[F.col(k).alias(f"_{k}") for k in KEY]).agg(*[
        F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))).alias(f"_{kind}") for kind in KINDS])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY]
    total = counts.groupBy(*KEY).agg(F.sum("n").alias("event_count"))
    zero = F.lit(0).cast("long")
    return total.join(held, same, "left").select(
        *KEY, "event_count", F.coalesce("_user", zero).alias("total_users"), F.coalesce("_session", zero).alias("sessions"))


def event_daily_bitmap(events: DataFrame) -> DataFrame:
    """``web.event_daily`` by bitmaps (numbers the ids, which runs a job)."""
    seen = seen_ids(events)
    counts = events.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    return daily_facts(counts, bitmaps_of(seen, new_ids(seen)))
