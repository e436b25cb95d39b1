"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

Equal vectors are one node. Every node begins with a few nodes picked by a hash; in each round
a node's list and a sample of the nodes that list it meet (neighbours of neighbours), and pairs
with a new member that are nearer than the worst of a list enter it. Vectors reach a node by a
join on the neighbour's number, so a task holds a few thousand lists at a time and nothing
grows with the table but the number of tasks. Rounds end once few entries are new.

A search keeps the ``beam`` nearest nodes seen, and in each round asks for the neighbours of
those that it has not asked for yet, until there are none. All queries move together: a round
is three joins (lists, vectors, beams). Beams use half-precision unit vectors; the nodes found
are then scored on the original vectors in double precision.

Parameters (not tied to the size of the input): ``K`` list length, ``REVERSE`` sampled reverse
neighbours, ``START`` first neighbours, ``BEAM`` width of the search.

Defined cases: rows with a null id, a null or empty vector, null or non-finite components or no
component but zeros take no part. Vectors of unequal length are compared as if zeros followed
the shorter one. Equal rows are rows like any other: a query leaves out one row of its own id and vector.
Fewer candidates than asked for: all that the graph reaches (up to ``K`` + 1 different vectors the graph is
complete). Ties go to the smaller id. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import written

K = 32
REVERSE = 20
START = 10
BEAM = 128
FEW_NEW = 0.02              # share of entries that are new in the last round
MOST_ROUNDS = 12
ENTRIES = 16                # nodes where a search begins that has none of its own
LEAST_ROWS = 20_000         # rows a task works on at a time
GROUPS = 1024               # lists compared at a time
SALTS = 16


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by an integer key."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < LEAST_ROWS:
            continue
        table = pa.Table.from_batches(held)
        keys = table[key].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            rows -= cut
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """Equally long binary values as rows of a matrix."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), -1)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Row numbers at which groups of equal neighbouring keys begin."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of unsigned integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


# Nodes ----------------------------------------------------------------------------------

def valid_vectors(table: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, vector (doubles) of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"),
                        F.col(column).cast("array<double>").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
                      & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0)).select(
        "vec_id", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector"))


def _packed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Adds the half-precision unit vector, filled up with zeros to ``size``."""
    for batch in batches:
        vectors = [np.asarray(v, dtype=np.float64) for v in batch.column("vector").to_pylist()]
        out = []
        for v in vectors:
            v = v / np.abs(v).max()
            unit = np.zeros(size, dtype="<f2")
            unit[:len(v)] = v / np.sqrt(v @ v)
            out.append(unit.tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, type=pa.binary())],
                                         names=[*batch.schema.names, "unit"])


def nodes_of(rows: DataFrame, keep: int) -> DataFrame:
    """One written row per different vector: idx (0, 1, ... in an order given by a hash), vector,
    unit (half precision), members (the ``keep`` smallest ids)."""
    spark = rows.sparkSession
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= keep)
    classes = few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))
    h = F.xxhash64("vector")
    sorted_classes = classes.repartitionByRange(h).sortWithinPartitions(h, "vector")
    placed = written(sorted_classes.select(F.monotonically_increasing_id().alias("place"), "vector", "members"),
                     "nn-classes")
    part = F.shiftright("place", 33).alias("part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size"))
    # One row per partition of the written table.
    counts = sorted(sizes.collect())
    first, offsets = 0, []
    for r in counts:
        offsets.append((r["part"], first))
        first += r["n"]
    size = max((r["size"] for r in counts), default=1)
    offsets = spark.createDataFrame(offsets, "part long, first long")
    nodes = placed.withColumn("part", part).join(offsets, "part").select(
        (F.col("first") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))).alias("idx"), "vector", "members")
    schema = f"idx long, vector array<double>, members array<long>, unit binary"
    return written(nodes.mapInArrow(functools.partial(_packed, size=size), schema), "nn-nodes")


# Neighbour graph ------------------------------------------------------------------------

_LISTS = "idx long, nbr array<long>, near array<float>, fresh array<boolean>, worst float"


def _list_batch(idx, counts, nbr, near, fresh, worst) -> pa.RecordBatch:
    offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in
             (nbr.astype(np.int64), near.astype(np.float32), fresh.astype(bool))]
    return pa.RecordBatch.from_arrays([pa.array(idx.astype(np.int64)), *lists, pa.array(worst.astype(np.float32))],
                                      names=["idx", "nbr", "near", "fresh", "worst"])


def _first_lists(batches: Iterator[pa.RecordBatch], n: int, start: int, k: int) -> Iterator[pa.RecordBatch]:
    """The node itself, so that it meets its neighbours, and nodes picked by a hash (all others
    where they fit a list)."""
    for batch in batches:
        idx = batch.column("idx").to_numpy().astype(np.uint64)
        many = n - 1 if n - 1 <= k else start
        step = np.arange(many + 1, dtype=np.uint64)
        if many < start or n - 1 <= k:
            nbr = (idx[:, None] + step) % np.uint64(n)
        else:
            nbr = _mixed(idx[:, None] * np.uint64(64) + step) % np.uint64(n)
            nbr[:, 0] = idx
        shape = nbr.shape
        yield _list_batch(idx, np.full(shape[0], shape[1]), nbr.ravel(), np.full(nbr.size, -2.0),
                          np.ones(nbr.size), np.full(shape[0], -3.0))


def _local_join(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (v, u, unit, worst, fresh), sorted by v and u: for each list the pairs with a new
    member that are nearer than the worst of the first one's own list; at most ``most`` for each
    first one (no list holds more)."""
    for table in whole_groups(batches, "v"):
        v, u = table["v"].to_numpy(), table["u"].to_numpy()
        unit = _matrix(table["unit"], "<f2").astype(np.float32)
        worst, fresh = table["worst"].to_numpy(), table["fresh"].to_numpy(zero_copy_only=False)
        first = _starts(v)
        sizes = np.diff(np.r_[first, len(v)])
        found: tuple = ([], [], [])
        for at in range(0, len(first), GROUPS):
            lo, count = first[at:at + GROUPS], sizes[at:at + GROUPS]
            wide = int(count.max())
            real = np.arange(wide) < count[:, None]
            rows = np.where(real, lo[:, None] + np.arange(wide), 0)
            ids = np.where(real, u[rows], -1)
            twice = np.zeros_like(real)
            twice[:, 1:] = ids[:, 1:] == ids[:, :-1]
            new = fresh[rows] & real
            new[:, :-1] |= new[:, 1:] & twice[:, 1:]
            real &= ~twice
            vec = unit[rows]
            sim = vec @ vec.transpose(0, 2, 1)
            ok = real[:, :, None] & real[:, None, :] & (new[:, :, None] | new[:, None, :])
            ok &= sim > worst[rows][:, :, None]
            ok[:, np.arange(wide), np.arange(wide)] = False
            sim[~ok] = -np.inf
            if wide > most:
                cut = np.partition(sim, wide - most, axis=2)[:, :, wide - most]
                ok &= sim >= cut[:, :, None]
            g, i, j = np.nonzero(ok)
            found[0].append(ids[g, i])
            found[1].append(ids[g, j])
            found[2].append(sim[g, i, j])
        a, b, s = (np.concatenate(x) for x in found)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s.astype(np.float32)),
                                          pa.array(np.ones(len(a), bool))], names=["idx", "u", "s", "fresh"])


def _merged_lists(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Entries (idx, u, s, fresh) sorted by idx to lists of the ``k`` nearest."""
    for table in whole_groups(batches, "idx"):
        idx, u, s = (table[c].to_numpy() for c in ("idx", "u", "s"))
        fresh = table["fresh"].to_numpy(zero_copy_only=False)
        keep = (idx != u)
        idx, u, s, fresh = idx[keep], u[keep], s[keep], fresh[keep]
        if not len(idx):
            continue
        order = np.lexsort((fresh, u, idx))             # an entry that was there before is not new
        idx, u, s, fresh = idx[order], u[order], s[order], fresh[order]
        head = np.r_[True, (idx[1:] != idx[:-1]) | (u[1:] != u[:-1])]
        near = np.maximum.reduceat(s, np.flatnonzero(head))
        known = np.minimum.reduceat(s, np.flatnonzero(head)) > -2.0
        idx, u, fresh = idx[head], u[head], fresh[head] | ~known
        order = np.lexsort((u, -near, idx))
        idx, u, near, fresh = idx[order], u[order], near[order], fresh[order]
        first = _starts(idx)
        place = np.arange(len(idx)) - np.repeat(first, np.diff(np.r_[first, len(idx)]))
        keep = place < k
        idx, u, near, fresh = idx[keep], u[keep], near[keep], fresh[keep]
        first = _starts(idx)
        counts = np.diff(np.r_[first, len(idx)])
        worst = np.where(counts == k, near[first + counts - 1], -3.0)
        yield _list_batch(idx[first], counts, u, near, fresh, worst)


def _entries(lists: DataFrame) -> DataFrame:
    return lists.select("idx", F.explode(F.arrays_zip("nbr", "near", "fresh")).alias("e")).select(
        "idx", F.col("e.nbr").alias("u"), F.col("e.near").alias("s"), F.col("e.fresh").alias("fresh"))


def _sampled_reverse(entries: DataFrame, size: int, turn: int) -> DataFrame:
    """(v, u, fresh): up to ``size`` of the nodes u that list v, new entries first."""
    by = Window.partitionBy("u").orderBy(F.col("fresh").desc(), F.xxhash64("idx", "u", F.lit(turn)), "idx")
    picked = entries.select("idx", "u", "fresh").withColumn("nth", F.row_number().over(by))
    return picked.where(F.col("nth") <= size).select(F.col("u").alias("v"), F.col("idx").alias("u"), "fresh")


def build_graph(nodes: DataFrame, k: int = K, reverse: int = REVERSE, start: int = START) -> tuple[DataFrame, int]:
    """Written lists (``_LISTS``) of the nodes' nearest nodes, and the number of rounds."""
    n = nodes.count()
    first = functools.partial(_first_lists, n=n, start=start, k=k)
    lists = nodes.select("idx").mapInArrow(first, _LISTS)
    for turn in range(MOST_ROUNDS):
        entries = _entries(lists)
        wants = entries.select(F.col("idx").alias("v"), "u", "fresh").unionByName(
            _sampled_reverse(entries, reverse, turn))
        worst = lists.select(F.col("idx").alias("w_idx"), "worst")
        units = nodes.select("idx", "unit").join(worst, F.col("idx") == F.col("w_idx")).select("idx", "unit", "worst")
        sent = wants.join(units, F.col("u") == F.col("idx")).select("v", "u", "unit", "worst", "fresh")
        most = k if turn else max(1, k // 4)
        pairs = sent.repartition("v").sortWithinPartitions("v", "u").mapInArrow(
            functools.partial(_local_join, most=most), "idx long, u long, s float, fresh boolean")
        old = entries.withColumn("fresh", F.lit(False))
        lists = written(old.unionByName(pairs).repartition("idx").sortWithinPartitions("idx").mapInArrow(
            functools.partial(_merged_lists, k=k), _LISTS), f"nn-lists-{turn}")
        new = lists.agg(F.sum(F.size(F.filter("fresh", lambda x: x))).alias("new"),
                        F.sum(F.size("fresh")).alias("all")).first()
        if not new["all"] or new["new"] <= FEW_NEW * new["all"]:
            break
    return lists, turn + 1


def adjacency(lists: DataFrame, reverse: int = 2 * K) -> DataFrame:
    """Written rows (idx, next): a node's list and a sample of the nodes that list it."""
    entries = _entries(lists).withColumn("fresh", F.lit(False))
    both = entries.select("idx", "u").unionByName(
        _sampled_reverse(entries, reverse, -1).select(F.col("v").alias("idx"), "u"))
    return written(both.groupBy("idx").agg(F.collect_set("u").alias("next")), "nn-adjacency")


# Greedy search --------------------------------------------------------------------------

_BEAMS = "q long, unit binary, ids array<long>, near array<float>, open array<boolean>"


def _moved_beams(batches: Iterator[pa.RecordBatch], beam: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by q and kind: a beam (kind 0), then nodes (x, unit) to be put into it."""
    out_names = ["q", "unit", "ids", "near", "open"]
    for table in whole_groups(batches, "q"):
        q, kind, x = (table[c].to_numpy() for c in ("q", "kind", "x"))
        units = table["unit"]
        first = _starts(q)
        out: list[list] = [[], [], [], [], []]
        for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(q)]):
            own = units[lo].as_py()
            ids = np.asarray(table["ids"][lo].as_py(), dtype=np.int64)
            near = np.asarray(table["near"][lo].as_py(), dtype=np.float32)
            still = np.zeros(len(ids), dtype=bool)      # every open node was asked for
            if hi > lo + 1:
                at = np.frombuffer(own, dtype="<f2").astype(np.float32)
                seen = x[lo + 1:hi]
                score = _matrix(units.slice(lo + 1, hi - lo - 1), "<f2").astype(np.float32) @ at
                fresh = ~np.isin(seen, ids)
                ids = np.r_[ids, seen[fresh]]
                near = np.r_[near, score[fresh]]
                still = np.r_[still, np.ones(int(fresh.sum()), dtype=bool)]
                order = np.lexsort((ids, -near))[:beam]
                ids, near, still = ids[order], near[order], still[order]
            for column, value in zip(out, (int(q[lo]), own, ids.tolist(), near.tolist(), still.tolist())):
                column.append(value)
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.float32()), pa.list_(pa.bool_()))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], names=out_names)


def search(nodes: DataFrame, graph: DataFrame, queries: DataFrame, beam: int = BEAM) -> DataFrame:
    """Rows (q, x): the nodes in the final beam of each query. ``queries``: q, unit and start (an
    array of nodes, or null for the first ``ENTRIES``, which a hash picked)."""
    begin = F.coalesce("start", F.sequence(F.lit(0).cast("long"), F.lit(ENTRIES - 1).cast("long")))
    asked = queries.select("q", F.explode(begin).alias("x"))
    state = queries.select("q", "unit", F.lit(None).cast("array<long>").alias("ids"),
                           F.lit(None).cast("array<float>").alias("near"),
                           F.lit(None).cast("array<boolean>").alias("open"))
    empty = F.array()
    state = state.select("q", "unit", F.coalesce("ids", empty.cast("array<long>")).alias("ids"),
                         F.coalesce("near", empty.cast("array<float>")).alias("near"),
                         F.coalesce("open", empty.cast("array<boolean>")).alias("open"))
    units = nodes.select("idx", "unit")
    done = []
    while True:
        found = asked.distinct().join(units, F.col("x") == F.col("idx"))
        no = lambda kind: F.lit(None).cast(kind)
        rows = state.select("q", F.lit(0).alias("kind"), no("long").alias("x"), "unit", "ids", "near").unionByName(
            found.select("q", F.lit(1).alias("kind"), "x", "unit", no("array<long>").alias("ids"),
                         no("array<float>").alias("near")))
        beams = written(rows.repartition("q").sortWithinPartitions("q", "kind").mapInArrow(
            functools.partial(_moved_beams, beam=beam), _BEAMS), "nn-beams")
        going = F.exists("open", lambda x: x)
        done.append(beams.where(~going).select("q", F.explode("ids").alias("x")))
        state = beams.where(going)
        if state.isEmpty():
            break
        asked = state.select("q", F.explode(F.arrays_zip("ids", "open")).alias("e")).where("e.open").select(
            "q", F.col("e.ids").alias("u")).join(graph, F.col("u") == F.col("idx")).select(
            "q", F.explode("next").alias("x"))
    return functools.reduce(DataFrame.unionByName, done)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles; zeros follow the shorter one."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    times = F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0.0)))
    length = lambda c: F.sqrt(total(F.transform(c, lambda x: x * x)))
    return total(times) / (length(a) * length(b))


def _level(c: Column) -> Column:
    """The vector, divided by a power of two where its squares would leave the range of doubles."""
    most = F.array_max(F.transform(c, lambda x: F.abs(x)))
    by = F.pow(F.lit(2.0), F.floor(F.log2(most)))
    return F.when((most > 1e100) | (most < 1e-100), F.transform(c, lambda x: x / by)).otherwise(c)


def nearest(table: DataFrame, every: int = 50, top: int = 5, k: int = K, beam: int = BEAM) -> DataFrame:
    """The ``top`` nearest rows of each row whose vec_id is divisible by ``every``: query_id, rank,
    vec_id, score."""
    rows = valid_vectors(table)
    nodes = nodes_of(rows, top + 1)
    lists, _ = build_graph(nodes, k)
    graph = adjacency(lists, 2 * k)
    asking = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    # A class that asks: one search for all its equal rows.
    classes = asking.select("vector").distinct().join(
        nodes.select(F.col("vector").alias("n_vector"), "idx", "unit"), F.col("vector") == F.col("n_vector"))
    classes = written(classes.select(F.col("idx").alias("q"), "vector", "unit"), "nn-queries")
    beams = search(nodes, graph, classes.select("q", "unit", F.array("q").alias("start")), beam)
    other = nodes.select("idx", F.col("vector").alias("x_vector"), "members")
    pairs = beams.join(other, F.col("x") == F.col("idx")).join(classes.select("q", "vector"), "q")
    own = F.col("q") == F.col("x")
    scored = pairs.select("q", "vector", own.alias("own"), "members",
                          cosine(_level(F.col("vector")), _level(F.col("x_vector"))).alias("score"))
    member = scored.select("q", "vector", "own", "score", F.explode("members").alias("vec_id"))
    by = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id", F.col("own").desc())
    best = member.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= top + 1)
    best = best.groupBy("vector").agg(F.array_sort(F.collect_list(
        F.struct("nth", "vec_id", "score", "own"))).alias("best"))
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int")
    each = asking.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("q_vector"), salt.alias("q_salt")).join(
        best, (F.col("q_vector") == F.col("vector")) & (F.col("q_salt") == F.col("salt")))
    itself = F.array_position(F.transform("best", lambda s: s["own"] & (s["vec_id"] == F.col("query_id"))), True)
    rest = F.slice(F.filter("best", lambda s, i: i + 1 != itself), 1, top)
    out = each.select("query_id", F.posexplode(rest).alias("pos", "hit"))
    return out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                      F.col("hit.score").alias("score"))
