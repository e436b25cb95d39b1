"""SimHash near-duplicates over a Gray-order hierarchical index.

``fingerprints`` folds the XXH64 of word shingles into 64 bits. All distinct fingerprints are
sorted by Gray rank over the whole table, once for each of ``max_bits`` + 1 turns of their
bits; neighbours in that order share long bit patterns. Leaves are runs of 1,024 of them,
wherever the order's values crowd, so a hot pattern is many leaves; upper nodes are 16 of the
level below, and each keeps the bits that all below it share. Nodes meet nodes by joins, level
by level, and a pair is dropped with everything below it once its shared bits differ in more
than ``max_bits``. Two fingerprints within three bits agree in one of four 16-bit blocks, and
the turn that brings this block to the front finds them, so there the front block may not
differ at all. Pairs of leaves that are left are searched in tasks of their own, by the same
rule over smaller nodes, and give a spanning forest of their links, never their pairs.

Components come from alternating large-star and small-star steps, each a
written table. Copies collapse to one fingerprint before any of this.

Defined cases: a null or empty text, or one of blanks, has fingerprint zero and is linked
like any other; fewer words than a shingle are one shingle; repeated rows share a component;
a null ``doc_id`` names no component unless all ids of it are null; an empty table gives no
rows; other columns are not read (``near_duplicates``) or kept (``one_of_each``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, short_batches, utf8, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
LEAF_ROWS = 1024       # fingerprints of a leaf, which is sent and searched as one
FAN_BITS = 4           # 16 children make an upper node
RUN, FAN = 16, 8       # the levels inside a leaf
QUERIES = 256          # fingerprints searched at a time

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fold(hashes: np.ndarray) -> int:
    """The bits set in over half of the unsigned 64-bit hashes, as a signed long."""
    n = len(hashes)
    planes = hashes.astype(">u8").view(np.uint8).reshape(n, 8)
    if n < 300:
        ones = np.unpackbits(planes, axis=1).sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(planes[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > n).view(">u8")[0].astype(np.uint64).view(np.int64))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the shingles of blank-separated words, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(line[a:b], SEED) for a, b in
                          zip(begins[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())],
                         dtype=np.uint64, count=len(words) - k + 1)
    return fold(hashes)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All rows and columns, with a long column of fingerprints added last."""
    short_batches(docs.sparkSession)
    (name,) = fresh(docs, "fp")
    place = docs.columns.index("text")

    def add(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in utf8(batch.column(place))]
            yield pa.record_batch([*batch.columns, pa.array(fps, pa.int64())],
                                  names=[*batch.schema.names, name])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(add, ", ".join([*fields, f"`{name}` long"]))


# ---------------------------------------------------------------- links ----
def gray_rank(fp: Column) -> Column:
    """Place of a bit pattern in the Gray sequence: the XOR of all its right shifts."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp


def _turns(max_bits: int) -> list[tuple[int, int]]:
    """(bits turned left, bits of the front block) of every order: two fingerprints within
    ``max_bits`` agree in one of the blocks, which that order brings to the front."""
    edges = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


def _front(size: int) -> int:
    """The first ``size`` bits set, as a signed long."""
    return -1 << (64 - size)


def turned(fp: Column, by: int) -> Column:
    if not by:
        return fp
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


class GrayIndex:
    """Nodes over the fingerprints of a leaf in Gray order; level 0 has runs of them."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps
        starts = np.arange(0, len(fps), RUN)
        first = fps[starts]
        spread = np.bitwise_or.reduceat(fps ^ np.repeat(first, np.diff([*starts, len(fps)])), starts)
        self.levels = [(~spread, first)]
        while len(self.levels[-1][0]) > FAN:
            mask, value = self.levels[-1]
            starts = np.arange(0, len(mask), FAN)
            first = value[starts]
            other = value ^ np.repeat(first, np.diff([*starts, len(mask)]))
            self.levels.append((np.bitwise_and.reduceat(mask & ~other, starts), first))

    def search(self, queries: np.ndarray, max_bits: int, front: int = 0):
        """Places (in queries, in the leaf) of all pairs within ``max_bits`` that agree in the
        bits of ``front``."""
        front = np.uint64(front & (2**64 - 1))
        mask, value = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(mask))
        node = np.tile(np.arange(len(mask)), len(queries))
        known = np.zeros(len(q), dtype=np.uint64)          # bits counted above
        so_far = np.zeros(len(q), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            mask, value = self.levels[level]
            apart = (queries[q] ^ value[node]) & mask[node] & ~known
            so_far = so_far + np.bitwise_count(apart)
            keep = (so_far <= max_bits) & (apart & front == 0)
            q, node, so_far = q[keep], node[keep], so_far[keep]
            known = mask[node]
            fan = FAN if level else RUN
            size = len(self.levels[level - 1][0]) if level else len(self.fps)
            child = (node[:, None] * fan + np.arange(fan)).ravel()
            q, so_far, known = (np.repeat(x, fan) for x in (q, so_far, known))
            real = child < size
            q, node, so_far, known = q[real], child[real], so_far[real], known[real]
        apart = (queries[q] ^ self.fps[node]) & ~known
        near = (so_far + np.bitwise_count(apart) <= max_bits) & (apart & front == 0)
        return q[near], node[near]


def forest(left: np.ndarray, right: np.ndarray | None, max_bits: int, front: int = 0):
    """Links between two leaves, or inside one (``right`` is None), as (fingerprint, first of
    its component) pairs: fewer than there are fingerprints."""
    fps = left if right is None else np.concatenate([left, right])
    index, shift = GrayIndex(left if right is None else right), 0 if right is None else len(left)
    label = np.arange(len(fps))
    for at in range(0, len(left), QUERIES):
        a, b = index.search(left[at:at + QUERIES], max_bits, front)
        a, b = a + at, b + shift
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := label[label], label):
                label = up
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def leaves(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """turn, part, number, ones, some, fps: runs of LEAF_ROWS turned fingerprints in the Gray
    order of every turn, with the bits set in all (``ones``) and in any (``some``) of them."""
    def cut(batches):
        part, number = TaskContext.get().partitionId(), 0

        def rows(turn, fps):
            nonlocal number
            at = range(0, len(fps), LEAF_ROWS)
            numbers = list(range(number, number + len(at)))
            number += len(at)
            return pa.record_batch([
                pa.array([turn] * len(at), pa.int32()), pa.array([part] * len(at), pa.int64()),
                pa.array(numbers, pa.int64()),
                pa.array(np.bitwise_and.reduceat(fps, list(at)).view(np.int64)),
                pa.array(np.bitwise_or.reduceat(fps, list(at)).view(np.int64)),
                pa.array([fps[i:i + LEAF_ROWS].tobytes() for i in at], pa.binary())],
                names=["turn", "part", "number", "ones", "some", "fps"])

        turn, held = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            turns = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy().view(np.uint64)
            cuts = [0, *(np.flatnonzero(turns[1:] != turns[:-1]) + 1).tolist(), len(turns)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if len(held) and turns[a] != turn:
                    yield rows(turn, held)
                    held = held[:0]
                turn, held = int(turns[a]), np.concatenate([held, fps[a:b]])
                whole = len(held) - len(held) % LEAF_ROWS
                if whole:
                    yield rows(turn, held[:whole])
                    held = held[whole:]
        if len(held):
            yield rows(turn, held)

    every = F.array(*[F.struct(F.lit(i).alias("turn"), turned(F.col("fp"), by).alias("bits"))
                      for i, (by, _) in enumerate(_turns(max_bits))])
    rows = distinct.select(F.explode(every).alias("t")).select("t.turn", "t.bits")
    rank = gray_rank(F.col("bits"))
    return (rows.withColumn("rank", rank).repartitionByRange("turn", "rank")
            .sortWithinPartitions("turn", "rank").select("turn", "bits")
            .mapInArrow(cut, "turn int, part long, number long, ones long, some long, fps binary"))


def numbered(leaf: DataFrame) -> tuple[DataFrame, int]:
    """The written leaves with an ``id`` in Gray order, and its bits below the turn."""
    top = leaf.agg(F.max("part"), F.max("number")).first()
    part, number = ((x or 0).bit_length() for x in top)
    place = (F.shiftleft(F.col("turn").cast("long"), part + number)
             .bitwiseOR(F.shiftleft("part", number)).bitwiseOR(F.col("number")))
    return leaf.withColumn("id", place), part + number


def leaf_pairs(leaf: DataFrame, depth: int, max_bits: int = MAX_BITS) -> DataFrame:
    """left, right (left <= right): the pairs of leaves that may hold a link. Pairs of nodes
    go down the levels from the root of each order. A node's children share all bits that it
    shares, so differences only add up on the way, and a pair of nodes that exceeds ``max_bits``
    or differs in the order's front block is dropped with everything below it."""
    fronts = F.array(*[F.lit(_front(size)) for _, size in _turns(max_bits)])
    shifts = [*range(0, depth, FAN_BITS), depth][::-1]

    def level(shift):
        return leaf.groupBy(F.shiftright("id", shift).alias("id")).agg(
            F.bit_and("ones").alias("ones"), F.bit_or("some").alias("some"))

    pairs = level(depth).select(F.col("id").alias("left"), F.col("id").alias("right"))
    for above, shift in zip(shifts, shifts[1:]):
        nodes = level(shift) if shift else leaf.select("id", "ones", "some")
        parent = F.shiftright("id", above - shift)
        a = nodes.select(parent.alias("left"), F.struct("id", "ones", "some").alias("a"))
        b = nodes.select(parent.alias("right"), F.struct("id", "ones", "some").alias("b"))
        apart = (F.col("a.ones").bitwiseAND(F.bitwise_not("b.some"))
                 .bitwiseOR(F.col("b.ones").bitwiseAND(F.bitwise_not("a.some"))))
        front = F.element_at(fronts, (F.shiftright("a.id", depth - shift) + 1).cast("int"))
        pairs = (pairs.join(a, "left").join(b, "right").where("a.id <= b.id")
                 .where((F.bit_count(apart) <= max_bits) & (apart.bitwiseAND(front) == 0))
                 .select(F.col("a.id").alias("left"), F.col("b.id").alias("right")))
    return pairs


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """src, dst: links that connect all fingerprints (column ``fp``, distinct) within
    ``max_bits``; the links of a pair of leaves are thinned to a forest."""
    turns = _turns(max_bits)

    def search(batches):
        for batch in batches:
            left, right = [], []
            for turn, same, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                by, size = turns[turn]
                a, b = (np.frombuffer(x, dtype=np.uint64) for x in (a, b))
                found = forest(a, None if same else b, max_bits, _front(size))
                back = [x if not by else x >> np.uint64(by) | x << np.uint64(64 - by) for x in found]
                left.append(back[0])
                right.append(back[1])
            if left:
                yield pa.record_batch([pa.array(np.concatenate(x).view(np.int64))
                                       for x in (left, right)], names=["src", "dst"])

    spark = distinct.sparkSession
    leaf, depth = numbered(written(leaves(distinct, max_bits), "leaves"))
    pairs = leaf_pairs(leaf, depth, max_bits)
    met = (pairs.join(leaf.select(F.col("id").alias("left"), "turn", F.col("fps").alias("a")), "left")
           .join(leaf.select(F.col("id").alias("right"), F.col("fps").alias("b")), "right"))
    # pairs cost time, not bytes: as many tasks as the session has, whatever their size
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (met.repartition(tasks, "left", "right")
            .select("turn", (F.col("left") == F.col("right")).alias("same"), "a", "b")
            .mapInArrow(search, "src long, dst long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node of its component) for every node of an edge."""
    def pairs(df, a, b):
        return df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v")

    def state(df):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                            F.sum(F.col("v").cast("decimal(20,0)"))).first())

    e = written(pairs(edges, "src", "dst").distinct(), "links")
    now = state(e)
    while now[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        m = F.least("u", "m")
        large = pairs(both.join(least, "u").where("v > u").select("v", m.alias("m")),
                      "v", "m").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u")
        e = written(pairs(small, "v", "m").unionByName(pairs(small, "u", "m")).distinct(), "links")
        before, now = now, state(e)
        if now == before:
            break
    star = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    roots = e.select(F.col("v").alias("node")).distinct()
    return star.unionByName(roots.select("node", F.col("node").alias("label")))


def _classes(prints: DataFrame, doc_id: str, fp: str, max_bits: int) -> DataFrame:
    """fp, component_id for every distinct fingerprint of a written table."""
    first = written(prints.groupBy(F.col(f"`{fp}`").alias("fp"))
                    .agg(F.min(f"`{doc_id}`").alias("first")), "distinct")
    label = components(links(first.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = first.join(label, "fp").select("fp", "label", "first")
    ids = linked.groupBy("label").agg(F.min("first").alias("component_id"))
    linked = linked.join(ids, "label").select("fp", "component_id")
    alone = first.join(label, "fp", "left_anti").select("fp", F.col("first").alias("component_id"))
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long), component_id: the smallest doc_id reachable over links of
    ``max_bits`` or fewer differing bits, one row per document."""
    prints = written(fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"),
                     "fingerprints")
    return prints.join(_classes(prints, "doc_id", "fp", max_bits), "fp").select(
        "doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, columns as they are: the smallest by doc_id (rows without id
    last), fingerprint and hash of the text. Which rows go together is up to their fingerprints
    alone, so rows that repeat an id with other texts are documents of their own."""
    prints = fingerprints(docs, shingle)
    fp, (row,) = prints.columns[-1], fresh(prints, "row")
    prints = written(prints.withColumn(row, F.monotonically_increasing_id()), "fingerprints")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"),
                          F.col(f"`{fp}`").alias("fp"), F.xxhash64("text").alias("text"),
                          F.col(f"`{row}`").alias("row"))).alias("best")
    first = written(prints.groupBy(F.col(f"`{fp}`").alias("fp")).agg(best), "distinct")
    label = components(links(first.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    # a label is a fingerprint of its component; one without links is a component of its own
    kept = (first.join(label, "fp", "left").groupBy(F.coalesce("label", "fp").alias("label"))
            .agg(F.min("best").alias("best")).select(F.col("best.row").alias(row)))
    return prints.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
