"""Token ids in compressed files of independent blocks.

A file is a Parquet table whose rows are blocks of up to ``BLOCK`` ids, in ascending order of
documents; ``data`` holds a block's bytes::

    magic "CMR2" | ids u32 | CRC-32 of the ids u32 | range-coded 16-bit words, little-endian

Every block starts from the same empty model, so each can be decoded alone, and many blocks
are coded side by side: one numpy step codes the next id of every block. The model predicts an
id from the two ids before it (order 2), from the one before it (order 1), and by how often
ids of its size came (order 0). Whether the order-2 guess is right is coded with a logistic
mix of what the confidences of orders 2 and 1 have meant so far; else whether the order-1
guess is right; else the size class by its adaptive count and the rest of the id evenly. All
arithmetic is on integers, so that encoder and decoder agree on every machine.

Defined cases: a null or empty text is the end id alone; a null id sorts last; rows that
repeat an id are documents of their own, by the hash of their text; an empty table gives an empty file; a damaged
block raises ``ValueError``; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import pieces_of, short_batches, type_of
from .multiset import bytes_of, range_count
from .tokens import END_ID, default_tokenizer, encoder

BLOCK = 4096                # ids of a block
LANES = 2048                # blocks coded side by side; up to twice as many, if they are the last
SLOTS = 2048                # contexts a block remembers for each order
MAGIC = b"CMR2"
HEADER = struct.Struct("<4sII")

_SQUASH = np.array([min(4095, max(1, round(4096 / (1 + math.exp(-x / 256)))))
                    for x in range(-2047, 2048)], dtype=np.int32)
_STRETCH = np.array([max(-2047, min(2047, round(256 * math.log((p + .5) / (4095.5 - p)))))
                     for p in range(4096)], dtype=np.int32)
_LEAST, _WORD = np.uint64(1 << 40), np.uint64(16)
_ENOUGH, _INSIDE = np.uint64(1 << 36), np.uint64((1 << 56) - 1)    # range for two parts; window
_NONE = np.uint64(0)

# Size classes of ids: the leading bit's place and the bit after it.
_CLASS = np.array([0, 1, 2, 2] + [2 * (i.bit_length() - 1) + (i >> (i.bit_length() - 2) & 1) - 1
                                  for i in range(4, 1 << 16)], dtype=np.int64)
CLASSES = int(_CLASS[-1]) + 1
_CLASS_FIRST = np.searchsorted(_CLASS, np.arange(CLASSES)).astype(np.int64)
_CLASS_SPAN = np.array([1 << int(n - 1).bit_length() for n in np.bincount(_CLASS)], dtype=np.uint64)
LEARN, MOST = 24, 1 << 13   # weight of one more id of a class; counts are halved from MOST on,
EVERY = 16                  # and take effect every so many ids
# What a guess's level changes by, wrong or right; a wrong one of level 0 or 1 is replaced.
_STEP = np.array([(i >> 1) - i for i in range(8)] + [min(i + 1, 7) - i for i in range(8)],
                 dtype=np.int32)
_EIGHT = np.int32(8)


def _width(words: int) -> int:
    """So many words or a few more, an odd number of cache lines, so that the rows of a matrix
    do not compete for the same places in the cache."""
    return (words + 63) // 64 * 64 + 32


class RangeCoder:
    """Range coder lanes with a window of 56 bits; whole 16-bit words leave it."""

    def __init__(self, lanes: int, capacity: int = 0, words: np.ndarray | None = None):
        self.range = np.full(lanes, _INSIDE, dtype=np.uint64)
        self.encoding = words is None
        if self.encoding:
            self.low = np.zeros(lanes, dtype=np.uint64)
            self._keep(np.zeros((lanes, _width(capacity)), dtype=np.uint16))
            self.at = self.first.copy()
        else:
            # the encoder's first word holds the window's upper 16 bits
            w = [words[:, k].astype(np.uint64) for k in range(4)]
            self.offset = (w[0] << np.uint64(40) | w[1] << np.uint64(24) | w[2] << np.uint64(8)
                           | w[3] >> np.uint64(8))
            # the window's last byte and the next word's first lie in one byte pair each
            pairs = words << np.uint16(8)
            pairs[:, :-1] |= words[:, 1:] >> np.uint16(8)
            self._keep(pairs)
            self.at = self.first + 3

    def _keep(self, words: np.ndarray) -> None:
        """``at`` counts in the rows of ``words`` one after another."""
        self.words, self.flat = words, words.reshape(-1)
        self.first = np.arange(len(words)) * words.shape[1]

    def reserve(self, steps: int) -> None:
        """Room for the words of so many more ids (four each at most)."""
        used = self.at - self.first
        need = int(used.max()) + 4 * steps + 8
        if self.encoding and need > self.words.shape[1]:
            more = np.zeros((len(self.words), _width(need + 512)), dtype=np.uint16)
            more[:, :self.words.shape[1]] = self.words
            self._keep(more)
            self.at = self.first + used

    def _carry(self, lanes: np.ndarray) -> None:
        self.low[lanes] &= _INSIDE
        place = self.at[lanes] - 1
        while len(place):
            self.flat[place] += np.uint16(1)
            place = place[self.flat[place] == 0] - 1

    def renew(self) -> None:
        """Move words out of the window until every lane has range to spare."""
        short = self.range < _LEAST
        shift = short * _WORD
        if self.encoding:
            over = self.low > _INSIDE
            if over.any():
                self._carry(over.nonzero()[0])
            # lanes that keep their word write it again later
            self.flat[self.at] = self.low >> np.uint64(40)
            self.low <<= shift
            self.low &= _INSIDE
        else:
            self.offset <<= shift
            self.offset |= self.flat[self.at] * short
        self.range <<= shift
        self.at += short
        self.renew_some((self.range < _LEAST).nonzero()[0], _LEAST)

    def renew_some(self, short: np.ndarray, least: np.uint64) -> None:
        """The same for lanes that are short of range."""
        while len(short):
            size = self.range[short]
            size <<= _WORD
            self.range[short] = size
            at = self.at[short]
            if self.encoding:
                low = self.low[short]
                over = low > _INSIDE
                if over.any():
                    self._carry(short[over])
                self.flat[at] = low >> np.uint64(40)
                low <<= _WORD
                low &= _INSIDE
                self.low[short] = low
            else:
                offset = self.offset[short]
                offset <<= _WORD
                offset |= self.flat[at]
                self.offset[short] = offset
            at += 1
            self.at[short] = at
            short = short[size < least]

    def bit(self, lanes: int, chance: np.ndarray, hit: np.ndarray | None) -> np.ndarray:
        """Code for the first lanes whether something happens, of chance / 65536. The caller
        renews."""
        size = self.range[:lanes]
        bound = size >> _WORD
        bound *= chance.astype(np.uint64)
        if self.encoding:
            self.low[:lanes] += np.where(hit, _NONE, bound)
        else:
            offset = self.offset[:lanes]
            hit = offset < bound
            offset -= np.where(hit, _NONE, bound)
        self.range[:lanes] = np.where(hit, bound, size - bound)
        return hit

    def bit_of(self, lanes: np.ndarray, chance: np.ndarray, hit: np.ndarray | None) -> np.ndarray:
        """``bit`` of some lanes."""
        size = self.range[lanes]
        bound = size >> _WORD
        bound *= chance.astype(np.uint64)
        if self.encoding:
            self.low[lanes] = self.low[lanes] + np.where(hit, _NONE, bound)
        else:
            offset = self.offset[lanes]
            hit = offset < bound
            self.offset[lanes] = offset - np.where(hit, _NONE, bound)
        size -= bound
        self.range[lanes] = np.where(hit, bound, size)
        return hit

    def part(self, lanes: np.ndarray, below: np.ndarray, share: np.ndarray, total: np.ndarray) -> None:
        """Code that the value lies in [below, below + share) of total. The caller renews."""
        unit = self.range[lanes] // total
        if self.encoding:
            self.low[lanes] = self.low[lanes] + unit * below
        else:
            self.offset[lanes] = self.offset[lanes] - unit * below
        self.range[lanes] = unit * share

    def value(self, lanes: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Decoding: the value of [0, total) that comes next."""
        return np.minimum(self.offset[lanes] // (self.range[lanes] // total),
                          total - np.uint64(1))

    def finish(self) -> list[np.ndarray]:
        """The words of every lane, the whole window included."""
        for _ in range(4):
            self._carry((self.low > _INSIDE).nonzero()[0])
            self.flat[self.at] = self.low >> np.uint64(40)
            self.low = self.low << _WORD & _INSIDE
            self.at += 1
        return [w[:n] for w, n in zip(self.words, (self.at - self.first).tolist())]


class Guesses:
    """For each lane, a table of contexts of order 1 and one of order 2: the id that followed
    last and how reliably. Arrays have a row for each order."""

    def __init__(self, lanes: int):
        self.table = np.full(2 * lanes * SLOTS, -8, dtype=np.int32)      # id * 8 + level
        self.first = np.arange(2 * lanes).reshape(2, lanes) * SLOTS
        self.shift = np.uint32(32 - (SLOTS.bit_length() - 1))

    def look(self, prev: np.ndarray, prev2: np.ndarray):
        lanes = len(prev)
        mixed = np.empty((2, lanes), dtype=np.uint32)
        np.multiply(prev.view(np.uint32), np.uint32(0x9E3779B1), out=mixed[0])
        np.multiply(prev2.view(np.uint32), np.uint32(0x85EBCA77), out=mixed[1])
        mixed[1] += mixed[0]
        mixed >>= self.shift
        self.slots = self.first[:, :lanes] + mixed
        self.found = self.table[self.slots]
        self.id, self.level = self.found >> 3, self.found & 7
        return self.id, self.level

    def learn(self, ids: np.ndarray) -> None:
        state = (self.id == ids) * _EIGHT
        state += self.level
        self.found += _STEP[state]
        np.copyto(self.found, ids * 8 + 1, where=state <= 1)       # an unsure guess that was wrong
        self.table[self.slots] = self.found


def _code(coder: RangeCoder, sizes: np.ndarray, ids: np.ndarray) -> None:
    """Code the columns of ``ids`` (steps x lanes); lanes come in descending order of sizes.
    A decoder fills ``ids``."""
    lanes, encoding = len(sizes), coder.encoding
    guesses = Guesses(lanes)
    # chances that a guess is right: of order 1 by its certainty and whether order 2 agreed, of
    # order 2 by its certainty and whether order 1 agrees, of order 2 by both certainties
    chances = np.full(lanes * 96, 1 << 14, dtype=np.int32)
    first = np.array([[80], [0], [16]]) + np.arange(lanes) * 96     # 16, 16 and 64 contexts
    weights = np.full((2, lanes), 1 << 15, dtype=np.int32)
    counts = np.ones((lanes, CLASSES), dtype=np.float32)       # whole numbers, exact in float32
    flat_counts = counts.ravel()
    up_to = np.triu(np.ones((CLASSES, CLASSES), dtype=np.float32))
    prev = np.zeros(lanes, dtype=np.int32)
    prev2 = np.zeros(lanes, dtype=np.int32)
    active = np.searchsorted(-sizes, -np.arange(len(ids)), side="left").tolist()

    for step, m in enumerate(active):
        if step % 256 == 0:
            coder.reserve(256)
        if step % EVERY == 0:
            full = counts.sum(axis=1) > MOST
            counts[full] = np.ceil(counts[full] / 2)
            shares, cum = flat_counts.copy(), counts @ up_to
            flat_cum, totals = cum.ravel(), cum[:, -1].astype(np.uint64)
        if len(prev) > m:
            prev, prev2 = prev[:m], prev2[:m]
        truth = ids[step, :m].astype(np.int32) if encoding else None
        (id1, id2), sure = guesses.look(prev, prev2)
        context = np.empty((3, m), dtype=np.int32)
        np.add(sure, (id1 == id2) * _EIGHT, out=context[:2])
        np.multiply(sure[1], _EIGHT, out=context[2])
        context[2] += sure[0]
        at = first[:, :m] + context
        old = chances[at]
        both = old[1:]
        push = _STRETCH[both >> 4]
        mixed = weights[:, :m] * push
        mixed = mixed[0] + mixed[1]
        mixed >>= 16
        mixed += 2047
        chance = _SQUASH.take(mixed, mode="clip")
        hit = coder.bit(m, chance << 4, truth == id2 if encoding else None)
        yes = hit.astype(np.int32)
        error = yes << 12
        error -= chance
        error *= 7
        push *= error
        push += 0x8000
        push >>= 16
        weights[:, :m] += push
        yes *= 65535
        change = yes - both
        change >>= 4
        both += change
        # the order-1 guess, where order 2 was wrong
        left = (~hit).nonzero()[0]
        guess, was = id1[left], old[0][left]
        value = truth[left] if encoding else None
        right = coder.bit_of(left, np.minimum(np.maximum(was, 16), 65520),
                             value == guess if encoding else None)
        was += (right * np.int32(65535) - was) >> 4
        old[0, left] = was
        chances[at] = old
        if not encoding:
            truth = id2.copy()
            truth[left] = guess
        wrong = ~right
        miss = left[wrong]
        if len(miss):
            coder.renew_some(miss[coder.range[miss] < _ENOUGH], _ENOUGH)
            total = totals[miss]
            if encoding:
                value = value[wrong]
                cls = _CLASS[value]
            else:
                ahead = coder.value(miss, total).astype(np.float32)
                cls = (cum.take(miss, axis=0) > ahead[:, None]).argmax(axis=1)
            place = miss * CLASSES + cls
            share = shares[place]
            below = flat_cum[place] - share
            coder.part(miss, below.astype(np.uint64), share.astype(np.uint64), total)
            span = _CLASS_SPAN[cls]
            if encoding:
                rest = (value - _CLASS_FIRST[cls]).astype(np.uint64)
            else:
                rest = coder.value(miss, span)
                truth[miss] = _CLASS_FIRST[cls] + rest.view(np.int64)
            coder.part(miss, rest, np.uint64(1), span)
            flat_counts[place] += LEARN
        coder.renew()
        if not encoding:
            ids[step, :m] = truth
        guesses.learn(truth)
        prev2, prev = prev, truth


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """The bytes of each block of ids (below 65,536)."""
    if not blocks:
        return []
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    ids = np.zeros((int(sizes[0]), len(blocks)), dtype=np.uint16)
    for lane, i in enumerate(order):
        ids[:sizes[lane], lane] = blocks[i]
    coder = RangeCoder(len(blocks), capacity=len(ids) + 512)
    _code(coder, sizes, ids)
    out: list = [b""] * len(blocks)
    for i, words in zip(order, coder.finish()):
        raw = blocks[i].astype("<u4").tobytes()
        out[i] = HEADER.pack(MAGIC, len(blocks[i]), zlib.crc32(raw)) + words.astype("<u2").tobytes()
    return out


def decode_blocks(data: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises ValueError for a damaged one."""
    if not data:
        return []
    heads = [HEADER.unpack_from(d) for d in data]
    order = sorted(range(len(data)), key=lambda i: -heads[i][1])
    sizes = np.array([heads[i][1] for i in order])
    if any(h[0] != MAGIC for h in heads):
        raise ValueError("not a block of token ids")
    parts = [np.frombuffer(data[i], dtype="<u2", offset=HEADER.size) for i in order]
    words = np.zeros((len(data), _width(max(map(len, parts)) + 8)), dtype=np.uint16)
    for lane, p in enumerate(parts):
        words[lane, :len(p)] = p
    ids = np.zeros((int(sizes[0]), len(data)), dtype=np.uint16)
    try:
        _code(RangeCoder(len(data), words=words), sizes, ids)
    except IndexError as e:
        raise ValueError("a block of token ids is damaged") from e
    out: list = [None] * len(data)
    for lane, i in enumerate(order):
        out[i] = ids[:sizes[lane], lane].astype("<u4")
        if zlib.crc32(out[i].tobytes()) != heads[i][2]:
            raise ValueError("a block of token ids is damaged")
    return out


# ---------------------------------------------------------------- files ----
FILE = ("part long, block long, first_doc long, doc_ids array<{0}>, doc_sizes array<long>, "
        "n_tokens long, data binary")


def write_token_file(docs: DataFrame, path: str, tokenizer: str | None = None,
                     end_id: int = END_ID, block: int = BLOCK) -> None:
    """Encode every text, add ``end_id``, and write all ids in ascending order of doc_id below
    ``path``. Documents are dealt into ranges (``part``) of (id, hash of the text, a random
    number), those without id into the last ones, so that no id and no text is too frequent;
    inside one, ``block`` counts from 0, and a row lists the documents in the block
    (``first_doc`` is the first one's place in the range) with how many of its ids are theirs."""
    tokenizer = tokenizer or default_tokenizer()
    short_batches(docs.sparkSession)
    kind = type_of(docs, "doc_id")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.rand(9).alias("r"))
    size = docs.agg(F.sum(bytes_of(F.col("text")))).first()[0] or 0
    keys = [F.asc_nulls_last("doc_id"), F.asc("h"), F.asc("r")]
    rows = rows.repartitionByRange(range_count(docs.sparkSession, size), *keys)
    rows = rows.sortWithinPartitions(*keys).select(
        F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")

    def write(batches):
        enc = encoder(tokenizer, end_id)
        now = None                    # the part being written
        number = place = 0            # of the next block, of the next document
        waiting: list = []            # (part, block, first_doc, ids, sizes, array) to be coded
        ids_of, sizes_of, pieces, filled, first = [], [], [], 0, 0
        id_type = None

        def close():
            nonlocal ids_of, sizes_of, pieces, filled, number
            if filled:
                waiting.append((now, number, first, ids_of, sizes_of,
                                np.concatenate(pieces).astype(np.uint16)))
                number += 1
            ids_of, sizes_of, pieces, filled = [], [], [], 0

        def coded(most=None):
            some = waiting[:most]
            data = encode_blocks([w[5] for w in some])
            columns = [*zip(*[w[:5] for w in some])]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64())]
            out = pa.record_batch(
                [*(pa.array(c, t) for c, t in zip(columns, kinds)),
                 pa.array([len(w[5]) for w in some], pa.int64()), pa.array(data, pa.binary())],
                names=["part", "block", "first_doc", "doc_ids", "doc_sizes", "n_tokens", "data"])
            del waiting[:most]
            return out

        for batch in batches:
            id_type = batch.column(1).type
            part_of, doc_ids, texts = (c.to_pylist() for c in batch.columns)
            at = 0
            for ids, offsets in enc.encode(texts):
                for a, b in pieces_of(offsets):
                    if part_of[at] != now:
                        close()
                        now, number, place = part_of[at], 0, 0
                    while a < b:
                        if not ids_of:
                            first = place
                        n = min(b - a, block - filled)
                        ids_of.append(doc_ids[at])
                        sizes_of.append(n)
                        pieces.append(ids[a:a + n].copy())
                        filled += n
                        a += n
                        if filled == block:
                            close()
                            if len(waiting) >= 2 * LANES:
                                yield coded(LANES)
                    place += 1
                    at += 1
        close()
        if waiting:
            yield coded()

    rows.mapInArrow(write, FILE.format(kind)).write.option("compression", "none").parquet(path)


def _matrix_times(matrix: list[int], vector: int) -> int:
    out = i = 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


@functools.cache
def _zero_bits(power: int) -> tuple[int, ...]:
    """The matrix over GF(2) that appends 2**power zero bits to what a CRC-32 has seen."""
    if not power:
        return (0xEDB88320, *(1 << i for i in range(31)))
    half = _zero_bits(power - 1)
    return tuple(_matrix_times(half, row) for row in half)


def crc_joined(first: int, second: int, second_bytes: int) -> int:
    """CRC-32 of two byte strings in a row, from those of each."""
    bits, power = 8 * second_bytes, 0
    while bits:
        if bits & 1:
            first = _matrix_times(_zero_bits(power), first)
        bits >>= 1
        power += 1
    return first ^ second if second_bytes else first


def _gathered(batches):
    """The rows of the batches, ``LANES`` at a time and at last fewer than twice as many: a step
    of the coder costs nearly the same for few blocks as for many."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        while n >= 2 * LANES:
            rows = pa.Table.from_batches(waiting)
            yield rows.slice(0, LANES)
            waiting = rows.slice(LANES).to_batches()
            n -= LANES
    if n:
        yield pa.Table.from_batches(waiting)


def read_token_file(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Per document and block, from the files below ``path``: part, doc (place in the range),
    block, doc_id, offset (ids of the range before), token_ids (little-endian unsigned 32-bit)."""
    short_batches(spark)
    rows = spark.read.schema(FILE.format(id_type)).parquet(path)
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("block")) - F.col("n_tokens")
    rows = rows.select("part", "block", "first_doc", "doc_ids", "doc_sizes",
                       before.alias("offset"), "data")

    def read(batches):
        encoder.cache_clear()               # a worker that wrote needs its words no more
        for some in _gathered(batches):
            part, block, first, ids, sizes, offset, data = (c.to_pylist() for c in some.columns)
            kinds = [pa.int64(), pa.int64(), pa.int64(),
                     some.schema.field("doc_ids").type.value_type, pa.int64(), pa.binary()]
            out = []
            for k, found in enumerate(decode_blocks(data), 1):
                a, raw = 0, found.tobytes()
                for j, (doc_id, n) in enumerate(zip(ids[k - 1], sizes[k - 1])):
                    out.append((part[k - 1], first[k - 1] + j, block[k - 1], doc_id,
                                offset[k - 1] + a, raw[4 * a:4 * (a + n)]))
                    a += n
                if k % 1024 == 0 or k == len(data):
                    yield pa.record_batch(
                        [pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                        names=["part", "doc", "block", "doc_id", "offset", "token_ids"])
                    out = []

    return rows.mapInArrow(read, f"part long, doc long, block long, doc_id {id_type}, "
                                 "offset long, token_ids binary")


def read_documents(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its
    ids as little-endian unsigned 32-bit). Pieces in different blocks join their checksums."""
    pieces = read_token_file(spark, path, id_type).select(
        "part", "doc", "block", "doc_id", "offset",
        F.octet_length("token_ids").cast("long").alias("bytes"), F.crc32("token_ids").alias("crc"))
    ranges = spark.read.schema(FILE.format(id_type)).parquet(path).groupBy("part").agg(
        F.sum("n_tokens").alias("n"))
    starts = ranges.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("part_start"))          # one row per range
    whole = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("offset").alias("offset"),
        F.sum("bytes").alias("bytes"),
        F.array_sort(F.collect_list(F.struct("block", "bytes", "crc"))).alias("pieces"))

    @F.udf("long", useArrow=True)
    def joined(parts):
        crc, *rest = parts
        total = crc["crc"]
        for p in rest:
            total = crc_joined(total, p["crc"], p["bytes"])
        return total

    one = whole.where(F.size("pieces") == 1).withColumn("ids_crc32", F.col("pieces")[0]["crc"])
    more = whole.where(F.size("pieces") > 1).withColumn("ids_crc32", joined("pieces"))
    return one.unionByName(more).join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("offset")).alias("start"),
        F.expr("bytes div 4").alias("n_tokens"), "ids_crc32")
