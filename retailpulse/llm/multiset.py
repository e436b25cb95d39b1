"""Homomorphic fingerprints of documents as multisets of paragraphs.

A text is cut into paragraphs: after every line end, and inside lines where the bytes just
read say so, about every 48 bytes; an edit therefore only disturbs the paragraphs around it.
Each paragraph is hashed to a wide vector. Summed over the paragraphs, eight lanes modulo
2**64 compare for equality; 256 signed lanes (+1 or -1 from each hash bit) modulo 2**32 have
inner products that estimate how much two texts share. Inserting or deleting a paragraph adds
or subtracts its vector, and the order of paragraphs does not matter.

Successors in descending order of ids are found without one global sort: documents are dealt
into ranges of (id, hash of the text), the first document of each range is also sent to the
range before it, and each range streams through a task in order. Ranges grow in number with
the bytes of the table; rows without id, or of one id, spread over ranges by their text.

Defined cases: a null or empty text is the empty multiset (all lanes zero), alike only to
another empty one; repeated rows follow each other as documents; documents without id come
last; rows of one id follow each other by the hash of their text, and only equal rows (id and
text) are sure to share a range; the successor of the last document is the first, of a single one itself; an empty table
gives no rows; other columns are not read. A paragraph has a byte at least and a text fewer
than 2**31 of them, so the signed lanes of a text are exact however often a paragraph repeats.
"""

from __future__ import annotations

import bisect
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import short_batches, type_of, written

LANES = 8                   # modulo 2**64, for equality
SIGNS = 256                 # modulo 2**32, for likeness
MEAN_BYTES = 48             # of a paragraph inside a long line
RANGE_BYTES = 32 << 20      # of text in a range while there are fewer ranges than shuffle
MOST_BYTES = 256 << 20      # partitions; beyond that a range holds up to so many
ROW_BYTES = 256             # what a row counts besides its text

_LINE_END = 10


def paragraphs(text: bytes) -> list[bytes]:
    """Consecutive parts of the text; where it is cut depends on the four bytes before only."""
    if not text:
        return []
    b = np.frombuffer(text, dtype=np.uint8)
    h = b.astype(np.uint32)
    for back, factor in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
        h[back:] += b[:-back].astype(np.uint32) * np.uint32(factor)
    h *= np.uint32(0x27D4EB2F)
    cut = np.flatnonzero((h < np.uint32(2 ** 32 // MEAN_BYTES)) | (b == _LINE_END)) + 1
    ends = cut.tolist()
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return [text[i:j] for i, j in zip([0, *ends], ends)]


class Multiset:
    """The sum of paragraph vectors."""

    def __init__(self, lanes=None, signs=None):
        self.lanes = np.zeros(LANES, dtype=np.uint64) if lanes is None else lanes
        self.signs = np.zeros(SIGNS, dtype=np.int32) if signs is None else signs

    @classmethod
    def of(cls, parts: list[bytes]) -> Multiset:
        if not parts:
            return cls()
        digest = hashlib.blake2b
        raw = b"".join([digest(p).digest() for p in parts])
        words = np.frombuffer(raw, dtype="<u8").reshape(len(parts), LANES)
        bits = np.frombuffer(raw, dtype=np.uint8).reshape(len(parts), 64)[:, :SIGNS // 8]
        ones = np.zeros(SIGNS, dtype=np.int64)
        for at in range(0, len(parts), 4096):
            ones += np.unpackbits(bits[at:at + 4096], axis=1).sum(axis=0, dtype=np.int64)
        return cls(words.sum(axis=0, dtype=np.uint64), (2 * ones - len(parts)).astype(np.int32))

    @classmethod
    def of_text(cls, text: str | None) -> Multiset:
        return cls.of(paragraphs((text or "").encode()))

    def __add__(self, other: Multiset) -> Multiset:
        return Multiset(self.lanes + other.lanes, self.signs + other.signs)

    def __sub__(self, other: Multiset) -> Multiset:
        return Multiset(self.lanes - other.lanes, self.signs - other.signs)

    def __str__(self) -> str:
        return (self.lanes.astype(">u8").tobytes() + self.signs.astype(">i4").tobytes()).hex()

    @classmethod
    def parse(cls, text: str) -> Multiset:
        raw = bytes.fromhex(text)
        return cls(np.frombuffer(raw[:8 * LANES], dtype=">u8").astype(np.uint64),
                   np.frombuffer(raw[8 * LANES:], dtype=">i4").astype(np.int32))

    def likeness(self, other: Multiset) -> float:
        """Cosine of the signed lanes, 0 if negative; 1 for equal multisets."""
        if np.array_equal(self.lanes, other.lanes):
            return 1.0
        a, b = self.signs.astype(float), other.signs.astype(float)
        size = math.sqrt(float(a @ a) * float(b @ b))
        return min(1.0, max(0.0, float(a @ b) / size)) if size else 0.0


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars (code points), fingerprint (hex) for every row."""
    short_batches(docs.sparkSession)

    def add(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([str(Multiset.of_text(t)) for t in texts], pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(
        add, f"doc_id {type_of(docs, 'doc_id')}, n_chars long, fingerprint string")


# ----------------------------------------------------------- successors ----
def range_count(spark: SparkSession, size: int) -> int:
    """Into how many ranges a table of ``size`` bytes is dealt."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(size / MOST_BYTES), min(math.ceil(size / RANGE_BYTES), wanted))


def bytes_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def _range_heads(rows: DataFrame) -> list[tuple]:
    """The first key (has an id, id, hash) of each range, descending; ``rows`` have doc_id, h and
    size. Only these keys come to the driver, one per range."""
    keys = written(rows, "range-keys")
    size = keys.agg(F.sum("size")).first()[0] or 0
    doc_id = F.col("doc_id")
    dealt = keys.repartitionByRange(range_count(rows.sparkSession, size),
                                    F.desc_nulls_last("doc_id"), F.desc("h"))
    first = dealt.groupBy(F.spark_partition_id().alias("part")).agg(
        F.max(F.struct(doc_id.isNotNull().alias("known"), doc_id, F.col("h"))).alias("head"))
    return sorted((tuple(r["head"]) for r in first.collect()), reverse=True)


def in_descending_order(docs: DataFrame) -> DataFrame:
    """part, late, doc_id, text: each part in its task, sorted; a late row is the document that
    follows the part's last one."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    heads = _range_heads(rows.select("doc_id", "h", bytes_of(F.col("text")).alias("size")))
    rising, parts = heads[::-1], len(heads)
    if not parts:
        return rows.select(F.lit(0).alias("part"), F.lit(0).alias("late"), "doc_id", "text")

    @F.arrow_udf("long")
    def place(doc_id: pa.Array, h: pa.Array) -> pa.Array:
        """Twice the range of a row, and one more for the first of a range."""
        out = []
        for key in zip(doc_id.is_valid().to_pylist(), doc_id.to_pylist(), h.to_pylist()):
            part = parts - 1 - bisect.bisect_left(rising, key)
            out.append(2 * part + (heads[part] == key))
        return pa.array(out, pa.int64())

    part = F.expr("place div 2")
    also = F.when(F.expr("place % 2 = 1"), F.struct(
        F.pmod(part - 1, F.lit(parts).cast("long")).alias("part"), F.lit(1).alias("late")))
    rows = rows.withColumn("place", place("doc_id", "h")).select(
        F.explode(F.array_compact(F.array(F.struct(part.alias("part"), F.lit(0).alias("late")), also)))
        .alias("to"), "doc_id", "h", "text")
    return (rows.select("to.part", "to.late", "doc_id", "h", "text").repartition("part")
            .sortWithinPartitions("part", "late", F.desc_nulls_last("doc_id"), F.desc("h"),
                                  F.asc_nulls_first("text"))
            .drop("h"))


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def edit_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text's SHA-256, both fingerprints, and their likeness; see
    ``edited``; documents follow each other in descending order of ids."""
    short_batches(docs.sparkSession)
    fields = [("n_chars", "long", pa.int64()), ("edited_sha256", "string", pa.string()),
              ("fingerprint", "string", pa.string()),
              ("edited_fingerprint", "string", pa.string()),
              ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64())]

    def walk(batches):
        waiting = None                      # (part, doc_id, text, multiset) without successor
        for batch in batches:
            out = []
            for part, late, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                if late and waiting is None:
                    continue
                mine = Multiset.of_text(text)
                if waiting is not None:
                    _, known, old, before = waiting
                    new = edited(old, text)
                    other = Multiset.of_text(new)
                    out.append((known, len(old), hashlib.sha256(new.encode()).hexdigest(),
                                str(before), str(other), before.likeness(other),
                                before.likeness(mine)))
                waiting = None if late else (part, doc_id, text, mine)
            if out:
                kinds = [batch.schema.field("doc_id").type, *(f[2] for f in fields)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                      names=["doc_id", *(f[0] for f in fields)])

    schema = ", ".join([f"doc_id {type_of(docs, 'doc_id')}", *(f"{n} {t}" for n, t, _ in fields)])
    return in_descending_order(docs).mapInArrow(walk, schema)
