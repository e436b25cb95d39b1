"""Language-model scores: a hashed maximum-entropy model over word classes, and word features.

``p(word | before) = p(class | before) * p(word | class)``. The most frequent tokens are classes
of their own, the others share classes by their outer letters. The class softmax sums the
weights of hashed n-gram features (one and two classes back) and skip features (two back,
three back, one and three back); inside a class, tokens are as likely as in training, smoothed.
Features over the words themselves (the word one back, the word two back) then move this towards
what followed that word in training: ``gate * n(before, word) / n(before) + (1 - gate) * p``, the
nearer word last. The weights are the counts of all distinct pairs; a pair has a number of its own,
so the probabilities of all words still sum to one. The gates go by the rank of the word before and
are learned by leaving each token out of its own counts.

Training: documents are cut into blocks (token codes and a vocabulary for each block, one
written table). Two passes over all training tokens count the features with the class that
followed, and the contexts (three classes back; a fixed number of them whatever the corpus).
Then every round broadcasts the weights (hash buckets x classes), tasks sum the gradient over
their share of the contexts, the sums are added up in a tree, and the weights move along
observed minus expected counts, scaled by the counts.

Scoring: a block's entries meet those of all other blocks in shards of the vocabulary, as packed
arrays and not as rows per token, and their counts go back to the block the same way, as do those
of its word features in shards of these, which grow in number with the corpus. Numpy then scores
a block at a time, each distinct context once.

Defined cases: a null or empty text is the end token alone; a null id is never held out; rows
that repeat are documents of their own; without training documents all classes are equally
likely; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import held_out, packed, short_batches, type_of, unpacked, utf8, written

FOLDS, HELD_OUT_FOLD = 10, 0
SMOOTHING = 0.1
END = b" "                           # no word holds a blank
FREQUENT, FORMS = 24, 40             # classes: frequent tokens, groups of the others
BUCKETS = 1 << 14                    # hashed features
ROUNDS, RATE = 2, 0.4
PRIOR, LIFT = 100, 2.0
BLOCK_DOCS, BLOCK_TOKENS = 512, 1_000_000
BLOCK_BITS, CODE_BITS = 15, 28       # of a block's number in its partition, of a code
CONTEXTS_AT_ONCE = 16_384
SHARD = 1 << 21                      # entries of blocks that meet in a task
BAND = 256                           # weight rows that travel together
TREE = 32                            # sums added at a time
TEMPLATES = ((0,), (1,), (2,), (0, 1), (0, 2))      # places back, from 0
WORD_TEMPLATES = (2, 1)              # a word's feature: the word so many places before; the nearest last
GATE_ROUNDS = 50


def tokens(text: bytes) -> list[bytes]:
    """Words between blanks, A-Z lower-cased, then the end."""
    return [*text.lower().split(), END]


def form_of(token: bytes) -> int:
    """Group of a token by its outer letters."""
    return zlib.crc32(token[:2] + token[-2:]) % FORMS


def _letters(tokens_: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens, and where each begins and ends."""
    offsets = np.frombuffer(tokens_.buffers()[1], np.int32)[tokens_.offset:tokens_.offset + len(tokens_) + 1]
    return np.frombuffer(tokens_.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def forms_of(tokens_: pa.Array) -> np.ndarray:
    """``form_of`` of every token; none is empty."""
    letters, ends = _letters(tokens_)
    first, last, short = ends[:-1], ends[1:] - 1, np.diff(ends) == 1
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ 0xEDB88320, table >> 1).astype(np.uint32)
    crc = np.full(len(first), 0xFFFFFFFF, np.uint32)
    for place, more in ((first, False), (np.where(short, first, first + 1), False),
                        (np.where(short, first, last - 1), True), (last, True)):
        new = table[(crc ^ letters[place]) & 255] ^ crc >> 8
        crc = np.where(short, crc, new) if more else new
    return ((crc ^ 0xFFFFFFFF) % FORMS).astype(np.uint8)


def hashes_of(tokens_: pa.Array) -> np.ndarray:
    """32-bit hashes: a polynomial of each token's bytes, from running sums over all of them."""
    letters, ends = _letters(tokens_)
    base = 0x9E3779B97F4A7C15
    power = np.cumprod(np.full(len(letters), base, np.uint64))
    back = np.cumprod(np.full(len(letters), pow(base, -1, 1 << 64), np.uint64))
    sums = np.r_[np.uint64(0), np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * power)]
    h = (sums[ends[1:]] - sums[ends[:-1]]) * back[ends[:-1]]
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(32)).astype(np.uint32)


# --------------------------------------------------------------- blocks ----
def blocks(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT_FOLD) -> DataFrame:
    """block, ids, held, sizes (per document), vocabulary (by hash, so that a shard of the tokens is
    a run of codes), counts and lasts (per entry: in training documents, as their last word), forms
    (a byte per entry, see ``form_of``) and codes (packed) of runs of documents, as a written
    table."""
    short_batches(docs.sparkSession)
    kind = type_of(docs, "doc_id")

    def cut(batches):
        number = first = TaskContext.get().partitionId() << BLOCK_BITS
        ids, held, words, sizes = [], [], [], []
        id_type = None

        def row():
            nonlocal number
            coded = pa.array(words, pa.binary()).dictionary_encode()
            n = len(coded.dictionary)
            if n > 1 << CODE_BITS or number - first == 1 << BLOCK_BITS:
                raise ValueError("more words in a text, or more blocks in a partition, than have numbers")
            order = np.argsort(hashes_of(coded.dictionary), kind="stable")
            vocabulary, place = coded.dictionary.take(pa.array(order)), np.empty(n, np.int64)
            place[order] = np.arange(n)
            codes = place[coded.indices.to_numpy()]
            known, size = ~np.array(held, dtype=bool), np.array(sizes)
            counts = np.bincount(codes[np.repeat(known, size)], minlength=n)
            lasts = np.bincount(codes[(np.cumsum(size) - 2)[known & (size > 1)]], minlength=n)
            forms = forms_of(vocabulary).tobytes()
            out = pa.record_batch(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(id_type)),
                 pa.array([held], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), vocabulary),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([lasts], pa.list_(pa.int64())),
                 pa.array([forms], pa.binary()), pa.array([packed(codes)], pa.binary())],
                names=["block", "ids", "held", "sizes", "vocabulary", "counts", "lasts", "forms", "codes"])
            number += 1
            for x in (ids, held, words, sizes):
                x.clear()
            return out

        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text, out in zip(batch.column(0).to_pylist(), utf8(batch.column(1)),
                                         batch.column(2).to_pylist()):
                found = tokens(text)
                if ids and len(words) + len(found) > BLOCK_TOKENS:
                    yield row()
                ids.append(doc_id)
                held.append(out)
                sizes.append(len(found))
                words += found
                if len(ids) >= BLOCK_DOCS:
                    yield row()
        if ids:
            yield row()

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id"), folds, fold).alias("held"))
    return written(rows.mapInArrow(
        cut, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, "
             "vocabulary array<binary>, counts array<long>, lasts array<long>, forms binary, codes binary"),
        "blocks", "zstd")


def token_totals(table: DataFrame) -> tuple[DataFrame, int]:
    """What the blocks' entries are in the whole corpus, as a written table, and the number of
    shards. A shard is a range of token hashes that holds about ``SHARD`` entries of all blocks, one
    for each block and token, so a frequent token makes no shard large. A row without a block names
    a shard's tokens, frequent ones first, and their counts (``tokens``, ``c``); the others have, for
    a block's entries in the shard, packed ``ids`` (place in the shard * shards + shard), ``counts``
    and ``lasts``."""
    entries = table.agg(F.sum(F.length("forms"))).first()[0] or 0
    shards = max(1, -(-entries // SHARD))

    def deal(batches):
        for batch in batches:
            for block, vocabulary, counts, lasts in zip(*(batch.column(k) for k in range(4))):
                words, n, last = (x.values for x in (vocabulary, counts, lasts))
                letters, offsets = _letters(words)
                ends = np.searchsorted(hashes_of(words).astype(np.int64) * shards >> 32,
                                       np.arange(shards), side="right")
                for shard, (i, j) in enumerate(zip([0, *ends.tolist()], ends.tolist())):
                    if i < j:
                        some = letters[offsets[i]:offsets[j]].tobytes()
                        yield pa.record_batch(
                            [pa.array([shard], pa.int32()), pa.array([block.as_py()], pa.int64()),
                             pa.array([pa.compress(some, codec="zstd", asbytes=True)]),
                             pa.array([packed(np.diff(offsets[i:j + 1]))]), pa.array([packed(n[i:j].to_numpy())]),
                             pa.array([packed(last[i:j].to_numpy())])],
                            names=["shard", "block", "letters", "sizes", "counts", "lasts"])

    def total(part: pa.Table) -> pa.Table:
        shard, blocks_ = part.column("shard")[0].as_py(), part.column("block").to_pylist()
        sizes, n, last = (list(map(unpacked, part.column(c).to_pylist())) for c in ("sizes", "counts", "lasts"))
        letters = b"".join(pa.decompress(x, int(k.sum()), codec="zstd", asbytes=True)
                           for x, k in zip(part.column("letters").to_pylist(), sizes))
        ends = np.cumsum(list(map(len, sizes)))[:-1]
        offsets = np.r_[0, np.cumsum(np.concatenate(sizes))]
        coded = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
            None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        number, types = coded.indices.to_numpy(), len(coded.dictionary)
        c, e = (np.bincount(number, np.concatenate(x), types).astype(np.int64) for x in (n, last))
        order = pc.sort_indices(pa.table({"c": c, "token": coded.dictionary}),
                                sort_keys=[("c", "descending"), ("token", "ascending")]).to_numpy()
        place = np.empty(types, np.int64)
        place[order] = np.arange(types)
        values = [place[number] * shards + shard, c[number], e[number]]
        names = coded.dictionary.take(pa.array(order)).cast(pa.binary())
        first = lambda x: pa.concat_arrays([  # noqa: E731  a list, then nulls
            pa.ListArray.from_arrays(pa.array([0, types], pa.int32()), x), pa.nulls(len(blocks_), pa.list_(x.type))])
        return pa.table({
            "shard": pa.array([shard] * (len(blocks_) + 1), pa.int32()), "block": pa.array([None, *blocks_], pa.int64()),
            "tokens": first(names), "c": first(pa.array(c[order])),
            **{name: pa.array([None, *map(packed, np.split(x, ends))], pa.binary())
               for name, x in zip(("ids", "counts", "lasts"), values)}})

    dealt = table.select("block", "vocabulary", "counts", "lasts").mapInArrow(
        deal, "shard int, block long, letters binary, sizes binary, counts binary, lasts binary")
    return written(dealt.groupBy("shard").applyInArrow(
        total, "shard int, block long, tokens array<binary>, c array<long>, ids binary, counts binary, "
               "lasts binary"), "token-totals", "zstd", once=True), shards


def known_entries(totals: DataFrame, *names: str) -> DataFrame:
    """block, entries: these columns of a block's shards, in the order of its vocabulary."""
    return totals.where("block IS NOT NULL").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("shard", *names))).alias("entries"))


def _entries(entries: pa.StructArray, *names: str) -> list[np.ndarray]:
    return [np.concatenate(list(map(unpacked, entries.field(name).to_pylist()))) for name in names]


def token_uses(table: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """What a token's count over all training documents (``c``) is, in two sorts of rows: one row
    names each token (``token``), and uses in blocks that do not hold all of its occurrences carry
    ``at`` (block and code). Where a block does, its own count is right already."""
    totals = token_totals(table)[0] if totals is None else totals

    def other(batches):
        for batch in batches:
            for block, own, entries in zip(*(batch.column(k) for k in range(3))):
                c, = _entries(entries.values, "counts")
                code = np.flatnonzero(c != own.values.to_numpy())
                yield pa.record_batch([pa.array(block.as_py() << CODE_BITS | code), pa.array(c[code])],
                                      names=["at", "c"])

    null = lambda kind: F.lit(None).cast(kind)
    names = totals.where("block IS NULL").select(F.explode(F.arrays_zip("tokens", "c")).alias("p")).select(
        F.col("p.tokens").alias("token"), null("long").alias("at"), F.col("p.c").alias("c"))
    uses = (table.select("block", "counts").join(known_entries(totals, "counts"), "block")
            .select("block", F.col("counts"), "entries").mapInArrow(other, "at long, c long"))
    return names.unionByName(uses.select(null("binary").alias("token"), "at", "c"))


def token_counts(uses: DataFrame) -> DataFrame:
    """token, c (count in training documents; 0 for tokens of held-out documents only)."""
    return uses.where("token IS NOT NULL").select("token", "c")


# ---------------------------------------------------------------- model ----
@dataclass
class Model:
    """Classes and weights; what is broadcast has a fixed size."""
    frequent: dict[bytes, int]
    class_tokens: np.ndarray          # training tokens of each class
    class_types: np.ndarray           # distinct ones
    weights: np.ndarray               # buckets x classes
    n_tokens: int
    n_types: int

    @property
    def classes(self) -> int:
        return FREQUENT + FORMS

    def classes_of(self, vocabulary: pa.Array, forms: np.ndarray) -> np.ndarray:
        """Classes of the entries of a vocabulary, whose forms are known."""
        found = pc.index_in(vocabulary, value_set=pa.array(list(self.frequent), pa.binary()))
        place = found.fill_null(-1).to_numpy()
        return np.where(place >= 0, place, FREQUENT + forms.astype(np.int64))

    def log_probabilities(self, contexts: np.ndarray) -> np.ndarray:
        """Natural logs of the class probabilities after each context (rows of places back)."""
        out = np.empty((len(contexts), self.classes), dtype=np.float32)
        for at in range(0, len(contexts), CONTEXTS_AT_ONCE):
            some, z = contexts[at:at + CONTEXTS_AT_ONCE], out[at:at + CONTEXTS_AT_ONCE]
            z[:] = self.weights[feature(some, 0)]
            for t in range(1, len(TEMPLATES)):
                z += self.weights[feature(some, t)]
            z -= z.max(axis=1, keepdims=True)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out


def feature(contexts: np.ndarray, template: int) -> np.ndarray:
    """Hash bucket of the template's places in each context."""
    h = np.full(len(contexts), 0x9E3779B1 * (template + 1) & 0xFFFFFFFF, dtype=np.uint64)
    for place in TEMPLATES[template]:
        h = (h ^ contexts[:, place].astype(np.uint64)) * np.uint64(0x100000001B3)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def context_keys(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A number for the three classes before each token; ``starts`` are the documents' first
    tokens, before which there is a class of its own."""
    base = FREQUENT + FORMS + 1
    key = np.zeros(len(classes), dtype=np.int64)
    place = np.arange(len(classes)) - np.repeat(starts, np.diff(np.append(starts, len(classes))))
    for back in (3, 2, 1):
        before = np.full(len(classes), base - 1, dtype=np.int64)
        before[back:] = classes[:-back]
        before[place < back] = base - 1
        key = key * base + before
    return key


def contexts_of(keys: np.ndarray) -> np.ndarray:
    base = FREQUENT + FORMS + 1
    return np.stack([keys % base, keys // base % base, keys // base ** 2], axis=1)


def _training_tokens(batches, model: Model):
    """(context keys, classes) of the training tokens of each block."""
    for batch in batches:
        for held, sizes, vocabulary, forms, codes in zip(*(batch.column(k) for k in range(5))):
            sizes = np.array(sizes.as_py(), dtype=np.int64)
            classes = model.classes_of(vocabulary.values, np.frombuffer(forms.as_py(), np.uint8))
            classes = classes[unpacked(codes.as_py())]
            key = context_keys(classes, np.cumsum(sizes) - sizes)
            learned = np.repeat(~np.array(held.as_py(), dtype=bool), sizes)
            yield key[learned], classes[learned]


def _tree_sum(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of the tasks' matrices (buckets x size), which travel in bands of rows and are
    added up ``TREE`` at a time."""
    def join(part: pa.Table) -> pa.Table:
        sums = [np.frombuffer(x, "<f8") for x in part.column("sums").to_pylist()]
        return pa.table({"band": part.column("band")[:1], "task": part.column("task")[:1],
                         "sums": pa.array([np.sum(sums, axis=0).tobytes()], pa.binary())})

    tasks = rows.rdd.getNumPartitions()
    while True:
        rows = (rows.withColumn("task", F.floor(F.col("task") / TREE))
                .groupBy("band", "task").applyInArrow(join, rows.schema))
        tasks = -(-tasks // TREE)
        if tasks <= 1:
            break
    out = np.zeros((BUCKETS // BAND, BAND, size))
    for r in rows.collect():                        # one row for each band
        out[r["band"]] = np.frombuffer(r["sums"], "<f8").reshape(BAND, size)
    return out.reshape(BUCKETS, size)


BANDS = "band long, task long, sums binary"


def _bands(total: np.ndarray):
    """A task's matrix as rows of ``BANDS``; bands of zeros are left out."""
    task, bands = TaskContext.get().partitionId(), total.reshape(-1, BAND, total.shape[1])
    for band in np.flatnonzero(bands.any(axis=(1, 2))).tolist():
        yield pa.record_batch([pa.array([band]), pa.array([task]),
                               pa.array([bands[band].astype("<f8").tobytes()], pa.binary())],
                              names=["band", "task", "sums"])


def observed_counts(table: DataFrame, model: Model) -> np.ndarray:
    """How often each feature was followed by each class, over all training documents."""
    held_model = table.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        m, base = held_model.value, FREQUENT + FORMS + 1
        cells = [np.zeros(base ** len(t) * m.classes, dtype=np.int64) for t in TEMPLATES]
        for key, labels in _training_tokens(batches, m):
            back = [key % base, key // base % base, key // base ** 2]
            for t, places in enumerate(TEMPLATES):
                at = back[places[0]]
                for place in places[1:]:
                    at = at * base + back[place]
                cells[t] += np.bincount(at * m.classes + labels, minlength=len(cells[t]))
        total = np.zeros((BUCKETS, m.classes))
        for t, places in enumerate(TEMPLATES):
            rows = np.arange(base ** len(places))
            contexts = np.zeros((len(rows), 3), dtype=np.int64)
            for place in reversed(places):
                contexts[:, place], rows = rows % base, rows // base
            np.add.at(total, feature(contexts, t), cells[t].reshape(-1, m.classes))
        yield from _bands(total)

    return _tree_sum(table.select("held", "sizes", "vocabulary", "forms", "codes")
                     .mapInArrow(count, BANDS), model.classes)


def context_counts(table: DataFrame, model: Model) -> DataFrame:
    """key, n: training tokens after each context, as a written table of a bounded size."""
    held_model = table.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        total = np.zeros((FREQUENT + FORMS + 1) ** 3, dtype=np.int64)
        for key, _ in _training_tokens(batches, held_model.value):
            total += np.bincount(key, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["key", "n"])

    return written(table.select("held", "sizes", "vocabulary", "forms", "codes")
                   .mapInArrow(count, "key long, n long")
                   .groupBy("key").agg(F.sum("n").alias("n")), "contexts", once=True)


def expected_counts(contexts: DataFrame, model: Model) -> np.ndarray:
    """How often the model expects each feature to be followed by each class."""
    held_model = contexts.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        m = held_model.value
        total = np.zeros((BUCKETS, m.classes))
        for batch in batches:
            places = contexts_of(batch.column(0).to_numpy())
            mass = np.exp(m.log_probabilities(places)) * batch.column(1).to_numpy()[:, None]
            for t in range(len(TEMPLATES)):
                bucket = feature(places, t)
                order = np.argsort(bucket, kind="stable")
                at = np.flatnonzero(np.diff(bucket[order], prepend=-1))
                total[bucket[order][at]] += np.add.reduceat(mass[order], at, axis=0)
        yield from _bands(total)

    return _tree_sum(contexts.mapInArrow(count, BANDS), model.classes)


def _class_totals(counts: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    held_model = counts.sparkSession.sparkContext.broadcast(model)

    def total(batches):
        m = held_model.value
        n, types = np.zeros(m.classes), np.zeros(m.classes)
        for batch in batches:
            tokens_ = batch.column(0)
            cls = m.classes_of(tokens_, forms_of(tokens_))
            c = batch.column(1).to_numpy()
            n += np.bincount(cls, c, minlength=m.classes)
            types += np.bincount(cls, c > 0, minlength=m.classes)
        yield pa.record_batch([pa.array(range(m.classes), pa.int64()), pa.array(n), pa.array(types)],
                              names=["k", "n", "types"])

    rows = (counts.mapInArrow(total, "k long, n double, types double")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).collect())
    n, types = np.zeros(model.classes), np.zeros(model.classes)
    for r in rows:
        n[r["k"]], types[r["k"]] = r["n"], r["types"]
    return n, types


def train(table: DataFrame, counts: DataFrame, rounds: int = ROUNDS, rate: float = RATE,
          prior: float = PRIOR, lift: float = LIFT) -> Model:
    """The model of the blocks' training documents. ``prior`` is the number of tokens with the
    classes' overall shares that each feature is taken to have been seen with besides."""
    totals = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    top = (counts.where((F.col("c") > 0) & (F.col("token") != F.lit(END)))
           .orderBy(F.desc("c"), "token").limit(FREQUENT - 1).collect())
    frequent = {END: 0, **{bytes(r["token"]): i + 1 for i, r in enumerate(top)}}
    size = FREQUENT + FORMS
    model = Model(frequent, np.zeros(size), np.zeros(size),
                  np.zeros((BUCKETS, size), dtype=np.float32), totals["n"] or 0, totals["v"] or 0)
    model.class_tokens, model.class_types = _class_totals(counts, model)
    if not model.n_tokens:
        return model
    observed = observed_counts(table, model)
    contexts = context_counts(table, model)
    # a first guess: how far each feature moves the classes from their shares, split evenly
    share = (model.class_tokens + 1) / (model.class_tokens + 1).sum()
    seen = observed.sum(axis=1, keepdims=True)
    move = np.log((observed + prior * share) / (seen + prior) / share)
    weights = (np.log(share) + lift * move) / len(TEMPLATES)
    for _ in range(rounds):
        model.weights = weights.astype(np.float32)
        expected = expected_counts(contexts, model)
        weights = weights + rate * (observed - expected) / (np.maximum(observed, expected) + prior)
    model.weights = weights.astype(np.float32)
    return model


# -------------------------------------------------------- word features ----
@dataclass
class Words:
    """Numbers of tokens and of the features that reach them. A feature is a pair: a word, and the
    word 1 or 2 places before it. It has a number of 2 * ``bits`` bits, which no other pair has."""
    shards: int                       # of the vocabulary, see token_totals
    bits: int
    split: int                        # bits that name a feature's shard
    gates: np.ndarray                 # templates x ranks of the word before

    def pairs(self, numbers: np.ndarray, place: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, features) of the tokens that have a word ``back`` places before them."""
        at = np.flatnonzero(place >= back)
        return at, mixed(numbers[at - back] << self.bits | numbers[at], self.bits)

    def ranks(self, numbers: np.ndarray) -> np.ndarray:
        return np.frexp((numbers // self.shards).astype(np.float64))[1]


_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mixed(x: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of 2 * bits bits, spread over all of them; no two become one."""
    x, mask = x.astype(np.uint64), np.uint64((1 << 2 * bits) - 1)
    x = x * np.uint64(_ODD[0]) & mask
    x ^= x >> np.uint64(bits)
    return x * np.uint64(_ODD[1]) & mask


def unmixed(x: np.ndarray, bits: int) -> np.ndarray:
    mask, odd = np.uint64((1 << 2 * bits) - 1), [np.uint64(pow(k, -1, 1 << 64)) for k in _ODD]
    x = x * odd[1] & mask
    x ^= x >> np.uint64(bits)
    return (x * odd[0] & mask).astype(np.int64)


def _places(sizes: np.ndarray) -> np.ndarray:
    """Each token's place in its document."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def words_of(table: DataFrame, totals: DataFrame, shards: int) -> Words:
    """The numbers' sizes; the gates are 0 until ``learn_gates`` has set them."""
    tokens_ = table.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    longest = totals.agg(F.max(F.size("tokens"))).first()[0] or 1
    bits = max(1, (longest * shards - 1).bit_length())
    if bits > 31:
        raise ValueError("more distinct words than have numbers")
    return Words(shards, bits, min(2 * bits, max(0, (tokens_ - 1) // SHARD).bit_length()),
                 np.zeros((len(WORD_TEMPLATES), 64)))


def feature_totals(table: DataFrame, totals: DataFrame, words: Words) -> DataFrame:
    """How often each feature occurs in all training documents, as a written table. A shard is a
    range of features of one template. Rows with a block have, packed, the counts of the block's
    distinct features in the shard, in ascending order; a row without one has what the gates are
    learned from: ``tokens`` and ``hits`` (the other occurrences of their features, summed) by
    ``cell`` (rank of the word before, rank of the word, binary places of the count)."""
    low = 2 * words.bits - words.split

    def deal(t, batches):
        for batch in batches:
            for block, held, sizes, codes, entries in zip(*(batch.column(k) for k in range(5))):
                numbers, = _entries(entries.values, "ids")
                numbers, sizes = numbers[unpacked(codes.as_py())], np.array(sizes.as_py(), dtype=np.int64)
                at, key = words.pairs(numbers, _places(sizes), WORD_TEMPLATES[t])
                key = np.sort(key << np.uint64(1) | np.repeat(np.array(held.as_py(), dtype=np.uint64), sizes)[at])
                out, key = (key & np.uint64(1)).astype(np.int64), (key >> np.uint64(1)).astype(np.int64)
                first = np.flatnonzero(np.diff(key, prepend=-1))
                n, key = np.add.reduceat(1 - out, first) if len(key) else out, key[first]
                ends = np.searchsorted(key >> low, np.arange(1 << words.split), side="right").tolist()
                for shard, (i, j) in enumerate(zip([0, *ends], ends)):
                    if i < j:
                        yield pa.record_batch(
                            [pa.array([shard], pa.int32()), pa.array([block.as_py()], pa.int64()),
                             pa.array([packed(np.diff(key[i:j], prepend=shard << low))]),
                             pa.array([packed(n[i:j])])], names=["shard", "block", "steps", "n"])

    def total(part: pa.Table) -> pa.Table:
        shard, blocks_ = part.column("shard")[0].as_py(), part.column("block").to_pylist()
        steps = list(map(unpacked, part.column("steps").to_pylist()))
        ends = np.cumsum(list(map(len, steps)))[:-1]
        key, which = np.unique(np.concatenate([np.cumsum(x) for x in steps]), return_inverse=True)
        n = np.bincount(which, np.concatenate(list(map(unpacked, part.column("n").to_pylist()))),
                        len(key)).astype(np.int64)
        counts = list(map(packed, np.split(n[which], ends)))
        key, n = key[n > 0], n[n > 0]
        pair = unmixed((key + (shard << low)).astype(np.uint64), words.bits)
        cell = (words.ranks(pair >> words.bits) << 6 | words.ranks(pair & (1 << words.bits) - 1)) << 6
        cells, which = np.unique(cell | np.frexp(n.astype(np.float64))[1], return_inverse=True)
        sums = [np.bincount(which, x, len(cells)).astype(np.int64) for x in (n, n * (n - 1.0))]
        first = lambda x: pa.concat_arrays([  # noqa: E731  a list, then nulls
            pa.array([x], pa.list_(pa.int64())), pa.nulls(len(blocks_), pa.list_(pa.int64()))])
        return pa.table({
            "shard": pa.array([shard] * (len(blocks_) + 1), pa.int32()),
            "block": pa.array([None, *blocks_], pa.int64()), "counts": pa.array([None, *counts], pa.binary()),
            "cell": first(cells.astype(np.int64)), "tokens": first(sums[0]), "hits": first(sums[1])})

    def of(t: int) -> DataFrame:
        rows = table.select("block", "held", "sizes", "codes").join(known_entries(totals, "ids"), "block")
        dealt = rows.mapInArrow(functools.partial(deal, t), "shard int, block long, steps binary, n binary")
        return written(dealt.groupBy("shard").applyInArrow(
            total, "shard int, block long, counts binary, cell array<long>, tokens array<long>, "
                   "hits array<long>"), "feature-totals", "zstd", once=True).withColumn("template", F.lit(t))

    # one after the other: the pairs of one template at a time are on disk
    return functools.reduce(DataFrame.unionByName, map(of, range(len(WORD_TEMPLATES))))


def learn_gates(features: DataFrame, totals: DataFrame, words: Words) -> None:
    """How far a word's feature is believed, by template and rank of the word before: the share that
    makes each training token likeliest where its own occurrence is left out of the counts, against
    the tokens' overall shares."""
    rank = F.when(F.col("place") == 0, 0).otherwise(F.floor(F.log2("place")) + 1)
    types, mass = np.zeros(64), np.zeros(64)
    for r in (totals.where("block IS NULL").select(F.posexplode("c").alias("place", "c")).where("c > 0")
              .groupBy(rank.alias("rank")).agg(F.count("c").alias("types"), F.sum("c").alias("mass")).collect()):
        types[r["rank"]], mass[r["rank"]] = r["types"], r["mass"]
    cells = (features.where("block IS NULL")
             .select("template", F.explode(F.arrays_zip("cell", "tokens", "hits")).alias("p"))
             .groupBy("template", F.col("p.cell").alias("cell"))
             .agg(F.sum("p.tokens").alias("tokens"), F.sum(F.col("p.hits").cast("double")).alias("hits")).toArrow())
    t, cell, tokens_, hits = (cells.column(k).to_numpy() for k in range(4))
    often = mass / np.maximum(types, 1)               # of a word of a rank
    before, word = cell >> 12, cell >> 6 & 63
    near = np.minimum(1, hits / tokens_ / np.maximum(often[before] - 1, 1e-9))
    far = often[word] / max(mass.sum(), 1)
    group = t * 64 + before
    size, gates = np.bincount(group, tokens_, words.gates.size), np.full(words.gates.size, 0.5)
    for _ in range(GATE_ROUNDS):
        own = gates[group] * near
        gates = np.bincount(group, tokens_ * own / (own + (1 - gates[group]) * far), len(gates)) / (size + 1)
    words.gates = gates.reshape(words.gates.shape)


# -------------------------------------------------------------- scoring ----
def score_blocks(table: DataFrame, totals: DataFrame, features: DataFrame, model: Model, words: Words) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score (both log10) per document."""
    spark = table.sparkSession
    kind = table.schema["ids"].dataType.elementType.simpleString()
    rows = table.select("block", "ids", "held", "sizes", "forms", "codes").join(
        known_entries(totals, "ids", "counts", "lasts"), "block")
    found = features.where("block IS NOT NULL").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("template", "shard", "counts"))).alias("features"))
    rows = rows.join(found, "block", "left")
    named = totals.where("block IS NULL").select("shard", F.posexplode("tokens").alias("place", "token"))
    special = {r["place"] * words.shards + r["shard"]: model.frequent[bytes(r["token"])] for r in named.where(
        F.col("token").isin([F.lit(t) for t in model.frequent])).collect()}
    held_model = spark.sparkContext.broadcast(model)

    def score(batches):
        m = held_model.value
        whole = np.log10(m.n_tokens + SMOOTHING * (m.n_types + 1))
        inner = np.log10(m.class_tokens + SMOOTHING * (m.class_types + 1))
        for batch in batches:
            for k in range(batch.num_rows):
                ids, held, sizes, forms, codes, entries, features_ = (batch.column(x)[k] for x in range(7))
                sizes, codes = np.array(sizes.as_py(), dtype=np.int64), unpacked(codes.as_py())
                starts = np.cumsum(sizes) - sizes
                numbers, counts, lasts = _entries(entries.values, "ids", "counts", "lasts")
                mass = np.log10(counts + SMOOTHING)
                cls = FREQUENT + np.frombuffer(forms.as_py(), np.uint8).astype(np.int64)
                for number, class_ in special.items():
                    cls[numbers == number] = class_
                context, which = np.unique(context_keys(cls[codes], starts), return_inverse=True)
                after = m.log_probabilities(contexts_of(context))
                p = 10 ** (mass - inner[cls])[codes] * np.exp(after[which, cls[codes]].astype(np.float64))
                place, got = _places(sizes), features_.values
                template = got.field("template").to_numpy() if features_.is_valid else None
                for t, back in enumerate(WORD_TEMPLATES):
                    here, key = words.pairs(numbers[codes], place, back)
                    if len(here):
                        n, = _entries(got.filter(pa.array(template == t)), "counts")
                        n = n[np.unique(key, return_inverse=True)[1]]
                        before = codes[here - back]
                        seen = counts[before] - (lasts[before] if back == 2 else 0)
                        gate = np.where(seen > 0, words.gates[t, words.ranks(numbers[before])], 0)
                        p[here] = gate * n / np.maximum(seen, 1) + (1 - gate) * p[here]
                score_ = np.log10(p)
                base = (mass - whole)[codes]
                yield pa.record_batch(
                    [ids.values, held.values, pa.array(sizes),
                     pa.array(np.add.reduceat((counts > 0)[codes].astype(np.int64), starts)),
                     pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score_, starts))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return rows.select("ids", "held", "sizes", "forms", "codes", "entries", "features").mapInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, "
               "base_score double, score double")


def score_documents(docs: DataFrame, folds: int = FOLDS, fold: int = HELD_OUT_FOLD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document; the
    model learns from the documents that are not held out."""
    table = blocks(docs, folds, fold)
    totals, shards = token_totals(table)
    model = train(table, token_counts(token_uses(table, totals)))
    words = words_of(table, totals, shards)
    features = feature_totals(table, totals, words)
    learn_gates(features, totals, words)
    return score_blocks(table, totals, features, model, words).select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(int(model.n_tokens)).cast("long").alias("train_tokens"), "base_score", "score")
