"""Toxicity score: a logistic model whose training swaps identity terms.

Features are words and word beginnings, hashed, weighted by how dense they are in the text.
Every labelled sentence that names a group is paired with its counterfactual, in which each
identity term is replaced by another of its kind; the loss adds the squared difference of the
two scores, so that a group mention alone moves nothing.

Only the fit looks at a sample: at most ``sample_rows`` labelled rows of the training folds,
chosen by hash. Their feature statistics are summed by Spark, the ``n_features`` strongest
ones go to the driver (a bounded number) with the sparse rows over them. Every document is
scored from its whole text; ids, sources, languages and labels never enter a score.

Defined cases: a null text scores as an empty one; rows without id or label are not trained
on; repeated labels of a document count once each (the larger label wins); without labels of
both kinds the score is the share of toxic training rows, or 0 if there are none; an empty
table gives no rows; other columns are not read (``score_documents``) or kept
(``drop_toxic``).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, held_out, short_batches, type_of, utf8, written

SAMPLE_ROWS = 20_000
N_FEATURES = 4096
BEGINNINGS = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
PENALTY = 1.0              # weight of the squared score change under a swap
RIDGE = 2e-4
STEPS, RATE = 400, 0.05
WORDS_KNOWN = 150_000      # words whose features a worker remembers

# Terms that may stand for each other; a swap takes the next one of the row.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "bisexual"), ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "foreigners", "citizens"),
    ("frauen", "männer"), ("juden", "muslime", "christen"), ("femmes", "hommes"),
    ("juifs", "musulmans", "chrétiens"), ("mujeres", "hombres"),
    ("judíos", "musulmanes", "cristianos"))

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
                 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def features_of(word: bytes) -> list[int]:
    """Hashes of the word and of its beginnings."""
    return [zlib.crc32(b"w" + word),
            *(zlib.crc32(b"b" + word[:k]) for k in BEGINNINGS if len(word) > k)]


def swaps(groups) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for g in groups for a, b in zip(g, (*g[1:], g[0]))}


def density(count: int, n_words: int) -> float:
    return math.log1p(1000 * count / (n_words + 20))


def counts(text_words: list[bytes]) -> Counter:
    out: Counter = Counter()
    for word, n in Counter(text_words).items():
        for f in features_of(word):
            out[f] += n
    return out


@dataclass
class Model:
    """Weights by feature hash, and a bias."""
    weights: dict[int, float]
    bias: float
    seen: dict[bytes, tuple[int, ...]] = field(default_factory=dict)

    def score(self, text: bytes) -> float:
        ws = words(text)
        if len(self.seen) > WORDS_KNOWN:
            self.seen = {}
        seen, found = self.seen, Counter()
        for word, n in Counter(ws).items():
            hits = seen.get(word)
            if hits is None:
                hits = tuple(f for f in features_of(word) if f in self.weights)
                if len(word) <= 64:
                    seen[word] = hits
            for f in hits:
                found[f] += n
        z = self.bias + sum(self.weights[f] * density(n, len(ws)) for f, n in sorted(found.items()))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def fit_logistic(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, swapped: np.ndarray,
                 labels: np.ndarray, n_features: int, penalty: float = PENALTY,
                 ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Adam on mean log loss + ridge + penalty * mean squared score change; ``swapped`` are
    the values of the same (row, column) cells in the counterfactual."""
    n, change = len(labels), swapped - values
    w, share = np.zeros(n_features), labels.mean()
    bias = math.log(share / (1 - share))
    mean, square = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(rows, values * w[columns], minlength=n)
        off = 1 / (1 + np.exp(-z)) - labels
        drift = np.bincount(rows, change * w[columns], minlength=n)
        pull = values * off[rows] + 2 * penalty * change * drift[rows]
        grad = np.append(np.bincount(columns, pull, minlength=n_features) / n + ridge * w,
                         off.mean())
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        move = RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def _information(pos, neg, n_pos: int, n_neg: int):
    """Log-likelihood ratio of presence against the label, for features of toxic rows."""
    n = n_pos + n_neg

    def part(k, of):
        def side(x, total, all_of):
            return F.when(x > 0, x * F.log(x * n / (total * F.lit(float(all_of))))).otherwise(0.0)
        both = pos + neg
        return side(k, both, of) + side(of - k, n - both, of)
    gain = part(pos, n_pos) + part(neg, n_neg)
    return F.when(pos * n_neg > neg * n_pos, gain).otherwise(-gain)


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS,
          n_features: int = N_FEATURES, identity_terms=IDENTITY_TERMS,
          penalty: float = PENALTY) -> Model:
    """Fit on at most ``sample_rows`` labelled rows whose fold is not the held-out one."""
    spark = docs.sparkSession
    short_batches(spark)
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                          & ~held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = written(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
                     .groupBy("doc_id").agg(F.min("text").alias("text"),
                                            F.max("label").alias("label")), "labelled")
    totals = {r["label"]: r["n"] for r in
              sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = totals.get(1, 0), totals.get(0, 0)
    if not n_pos or not n_neg:
        return Model({}, 700.0 if n_pos else -1000.0)
    other = swaps(identity_terms)

    def presence(batches):
        pos, neg = Counter(), Counter()
        for batch in batches:
            for text, label in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                (pos if label else neg).update(counts(words(text)).keys())
        both = list(pos.keys() | neg.keys())
        for at in range(0, len(both), 100_000):
            part = both[at:at + 100_000]
            yield pa.record_batch(
                [pa.array(part, pa.int64()), pa.array([pos[f] for f in part], pa.int64()),
                 pa.array([neg[f] for f in part], pa.int64())], names=["f", "pos", "neg"])

    stats = (sample.select("text", "label").mapInArrow(presence, "f long, pos long, neg long")
             .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .where((F.col("pos") + F.col("neg") >= 2) & (F.col("pos") > 0)))
    best = (stats.select("f", _information(F.col("pos"), F.col("neg"), n_pos, n_neg).alias("g"))
            .orderBy(F.desc("g"), "f").limit(n_features).collect())
    place = spark.sparkContext.broadcast({r["f"]: i for i, r in enumerate(best)})

    def sparse(batches):
        at = place.value
        for batch in batches:
            out = []
            for text, label in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                ws = words(text)
                mine = counts(ws)
                theirs = counts([other.get(w, w) for w in ws]) if not other.keys().isdisjoint(ws) \
                    else mine
                cells = sorted(at[f] for f in mine.keys() | theirs.keys() if f in at)
                names = {at[f]: f for f in mine.keys() | theirs.keys() if f in at}
                out.append((label, cells, [density(mine[names[c]], len(ws)) for c in cells],
                            [density(theirs[names[c]], len(ws)) for c in cells]))
            yield pa.record_batch([pa.array(x, t) for x, t in zip(
                zip(*out), (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float32()),
                            pa.list_(pa.float32())))], names=["y", "c", "v", "s"])

    got = sample.select("text", "label").mapInArrow(
        sparse, "y int, c array<int>, v array<float>, s array<float>").toArrow().combine_chunks()
    lists = [got.column(k).combine_chunks() for k in ("c", "v", "s")]
    rows = np.repeat(np.arange(len(got)), np.diff(lists[0].offsets.to_numpy()))
    columns, values, swapped = (x.flatten().to_numpy().astype(float) for x in lists)
    weights, bias = fit_logistic(rows, columns.astype(int), values, swapped,
                                 got.column("y").to_numpy().astype(float), max(1, len(best)),
                                 penalty)
    return Model({r["f"]: float(w) for r, w in zip(best, weights)}, float(bias))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score for every row."""
    short_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)      # n_features weights

    def score(batches):
        for batch in batches:
            scores = [held.value.score(t) for t in utf8(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(scores, pa.float64())],
                                  names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        score, f"doc_id {type_of(docs, 'doc_id')}, score double")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below ``threshold``, all columns."""
    short_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array([held.value.score(t) < threshold
                                         for t in utf8(batch.column(place))], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
