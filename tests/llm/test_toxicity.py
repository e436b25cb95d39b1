import random
import zlib

import numpy as np

from retailpulse.llm import toxicity
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = REGISTRY["op8_toxicity"](spark, SF).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    found = sum(p and y for p, y in judged)
    assert found >= 0.75 * sum(y for _, y in judged)
    assert found >= 0.9 * sum(p for p, _ in judged)


def groups(spark):
    """Labelled sentences in which one group is named mostly in toxic rows."""
    rng, rows = random.Random(1), []
    filler = "river stone cloud lamp window paper garden music".split()
    for i in range(600):
        toxic = i % 2
        words = rng.choices(filler, k=12) + (["idiot"] if toxic and rng.random() < .7 else [])
        words.append("muslims" if (rng.random() < .8) == bool(toxic) else "christians")
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


def test_swaps_take_weight_from_group_mentions(spark):
    docs, labels = groups(spark)
    neutral = b"river stone lamp garden music paper window cloud muslims"
    other = neutral.replace(b"muslims", b"christians")
    gaps = {}
    for penalty in (0.0, toxicity.PENALTY):
        model = toxicity.train(docs, labels, penalty=penalty)
        gaps[penalty] = model.score(neutral) - model.score(other)
        assert model.score(b"river idiot lamp") > model.score(b"river stone lamp")
    assert abs(gaps[toxicity.PENALTY]) < 0.3 * abs(gaps[0.0])


def test_score_equals_a_dense_sum(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    texts[-1], texts[-2] = b"", b"a " * 5000
    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    place = {f: k for k, f in enumerate(model.weights)}
    weights = np.array(list(model.weights.values()))
    more = spark.createDataFrame([(i, texts[i].decode()) for i in (-1, -2)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(more)
    for r in toxicity.score_documents(rows, model).collect():
        lower = bytes(b + 32 if 65 <= b <= 90 else b for b in texts[r["doc_id"]])
        ws = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in lower).split()
        dense = np.zeros(len(weights))
        for w in ws:
            for f in [zlib.crc32(b"w" + w)] + [zlib.crc32(b"b" + w[:k]) for k in range(4, 9) if len(w) > k]:
                if f in place:
                    dense[place[f]] += 1
        z = model.bias + weights @ np.log1p(1000 * dense / (len(ws) + 20))
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9


def test_penalty_gradient():
    rng = np.random.default_rng(0)
    rows, columns = np.repeat(np.arange(50), 2), rng.integers(0, 4, 100)
    values, swapped = rng.random(100), rng.random(100)
    labels = rng.integers(0, 2, 50).astype(float)
    drift = lambda w: np.bincount(rows, (swapped - values) * w[columns])
    free, _ = toxicity.fit_logistic(rows, columns, values, swapped, labels, 4, penalty=0)
    bound, _ = toxicity.fit_logistic(rows, columns, values, swapped, labels, 4, penalty=10)
    assert (drift(bound) ** 2).sum() < 0.2 * (drift(free) ** 2).sum()


def test_awkward_rows(spark, awkward, no_documents):
    labels = spark.createDataFrame(
        [(0, 1), (0, 1), (1, 0), (3, 0), (None, 1), (5, None), (7, 1), (9, 0)], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels)
    rows = toxicity.score_documents(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    kept = toxicity.drop_toxic(awkward, model)
    assert kept.schema == awkward.schema
    assert kept.count() == sum(r["score"] < toxicity.THRESHOLD for r in rows)
    assert toxicity.score_documents(no_documents, model).count() == 0
    nothing = toxicity.train(awkward, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(awkward, nothing).collect()} == {0.0}
