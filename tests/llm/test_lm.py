import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from retailpulse.llm import lm
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [*WORD.findall((text or "").translate(LOW)), None]


def test_base_score_and_held_out_gain(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts = Counter(t for i, x in texts.items() if zlib.crc32(str(i).encode()) % 10 for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    rows = REGISTRY["op3_lm"](spark, SF).collect()
    assert len(rows) == len(texts)
    base = own = 0.0
    for r in rows:
        ts = tokens(texts[r["doc_id"]])
        want = sum(math.log10((counts[t] + .1) / (n + .1 * (v + 1))) for t in ts)
        assert abs(r["base_score"] - want) < 1e-7 * abs(want)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ts), sum(t in counts for t in ts), n)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0)
        if r["held_out"]:
            base, own = base + r["base_score"], own + r["score"]
    assert own > 0.98 * base


def test_probabilities_sum_to_one(spark, documents):
    table = lm.blocks(documents)
    counts = lm.token_counts(lm.token_uses(table))
    model = lm.train(table, counts)
    contexts = np.random.default_rng(0).integers(0, model.classes + 1, (200, 3))
    assert np.allclose(np.exp(model.log_probabilities(contexts)).sum(axis=1), 1, atol=1e-5)
    inside = np.zeros(model.classes)
    for r in counts.where("c > 0").collect():
        t = bytes(r["token"])
        k = model.frequent.get(t, lm.FREQUENT + lm.form_of(t))
        inside[k] += (r["c"] + lm.SMOOTHING) / (
            model.class_tokens[k] + lm.SMOOTHING * (model.class_types[k] + 1))
    used = model.class_types > 0
    unseen = lm.SMOOTHING / (model.class_tokens + lm.SMOOTHING * (model.class_types + 1))
    assert np.allclose((inside + unseen)[used], 1)


def test_rounds_follow_the_gradient(spark, documents):
    table = lm.blocks(documents)
    counts = lm.token_counts(lm.token_uses(table))
    gaps = []
    for rounds in (0, 4):
        model = lm.train(table, counts, rounds=rounds, prior=10)
        observed = lm.observed_counts(table, model)
        expected = lm.expected_counts(lm.context_counts(table, model), model)
        assert np.isclose(observed.sum(), expected.sum())
        assert np.isclose(observed.sum(), len(lm.TEMPLATES) * model.n_tokens)
        gaps.append(np.abs(observed - expected).sum())
    assert gaps[1] < 0.9 * gaps[0]


def test_context_keys_stop_at_documents():
    classes, starts = np.array([5, 6, 7, 8, 1, 2]), np.array([0, 4])
    outside = lm.FREQUENT + lm.FORMS
    assert lm.contexts_of(lm.context_keys(classes, starts)).tolist() == [
        [outside] * 3, [5, outside, outside], [6, 5, outside], [7, 6, 5],
        [outside] * 3, [1, outside, outside]]


def test_awkward_rows(spark, awkward, no_documents):
    rows = lm.score_documents(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3, 4)} == {1}
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert lm.score_documents(no_documents).count() == 0
    held = spark.createDataFrame([(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0],
                                 "doc_id long, text string")
    assert {(r["n_known"], r["base_score"], r["train_tokens"]) for r in
            lm.score_documents(held).collect()} == {(0, 0.0, 0)}


def test_token_counts_of_many_blocks(spark, monkeypatch):
    """Uses against a plain count, where some tokens lie in every block."""
    docs = spark.createDataFrame([(k, f"often w{k % 7} only{k}" if k % 4 else None) for k in range(120)],
                                 "doc_id long, text string").repartition(3)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 8)
    table = lm.blocks(docs)
    rows = table.select("block", "vocabulary", "counts").collect()
    assert len(rows) > 30
    want = Counter()
    for r in rows:
        want.update({bytes(t): n for t, n in zip(r["vocabulary"], r["counts"])})
    uses = lm.token_uses(table)
    named = uses.where("token IS NOT NULL").collect()
    assert {bytes(r["token"]): r["c"] for r in named} == {t: want[t] for t in want} and len(named) == len(want)
    places = {r["at"]: r["c"] for r in uses.where("at IS NOT NULL").collect()}
    assert places == {r["block"] << lm.CODE_BITS | code: want[bytes(t)] for r in rows
                      for code, (t, n) in enumerate(zip(r["vocabulary"], r["counts"])) if n != want[bytes(t)]}


def test_forms_and_hashes_of_arrays():
    words = pa.array([b" ", b"a", b"ab", b"ba", b"abc", b"\xff", b"long" * 500, "wörter".encode(), b"ab"], pa.binary())
    for some in (words, words[2:], words[3:4]):
        assert lm.forms_of(some).tolist() == [lm.form_of(t) for t in some.to_pylist()]
    assert lm.hashes_of(words)[2:].tolist() == lm.hashes_of(words[2:]).tolist()
    assert len(set(lm.hashes_of(words).tolist())) == 8


def test_no_list_of_uses_on_the_heap(spark, documents, monkeypatch):
    """A block's counts come back in a few packed arrays, whatever its vocabulary: its codes were
    gathered as boxed numbers before."""
    monkeypatch.setattr(lm, "SHARD", 1_000)
    table = lm.blocks(documents)
    totals, shards = lm.token_totals(table)
    assert shards > 5
    known = {r["block"]: r["entries"] for r in lm.known_entries(totals, "ids", "counts").collect()}
    want = Counter()
    rows = table.select("block", "vocabulary", "counts", "lasts").collect()
    for r in rows:
        want.update({bytes(t): n for t, n in zip(r["vocabulary"], r["counts"])})
    number = {}
    for r in rows:
        assert len(known[r["block"]]) <= shards
        entries = pa.array([e.asDict() for e in known[r["block"]]])
        ids, counts = lm._entries(entries, "ids", "counts")
        assert counts.tolist() == [want[bytes(t)] for t in r["vocabulary"]]
        assert all(number.setdefault(bytes(t), i) == i for t, i in zip(r["vocabulary"], ids.tolist()))
    assert len(set(number.values())) == len(number) == len(want)


def test_word_features_against_plain_counts(spark, monkeypatch):
    """Scores of documents from a count of all word pairs; the probabilities of all words sum to
    one; a phrase of the training documents is worth more than its words in another order."""
    monkeypatch.setattr(lm, "BLOCK_DOCS", 7)
    monkeypatch.setattr(lm, "SHARD", 300)
    rng = np.random.default_rng(3)
    phrase = [f"p{k}" for k in rng.permutation(12)]
    made = [" ".join([*(f"w{k}" for k in rng.zipf(1.7, rng.integers(0, 9)) % 40), *phrase]) for _ in range(150)]
    docs = [(k, t) for k, t in enumerate(made)] + [(None, "w1 w2 w3"), (3, None), (3, ""), (3, made[3])]
    held = [k for k in range(200, 400) if zlib.crc32(str(k).encode()) % 10 == 0][:2]
    other = [phrase[k] for k in rng.permutation(12)]
    docs += [(held[0], " ".join(phrase)), (held[1], " ".join(other))]
    table = lm.blocks(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
    totals, shards = lm.token_totals(table)
    model = lm.train(table, lm.token_counts(lm.token_uses(table, totals)))
    words = lm.words_of(table, totals, shards)
    features = lm.feature_totals(table, totals, words)
    assert shards > 1 and features.where("block IS NULL").count() > len(lm.WORD_TEMPLATES)
    lm.learn_gates(features, totals, words)
    assert ((words.gates >= 0) & (words.gates < 1)).all() and words.gates.max() > 0.5

    learned = [[t.encode() if t else lm.END for t in tokens(x)] for i, x in docs
               if i is None or zlib.crc32(str(i).encode()) % 10]
    counts = Counter(t for d in learned for t in d)
    pairs = {back: Counter((d[i - back], d[i]) for d in learned for i in range(back, len(d)))
             for back in lm.WORD_TEMPLATES}
    seen = {back: Counter() for back in pairs}
    for back, found in pairs.items():
        for (before, _), n in found.items():
            seen[back][before] += n
    rank = {bytes(t): k.bit_length() for r in totals.where("block IS NULL").collect() for k, t in enumerate(r["tokens"])}
    class_of = lambda t: model.frequent.get(t, lm.FREQUENT + lm.form_of(t))

    def chance(before, token):
        classes = [class_of(t) for t in before[::-1][:3]] + [model.classes] * 3
        c = class_of(token)
        p = math.exp(model.log_probabilities(np.array([classes[:3]]))[0, c]) * (counts[token] + lm.SMOOTHING) / (
            model.class_tokens[c] + lm.SMOOTHING * (model.class_types[c] + 1))
        for t, back in enumerate(lm.WORD_TEMPLATES):
            f = before[-back] if len(before) >= back else None
            if seen[back][f]:
                gate = words.gates[t, rank[f]]
                p = gate * pairs[back][f, token] / seen[back][f] + (1 - gate) * p
        return p

    rows = lm.score_blocks(table, totals, features, model, words).collect()
    assert len(rows) == len(docs)
    want = Counter()
    for i, text in docs:
        d = [t.encode() if t else lm.END for t in tokens(text)]
        want[i, len(d), round(sum(math.log10(chance(d[:k], t)) for k, t in enumerate(d)), 3)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], round(r["score"], 3)) for r in rows) == want
    used = [k for k in range(model.classes) if model.class_types[k]]
    for before in ([], [b"w1"], [phrase[0].encode(), phrase[1].encode()], [b"w2", b"w3"]):
        rest = sum(math.exp(model.log_probabilities(np.array([([class_of(t) for t in before[::-1]] + [model.classes] * 3)[:3]]))[0, k])
                   * (1 if k not in used else lm.SMOOTHING / (model.class_tokens[k] + lm.SMOOTHING * (model.class_types[k] + 1)))
                   for k in range(model.classes))
        for t, back in enumerate(lm.WORD_TEMPLATES):
            if len(before) >= back and seen[back][before[-back]]:
                rest *= 1 - words.gates[t, rank[before[-back]]]
        assert math.isclose(sum(chance(before, t) for t in counts) + rest, 1, abs_tol=1e-4)
    score = {r["doc_id"]: r["score"] for r in rows}
    assert score[held[0]] > score[held[1]] + 5


def test_mixed_numbers_are_distinct():
    for bits in (1, 5, 23, 31):
        x = np.arange(1 << min(2 * bits, 12)) * (1 << max(0, 2 * bits - 12)) | 1
        y = lm.mixed(np.unique(x), bits)
        assert len(set(y.tolist())) == len(set(x.tolist())) and int(y.max()) < 1 << 2 * bits
        assert lm.unmixed(y, bits).tolist() == np.unique(x).tolist()
