import hashlib
import random
from collections import Counter

from retailpulse.llm.multiset import (Multiset, edit_likeness, edited, fingerprint_documents,
                                      in_descending_order, paragraphs)
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def expected(texts):
    """(length, SHA-256 of the edited text) by place in descending order of ids."""
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    out = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        out.append((doc, len(text), hashlib.sha256(
            (text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    return out


def test_query_equals_brute_force(spark, texts):
    rows = REGISTRY["op10_fingerprint"](spark, SF).collect()
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows) == sorted(
        expected(list(texts.items())))
    prints = {}
    for r in rows:
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for s in prints.values() for p in s}) == len(prints)
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.9 * len(rows)


def test_homomorphism():
    rng = random.Random(1)
    parts = [bytes(rng.choices(b"abc \n", k=rng.randint(1, 60))) for _ in range(300)]
    whole = Multiset.of(parts)
    rng.shuffle(parts)
    assert str(Multiset.of(parts)) == str(whole)
    assert str(Multiset.of(parts[:100]) + Multiset.of(parts[100:])) == str(whole)
    assert str(whole - Multiset.of(parts[7:8])) == str(Multiset.of(parts[:7] + parts[8:]))
    assert str(Multiset.of(parts + parts[:1])) != str(whole)
    assert str(Multiset.parse(str(whole))) == str(whole)
    assert b"".join(paragraphs(b"\n".join(parts))) == b"\n".join(parts)


def test_likeness_follows_shared_text():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    a, b = (" ".join(word() for _ in range(2000)) for _ in range(2))
    near = [Multiset.of_text(a).likeness(Multiset.of_text(a[:k * len(a) // 4] + b[k * len(b) // 4:]))
            for k in range(5)]
    assert near == sorted(near) and near[0] < 0.15 and abs(near[2] - 0.5) < 0.12 and near[4] == 1


def test_a_paragraph_may_repeat_often(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    texts = {2: "\n" * 40_000 + "end", 1: " ".join(word() for _ in range(3000))}

    def exact(text):
        bits = [hashlib.blake2b(p).digest()[:32] for p in paragraphs(text.encode())]
        return [sum(n * (1 if d[k >> 3] >> (7 - k % 8) & 1 else -1) for d, n in Counter(bits).items())
                for k in range(256)]

    def cosine(a, b):
        size = lambda v: sum(x * x for x in v) ** 0.5
        return max(0.0, sum(x * y for x, y in zip(a, b)) / (size(a) * size(b)))

    whole = Multiset.of_text(texts[2])
    assert max(map(abs, exact(texts[2]))) > 32_768 and whole.signs.tolist() == exact(texts[2])
    assert Multiset.parse(str(whole)).signs.tolist() == exact(texts[2])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in edit_likeness(docs).collect()}
    for doc, after in ((2, 1), (1, 2)):
        new = edited(texts[doc], texts[after])
        assert abs(rows[doc]["near_edited"] - cosine(exact(texts[doc]), exact(new))) < 1e-9
        assert abs(rows[doc]["near_next"] - cosine(exact(texts[doc]), exact(texts[after]))) < 1e-9
    assert rows[2]["near_edited"] > 0.9


def test_ranges_stitch_together(spark, monkeypatch):
    monkeypatch.setattr("retailpulse.llm.multiset.RANGE_BYTES", 2000)
    monkeypatch.setattr("retailpulse.llm.multiset.MOST_BYTES", 4000)
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(0, 400, 3)]), f"text {k} " * (k % 5)) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert in_descending_order(docs).select("part").distinct().count() > 5
    once = list({i: (i, t) for i, t in rows if i is not None}.values())
    docs = spark.createDataFrame(once, "doc_id long, text string")
    got = {r["doc_id"]: (r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in edit_likeness(docs).collect()}
    assert got == {e[0]: e for e in expected(once)}


def test_rows_without_id_spread_over_ranges(spark, monkeypatch):
    """A third of the rows has no id, another third one and the same."""
    monkeypatch.setattr("retailpulse.llm.multiset.MOST_BYTES", 4000)
    rows = [((None, 7, k)[k % 3], f"text {k} " * (k % 50)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = in_descending_order(docs).where("late = 0").collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in dealt) == sorted((str(i), t) for i, t in rows)
    parts = {}
    for r in dealt:
        parts.setdefault(r["doc_id"], set()).add(r["part"])
    assert len(parts[None]) > 5 and len(parts[7]) > 5
    # every document has one successor, so each text but the repeated empty one is followed once
    ordered = sorted(dealt, key=lambda r: r["part"])            # stable: parts come sorted
    texts = [r["text"] for r in ordered]
    want = sorted(hashlib.sha256(edited(a, b).encode()).hexdigest() for a, b in zip(texts, texts[1:] + texts[:1]))
    assert sorted(r["edited_sha256"] for r in edit_likeness(docs).collect()) == want
    ids = [r["doc_id"] for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is None, -(i or 0)))


def test_awkward_rows(spark, awkward, no_documents):
    rows = edit_likeness(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (2, 3)} == {str(Multiset())}
    assert edit_likeness(no_documents).count() == 0
    alone = edit_likeness(awkward.where("doc_id = 6")).collect()
    assert (alone[0]["near_edited"], alone[0]["near_next"]) == (0, 1) or alone[0]["near_next"] == 1
    assert edit_likeness(awkward.where("doc_id IS NULL")).count() == 2
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprint_documents(awkward).collect()}
    assert all(plain[r["doc_id"]] == r["fingerprint"] for r in rows if r["doc_id"] is not None)
