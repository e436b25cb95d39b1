import random

import numpy as np
import xxhash

from retailpulse.llm.queries import REGISTRY
from retailpulse.llm import simhash
from retailpulse.llm.common import written
from retailpulse.llm.simhash import (GrayIndex, components, fingerprint, forest, leaf_pairs, leaves,
                                     links, near_duplicates, numbered, one_of_each)

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(len(words) - k + 1)]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def classes(fps, bits=3):
    ids, root = sorted(fps), {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark, texts):
    fps = {i: slow_fingerprint(t) for i, t in texts.items()}
    want = classes(fps)
    rows = REGISTRY["op7_simhash"](spark, SF).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{fps[i]:016x}", want[i]) for i in fps}


def near(rng, fps, bits):
    return rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits)))


def linked_as(spark, fps, bits=3):
    """Whether the components of the links are those of all pairs."""
    rows = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    frame = spark.createDataFrame(rows, "fp long")
    got = {r["node"]: r["label"] for r in components(links(frame, bits)).collect()}
    want = classes(dict(enumerate(fps)), bits)
    mine = [got.get(x, x) for (x,) in rows]
    return len(set(zip(mine, want.values()))) == len(set(mine)) == len(set(want.values()))


def crowd(seed, n, centres, bits):
    rng = random.Random(seed)
    fps = [rng.getrandbits(64) for _ in range(centres)]
    while len(set(fps)) < n:
        fps.append(near(rng, fps, bits))
    return list(dict.fromkeys(fps))


def test_links_lose_nothing(spark, monkeypatch):
    for rows in (4, 64, 1024):
        monkeypatch.setattr(simhash, "LEAF_ROWS", rows)
        assert linked_as(spark, crowd(3, 560, 60, 5))
    for bits in (0, 1, 5):
        assert linked_as(spark, crowd(5, 300, 30, 6), bits)
    assert linked_as(spark, [0]) and linked_as(spark, [0, 7, 2**63, 2**64 - 1])


def test_every_link_lies_in_a_pair_of_leaves_left_by_the_nodes(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LEAF_ROWS", 16)
    rng = random.Random(8)
    fps = list({rng.getrandbits(64) for _ in range(2000)} | set(crowd(9, 500, 20, 4)))
    frame = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    leaf, depth = numbered(written(leaves(frame), "leaves"))
    place, turn = {}, {}
    for r in leaf.collect():
        by = 16 * r["turn"]
        for x in np.frombuffer(r["fps"], dtype=np.uint64).tolist():
            x = (x >> by | x << (64 - by)) & (2**64 - 1) if by else x
            place[r["turn"], x] = r["id"]
        turn[r["id"]] = r["turn"]
    assert len(place) == 4 * len(fps)
    left = {(r["left"], r["right"]) for r in leaf_pairs(leaf, depth).collect()}
    for n, a in enumerate(fps):
        for b in fps[n + 1:]:
            if (a ^ b).bit_count() <= 3:
                met = [tuple(sorted((place[t, a], place[t, b]))) in left for t in range(4)]
                assert any(met)
    of_turn = [list(turn.values()).count(t) for t in range(4)]
    assert len(left) < 0.1 * sum(n * (n + 1) / 2 for n in of_turn)      # the rest was pruned


def test_a_crowd_of_near_texts_is_many_leaves_in_many_tasks(spark):
    rng, fps = np.random.default_rng(2), np.zeros(30_000, dtype=np.uint64)
    for _ in range(8):
        fps ^= np.left_shift(np.uint64(1), rng.integers(0, 64, len(fps)).astype(np.uint64))
    fps = np.unique(fps)
    frame = spark.createDataFrame([(x,) for x in fps.view(np.int64).tolist()], "fp long")
    leaf = written(leaves(frame), "leaves")
    sizes = [len(r["fps"]) // 8 for r in leaf.select("fps").collect()]
    assert max(sizes) <= 1024 and sum(sizes) == 4 * len(fps) and len(sizes) > 100
    got = {r["node"]: r["label"] for r in components(links(frame)).collect()}
    label = np.arange(len(fps))
    for at in range(0, len(fps), 500):                                  # brute force
        a, b = np.nonzero(np.bitwise_count(fps[at:at + 500, None] ^ fps) <= 3)
        a = a + at
        while (label[a] != label[b]).any():
            x, y = label[a], label[b]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := label[label], label):
                label = up
    mine = [got.get(x, x) for x in fps.view(np.int64).tolist()]
    assert len(set(zip(mine, label.tolist()))) == len(set(mine)) == len(set(label.tolist()))


def test_gray_index_equals_all_pairs():
    for n in (1, 17, 400):
        fps = np.array(sorted(crowd(4, n, 1, 4)), dtype=np.uint64)
        front = -1 << 60
        for mask in (0, front):
            a, b = GrayIndex(fps).search(fps, 3, mask)
            want = {(i, j) for i in range(len(fps)) for j in range(len(fps))
                    if int(fps[i] ^ fps[j]).bit_count() <= 3
                    and not int(fps[i] ^ fps[j]) & mask & (2**64 - 1)}
            assert set(zip(a.tolist(), b.tolist())) == want
        assert len(forest(fps, None, 3)[0]) <= len(fps) - 1
        if n > 9:
            assert len(forest(fps[:9], fps[9:], 3)[0]) <= len(fps) - 1


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "src long, dst long")
    assert {r["label"] for r in components(edges).collect()} == {0}
    assert components(edges.limit(0)).count() == 0


def test_awkward_rows(spark, awkward, no_documents):
    rows = near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert {r["component_id"] for i in (0, 1) for r in by_id[i]} == {0}
    assert {by_id[i][0]["fp"] for i in (2, 3, 4)} == {0}
    assert {r["component_id"] for i in (2, 3, 4) for r in by_id[i]} == {2}
    assert fingerprint(b" \n ") == 0
    assert near_duplicates(no_documents).count() == 0
    kept = one_of_each(awkward)
    assert kept.schema == awkward.schema
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert got == [(False, i) for i in (0, 2, 5, 6, 7, 8, 9)] + [(True, 0)]
    assert one_of_each(no_documents).count() == 0


def test_one_of_each_goes_by_component(spark):
    near_a, a, b = ("The quick brown fox jumps", "the quick brown fox jumps", "something else altogether here")
    alone = " ".join(f"word{k}" for k in range(400))
    close = alone.replace("word200", "other")
    assert 0 < (fingerprint(alone.encode()) ^ fingerprint(close.encode())).bit_count() <= 3
    rows = [(3, near_a), (5, a), (5, b), (5, b), (None, alone), (None, close), (None, close)]
    for some in (rows, rows[::-1], rows[2:] + rows[:2], rows[1:3] + rows[:1] + rows[3:]):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        got = [(r["doc_id"], r["text"]) for r in one_of_each(docs).collect()]
        assert len(got) == 3 and {(3, near_a), (5, b)} < set(got)
        assert {t for i, t in got if i is None} <= {alone, close}
