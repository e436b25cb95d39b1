import hashlib
import random
import re

from retailpulse.llm.decontaminate import Automaton, dealt, decontaminate, find_contamination, words
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def brute(texts, items, window=13):
    grams = {}
    for name, text in items:
        w = WORD.findall((text or "").translate(LOW))
        if 0 < len(w) < window:
            grams.setdefault(tuple(w), set()).add(name)
        for k in range(len(w) - window + 1):
            grams.setdefault(tuple(w[k:k + window]), set()).add(name)
    sizes, out = {len(g) for g in grams}, {}
    for doc, text in texts.items():
        w = WORD.findall((text or "").translate(LOW))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[tuple(w[k:k + n])]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def test_query_equals_brute_force(spark, texts):
    items = [(str(r["item_id"]), r["text"]) for r in
             spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute(texts, items)
    rows = REGISTRY["op6_decontaminate"](spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, hit, found = want[r["doc_id"]]
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(found), digest)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_automaton_on_random_words():
    rng = random.Random(5)
    for _ in range(150):
        letters = "abc"[:rng.randint(1, 3)]
        line = lambda n: " ".join(rng.choice(letters) for _ in range(n))
        items = [(str(k), line(rng.randint(0, 9))) for k in range(rng.randint(1, 6))]
        text, window = line(rng.randint(0, 30)), rng.randint(2, 5)
        spans, found = [], set()
        Automaton([(n, words(t.encode())) for n, t in items], window).scan(
            words(text.encode()), spans, found)
        _, hit, want = brute({0: text}, items, window)[0]
        assert (sum(b - a for a, b in spans), sorted(found)) == (hit, want)


def test_a_benchmark_of_many_shards(spark):
    rng = random.Random(11)
    line = lambda n: " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(n))
    items = [(str(k % 70), line(rng.choice([0, 1, 2, 5, 13, 40, 200]))) for k in range(90)]
    texts = {k: " ".join([line(20), *(rng.choice(items)[1][:400].split()[2:]), line(20)])
             for k in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    assert dealt(bench, 5, 300)[1] >= 100
    want = brute(texts, items, 5)
    for shard_bytes in (300, 500_000):
        got = find_contamination(docs, bench, window=5, shard_bytes=shard_bytes).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in got} == want
    cut = decontaminate(docs, bench, window=5, min_share=1, shard_bytes=5000)
    whole = decontaminate(docs, bench, window=5, min_share=1)
    assert sorted(cut.collect()) == sorted(whole.collect())


def test_awkward_rows(spark, awkward, no_documents):
    bench = spark.createDataFrame(
        [(1, "three four five"), (1, "three four five"), (2, None), (3, ""), (None, "café 中文")],
        "item_id long, text string")
    rows = find_contamination(awkward, bench).collect()
    assert len(rows) == awkward.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [(r["n_hit"], r["item_ids"]) for r in by_id[1]] == [(3, ["1"])] * 2
    assert by_id[2][0]["n_words"] == 0 and not by_id[2][0]["contaminated"]
    assert by_id[7][0]["item_ids"] == [""]
    assert find_contamination(no_documents, bench).count() == 0
    assert find_contamination(awkward, bench.limit(0)).where("n_hit > 0").count() == 0
    kept = decontaminate(awkward, bench)
    assert kept.schema == awkward.schema
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 5, 6, 8, 9, None}


def test_short_overlaps_are_cut_out(spark):
    filler = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(1, f"Start. {filler} The Quick, brown fox! tail {filler}")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the quick brown fox")], "item_id long, text string")
    assert decontaminate(docs, bench).first()["text"] == f"Start. {filler} ! tail {filler}"
