import random

import corpus_pipeline as P
import __spark_entry__ as E
from retailpulse.llm import queries, toxicity
from retailpulse.llm.common import written
from retailpulse.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    names = E.queries()
    assert names["pipeline"] is P.run and set(queries.REGISTRY) <= set(names)
    assert [f"op{n}_" for n in range(1, 14)] == sorted(
        (k.split("_")[0] + "_" for k in queries.REGISTRY), key=lambda k: int(k[2:-1]))
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination",
                                        "secret_scan", "packing"]


def test_stages_on_tables(spark, documents):
    docs, seen = documents, []
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, SF), "test")
        assert out.schema == documents.schema
        assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in docs.collect()}
        seen.append(out)
        docs = out
    clean, single, checked, masked = seen
    model = toxicity.train(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(documents, model).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, s in scores.items() if s < 0.3}
    # brute force: the smallest id of every group of close fingerprints
    fps = {r["doc_id"]: fingerprint((r["text"] or "").encode()) for r in clean.collect()}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sorted(fps):
        for b in sorted(fps):
            if a < b and ((fps[a] ^ fps[b]) & (2 ** 64 - 1)).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in single.collect()} == {i for i in fps if find(i) == i}
    assert masked.count() == checked.count()
    assert all(r["n_chars"] == len(r["text"]) for r in masked.collect())
    assert P.run(spark, SF).count() == P.pack(spark, masked, SF).count()


def test_stages_on_planted_rows(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=7))
    text = lambda n: " ".join(word() for _ in range(n))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first()["text"]
    long = text(400)
    rows = [(9000, long), (9001, long), (9002, f"{text(60)} {item} {text(10)}"),
            (9003, f'{text(50)} token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" {text(50)}'),
            (9004, text(120)), (9005, " ".join(["idiot moron"] * 10 + [text(40)])), (9006, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(spark.read.parquet(f"{SF}/documents.parquet"))
    for _, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test")
    kept = {r["doc_id"]: r["text"] for r in docs.where("doc_id >= 9000").collect()}
    assert set(kept) == {9000, 9003, 9004, 9006} or set(kept) == {9000, 9003, 9004}
    assert "f33e6108" not in kept[9003] and "[SECRET]" in kept[9003]
    assert kept[9004] == rows[4][1]


def test_awkward_rows_through_all_stages(spark, awkward):
    """Nulls in every column, repeated ids and rows, very long texts and columns that are named
    as the stages name their own: a stage keeps the columns, and drops or changes what it should."""
    docs, ids = awkward, []
    for name, stage in P.STAGES[:-1]:
        out = written(stage(spark, docs, SF), "test")
        assert out.schema == awkward.schema, name
        ids.append(sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect()))
        docs = out
    every = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in awkward.collect())
    assert ids[0] == every                      # no row has a label of either kind here
    assert ids[1:] == [[(False, i) for i in (0, 2, 5, 6, 7, 8, 9)] + [(True, 0)]] * 3
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert texts <= {(r["doc_id"], r["text"]) for r in awkward.collect()}
    assert (None, "a text without id") in texts     # the null text without id goes with document 2
    assert all(r["n_chars"] == len(r["text"] or "") for r in docs.collect())
    pieces = P.pack(spark, docs, SF)
    total = pieces.groupBy("doc_id").sum("length").count()
    assert total == len(texts)


def test_empty_table(spark, documents):
    docs = documents.limit(0)
    for _, stage in P.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test")
        assert docs.schema == documents.schema and docs.count() == 0
    assert P.pack(spark, docs, SF).count() == 0
