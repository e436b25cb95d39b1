import math
import random

import numpy as np
import pytest

from retailpulse.llm import neighbours as N
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def brute(rows, every=50, top=5):
    """(query, [(vec_id, score)]) for every query row, all other rows compared in double precision."""
    good = [(i, np.array([float(x) for x in v])) for i, v in rows if i is not None and v
            and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (q, v) in enumerate(good):
        if q % every == 0:
            hits = []
            for other, (i, w) in enumerate(good):
                if other != at:
                    size = max(len(v), len(w))
                    a, b = np.pad(v, (0, size - len(v))), np.pad(w, (0, size - len(w)))
                    hits.append((-float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))), i))
            hits.sort(key=lambda h: (round(h[0], 12), h[1]))
            out.append((q, [(i, -s) for s, i in hits[:top]]))
    return out


def found(df):
    rows = {}
    for r in df.collect():
        rows.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(hits) for q, hits in rows.items()}


def test_recall_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = found(REGISTRY["op13_neighbours"](spark, SF)), dict(brute(rows))
    assert set(got) == set(want)
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    hit = 0
    for q, hits in got.items():
        assert [r for r, _, _ in hits] == [1, 2, 3, 4, 5]
        assert [(-s, i) for _, i, s in hits] == sorted((-s, i) for _, i, s in hits)
        for _, i, s in hits:
            a, b = vectors[q], vectors[i]
            assert i != q and s == pytest.approx(float(a @ b / math.sqrt((a @ a) * (b @ b))), abs=1e-14)
        hit += len({i for _, i, _ in hits} & {i for i, _ in want[q]})
    assert hit >= 0.95 * 5 * len(want)


def test_descent_beats_its_start(spark):
    """Lists come from neighbours of neighbours: the few random first ones hold next to none of the nearest."""
    rng = np.random.default_rng(4)
    data = rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    nodes = N.nodes_of(N.valid_vectors(df), 6)
    lists, rounds = N.build_graph(nodes, k=16, reverse=12, start=6)
    members = {r["idx"]: r["members"][0] for r in nodes.collect()}
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    hit = total = 0
    for r in lists.collect():
        sim = unit @ unit[members[r["idx"]]]
        sim[members[r["idx"]]] = -2
        assert len(r["nbr"]) == 16 and r["idx"] not in r["nbr"] and len(set(r["nbr"])) == 16
        assert np.allclose(r["near"], sim[[members[x] for x in r["nbr"]]], atol=2e-3)
        hit += len({members[x] for x in r["nbr"]} & set(np.argsort(-sim)[:5].tolist()))
        total += 5
    assert rounds > 2 and hit > 0.8 * total
    # queries that are no nodes begin at nodes picked by a hash
    asked = rng.normal(size=(40, 16))
    units = [(v / np.linalg.norm(v)).astype("<f2").tobytes() for v in asked]
    queries = spark.createDataFrame([(q, u, None) for q, u in enumerate(units)], "q long, unit binary, start array<long>")
    beams = {}
    for r in N.search(nodes, N.adjacency(lists), queries, beam=64).collect():
        beams.setdefault(r["q"], set()).add(members[r["x"]])
    hits = sum(len(beams[q] & set(np.argsort(-(unit @ v))[:5].tolist())) for q, v in enumerate(asked))
    assert hits >= 0.9 * 5 * len(asked)


def test_awkward_rows(spark):
    rng = random.Random(5)
    vec = lambda: [rng.gauss(0, 1) for _ in range(4)]
    same, nan = vec(), float("nan")
    rows = [(i, vec()) for i in range(0, 40)]
    rows += [(50, same), (100, same), (100, same), (7, same), (150, [2 * x for x in same])]
    rows += [(200, None), (250, []), (300, [0.0, 0.0, 0.0, 0.0]), (350, [1.0, None, 0.0, 0.0]), (400, [1.0, nan, 0.0, 0.0]),
             (450, [float("inf"), 0.0, 0.0, 0.0]), (None, vec()), (500, [1.0, 2.0]), (550, [1e200, 2e200, 0.0, 0.0]),
             (600, [-0.0, 1e-170, 0.0, 1e-170])]
    df = spark.createDataFrame([(*r, 1, "x", [1]) for r in rows],
                               "vec_id long, embedding array<double>, idx long, unit string, members array<long>")
    scaled = [(i, v if v is None or i not in (550, 600) else [x / max(v) for x in v]) for i, v in rows]
    want, got = brute(scaled), {}
    for r in N.nearest(df).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 10)))
    for q in {q for q, _ in want}:
        lists = sorted((rank, i, round(s, 10)) for p, hits in want if p == q for rank, (i, s) in enumerate(hits, 1))
        assert sorted(got[q]) == lists, q
    assert set(got) == {q for q, _ in want}


def test_copies_and_few_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 3000)] + [(5000, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(N.nearest(df))
    assert len(got) == 61
    assert [i for _, i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for _, i, _ in got[100]] == [0, 1, 2, 3, 4]
    assert [i for _, i, _ in got[5000]] == [0, 1, 2, 3, 4]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (50, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert {q: [i for _, i, _ in h] for q, h in found(N.nearest(few)).items()} == {0: [1, 50], 50: [1, 0]}
    assert N.nearest(few.where("vec_id = 0")).collect() == []
    assert N.nearest(few.limit(0)).collect() == []
