import hashlib
import random
import re

from retailpulse.llm import secret_scan as S
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def base(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_query_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] or "" for r in
             spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = REGISTRY["op2_secrets"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r["n_assign"] for r in rows) > 0
    for r in rows:
        want = base(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [
            sum(k == kind for k, _, _ in want) for kind in ("assign", "access", "hex")]


def found(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
            for r in S.scan(frame).collect()}


def test_base_spans_on_random_texts(spark):
    rng = random.Random(1)
    pieces = ["password", "PassWd", "secret", "api_key", "apikey", "token", "=", ":", " ", "  ", '"', "'", "é😀",
              "AKIA", "AKIAAKIA", "ABCDEFGHIJ0123", "0123456789abcdef", "deadbeef", "abcdefghijkl", "x.y/z+_-", "\n"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(400)]
    got = found(spark, texts)
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in S.BASE] == base(text), text


def test_weak_parts_need_their_complement(spark):
    user, opaque, url = "user: bob99", "Ab3dEf6hIj9lMn2pQr5tUv8xYz1", "https://db.example.com/x"
    far = " lorem" * 100
    got = found(spark, [user, opaque, url, f"{user} {opaque}", f"{user} {opaque} {url}", f"{user} {url}",
                        f"{opaque} {url}", f"{user}{far} {opaque}", f"é {user} é token=abcdefghijklmnop {url}",
                        f"{user}{far}{far} {user} {opaque}"])
    kinds = {i: sorted(k for k, _, _ in s) for i, s in got.items()}
    assert [kinds[i] for i in range(10)] == [
        [], [], [], ["ident", "opaque"], ["endpoint", "ident", "opaque"], [], [], [],
        ["assign", "endpoint", "ident"], ["ident", "opaque"]]
    assert got[8][0] == ("ident", 2, 13)


def test_weak_spans_and_credentials_equal_all_pairs(spark):
    rng = random.Random(6)
    pieces = ["user: bob99", "client_id=acme.7", "AKIA" + "Q1" * 9, "Ab3dEf6hIj9lMn2pQr5tUv8xYz1", "0123456789abcdef01",
              "token=abcdefghijklmnop", "https://db.example.com/x", "host: db-1.example", "é" * 40, "lorem " * 25]
    texts = ["\n".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(250)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = {}
    keys = {r["key"]: r["doc_id"] for r in docs.select("doc_id", S._key(docs).alias("key")).collect()}
    for r in S._candidates(docs).collect():
        parts.setdefault(keys[r["key"]], []).append((r["start"], r["end"], r["kind"]))
    near = lambda p, others, kinds: sorted(                      # noqa: E731
        (abs(p[0] - o[0]), o) for o in others if o[2] in kinds and abs(p[0] - o[0]) <= S.SCOPE)
    linked = 0
    for r in S.scan(docs).collect():
        mine = parts.get(r["doc_id"], [])
        want = {p for p in mine if p[2] in S.BASE
                or p[2] == "ident" and near(p, mine, S.SECRETS)
                or p[2] == "opaque" and near(p, mine, S.IDENTIFIERS)
                or p[2] == "endpoint" and near(p, mine, S.SECRETS) and near(p, mine, S.IDENTIFIERS)}
        assert {(s["start"], s["end"], s["kind"]) for s in r["spans"]} == want
        expected = []
        for p in sorted(p for p in want if p[2] in S.SECRETS):
            ids, places = near(p, want, S.IDENTIFIERS), near(p, want, ("endpoint",))
            if ids:
                expected.append((p, ids[0][1], places[0][1] if places else None))
        got = [tuple(c[k] and tuple(c[k]) for k in ("secret", "identifier", "endpoint")) for c in r["credentials"]]
        assert got == expected
        linked += len(got)
    assert linked > 100


def test_awkward_rows(spark, awkward, no_documents):
    extra = spark.createDataFrame(
        [(20, 'x token = "abcdefghijklmnop" deadbeefdeadbeef\n', 1)] * 2
        + [(None, "password: hunter2hunter2", 2), (21, "0123456789abcdef" * 2000 + " " + "f" * 15, 3)],
        "doc_id long, text string, spans long")
    frame = awkward.unionByName(extra, allowMissingColumns=True)
    rows = S.scan(frame).collect()
    assert len(rows) == frame.count()
    twice = [r["spans"] for r in rows if r["doc_id"] == 20]
    assert twice[0] == twice[1] and [s["kind"] for s in twice[0]] == ["assign", "hex"]
    red = S.redact(frame)
    assert red.schema == frame.schema
    texts = sorted(str(r["text"]) for r in red.collect())
    kept = sorted(str(r["text"]) for r in awkward.collect())
    assert texts == sorted(kept + [f'x token = "{S.MASK}" {S.MASK}\n'] * 2
                           + [f"password: {S.MASK}", f"{S.MASK} {'f' * 15}"])
    assert S.scan(no_documents).count() == S.redact(no_documents).count() == 0


def test_no_python_on_the_path(spark, documents):
    for rows in (S.redact(documents), S.scan(documents)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
