import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from retailpulse.llm import repair as R
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def least_edits(rows):
    """(cost, audit, repaired) by a plain programme over (state, cost, audit) that tries every edit."""
    after = {("", "u"): "u", ("", "s"): "s", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(best):
        for _ in range(4):
            for state, (cost, audit, out) in list(best.items()):
                for initial in "ua":
                    to = after.get((state, initial))
                    if to is not None:
                        new = (cost + 2, audit + "I", out + ((full[initial], ""),))
                        best[to] = min(best.get(to, new), new)
        return best

    best = inserted({"": (0, "", ())})
    for role, text, fault in rows:
        new = {}

        def put(state, item):
            new[state] = min(new.get(state, item), item)
        for state, (cost, audit, out) in best.items():
            put(state, (cost + 3, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                extra = 1 if fault == "truncated" else 0
                to = after.get((state, role[:1]))
                if to:
                    put(to, (cost + extra, audit + "K", out + ((role, text),)))
                for initial in "ua":
                    to = after.get((state, initial))
                    if to:
                        put(to, (cost + 2 + extra, audit + "R", out + ((full[initial], text),)))
        best = inserted(new)
    return min(v for k, v in best.items() if k in ("", "a"))


def expected(turns):
    """Per conversation, from (conv_id, turn, role, text) rows after damage."""
    blank = " \t\n\x0b\x0c\r"
    rows = sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        fault = ("blank" if not text.strip(blank) else "duplicate" if (role, text) in seen
                 else "truncated" if text.rstrip(blank)[-1] not in ".!?" else "")
        seen.add((role, text))
        faults.append((role, text, fault))
        if fault:
            counts[fault] += 1
    cost, audit, out = least_edits(faults)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"],
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def damage(rows):
    """conv_id -> rows after damage, in plain Python."""
    show = lambda v: " " if v is None else str(v)
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20, show(role), show(text)
        out[conv]
        if kind == 1:
            text = ""
        elif kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        elif kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def found(df):
    rows = {}
    for r in df.collect():
        assert r["conv_id"] not in rows
        rows[r["conv_id"]] = tuple(r[n] for n in NAMES)
    return rows


def test_programme_equals_every_edit():
    rng = random.Random(3)
    for trial in range(1500):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{i}",
                 rng.choice(["", "", "", "blank", "truncated", "duplicate"])) for i in range(rng.randint(0, 9))]
        if trial % 3 == 0:              # long runs
            rows = [r for r in rows for _ in range(rng.randint(1, 6))]
        runs = []
        for role, _, fault in rows:
            sym = R.symbol(role, fault)
            if runs and runs[-1][0] == sym:
                runs[-1] = (sym, runs[-1][1] + 1)
            else:
                runs.append((sym, 1))
        edits, state = R.unroll(runs, R.AT_END, 0)
        edits += R.closing(state)
        want = least_edits(rows)
        assert (R._cost(edits, runs), edits) == want[:2], rows
        assert tuple(R.apply_edits(edits, iter([r[:2] for r in rows]), 0)) == want[2]
        costs = R.before(R.matrix_of(runs), R.AT_END)
        assert costs[0] == want[0]
        cut = rng.randint(0, len(runs))
        assert R.times(R.matrix_of(runs[:cut]), R.matrix_of(runs[cut:])) == R.matrix_of(runs)


def test_powers_reach_any_length():
    assert R.run_before("u", 10 ** 15, R.AT_END)[0] == 10 ** 15
    edits, state = R.unroll([("u", 1 << 20)], R.AT_END, 0)
    assert edits + R.closing(state) == "KR" * (1 << 19)


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert found(REGISTRY["op11_repair"](spark, SF)) == {k: expected(v) for k, v in damage(rows).items()}


@pytest.mark.parametrize("piece_rows", [3, 2048])
def test_awkward_rows_in_many_pieces(spark, piece_rows):
    rng = random.Random(piece_rows)
    texts = ["Yes.", "No", " ", "", None, "Why?", "naïve é!", "x" * 50_000 + ".", "tab\t", "end.\n"]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 1, 2, 2, 5, 9, 40]), rng.choice(roles[:2] + roles),
             rng.choice(texts)) for _ in range(400)]
    rows += [(None, 7, "user", "same.")] * 300 + [(50, 0, "user", "only")] + [(51, t, "assistant", "ok.") for t in range(90)]
    df = spark.createDataFrame([(*r, "fp", 3, "z") for r in rows],
                               "conv_id long, turn long, role string, text string, conv string, n long, part string")
    made = R.repair(R.damaged(df), times_column="times", piece_rows=piece_rows)
    assert found(R.conversations_of(made)) == {k: expected(v) for k, v in damage(rows).items()}
    assert {r["conv_id"] for r in made.collect()} == {k for k, *_ in rows}


@pytest.fixture
def small_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_conversation_lies_in_many_tasks(spark, small_partitions):
    n = 30_000
    df = spark.range(n).selectExpr("cast(null as long) conv_id", "id % 10 turn",
                                   "case when id % 3 = 0 then 'assistant' else 'user' end role",
                                   "concat('text ', id, '.') text")
    cut = R.pieces(df)
    assert cut.select("part").distinct().count() > 4 and cut.count() > n / R.PIECE_ROWS
    got = found(R.conversations_of(R.repair(df)))
    rows = [(r["turn"], r["role"], r["text"]) for r in df.collect()]
    assert set(got) == {None}
    rows.sort()
    runs = []
    for _, role, _ in rows:
        if runs and runs[-1][0] == role[0]:
            runs[-1] = (role[0], runs[-1][1] + 1)
        else:
            runs.append((role[0], 1))
    edits, state = R.unroll(runs, R.AT_END, 0)
    assert got[None][6] == edits + R.closing(state)
    text = "\n".join(f"{r}:{t}" for r, t in R.apply_edits(got[None][6], iter([r[1:] for r in rows]), 0))
    assert got[None][7] == hashlib.sha256(text.encode()).hexdigest()


def test_empty_table_and_empty_conversation(spark):
    kinds = "conv_id string, turn int, role string, text string"
    assert found(R.conversations_of(R.repair(spark.createDataFrame([], kinds)))) == {}
    gone = spark.createDataFrame([("c", 1, "user", "x.")], kinds).selectExpr("*", "0 times")
    empty = hashlib.sha256(b"").hexdigest()
    assert found(R.conversations_of(R.repair(gone, "times"))) == {"c": (0, 0, 0, 0, 0, 0, "", empty)}
