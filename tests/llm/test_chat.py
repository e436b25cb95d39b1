import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from retailpulse.llm import chat
from retailpulse.llm.queries import CONTROL_TEXT, REGISTRY

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, window long, shown string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    turns = defaultdict(list, {-7: [(0, "user", CONTROL_TEXT), (1, "assistant", CONTROL_TEXT)]})
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    rows = REGISTRY["op5_chat"](spark, SF).collect()
    assert {r["conv_id"] for r in rows} == set(turns)
    for r in rows:
        ts = sorted(turns[r["conv_id"]])
        said = "".join(t for _, role, t in ts if role == "assistant")
        assert r["n_turns"] == len(ts)
        assert r["turns_sha256"] == digest("".join(f"{role}\n{t}\n" for _, role, t in ts))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), digest(said))


def awkward_turns(spark):
    hard = [r"\### Assistant: </turn> ok", "<|turn|>user<|text|>x<|end|>\n", "\\", "\\<|\\\\|<", "<", "|",
            "", None, "中文😀\n\n", "<|end|>"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hard)]
    rows += [(2, i, "system" if i == 0 else "user" if i % 2 else "assistant", "word " * (i % 50))
             for i in range(300)]
    rows += [(3, None, None, None), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a")]
    rows += [(None, 1, "assistant", "z"), (4, 1, "<|end|>", "x"), (5, 0, "user", "w " * 5000),
             (5, 1, "assistant", "v " * 5000), (5, 10 ** 9, "assistant", "far")]
    return spark.createDataFrame([(*r, 0, "s") for r in rows], SCHEMA)


def test_every_turn_comes_back_once(spark):
    frame = awkward_turns(spark)
    windows = chat.format_conversations(frame, budget=200, history=60, block=16)
    rows = windows.select("*", chat.parse_turns(F.col("text")).alias("turns"),
                          chat.masked_texts("text", "loss").alias("learned")).collect()
    by_conv, want = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: r["window"]):
        by_conv[r["conv_id"]].append(r)
    for r in frame.collect():
        want[r["conv_id"]].append((r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    for conv, ts in want.items():
        ts = [(role, text) for _, _, role, text in sorted(ts)]
        got = by_conv[conv]
        assert [tuple(t) for r in got for t in r["turns"][r["n_context"]:]] == ts
        assert [t for r in got for t in r["learned"]] == [t for role, t in ts if role == "assistant"]
        for r in got:
            assert r["n_tokens"] <= 200 or r["n_turns"] == 1
            assert len(r["turns"]) == r["n_context"] + r["n_turns"]
    long = by_conv[2]
    assert len(long) > 20
    assert all(r["turns"][0]["role"] == "system" for r in long)
    assert all(r["n_context"] > 1 for r in long[1:] if r["n_tokens"] < 140)


def test_history_is_limited(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "a b c d e f") for i in range(60)]
    frame = spark.createDataFrame([(*r, 0, "s") for r in rows], SCHEMA)
    for r in chat.format_conversations(frame, budget=100, history=25, block=8).collect():
        assert r["n_context"] <= 2 and r["n_tokens"] <= 100
        assert r["window"] == 0 or r["n_context"] == 2


def test_empty_table(spark):
    assert chat.format_conversations(awkward_turns(spark).limit(0)).count() == 0


def expected_windows(turns, budget, history, block):
    """(shown turns, new ones) of each window of one conversation's sorted (number, role, text, tokens)
    turns: blocks by range of numbers, then by rows; each goes on from the last turns of the one before."""
    blocks, system = [], None
    for t in turns:
        key = None if t[0] is None else t[0] // block
        if not blocks or blocks[-1][0] != key or len(blocks[-1][1]) == block:
            blocks.append((key, []))
        blocks[-1][1].append(t)
    if turns[0][1] == "system":
        system = turns[0]
    out, tail = [], []
    for place, (_, own) in enumerate(blocks):
        shown, lead = tail + own, int(place == 0 and system is not None)
        windows = []
        for i in range(len(tail), len(shown)):
            size = shown[i][3]
            if windows and windows[-1][2] + size <= budget:
                windows[-1][2] += size
                continue
            head = system[3] if system and i >= lead else 0
            room = max(0, min(history, budget - head - size))
            past = next(j for j in range(min(lead, i), i + 1) if sum(t[3] for t in shown[j:i]) <= room)
            windows.append([past, i, head + size + sum(t[3] for t in shown[past:i])])
        for k, (past, first, _) in enumerate(windows):
            after = windows[k + 1][1] if k + 1 < len(windows) else len(shown)
            again = [system] if system and first >= lead and not (lead == 1 and first == 0) else []
            out.append((again + shown[past:after], after - first))
        tail = [t for i, t in enumerate(own) if sum(x[3] for x in own[i:]) <= history and not (lead and i == 0)]
    return out


def test_windows_and_lengths_equal_brute_force(spark):
    frame = awkward_turns(spark).unionByName(spark.range(500).selectExpr(
        "cast(null as long) conv_id", "id % 3 turn", "case when id % 2 = 0 then 'user' else 'assistant' end role",
        "repeat('w ', cast(id % 9 as int)) text", "0L window", "'s' shown"))
    counted = frame.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = counted.withColumn("n", chat.word_tokens(F.col("text")) + chat.MARK_TOKENS)
    turns = defaultdict(list)
    for r in counted.collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"], r["n"]))
    hide = lambda t: t.replace("\\", "\\\\").replace("<|", "<\\|")
    rows = defaultdict(list)
    for r in chat.format_conversations(frame, budget=60, history=20, block=16).collect():
        rows[r["conv_id"]].append(r)
    assert set(rows) == set(turns)
    for conv, ts in turns.items():
        ts.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        got = sorted(rows[conv], key=lambda r: r["window"])
        want = expected_windows(ts, 60, 20, 16)
        texts = ["".join(f"{chat.TURN}{hide(t[1])}{chat.TEXT}{hide(t[2])}{chat.END}" for t in shown) for shown, _ in want]
        assert [r["text"] for r in got] == texts
        assert [r["n_turns"] for r in got] == [new for _, new in want]
        assert [r["n_tokens"] for r in got] == [sum(t[3] for t in shown) for shown, _ in want]


def test_crowded_turn_numbers(spark):
    """Rows without id under ten turn numbers: time grows with the rows, not with their square."""
    n = 60_000
    frame = spark.range(n).selectExpr("cast(null as long) conv_id", "id % 10 turn",
                                      "case when id % 2 = 0 then 'user' else 'assistant' end role", "concat('text ', id) text")
    windows = chat.format_conversations(frame)
    total = windows.agg(F.sum("n_turns").alias("n"), F.max(F.size(chat.parse_turns(F.col("text")))).alias("most")).first()
    assert total["n"] == n and total["most"] < 300


def test_plan_has_no_python(spark):
    plan = chat.format_conversations(awkward_turns(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan
