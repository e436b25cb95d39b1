"""Chat formatting into budgeted windows, with DataFrame functions only.

Turns of a conversation are gathered in blocks of at most ``BLOCK`` rows whose turn numbers lie
in one range of ``BLOCK`` numbers, so that a conversation of any length is spread over many rows;
where turn numbers repeat, a range has several blocks. Inside a block, prefix sums of turn
tokens choose spans of whole turns that fill the budget. Every window starts with the
conversation's system turn and repeats up to ``history`` tokens of the turns before it (from
the block before, too); only assistant texts that a window shows for the first time are in
its loss mask, so each is learned once.

Template: ``<|turn|>ROLE<|text|>TEXT<|end|>`` and a line end. Backslashes are doubled and ``<|``
becomes ``<\\|`` inside roles and texts, so no text can hold a marker; ``unescape`` undoes it.

Defined cases: a null text or role is empty; a null turn number comes first; rows that repeat
a turn number are turns of their own, by role and text; a null conversation id is a
conversation; a turn longer than the budget has a window of its own; a system turn counts as
such only as the first turn; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
BUDGET, HISTORY, BLOCK = 1024, 256, 64
SYSTEM, ASSISTANT = "system", "assistant"
MARK_TOKENS = 4                      # tokens of a turn's markers and role
_TOKEN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\\")), F.regexp_replace(c, r"(?s)\\(.)", "$1")).otherwise(c)


def word_tokens(text: Column) -> Column:
    """Words, numbers and single signs: the default measure of a turn."""
    return F.regexp_count(text, F.lit(_TOKEN))


def _blocks(conversations: DataFrame, tokens: Callable[[Column], Column], block: int) -> DataFrame:
    """conv, conv_id, block (the range of turn numbers), sub (the block in it), turns: turns sorted,
    with role, text and tokens."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    number = F.coalesce(F.floor(F.col("turn") / F.lit(block)).cast("long"), F.lit(-(1 << 62)))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"),
                    (tokens(text) + MARK_TOKENS).cast("long").alias("tokens"))
    rows = conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null")).alias("conv"),
        "conv_id", number.alias("block"), turn.alias("t"))
    nth = F.row_number().over(Window.partitionBy("conv", "block").orderBy("t")) - 1
    return (rows.withColumn("sub", F.floor(nth / block).cast("int"))
            .groupBy("conv", "conv_id", "block", "sub").agg(F.array_sort(F.collect_list("t")).alias("turns")))


def _order(conversations: DataFrame, tokens: Callable[[Column], Column], block: int) -> DataFrame:
    """conv, block, begin (blocks of the conversation before this range), system (its system turn)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    number = F.coalesce(F.floor(F.col("turn") / F.lit(block)).cast("long"), F.lit(-(1 << 62)))
    first = F.min(F.struct(F.col("turn"), role.alias("role"),
                           F.when(role == SYSTEM, text).otherwise("").alias("text")))
    blocks = (conversations.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
        .alias("conv"), number.alias("block"), "turn", "role", "text")
        .groupBy("conv", "block").agg(first.alias("first"), F.ceil(F.count(F.lit(1)) / block).alias("subs")))
    by_block = Window.partitionBy("conv").orderBy("block")
    opening = F.first("first").over(by_block)
    return blocks.select(
        "conv", "block", (F.sum("subs").over(by_block) - F.col("subs")).alias("begin"),
        F.when(opening["role"] == SYSTEM, F.struct(
            opening["role"].alias("role"), opening["text"].alias("text"),
            (tokens(opening["text"]) + MARK_TOKENS).cast("long").alias("tokens"))).alias("system"))


def _running(turns: Column) -> Column:
    """Prefix sums of tokens: entry i is what stands before turn i; one entry more than turns."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(turns, zero, lambda acc, t: F.concat(
        acc, F.array(F.element_at(acc, -1) + t["tokens"])))


def _spans(budget: int, history: int) -> Column:
    """Windows (past, first, after) over the row's ``shown`` turns: history from ``past``, new
    turns from ``first``, the next window from ``after``. ``before`` has the prefix sums,
    ``skip`` the turns already shown by the block before, ``lead`` 1 if the first turn of
    all is the system turn."""
    before, skip, lead = F.col("before"), F.col("skip"), F.col("lead")
    span = "array<struct<past:int,first:int,used:bigint>>"

    def fit(windows, i):
        size = F.get(before, i + 1) - F.get(before, i)
        system = F.when(i < lead, F.lit(0).cast("long")).otherwise(F.col("system_tokens"))
        room = F.greatest(F.lit(0).cast("long"),
                          F.least(F.lit(history).cast("long"), budget - system - size))
        past = F.coalesce(F.array_min(F.filter(
            F.sequence(F.least(lead, i), i), lambda j: F.get(before, i) - F.get(before, j) <= room)), i)
        opened = F.struct(past.cast("int").alias("past"), i.cast("int").alias("first"),
                          (system + F.get(before, i + 1) - F.get(before, past)).alias("used"))
        last = F.try_element_at(windows, F.lit(-1))
        grown = F.struct(last["past"].alias("past"), last["first"].alias("first"),
                         (last["used"] + size).alias("used"))
        done = F.slice(windows, 1, F.greatest(F.size(windows) - 1, F.lit(0)))
        return F.when(last["used"] + size <= budget, F.concat(done, F.array(grown))
                      ).otherwise(F.concat(windows, F.array(opened)))

    return F.aggregate(F.sequence(skip, F.size("shown") - 1),
                       F.array().cast(span), fit)


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(TURN), escape(turn["role"]), F.lit(TEXT), escape(turn["text"]), F.lit(END))


def format_conversations(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY,
                         block: int = BLOCK,
                         tokens: Callable[[Column], Column] = word_tokens) -> DataFrame:
    """One row per window: conv_id, window (ascending in a conversation), n_context (turns
    shown before the new ones: the system turn and history), n_turns (new turns), n_tokens,
    text, loss (code point ranges, end exclusive)."""
    rows = _blocks(conversations, tokens, block).join(
        _order(conversations, tokens, block), ["conv", "block"]).withColumn("place", F.col("begin") + F.col("sub"))
    # the last turns of a block, at most ``history`` tokens, for the block after it
    suffix = F.filter(F.col("turns"), lambda t, i: (
        F.get(F.col("before"), F.size("turns")) - F.get(F.col("before"), i) <= history)
        & ~((F.col("place") == 0) & (i == 0) & F.col("system").isNotNull()))
    tails = (rows.withColumn("before", _running(F.col("turns")))
             .select("conv", (F.col("place") + 1).alias("place"), suffix.alias("tail"))
             .where(F.size("tail") > 0))
    rows = rows.join(tails, ["conv", "place"], "left")
    tail = F.coalesce("tail", F.slice("turns", 1, 0))
    rows = rows.select(
        "conv_id", "place", "system", F.concat(tail, "turns").alias("shown"),
        F.size(tail).alias("skip"),
        F.when((F.col("place") == 0) & F.col("system").isNotNull(), 1).otherwise(0).alias("lead"),
        F.coalesce(F.col("system.tokens"), F.lit(0).cast("long")).alias("system_tokens"))
    rows = rows.withColumn("before", _running(F.col("shown")))
    rows = rows.withColumn("spans", _spans(budget, history))
    # a block has a window at least; a plain posexplode would make the optimizer filter by the
    # size of ``spans``, worked out again from all that it is made of
    window = F.posexplode_outer("spans").alias("n", "span")
    rows = rows.select("*", window)
    after = F.coalesce(F.get(F.col("spans"), F.col("n") + 1)["first"], F.size("shown"))
    past, first = F.col("span.past"), F.col("span.first")
    again = F.when(F.col("system").isNotNull() & (first >= F.col("lead")) &
                   ~((F.col("lead") == 1) & (first == 0)), F.array("system")).otherwise(
                       F.slice(F.array("system"), 1, 0))
    plain = F.transform(F.slice("shown", past + 1, after - past),
                        lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"),
                                           t["tokens"].alias("tokens")))
    rows = rows.select(
        "conv_id", (F.col("place").cast("long") * (1 << 20) + F.col("n")).alias("window"),
        (F.size(again) + first - past).alias("n_context"), (after - first).alias("n_turns"),
        F.col("span.used").alias("n_tokens"), F.concat(again, plain).alias("turns"))
    parts = F.transform("turns", _rendered)
    rows = rows.withColumn("parts", parts)
    # where each part starts
    starts = F.aggregate("parts", F.array(F.lit(0)), lambda acc, p: F.concat(
        acc, F.array(F.element_at(acc, -1) + F.length(p))))
    rows = rows.withColumn("starts", starts)
    span = F.transform("turns", lambda t, i: F.when(
        (i >= F.col("n_context")) & (t["role"] == ASSISTANT),
        F.struct((F.get("starts", i) + len(TURN) + F.length(escape(t["role"])) + len(TEXT))
                 .cast("long").alias("start"),
                 (F.get("starts", i + 1) - len(END)).cast("long").alias("end"))))
    return rows.select("conv_id", "window", F.col("n_context").cast("long").alias("n_context"),
                       F.col("n_turns").cast("long").alias("n_turns"), "n_tokens",
                       F.array_join("parts", "").alias("text"), F.array_compact(span).alias("loss"))


def parse_turns(text: Column) -> Column:
    """Turns (role, text) of a formatted text, unescaped."""
    def turn(parts):
        return F.struct(unescape(parts[0]).alias("role"),
                        unescape(F.left(parts[1], F.length(parts[1]) - len(END))).alias("text"))

    pieces = F.filter(F.split(text, r"<\|turn\|>"), lambda p: p != "")
    return F.transform(F.transform(pieces, lambda p: F.split(p, r"<\|text\|>")), turn)


def masked_texts(text: str, loss: str) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(loss, lambda s: unescape(F.substr(
        F.col(text), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
