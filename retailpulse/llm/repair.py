"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A well-formed conversation has role initials ``(s?(ua)+)?``: perhaps a system turn, then
pairs of user and assistant. Edits: K keeps a row (0), R gives it the role user or assistant
(2), D deletes it (3; the only edit of blank and duplicate rows), I inserts an empty user or
assistant turn (2); a truncated row that stays adds 1. Of equally cheap edits the ones whose
initials read least in ASCII are taken.

Run-length dynamic programme over four states (nothing yet, after s, after u, after a): equal
consecutive role and fault symbols are one run, which moves the vector of costs by the cached
binary powers of the symbol's min-plus transition; the choices inside a run are unrolled by
halves, remembered by (symbol, length, state, costs behind), so a run of any length takes a
logarithm of steps besides writing its edits.

On Spark, equal rows of a conversation first become one row with a count; all rows are then
sorted by range, so that one conversation may lie in many tasks, and cut into pieces of at
most ``PIECE_ROWS`` rows. A piece that holds a whole conversation is solved alone. A piece of
a conversation that goes on elsewhere gives its min-plus matrix; costs run backward and states
forward over the pieces' few numbers, and every piece is then unrolled on its own.

Defined cases:
* null roles and texts are one space (so such a text is blank, such a role can't be kept); an
  empty role can't be kept either;
* null turns come first; rows of equal turn are ordered by role, then text; a null id is an
  id like any other, and so are ids of any type;
* equal rows (same turn, role and text) are duplicates of the first of them;
* other columns are ignored, whatever their names; an empty table gives no rows; a
  conversation of which no row is left has no edits and is well formed.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import scratch_path
from .common import short_batches, written

PIECE_ROWS = 2048            # rows of a piece at most, equal rows counted once
PIECE_CHARS = 1 << 21        # and characters of their texts, unless one row has more

INF = 1 << 60
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
CUT_OFF = 1
_NEXT = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
_WANTED = "uuau"             # the inserted or given initial, by state
_ROLES = {"u": "user", "a": "assistant"}
_STOPS = ".!?"
_SPACES = " \t\n\x0b\x0c\r"

Costs = tuple[int, int, int, int]
AT_END: Costs = (0, 4, 2, 0)            # cheapest inserts from each state to a whole pair
GONE = "d"                              # symbol of a row that must be deleted


def symbol(role: str, fault: str) -> str:
    """Symbol of a row: its initial (x: none that may stay), doubled if the text is cut off."""
    if fault in ("blank", "duplicate"):
        return GONE
    initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
    return initial + initial if fault == "truncated" else initial


def _steps(sym: str, state: int) -> list[tuple[str, int, int]]:
    """Edits that use up a row of the symbol in the state: (edit, cost, next state)."""
    out = [("D", DELETE, state)]
    if sym != GONE:
        extra = CUT_OFF if len(sym) == 2 else 0
        after = _NEXT.get(sym[0], {}).get(state)
        if after is not None:
            out.append(("K", KEEP + extra, after))
        out.append(("R", REROLE + extra, _NEXT[_WANTED[state]][state]))
    return out


Matrix = tuple[tuple[int, ...], ...]
ONE: Matrix = tuple(tuple(0 if i == j else INF for j in range(4)) for i in range(4))


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    columns = list(zip(*b))
    return tuple(tuple(min(INF, min(x + y for x, y in zip(row, col))) for col in columns) for row in a)


def before(m: Matrix, costs: Costs) -> Costs:
    """Costs in front of what the matrix describes, from the costs behind it."""
    return tuple(min(x + y for x, y in zip(row, costs)) for row in m)


@functools.cache
def power(sym: str, k: int) -> Matrix:
    """Transition of 2^k rows of the symbol: [state before][state after] -> least cost."""
    if k:
        return times(power(sym, k - 1), power(sym, k - 1))
    rows = []
    for state in range(4):
        row, at, paid = [INF] * 4, state, 0
        for _ in range(4):              # inserts in front of the row lead round the states
            for _, cost, after in _steps(sym, at):
                row[after] = min(row[after], paid + cost)
            at, paid = _NEXT[_WANTED[at]][at], paid + INSERT
        rows.append(tuple(row))
    return tuple(rows)


def _bits(length: int) -> Iterator[int]:
    while length:
        yield (length & -length).bit_length() - 1
        length &= length - 1


def run_before(sym: str, length: int, costs: Costs) -> Costs:
    for k in _bits(length):
        costs = before(power(sym, k), costs)
    return costs


def matrix_of(runs: list[tuple[str, int]]) -> Matrix:
    out = ONE
    for sym, length in runs:
        for k in _bits(length):
            out = times(out, power(sym, k))
    return out


@functools.lru_cache(maxsize=1 << 16)
def _unroll(sym: str, k: int, state: int, behind: Costs) -> tuple[str, int]:
    """Least edits of 2^k rows and the state after them; ``behind`` has 0 as its least cost."""
    if k:
        first, mid = _unroll(sym, k - 1, state, _level(before(power(sym, k - 1), behind)))
        second, end = _unroll(sym, k - 1, mid, behind)
        return first + second, end
    edits = ""
    while True:
        here = before(power(sym, 0), behind)[state]
        steps = {e: (cost, after) for e, cost, after in _steps(sym, state)}
        for edit in "DIKR":
            if edit == "I":
                after = _NEXT[_WANTED[state]][state]
                if INSERT + before(power(sym, 0), behind)[after] == here:
                    edits, state = edits + "I", after
                    break
            elif edit in steps and steps[edit][0] + behind[steps[edit][1]] == here:
                return edits + edit, steps[edit][1]


def _level(costs: Costs) -> Costs:
    least = min(costs)
    return tuple(c - least for c in costs)


def unroll(runs: list[tuple[str, int]], behind: Costs, state: int) -> tuple[str, int]:
    """Edits of the runs (no inserts after the last row) and the state after them."""
    behinds = []
    for sym, length in reversed(runs):
        parts = []
        for k in _bits(length):         # the shortest power is the last part of the run
            parts.append((k, _level(behind)))
            behind = before(power(sym, k), behind)
        behinds.append((sym, parts))
    edits = []
    for sym, parts in reversed(behinds):
        for k, costs in reversed(parts):
            text, state = _unroll(sym, k, state, costs)
            edits.append(text)
    return "".join(edits), state


def closing(state: int) -> str:
    return "I" * (AT_END[state] // INSERT)


def apply_edits(edits: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[tuple[str, str]]:
    """Repaired (role, text) rows."""
    for edit in edits:
        if edit == "I":
            role, text = _ROLES[_WANTED[state]], ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role = _ROLES[_WANTED[state]]
        yield role, text
        state = _NEXT[role[0]][state]


# Pieces of sorted rows ----------------------------------------------------------------

def _fault(text: str) -> str:
    found = text.rstrip(_SPACES)
    if not found:
        return "blank"
    return "" if found[-1] in _STOPS else "truncated"


def key_of(role: str, text: str) -> bytes:
    """128 bits that stand for a row's role and text among the rows of a conversation."""
    return hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def solve(roles: list[str], texts: list[str], counts: list[int], fresh: set[bytes] | None = None):
    """Runs of symbols and counts of faults of one piece. ``fresh``: keys that no earlier piece
    of the conversation has; None: there is no earlier piece."""
    runs: list[tuple[str, int]] = []
    found = {"blank": 0, "duplicate": 0, "truncated": 0}
    seen: set = set()
    illegal, last = 0, None

    def add(sym: str, n: int) -> None:
        if runs and runs[-1][0] == sym:
            runs[-1] = (sym, runs[-1][1] + n)
        else:
            runs.append((sym, n))

    for role, text, n in zip(roles, texts, counts):
        fault = _fault(text)
        if fault == "blank":
            found["blank"] += n
            add(GONE, n)
        else:
            key = (role, text)
            again = key in seen or (fresh is not None and key_of(role, text) not in fresh)
            seen.add(key)
            kept = 0 if again else 1
            if kept:
                if fault:
                    found[fault] += 1
                add(symbol(role, fault), 1)
            if n > kept:
                found["duplicate"] += n - kept
                add(GONE, n - kept)
        initial = role[:1]
        if last is not None and last + initial not in ("su", "ua", "au"):
            illegal += 1
        illegal += n - 1
        last = initial
    return runs, found, illegal


_PIECE = [("part", T.IntegerType()), ("seq", T.IntegerType()), ("alone", T.BooleanType()),
          ("roles", T.ArrayType(T.StringType())), ("texts", T.ArrayType(T.StringType())),
          ("counts", T.ArrayType(T.LongType())), ("first_turn", T.LongType()),
          ("last_turn", T.LongType()), ("turns", T.LongType())]


def _pieces(batches: Iterator[pa.RecordBatch], piece_rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, turn, role, text, n) to pieces of conversations. A partition's first
    and last conversation may go on in its neighbours, so they are not ``alone``."""
    from pyspark import TaskContext

    part, schema = TaskContext.get().partitionId(), None
    held: dict | None = None
    ready: list[dict] = []
    seq, n_convs = 0, 0

    def piece(conv) -> dict:
        return {"conv": conv, "part": part, "seq": seq, "alone": n_convs > 1, "roles": [], "texts": [],
                "counts": [], "first_turn": None, "last_turn": None, "turns": 0}

    def out():
        cols = {f.name: pa.array([p[f.name] for p in ready], type=f.type) for f in schema}
        ready.clear()
        return pa.RecordBatch.from_pydict(cols, schema=schema)

    chars = ready_chars = 0
    for batch in batches:
        if schema is None:
            kinds = T.StructType([T.StructField(n, t) for n, t in _PIECE])
            from pyspark.sql.pandas.types import to_arrow_schema
            schema = pa.schema([batch.schema.field("conv"), *to_arrow_schema(kinds)])
        for conv, turn, role, text, n in zip(*(batch.column(c).to_pylist() for c in
                                               ("conv", "turn", "role", "text", "n"))):
            if held is None or held["conv"] != conv:
                if held is not None:
                    ready.append(held)
                    ready_chars += chars
                n_convs, chars = n_convs + 1, 0
                held = piece(conv)
                seq += 1
            elif len(held["roles"]) >= piece_rows or chars + len(text) > PIECE_CHARS:
                held["alone"] = False
                ready.append(held)
                ready_chars, chars = ready_chars + chars, 0
                held = piece(conv)
                held["alone"] = False
                seq += 1
            if n:
                held["roles"].append(role)
                held["texts"].append(text)
                held["counts"].append(n)
                chars += len(text)
                if turn is not None:
                    if held["turns"] == 0:
                        held["first_turn"] = turn
                    held["turns"] += held["last_turn"] != turn
                    held["last_turn"] = turn
            if len(ready) >= 512 or ready_chars > PIECE_CHARS:
                yield out()
                ready_chars = 0
    if held is not None:
        held["alone"] = False
        ready.append(held)
        yield out()


_SOLVED = ("blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "roles array<string>, texts array<string>, first_turn long, last_turn long, turns long, "
           "first_role string, last_role string")


def _solved(conv_type: pa.Field):
    """Arrow schema of solved pieces."""
    text, number, many = pa.string(), pa.int64(), pa.list_(pa.string())
    kinds = {"string": text, "long": number, "array<string>": many}
    fields = [pa.field(*(lambda n, t: (n, kinds[t]))(*f.split(" "))) for f in _SOLVED.split(", ")]
    return pa.schema([conv_type, pa.field("part", pa.int32()), pa.field("seq", pa.int32()), *fields])


def _expanded(roles, texts, counts) -> Iterator[tuple[str, str]]:
    for role, text, n in zip(roles, texts, counts):
        for _ in range(n):
            yield role, text


def _cost(edits: str, runs: list[tuple[str, int]]) -> int:
    """Cost of the edits of the runs."""
    rows = iter(runs)
    sym, left, cost, at = "", 0, 0, 0
    while at < len(edits):
        edit = edits[at]
        if edit == "I":
            cost, at = cost + INSERT, at + 1
            continue
        if not left:
            sym, left = next(rows)
        end = at
        while end < len(edits) and edits[end] == edit and end - at < left:
            end += 1
        each = {"D": DELETE, "K": KEEP, "R": REROLE}[edit]
        if edit != "D" and len(sym) == 2:
            each += CUT_OFF
        cost += each * (end - at)
        left, at = left - (end - at), end
    return cost


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces to audits and repaired rows. Column ``fresh`` (keys), ``state`` and ``behind`` say
    what lies around a piece; where they are missing a piece is a whole conversation."""
    for batch in batches:
        around = "behind" in batch.schema.names
        schema = _solved(batch.schema.field("conv"))
        out = {f.name: [] for f in schema}
        for p in batch.to_pylist():
            fresh = set(p["fresh"] or ()) if around else None
            runs, found, illegal = solve(p["roles"], p["texts"], p["counts"], fresh)
            state, behind = (p["state"], tuple(p["behind"])) if around else (0, AT_END)
            edits, after = unroll(runs, behind, state)
            if not around or p["final"]:
                edits += closing(after)
            rows = list(apply_edits(edits, _expanded(p["roles"], p["texts"], p["counts"]), state))
            p |= found | {"illegal": illegal, "cost": _cost(edits, runs), "audit": edits,
                          "first_role": p["roles"][0] if p["roles"] else None,
                          "last_role": p["roles"][-1] if p["roles"] else None,
                          "roles": [r for r, _ in rows], "texts": [t for _, t in rows]}
            for name, column in out.items():
                column.append(p[name])
        yield pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], type=f.type) for f in schema},
                                         schema=schema)


def _piece_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each distinct key of a piece that is no blank row."""
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv"), pa.field("at", pa.int64()), pa.field("key", pa.binary())])
        out: dict = {"conv": [], "at": [], "key": []}
        for p in batch.to_pylist():
            keys = {key_of(r, t) for r, t in zip(p["roles"], p["texts"]) if _fault(t) != "blank"}
            out["conv"] += [p["conv"]] * len(keys)
            out["at"] += [p["at"]] * len(keys)
            out["key"] += keys
        yield pa.RecordBatch.from_pydict(
            {f.name: pa.array(out[f.name], type=f.type) for f in schema}, schema=schema)


def _piece_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The min-plus matrix of each piece and its runs, as JSON."""
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv"), pa.field("at", pa.int64()),
                            pa.field("runs", pa.string()), pa.field("matrix", pa.list_(pa.int64()))])
        out: dict = {"conv": [], "at": [], "runs": [], "matrix": []}
        for p in batch.to_pylist():
            runs, _, _ = solve(p["roles"], p["texts"], p["counts"], set(p["fresh"] or ()))
            out["conv"].append(p["conv"])
            out["at"].append(p["at"])
            out["runs"].append(json.dumps(runs))
            out["matrix"].append([x for row in matrix_of(runs) for x in row])
        yield pa.RecordBatch.from_pydict(
            {f.name: pa.array(out[f.name], type=f.type) for f in schema}, schema=schema)


def _scan_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation, last first: the costs behind each, and where each of the four
    states leads through it."""
    conv, costs = (), AT_END
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv"), pa.field("at", pa.int64()),
                            pa.field("behind", pa.list_(pa.int64())), pa.field("leads", pa.list_(pa.int64())),
                            pa.field("final", pa.bool_())])
        out: dict = {f.name: [] for f in schema}
        for p in batch.to_pylist():
            final = conv == () or p["conv"] != conv[0]
            if final:
                conv, costs = (p["conv"],), AT_END
            runs = [(s, n) for s, n in json.loads(p["runs"])]
            out["conv"].append(p["conv"])
            out["at"].append(p["at"])
            out["behind"].append(list(costs))
            out["leads"].append([unroll(runs, costs, s)[1] for s in range(4)])
            out["final"].append(final)
            costs = _level(before(tuple(zip(*[iter(p["matrix"])] * 4)), costs))
        yield pa.RecordBatch.from_pydict(
            {f.name: pa.array(out[f.name], type=f.type) for f in schema}, schema=schema)


def _scan_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation in order: the state in front of each."""
    conv, state = (), 0
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv"), pa.field("at", pa.int64()), pa.field("state", pa.int32())])
        out: dict = {f.name: [] for f in schema}
        for p in batch.to_pylist():
            if conv == () or p["conv"] != conv[0]:
                conv, state = (p["conv"],), 0
            out["conv"].append(p["conv"])
            out["at"].append(p["at"])
            out["state"].append(state)
            state = p["leads"][state]
        yield pa.RecordBatch.from_pydict(
            {f.name: pa.array(out[f.name], type=f.type) for f in schema}, schema=schema)


def pieces(turns: DataFrame, times_column: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Sorted pieces of the conversations, as a written table (see ``_PIECE``)."""
    spark = turns.sparkSession
    short_batches(spark)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    n = F.col(f"`{times_column}`").cast("long") if times_column else F.lit(1).cast("long")
    rows = turns.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        blank("role").alias("role"), blank("text").alias("text"), n.alias("n"))
    left = F.col("n") > 0
    rows = rows.select("conv", F.when(left, F.col("turn")).alias("turn"), F.when(left, F.col("role")).alias("role"),
                       F.when(left, F.col("text")).alias("text"), "n")
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kinds = T.StructType([T.StructField("conv", turns.schema["conv_id"].dataType),
                          *[T.StructField(n, t) for n, t in _PIECE]])
    path = scratch_path(spark, "repair-pieces")
    rows.mapInArrow(functools.partial(_pieces, piece_rows=piece_rows), kinds).write.partitionBy("alone").parquet(path)
    return spark.read.schema(kinds).parquet(path)


def repair(turns: DataFrame, times_column: str | None = None, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repaired pieces of conversations from rows conv_id, turn, role, text. ``times_column``
    names a column that says how often a row occurs (0: it is gone, its conversation is not).

    One row per piece: conv_id, part and seq (its order in the conversation), blank, duplicate,
    truncated, illegal, cost (of the piece), audit (edits), roles and texts (repaired rows),
    first_turn, last_turn, turns (distinct ones of the piece), first_role, last_role (before),
    whole (the piece is a whole conversation)."""
    cut = pieces(turns, times_column, piece_rows)
    conv_type = cut.schema["conv"].dataType
    solved = f"conv {conv_type.simpleString()}, part int, seq int, {_SOLVED}"
    alone = cut.where("alone").mapInArrow(_solve_pieces, solved)

    at = (F.col("part").cast("long") * (1 << 32) + F.col("seq")).alias("at")
    rest = cut.where("not alone").withColumn("at", at)
    keys = rest.select("conv", "at", "roles", "texts").mapInArrow(
        _piece_keys, f"conv {conv_type.simpleString()}, at long, key binary")
    first = keys.groupBy("conv", "key").agg(F.min("at").alias("at"))
    fresh = first.groupBy(F.col("conv").alias("f_conv"), F.col("at").alias("f_at")).agg(
        F.collect_list("key").alias("fresh"))
    same = lambda a, b, c, d: F.col(a).eqNullSafe(F.col(b)) & (F.col(c) == F.col(d))
    rest = written(rest.join(fresh, same("conv", "f_conv", "at", "f_at"), "left").drop("f_conv", "f_at"),
                   "repair-rest")
    kind = conv_type.simpleString()
    matrices = rest.select("conv", "at", "roles", "texts", "counts", "fresh").mapInArrow(
        _piece_matrices, f"conv {kind}, at long, runs string, matrix array<long>")
    backward = matrices.repartition("conv").sortWithinPartitions("conv", F.col("at").desc()).mapInArrow(
        _scan_back, f"conv {kind}, at long, behind array<long>, leads array<long>, final boolean")
    backward = written(backward, "repair-costs")
    forward = backward.select("conv", "at", "leads").repartition("conv").sortWithinPartitions(
        "conv", "at").mapInArrow(_scan_forward, f"conv {kind}, at long, state int")
    around = backward.drop("leads").join(
        forward.select(F.col("conv").alias("f_conv"), F.col("at").alias("f_at"), "state"),
        same("conv", "f_conv", "at", "f_at")).drop("f_conv", "f_at")
    around = around.select(F.col("conv").alias("f_conv"), F.col("at").alias("f_at"), "behind", "final", "state")
    split = rest.join(around, same("conv", "f_conv", "at", "f_at")).drop("f_conv", "f_at", "at")
    out = alone.withColumn("whole", F.lit(True)).unionByName(
        split.mapInArrow(_solve_pieces, solved).withColumn("whole", F.lit(False)))
    return out.withColumnRenamed("conv", "conv_id")


_SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string, n_repaired long")


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to one row per conversation; a piece is hashed as it passes."""
    schema, held, conv = None, None, ()
    ready: list[dict] = []

    def finish(h: dict) -> dict:
        turns = h["last_turn"] - h["first_turn"] + 1 - h["turns"] if h["turns"] else 0
        return h | {"gaps": turns, "audit": "".join(h["audits"]), "repaired_sha256": h["hash"].hexdigest()}

    def out():
        batch = pa.RecordBatch.from_pydict(
            {f.name: pa.array([r[f.name] for r in ready], type=f.type) for f in schema}, schema=schema)
        ready.clear()
        return batch

    for batch in batches:
        if schema is None:
            number, text = pa.int64(), pa.string()
            schema = pa.schema([batch.schema.field("conv_id"), *[
                pa.field(f.split(" ")[0], text if f.endswith("string") else number)
                for f in _SUMMARY.split(", ")]])
        for p in batch.to_pylist():
            if held is None or conv[0] != p["conv_id"]:
                if held is not None:
                    ready.append(finish(held))
                conv = (p["conv_id"],)
                held = {"conv_id": p["conv_id"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0,
                        "cost": 0, "audits": [], "hash": hashlib.sha256(), "n_repaired": 0,
                        "first_turn": None, "last_turn": None, "turns": 0, "last_role": None}
            for name in ("blank", "duplicate", "truncated", "illegal", "cost", "turns"):
                held[name] += p[name]
            held["audits"].append(p["audit"])
            if p["first_role"] is not None:
                if held["last_role"] is not None:
                    held["illegal"] += held["last_role"][:1] + p["first_role"][:1] not in ("su", "ua", "au")
                held["last_role"] = p["last_role"]
            if p["first_turn"] is not None:
                held["turns"] -= held["last_turn"] == p["first_turn"]
                held["first_turn"] = p["first_turn"] if held["first_turn"] is None else held["first_turn"]
                held["last_turn"] = p["last_turn"]
            for role, text in zip(p["roles"], p["texts"]):
                lead = "\n" if held["n_repaired"] else ""
                held["hash"].update(f"{lead}{role}:{text}".encode("utf-8", "surrogatepass"))
                held["n_repaired"] += 1
            if len(ready) >= 1024:
                yield out()
    if held is not None:
        ready.append(finish(held))
        yield out()


def conversations_of(repaired: DataFrame) -> DataFrame:
    """One row per conversation from its repaired pieces: conv_id, gaps (turn numbers missing
    between the least and the largest), blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of ``role:text`` rows joined by line ends) and n_repaired."""
    kind = repaired.schema["conv_id"].dataType.simpleString()
    split = repaired.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return repaired.where("whole").unionByName(split).mapInArrow(_summaries, f"conv_id {kind}, {_SUMMARY}")


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` with faults set by crc32 of ``conv_id:turn`` modulo 20 and a column
    ``times``: 0 drops a row (times 0), 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3
    repeats it (times 2), 4 makes it the user's. Nulls count as one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")), F.lit(20))
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"),
                        kind.alias("kind"))
    text = (F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    often = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), often.alias("times"))
