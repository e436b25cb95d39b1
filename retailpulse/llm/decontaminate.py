"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised words of the items build one automaton; the words of every document stream
through it, and the state always stands for the longest run of words that ends here and
occurs in some item. A run of ``window`` words (13) is a contaminated window; an item of
fewer words is one window as a whole. The automaton lives in the worker process; the items
it is built from are cut into pieces that share a window less one word and dealt into shards
of a bounded number of bytes, a written table; each shard is broadcast and streamed over in a
pass of its own and freed after it, so an arbitrarily large benchmark only adds passes, and the
driver never holds more than one shard.

Defined cases: a null document or item has no words; repeated items count once for each id;
a null ``item_id`` is shown as an empty string; an empty benchmark hits nothing; an empty
table gives no rows; other columns are not read (``find_contamination``) or kept as they are
(``decontaminate``).
"""

from __future__ import annotations

import functools
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fresh, short_batches, utf8, written

WINDOW = 13
MIN_SHARE = 20                 # contaminated from 1/20 of the words on
SHARD_BYTES = 500_000          # item text in one automaton
PIECE_WORDS = 2_000            # windows of an item that go to one shard together
SPANS = "array<struct<first:long,last:long>>"

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32
    for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 text: digits, letters a-z and all beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        number = self.vocabulary.setdefault
        sequences = [(name, [number(w, len(self.vocabulary)) for w in ws])
                     for name, ws in items if ws]
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        by_length = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        # the state of the window-long suffix of each state that is long enough
        self.suffix = [0] * len(self.link)
        for s in by_length:
            if self.length[s] >= window:
                up = self.link[s]
                self.suffix[s] = self.suffix[up] if self.length[up] >= window else s
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, sequence in sequences:
            if len(sequence) < window:
                state = 0
                for word in sequence:
                    state = self.next[state][word]
                self.short.setdefault(state, []).append((len(sequence), name))
            else:
                state = length = 0
                for word in sequence:
                    state, length = self._step(state, length, word)
                    if length >= window:
                        self.items.setdefault(self.suffix[state], set()).add(name)
        # the nearest state on the suffix path, itself included, where a short item ends
        self.ends = [0] * len(self.link)
        for s in by_length:
            self.ends[s] = s if s in self.short else self.ends[self.link[s]]

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """The target of the edge, cloned unless it is exactly one word longer."""
        target = self.next[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = clone
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def _step(self, state: int, length: int, word: int) -> tuple[int, int]:
        while word not in self.next[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            length = self.length[state]
        return self.next[state][word], length + 1

    def scan(self, text: list[bytes], spans: list[tuple[int, int]], found: set[str]) -> None:
        """Adds the hit word ranges (disjoint, ascending) and the items they come from."""
        steps, window, step = self.next, self.window, self._step
        state = length = 0
        for i, word in enumerate(map(self.vocabulary.get, text)):
            if word is None:
                state = length = 0
                continue
            after = steps[state].get(word)
            if after is None:
                state, length = step(state, length, word)
            else:
                state, length = after, length + 1
            begin = i + 1
            if length >= window:
                begin -= window
                found |= self.items[self.suffix[state]]
            end = self.ends[state]
            while end > 0:
                for size, name in self.short[end]:
                    if size <= length:
                        found.add(name)
                        begin = min(begin, i + 1 - size)
                end = self.ends[self.link[end]]
            if begin <= i:
                add_span(spans, begin, i + 1)


def add_span(spans: list[tuple[int, int]], begin: int, end: int) -> None:
    """Joins a range whose end lies beyond all others."""
    while spans and begin <= spans[-1][1]:
        begin = min(begin, spans.pop()[0])
    spans.append((begin, end))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def _size(spans: list[tuple[int, int]]) -> int:
    return sum(b - a for a, b in spans)


@functools.lru_cache(maxsize=1)
def _automaton(items: tuple[tuple[str, str], ...], window: int) -> Automaton:
    return Automaton([(name, words(text.encode())) for name, text in items], window)


def item_pieces(benchmark: DataFrame, window: int, piece_words: int = PIECE_WORDS) -> DataFrame:
    """i, t (distinct): the items' words in pieces that share ``window`` - 1 words with the next
    one, so that every window of an item lies in one of its pieces."""
    def cut(batches):
        for batch in batches:
            names, texts = [], []
            for name, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                ws = words(text)
                for at in range(0, max(1, len(ws) - window + 1), piece_words):
                    names.append(name)
                    texts.append(b" ".join(ws[at:at + piece_words + window - 1]).decode())
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(texts, pa.string())],
                                  names=["i", "t"])

    short_batches(benchmark.sparkSession)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text")
    return items.mapInArrow(cut, "i string, t string").where("t != ''").distinct()


def dealt(benchmark: DataFrame, window: int, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, int]:
    """The pieces as a written table partitioned by ``shard``, and the number of shards, which
    follows the size of the benchmark."""
    pieces = item_pieces(benchmark, window, max(1, min(PIECE_WORDS, shard_bytes // 100)))
    pieces = written(pieces, "items")
    total = pieces.agg(F.sum(F.octet_length("t") + F.octet_length("i"))).first()[0] or 0
    n = max(1, math.ceil(1.5 * total / shard_bytes)) if total > shard_bytes else 1
    shard = F.pmod(F.xxhash64("i", "t"), F.lit(n)).cast("int")
    return written(pieces.withColumn("shard", shard).repartition("shard"), "shards",
                   partition_by=["shard"]), n


def shard_items(table: DataFrame, shard: int) -> tuple[tuple[str, str], ...]:
    """The pieces (id, words) of one shard, which is of bounded size."""
    return tuple(sorted((r["i"], r["t"]) for r in
                        table.where(F.col("shard") == shard).select("i", "t").collect()))


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, last in spans:
        out.append(text[at:places[first][0]])
        at = places[last - 1][1]
    return "".join(out) + text[at:]


def _scanned(rows: DataFrame, text: str, names: list[str], window: int, held=None,
             min_share: int | None = None, hits_only: bool = False) -> DataFrame:
    """rows with n_words, spans (word ranges) and item_ids under the given names, added to what
    the frame holds of the latter two. ``held`` is the broadcast shard to look for. With
    ``min_share`` the text stays, and loses the words of the spans unless these reach that
    share; else it goes. ``hits_only`` leaves out rows without a span."""
    short_batches(rows.sparkSession)
    n_words, spans, items = names
    span_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    given, more = tuple(rows.columns), spans in rows.columns
    kept = [c for c in given if c not in names and (c != text or min_share)]

    def scan(batches):
        automaton = _automaton(held.value, window) if held is not None else None
        for batch in batches:
            columns = dict(zip(given, batch.columns))
            counts, ranges, hits = [], [], []
            before = zip(columns[spans].to_pylist(), columns[items].to_pylist()) if more else None
            for t in utf8(columns[text]):
                ws = words(t)
                old_spans, old_items = next(before) if before else (None, None)
                here, found = [], set(old_items or [])
                if automaton is not None:
                    automaton.scan(ws, here, found)
                if old_spans:
                    here = merged(here + [(s["first"], s["last"]) for s in old_spans])
                counts.append(len(ws))
                ranges.append(here)
                hits.append(sorted(found))
            out = {c: columns[c] for c in kept}
            if min_share and any(ranges):
                out[text] = pa.array(
                    [without_words(t, r) if 0 < min_share * _size(r) < n else t for t, r, n
                     in zip(columns[text].to_pylist(), ranges, counts)], columns[text].type)
            out[n_words] = pa.array(counts, pa.int64())
            out[spans] = pa.array([[{"first": a, "last": b} for a, b in r] for r in ranges], span_type)
            out[items] = pa.array(hits, pa.list_(pa.string()))
            found_rows = pa.record_batch(list(out.values()), names=list(out))
            yield found_rows.filter(pa.array([bool(r) for r in ranges], pa.bool_())) \
                if hits_only else found_rows

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept]
    return rows.mapInArrow(scan, ", ".join([*fields, f"`{n_words}` long", f"`{spans}` {SPANS}",
                                            f"`{items}` array<string>"]))


def _passes(rows: DataFrame, text: str, benchmark: DataFrame, window: int, shard_bytes: int,
            min_share: int | None = None) -> DataFrame:
    """rows with n_words, spans and item_ids added last, under names that the frame does not
    have; the text as in ``_scanned``. One shard needs one pass. Of several, each is collected,
    broadcast, looked for and let go before the next; only the spans of a pass are written, and
    they meet their rows once at the end."""
    sc = rows.sparkSession.sparkContext
    *names, row = fresh(rows, "n_words", "spans", "item_ids", "row")
    table, n = dealt(benchmark, window, shard_bytes)
    if n == 1:
        return _scanned(rows, text, names, window, sc.broadcast(shard_items(table, 0)), min_share)
    _, spans, items = names
    rows = written(rows.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = None
    for k in range(n):
        held = sc.broadcast(shard_items(table, k))
        hits = written(_scanned(rows.select(row, text), text, names, window, held,
                                hits_only=True).drop(names[0]), "hits")
        held.destroy()
        found = hits if found is None else found.unionByName(hits)
    found = found.groupBy(f"`{row}`").agg(
        F.flatten(F.collect_list(f"`{spans}`")).alias(spans),
        F.array_distinct(F.flatten(F.collect_list(f"`{items}`"))).alias(items))
    joined = rows.join(found, row, "left").drop(row)
    return _scanned(joined, text, names, window, None, min_share)


def _n_hit(spans: str):
    return F.aggregate(F.col(f"`{spans}`"), F.lit(0).cast("long"),
                       lambda n, s: n + s["last"] - s["first"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       min_share: int = MIN_SHARE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), spans (word
    ranges, end exclusive), contaminated (hit words are 1 / ``min_share`` of all or more)."""
    out = _passes(docs.select("doc_id", "text"), "text", benchmark, window, shard_bytes)
    n_hit = _n_hit("spans")
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.size("item_ids").cast("long").alias("n_items"), "item_ids", "spans",
                      ((n_hit > 0) & (min_share * n_hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  min_share: int = MIN_SHARE, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Documents whose hit words reach the coverage limit go; from the others every run of
    words that reaches the length limit is cut out of ``text``. Columns stay."""
    rows = _passes(docs, "text", benchmark, window, shard_bytes, min_share)
    n_words, spans, _ = rows.columns[-3:]
    n_hit = _n_hit(spans)
    return (rows.where((n_hit == 0) | (min_share * n_hit < F.col(f"`{n_words}`")))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
