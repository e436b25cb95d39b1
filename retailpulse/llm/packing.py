"""Packing of whole documents into training sequences (best-fit decreasing).

Every task packs the documents of its partition as they stream by: overlong documents are
first cut into full windows, the remainders gather in a buffer of bounded size, and a full
buffer is packed longest piece first. A segment tree whose leaves are the remaining
capacities finds the tightest open window that still takes a piece. Nothing is shuffled and
no group is formed, so a hot source or many copies change nothing.

Windows that best fit leaves open are completed by cutting pieces of the emptiest open
window; the one window left over moves to the next buffer, and at the end of a partition it
is written as sequences of power-of-two lengths, so that only gaps of up to ``slack`` tokens
are ever padded.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; an
empty table gives no rows; a null ``doc_id`` stays null; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import pieces_of, short_batches, type_of
from .tokens import END_ID, default_tokenizer, encoder

WINDOW = 1024
BUFFER_PIECES = 8192
ROWS_OUT = 1000


class CapacityTree:
    """Open windows by remaining capacity; a node counts the windows below it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.at[capacity].append(window)
        self._add(capacity, 1)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return (capacity, window) with the least capacity >= need."""
        node, count = need + self.leaves, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.at[capacity].pop()


class Packer:
    """Packs the pieces of one partition. A piece is (doc_id, start, ids, doc_tokens); a packed
    sequence is a list of pieces."""

    def __init__(self, window: int, buffer: int, slack: int):
        self.window, self.buffer, self.slack = window, buffer, slack
        self.pieces: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray):
        n, cut = len(ids), len(ids) - len(ids) % self.window
        for start in range(0, cut, self.window):
            yield [(doc_id, start, ids[start:start + self.window], n)]
        if cut < n:
            self.pieces.append((doc_id, cut, ids[cut:].copy(), n))
            if len(self.pieces) >= self.buffer:
                yield from self.flush()

    def best_fit(self) -> list[list[tuple]]:
        self.pieces.sort(key=lambda piece: -len(piece[2]))
        tree, windows = CapacityTree(self.window), []
        for piece in self.pieces:
            size = len(piece[2])
            found = tree.take_tightest(size)
            if found is None:
                found = self.window, len(windows)
                windows.append([])
            windows[found[1]].append(piece)
            if found[0] > size:
                tree.put(found[0] - size, found[1])
        self.pieces = []
        return windows

    def flush(self):
        """Pack the buffer; at most one window's pieces stay in it."""
        free = lambda w: self.window - sum(len(p[2]) for p in w)
        short = []
        for w in self.best_fit():
            gap = free(w)
            if gap <= self.slack:
                yield w
            else:
                short.append((gap, w))
        short.sort(key=lambda x: x[0])
        windows = [w for _, w in short]
        first, last = 0, len(windows) - 1
        while first < last:
            gap, taker = free(windows[first]), windows[first]
            while gap and first < last:
                doc, start, ids, n = windows[last].pop()
                if len(ids) > gap:
                    windows[last].append((doc, start + gap, ids[gap:], n))
                    ids = ids[:gap]
                taker.append((doc, start, ids, n))
                gap -= len(ids)
                if not windows[last]:
                    last -= 1
            if not gap:
                yield taker
                first += 1
        if first == last:
            self.pieces = windows[first]

    def finish(self):
        yield from self.flush()
        left = sum(len(p[2]) for p in self.pieces)
        while left:
            size = 1 << (left.bit_length() - 1)
            out, need = [], size
            while need:
                doc, start, ids, n = self.pieces.pop()
                if len(ids) > need:
                    self.pieces.append((doc, start + need, ids[need:], n))
                    ids = ids[:need]
                out.append((doc, start, ids, n))
                need -= len(ids)
            yield out
            left -= size


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW,
                   end_id: int = END_ID, buffer_pieces: int = BUFFER_PIECES,
                   slack: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, token_ids
    (little-endian unsigned 32-bit). Pieces of one sequence are gapless from offset 0 and
    hold at most ``window`` tokens; gaps of up to ``slack`` tokens (default ``window / 128``)
    may be left open."""
    path = tokenizer or default_tokenizer()
    slack = window // 128 if slack is None else slack
    short_batches(docs.sparkSession)
    kind = type_of(docs, "doc_id")

    def pack(batches):
        enc, packer = encoder(path, end_id), Packer(window, buffer_pieces, slack)
        number = TaskContext.get().partitionId() << 33
        columns: list[list] = [[] for _ in range(7)]
        id_type = pa.null()

        def sequences():
            for batch in batches:
                nonlocal id_type
                id_type = batch.column(0).type
                ids_of, texts, at = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
                for ids, offsets in enc.encode(texts):
                    for a, b in pieces_of(offsets):
                        yield from packer.add(ids_of[at], ids[a:b])
                        at += 1
            yield from packer.finish()

        def rows():
            types = [id_type, *[pa.int64()] * 5, pa.binary()]
            out = pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            for c in columns:
                c.clear()
            return out

        for sequence in sequences():
            offset = 0
            for doc, start, ids, n in sequence:
                row = (doc, start, len(ids), n, number, offset, ids.astype("<u4").tobytes())
                for c, x in zip(columns, row):
                    c.append(x)
                offset += len(ids)
            number += 1
            if len(columns[0]) >= ROWS_OUT:
                yield rows()
        if columns[0]:
            yield rows()

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "token_ids"]
    schema = (f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, "
              "offset long, token_ids binary")
    return docs.select("doc_id", "text").mapInArrow(pack, schema)
