"""Cross-tokenizer alignment: byte-level BPE tokens (A) against sentencepiece tokens (B).

Both tokenizers cut the bytes of blank + text. Offsets where a token of A and a token of B end
together cut the tokens into groups; the two tokens that end there are linked.

Fragments. The tokens that end in a byte range of a text are a fragment: an open prefix (up to
the range's first common end), closed groups, and an open suffix (behind its last one). Joining
neighbouring fragments closes one group out of suffix and prefix; this is associative, with the
empty fragment as its identity. A text of at most ``LONG`` characters is one range. A longer one
is dealt to tasks as ranges of ``CHUNK`` characters, each with enough text around it to find its
tokens, and the fragments are joined by a tree of ``FAN`` children a node, a Spark aggregation
per level. Closed groups stay where they were found; a level only adds the groups it closes.

Tokens. Neither tokenizer joins characters across a blank that follows a character that is no
white space (no entry of either vocabulary holds one inside), so words are the units that a
worker remembers: their numbers of tokens, groups and links.

Counts. Texts are handled in blocks; a block keeps its words' links as numbers of its distinct id
pairs. Pair counts are summed over blocks, the highest count of every B id is taken, and each
block gets the counts of its own pairs back, as sorted rows and not as a list on the heap, so
nothing that grows with the corpus is broadcast and no task holds the pairs of several blocks.

Defined cases: a text that is null or empty, or that either tokenizer does not give back byte by
byte (U+2581 in it), has no tokens: zeros and an empty digest, and its links count nowhere. Rows with a null or
repeated id are documents of their own; other columns are ignored; an empty table gives no rows.
Special tokens' strings in a text are ordinary text.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import packed, short_batches, type_of, unpacked, written
from .tokens import default_tokenizer, encoder

LONG = 100_000              # characters of a text that is one range
CHUNK = 50_000              # characters of a range of a longer text
FAN = 8                     # fragments joined at once
BLOCK_CHARS = 1_500_000     # characters of a block's texts
CACHE_WORDS = 400_000       # words a worker remembers
MARK = "▁"             # a blank in B's pieces

_LOOSE = re.compile(r"(?:^|\s) ")
_CUT = re.compile(r"(?<=\S) ")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def words_of(text: str) -> list[str]:
    """The text cut at blanks that follow no white space; blank + word, joined, is blank + text."""
    return _CUT.split(text) if _LOOSE.search(text) else text.split(" ")


# Fragments ------------------------------------------------------------------------------

class Fragment(NamedTuple):
    """``groups`` is None where no common end lies in the range: then all is prefix. ``at``: the
    range in which the prefix ends."""
    pre_a: tuple[int, ...]
    pre_b: tuple[int, ...]
    groups: list | None
    suf_a: tuple[int, ...] = ()
    suf_b: tuple[int, ...] = ()
    at: int = 0


EMPTY = Fragment((), (), None)


def group_text(a, b) -> bytes:
    return ("%s|%s" % (",".join(map(str, a)), ",".join(map(str, b)))).encode()


def joined(x: Fragment, y: Fragment) -> tuple[Fragment, bytes | None]:
    """The fragment of two neighbouring ranges and the group closed between them; the fragment
    keeps no groups besides (``groups`` only says whether there is a common end)."""
    if x.groups is None:
        return Fragment(x.pre_a + y.pre_a, x.pre_b + y.pre_b, y.groups, y.suf_a, y.suf_b,
                        y.at if y.groups is not None else x.at), None
    if y.groups is None:
        return x._replace(suf_a=x.suf_a + y.pre_a, suf_b=x.suf_b + y.pre_b), None
    a, b = x.suf_a + y.pre_a, x.suf_b + y.pre_b
    return x._replace(suf_a=y.suf_a, suf_b=y.suf_b), group_text(a, b) if a or b else None


def fragment_of(a, a_ends, b, b_ends, lo: int, hi: int) -> tuple[Fragment, np.ndarray]:
    """The fragment of the tokens that end in (lo, hi], and the rows (a id, b id) linked there."""
    keep = (a_ends > lo) & (a_ends <= hi)
    a, a_ends = a[keep], a_ends[keep]
    keep = (b_ends > lo) & (b_ends <= hi)
    b, b_ends = b[keep], b_ends[keep]
    _, at_a, at_b = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    ids_a, ids_b = a.tolist(), b.tolist()
    if not len(at_a):
        return Fragment(tuple(ids_a), tuple(ids_b), None), np.empty((0, 2), np.int64)
    cut_a, cut_b = (at_a + 1).tolist(), (at_b + 1).tolist()
    groups = [group_text(ids_a[i:j], ids_b[k:m]) for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
    found = Fragment(tuple(ids_a[:cut_a[0]]), tuple(ids_b[:cut_b[0]]), groups,
                     tuple(ids_a[cut_a[-1]:]), tuple(ids_b[cut_b[-1]:]))
    return found, np.stack([a[at_a], b[at_b]], axis=1)


# Tokens ---------------------------------------------------------------------------------

@functools.cache
def byte_of() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: visible Latin-1 characters stand for
    themselves, the other bytes for 256, 257, ... in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens, groups and links of words, remembered by word."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        self.a = encoder(a_path)
        table = byte_of()
        entries = self.a.tokenizer.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(table[c] for c in entry if c in table)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(_BYTE.fullmatch(p)[1], 16)]) if self.b.is_byte(i)
                        else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.blank = self.b.piece_to_id(MARK)
        self.reset()

    def reset(self) -> None:
        self.slot: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.links = np.zeros(1 << 16, dtype=np.uint32)     # a id << 16 | b id
        self.used = 0
        # by word: first link, links, tokens of A, of B, bytes, 1 if not given back
        self.word = np.zeros((1 << 14, 6), dtype=np.int64)

    def tokens(self, words: list[str]) -> tuple[list, list]:
        a = self.a._ids(words)
        return a, [ids or [self.blank] for ids in self.b.encode(words, num_threads=1)]

    def _learn(self, words: list[str]) -> None:
        a, b = self.tokens(words)
        raw = [(" " + w).encode() for w in words]
        n, known = len(words), len(self.slot)
        self.slot.update(zip(words, range(known, known + n)))
        bad = np.zeros(n, dtype=bool)
        for ids, entry in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(entry.__getitem__, itertools.chain.from_iterable(ids))) != b"".join(raw):
                bad |= [b"".join(map(entry.__getitem__, x)) != r for x, r in zip(ids, raw)]
        for i in np.flatnonzero(bad).tolist():
            a[i], b[i] = [], []
        rows = np.zeros((n, 6), dtype=np.int64)
        rows[:, 2], rows[:, 3] = list(map(len, a)), list(map(len, b))
        rows[:, 4], rows[:, 5] = list(map(len, raw)), bad
        flat_a = np.fromiter(itertools.chain.from_iterable(a), dtype=np.int64, count=int(rows[:, 2].sum()))
        flat_b = np.fromiter(itertools.chain.from_iterable(b), dtype=np.int64, count=int(rows[:, 3].sum()))
        _, at_a, at_b = np.intersect1d(np.cumsum(self.a_size[flat_a]), np.cumsum(self.b_size[flat_b]),
                                       assume_unique=True, return_indices=True)
        after = np.cumsum(rows[:, 2])
        rows[:, 1] = np.bincount(np.searchsorted(after, at_a, side="right"), minlength=n)
        rows[:, 0] = self.used + np.cumsum(rows[:, 1]) - rows[:, 1]
        links = (flat_a[at_a] << 16 | flat_b[at_b]).astype(np.uint32)
        while self.used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[self.used:self.used + len(links)] = links
        self.used += len(links)
        while known + n > len(self.word):
            self.word = np.concatenate([self.word, np.zeros_like(self.word)])
        self.word[known:known + n] = rows
        shown_a, shown_b = list(map(str, flat_a.tolist())), list(map(str, flat_b.tolist()))
        ends_a, ends_b = (at_a + 1).tolist(), (at_b + 1).tolist()
        texts = [(shown_a[i] if j == i + 1 else ",".join(shown_a[i:j])) + "|"
                 + (shown_b[k] if m == k + 1 else ",".join(shown_b[k:m]))
                 for i, j, k, m in zip([0, *ends_a], ends_a, [0, *ends_b], ends_b)]
        ends = np.cumsum(rows[:, 1]).tolist()
        self.groups += [";".join(texts[i:j]).encode() for i, j in zip([0, *ends], ends)]

    def slots(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.slot.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            self._learn(list(dict.fromkeys(words[i] for i in unknown)))
            found[unknown] = [self.slot[words[i]] for i in unknown]
        return found

    def block(self, slots: np.ndarray, more: list[np.ndarray]) -> dict:
        """Links of the words in ``slots`` and of further words (``more``: rows of id pairs) as
        numbers of the block's distinct pairs."""
        kinds, codes = np.unique(slots, return_inverse=True)
        size = self.word[kinds, 1]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.word[kinds, 0] - ends + size, size) + np.arange(total)
        extra = [(m[:, 0] << 16 | m[:, 1]).astype(np.uint32) for m in more]
        links = np.concatenate([self.links[at], *extra])
        size = np.r_[size, [len(m) for m in more]].astype(np.int64)
        codes = np.r_[codes.ravel(), np.arange(len(kinds), len(kinds) + len(more))].astype(np.int64)
        pairs, number = np.unique(links, return_inverse=True)
        often = np.bincount(codes, minlength=len(size))
        counts = np.bincount(number.ravel(), weights=np.repeat(often, size), minlength=len(pairs))
        return {"pairs": pairs.astype(np.int64).tolist(), "counts": counts.astype(np.int64).tolist(),
                "word_links": packed(size), "links": packed(number.ravel()), "codes": packed(codes)}


@functools.lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One for each worker process and pair of files."""
    return Aligner(a_path, b_path)


# Ranges of long texts -------------------------------------------------------------------

def _cut_before(text: str, at: int) -> int:
    """The last blank before ``at`` where a word begins, or 0."""
    while True:
        at = text.rfind(" ", 0, at)
        if at <= 0:
            return 0
        if not text[at - 1].isspace():
            return at


def _cut_after(text: str, at: int) -> int:
    """The first blank from ``at`` on where a word begins, or the end."""
    while True:
        at = text.find(" ", at)
        if at < 0:
            return len(text)
        if at and not text[at - 1].isspace():
            return at
        at += 1


def ranges_of(text: str, chunk: int = CHUNK) -> list[tuple[str, int, int]]:
    """(words' text, lo, hi) of each range: its tokens are those of blank + words' text that end
    in bytes (lo, hi]. A word without a blank is cut by one range's end at most."""
    ends = [0]
    for at in range(chunk, len(text), chunk):
        if _cut_before(text, at) > ends[-1]:
            ends.append(at)
    ends.append(len(text))
    out = []
    for begin, end in zip(ends, ends[1:]):
        first = _cut_before(text, begin) if begin else -1
        last = _cut_after(text, end) if end < len(text) else end
        window = text[first + 1:last]
        size = lambda upto: 1 + len(text[first + 1:upto].encode())
        lo = size(begin) if begin else 0
        if begin and begin <= first:        # the range begins with the blank of its first word
            lo = 0
        out.append((window, lo, size(end)))
    return out


def _windows(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Long documents to rows of ranges; ``key`` names the row they come from."""
    from pyspark import TaskContext
    key = TaskContext.get().partitionId() << 40
    for batch in batches:
        for doc, text in zip(batch.column("doc_id"), batch.column("text").to_pylist()):
            parts = ranges_of(text, chunk)
            for at in range(0, len(parts), 64):
                some = parts[at:at + 64]
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc.as_py()] * n, type=batch.schema.field("doc_id").type), pa.array([key] * n),
                     pa.array(range(at, at + n), type=pa.int32()), pa.array([s[1] for s in some], type=pa.int64()),
                     pa.array([s[2] for s in some], type=pa.int64()), pa.array([s[0] for s in some])],
                    names=["doc_id", "key", "k", "lo", "hi", "text"])
            key += 1


# Blocks ---------------------------------------------------------------------------------

_BLOCK = ("block long, key long, k int, doc_ids array<{id}>, ok array<boolean>, n_a array<long>, n_b array<long>, "
          "n_groups array<long>, words array<long>, digests array<string>, pairs array<long>, counts array<long>, "
          "word_links binary, links binary, codes binary, closed boolean, pre_a array<int>, pre_b array<int>, "
          "suf_a array<int>, suf_b array<int>, groups array<binary>")


def _block_schema(doc_id: pa.DataType) -> pa.Schema:
    many = {"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "string": pa.string(),
            "binary": pa.binary(), "{id}": doc_id}
    fields = []
    for field in _BLOCK.split(", "):
        name, kind = field.split(" ")
        inner = re.fullmatch(r"array<(.*)>", kind)
        fields.append(pa.field(name, pa.list_(many[inner[1]]) if inner else many[kind]))
    return pa.schema(fields)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs that end at ``ends``."""
    total = np.r_[0, np.cumsum(values)]
    return total[ends] - total[np.r_[0, ends[:-1]]]


def _block_of_texts(tool: Aligner, texts: list[str], keep_groups: bool) -> dict:
    """A block of whole texts."""
    words: list[str] = []
    ends = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        if text:
            words += words_of(text)
        ends[i] = len(words)
    slots = tool.slots(words)
    bad = _sums(tool.word[slots, 5], ends) > 0
    if bad.any():
        sizes = np.diff(np.r_[0, ends])
        slots = slots[np.repeat(~bad, sizes)]
        ends = np.cumsum(np.where(bad, 0, sizes))
    sizes = np.diff(np.r_[0, ends])
    shown = list(map(tool.groups.__getitem__, slots.tolist()))
    whole = [b";".join(shown[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())]
    return {"key": None, "k": 0, "ok": (sizes > 0).tolist(), "words": sizes.tolist(),
            "n_a": _sums(tool.word[slots, 2], ends).tolist(), "n_b": _sums(tool.word[slots, 3], ends).tolist(),
            "n_groups": _sums(tool.word[slots, 1], ends).tolist(),
            "digests": [hashlib.sha256(g).hexdigest() if g else "" for g in whole],
            "closed": True, "pre_a": [], "pre_b": [], "suf_a": [], "suf_b": [],
            "groups": whole if keep_groups else []} | tool.block(slots, [])


def _block_of_range(tool: Aligner, text: str, lo: int, hi: int) -> dict:
    """A block of one range of a long text, with its fragment."""
    words = words_of(text)
    slots = tool.slots(words)
    ends = np.cumsum(tool.word[slots, 4])
    starts = ends - tool.word[slots, 4]
    inside = (starts >= lo) & (ends <= hi)
    part = (ends > lo) & (starts < hi) & ~inside
    ok = not tool.word[slots[inside | part], 5].any()
    found, closed, links, n_a, n_b = EMPTY, [], [], 0, 0
    state = {"key": None, "ok": [ok], "words": [0], "n_a": [0], "n_b": [0], "n_groups": [0], "digests": [""]}
    if ok:
        at = np.flatnonzero(inside)
        split = np.flatnonzero(part).tolist()

        def add(i: int) -> None:
            nonlocal found, n_a, n_b
            (a,), (b,) = tool.tokens([words[i]])
            a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            a_ends, b_ends = starts[i] + np.cumsum(tool.a_size[a]), starts[i] + np.cumsum(tool.b_size[b])
            more, pairs = fragment_of(a, a_ends, b, b_ends, lo, hi)
            found, group = joined(found, more)
            closed.extend([group] if group else [])
            closed.extend(more.groups or [])
            links.append(pairs)
            n_a += int(((a_ends > lo) & (a_ends <= hi)).sum())
            n_b += int(((b_ends > lo) & (b_ends <= hi)).sum())

        for i in split:
            if not len(at) or i < at[0]:
                add(i)
        if len(at):
            found, group = joined(found, Fragment((), (), []))
            closed += [group] if group else []
            closed += map(tool.groups.__getitem__, slots[at].tolist())
            n_a += int(tool.word[slots[at], 2].sum())
            n_b += int(tool.word[slots[at], 3].sum())
        for i in split:
            if len(at) and i > at[0]:
                add(i)
        n_groups = int(tool.word[slots[at], 1].sum()) + sum(map(len, links))
        state |= {"words": [len(at) + len(links)], "n_a": [n_a], "n_b": [n_b], "n_groups": [n_groups]}
        slots = slots[at]
    return state | {"closed": found.groups is not None, "pre_a": found.pre_a, "pre_b": found.pre_b,
                    "suf_a": found.suf_a, "suf_b": found.suf_b,
                    "groups": closed} | tool.block(slots if ok else slots[:0], links)


def _blocks(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, keep_groups: bool,
            block_chars: int) -> Iterator[pa.RecordBatch]:
    """Documents (key null) and ranges of long ones to blocks, a row each."""
    from pyspark import TaskContext
    number, tool = TaskContext.get().partitionId() << 32, aligner(a_path, b_path)
    schema, ids, texts, chars = None, [], [], 0

    def out(row: dict) -> pa.RecordBatch:
        nonlocal number
        row = row | {"block": number}
        number += 1
        if len(tool.slot) > CACHE_WORDS:
            tool.reset()
        return pa.RecordBatch.from_pydict({f.name: pa.array([row[f.name]], type=f.type) for f in schema},
                                          schema=schema)

    for batch in batches:
        if schema is None:
            schema = _block_schema(batch.schema.field("doc_id").type)
        for doc, key, k, lo, hi, text in zip(*(batch.column(c).to_pylist() for c in
                                               ("doc_id", "key", "k", "lo", "hi", "text"))):
            if key is not None:
                yield out(_block_of_range(tool, text, lo, hi) | {"key": key, "k": k, "doc_ids": [doc]})
                continue
            ids.append(doc)
            texts.append(text or "")
            chars += len(texts[-1])
            if chars >= block_chars or len(ids) >= 20_000:
                yield out(_block_of_texts(tool, texts, keep_groups) | {"doc_ids": ids})
                ids, texts, chars = [], [], 0
    if ids:
        yield out(_block_of_texts(tool, texts, keep_groups) | {"doc_ids": ids})


def aligned_blocks(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, long: int = LONG,
                   chunk: int = CHUNK, block_chars: int = BLOCK_CHARS, keep_groups: bool = False) -> DataFrame:
    """The written table of blocks (``_BLOCK``) of rows doc_id, text."""
    spark = docs.sparkSession
    short_batches(spark)
    kind = type_of(docs, "doc_id")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    windows = rows.where(size > long).mapInArrow(
        functools.partial(_windows, chunk=chunk), f"doc_id {kind}, key long, k int, lo long, hi long, text string")
    windows = written(windows, "align-ranges").repartition("key", "k")
    null = lambda t: F.lit(None).cast(t)
    whole = rows.where(size <= long).select("doc_id", null("long").alias("key"), null("int").alias("k"),
                                            null("long").alias("lo"), null("long").alias("hi"), "text")
    make = functools.partial(_blocks, a_path=a_path or default_tokenizer(), b_path=b_path or default_pieces(),
                             keep_groups=keep_groups, block_chars=block_chars)
    return written(whole.unionByName(windows).mapInArrow(make, _BLOCK.format(id=kind)), "align-blocks", "zstd")


# Tree of fragments ----------------------------------------------------------------------

_NODE = ("key long, k int, closed boolean, pre_a array<int>, pre_b array<int>, suf_a array<int>, "
         "suf_b array<int>, at int, group binary")


def _join_children(table: pa.Table) -> pa.Table:
    """One node of the tree: the fragments of a parent, joined in order, and the groups closed
    between them (rows with a ``group``, whose ``at`` is the range in which the group ends)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["k"])
    whole, out = EMPTY, []
    for r in rows:
        child = Fragment(tuple(r["pre_a"]), tuple(r["pre_b"]), [] if r["closed"] else None,
                         tuple(r["suf_a"]), tuple(r["suf_b"]), r["at"])
        whole, group = joined(whole, child)
        if group:
            out.append({"key": r["key"], "at": child.at, "group": group})
    out.append({"key": rows[0]["key"], "k": rows[0]["k"] // FAN, "closed": whole.groups is not None,
                "pre_a": whole.pre_a, "pre_b": whole.pre_b, "suf_a": whole.suf_a, "suf_b": whole.suf_b,
                "at": whole.at})
    number = pa.list_(pa.int32())
    return pa.Table.from_pylist(out, schema=pa.schema([
        ("key", pa.int64()), ("k", pa.int32()), ("closed", pa.bool_()), ("pre_a", number), ("pre_b", number),
        ("suf_a", number), ("suf_b", number), ("at", pa.int32()), ("group", pa.binary())]))


def closed_between(blocks: DataFrame) -> DataFrame:
    """Rows (key, at, group): the groups that lie in several ranges of a long text, by the range in
    which they end. One aggregation per level of the tree."""
    level = blocks.where("key is not null").select(
        "key", "k", "closed", "pre_a", "pre_b", "suf_a", "suf_b", F.col("k").alias("at"))
    found = []
    while True:
        deepest = level.agg(F.max("k")).first()[0]
        if deepest is None:
            break
        made = written(level.groupBy("key", F.floor(F.col("k") / FAN)).applyInArrow(_join_children, _NODE),
                       "align-tree")
        found.append(made.where("group is not null").select("key", "at", "group"))
        level = made.where("group is null").drop("group")
        if deepest < FAN:
            break
    # At the root the prefix is the text's first group.
    text = F.concat_ws("|", F.array_join("pre_a", ","), F.array_join("pre_b", ","))
    root = level.where(F.size("pre_a") > 0).select("key", "at", text.cast("binary").alias("group"))
    return functools.reduce(DataFrame.unionByName, found, root)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, at, kind, groups) in order to the digest of each text, hashed as they pass."""
    key, digest, first = None, None, True
    out: dict = {"key": [], "digest": []}
    for batch in batches:
        for this, groups in zip(batch.column("key").to_pylist(), batch.column("groups").to_pylist()):
            if this != key:
                if key is not None:
                    out["key"].append(key)
                    out["digest"].append(digest.hexdigest())
                key, digest, first = this, hashlib.sha256(), True
            for group in groups:
                digest.update(group if first else b";" + group)
                first = False
    if key is not None:
        out["key"].append(key)
        out["digest"].append(digest.hexdigest())
    yield pa.RecordBatch.from_pydict({"key": pa.array(out["key"], type=pa.int64()),
                                      "digest": pa.array(out["digest"], type=pa.string())})


# Counts and totals ----------------------------------------------------------------------

def pair_counts(blocks: DataFrame) -> DataFrame:
    """Written rows (pair, total, best): how many links of the corpus hold the pair (a id << 16 |
    b id), and whether no pair of its b id has more."""
    bad = blocks.where("key is not null and not ok[0]").select("key").distinct()
    good = blocks.select("key", "pairs", "counts").join(bad, "key", "left_anti")
    each = good.select(F.explode(F.arrays_zip("pairs", "counts")).alias("e"))
    total = each.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.counts").alias("total"))
    most = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFF))))
    return written(total.withColumn("best", F.col("total") == most), "align-pairs")


_DOCUMENT = "doc_id {id}, key long, ok boolean, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _totals(blocks: pa.Table, found: pa.Table) -> pa.Table:
    """A block, and the counts of its pairs (rows nth, total, best, in any order), to documents or
    a range. Pairs without counts count nothing."""
    row = {c: blocks.column(c)[0] for c in blocks.column_names}
    links, codes = unpacked(row["links"].as_py()), unpacked(row["codes"].as_py())
    word_ends = np.cumsum(unpacked(row["word_links"].as_py()))
    ends = np.cumsum(row["words"].values.to_numpy())
    n, nth, sums = len(ends), found.column("nth").to_numpy(), []
    for name in ("best", "total"):
        value = np.zeros(int(links.max()) + 1 if len(links) else 0, dtype=np.int64)
        value[nth] = found.column(name).cast(pa.int64()).fill_null(0).to_numpy()
        sums.append(_sums(_sums(value[links], word_ends)[codes], ends) if len(links) else np.zeros(n, np.int64))
    longs = [row[c].values for c in ("n_a", "n_b", "n_groups", "n_groups")]
    return pa.table([row["doc_ids"].values, pa.array([row["key"].as_py()] * n, type=pa.int64()), row["ok"].values,
                     *longs, pa.array(sums[0]), pa.array(sums[1]), row["digests"].values],
                    names=[f.strip().split(" ")[0] for f in _DOCUMENT.split(",")])


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, long: int = LONG,
                    chunk: int = CHUNK, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose count
    is their b id's highest), count_sum (counts of its links) and groups_sha256."""
    blocks = aligned_blocks(docs, a_path, b_path, long, chunk, block_chars)
    counts = pair_counts(blocks)
    asked = blocks.select("block", F.posexplode("pairs").alias("nth", "want"))
    # A long text of which a range is not given back has no counts: its pairs may be unknown.
    found = asked.join(counts, F.col("want") == F.col("pair"), "left").select(
        F.col("block").alias("f_block"), "nth", "total", "best")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    given = blocks.select("block", "key", "doc_ids", "ok", "n_a", "n_b", "n_groups", "words", "digests",
                          "word_links", "links", "codes")
    rows = given.groupBy("block").cogroup(found.groupBy("f_block")).applyInArrow(_totals, _DOCUMENT.format(id=kind))
    rows = written(rows, "align-totals")
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    short = rows.where("key is null").select(*result)
    text = blocks.where("key is not null").select("key", F.col("k").alias("at"), F.lit(1).alias("kind"), "groups")
    between = closed_between(blocks).select("key", "at", F.lit(0).alias("kind"), F.array("group").alias("groups"))
    digests = text.unionByName(between).repartition("key").sortWithinPartitions("key", "at", "kind").select(
        "key", "groups").mapInArrow(_digests, "key long, digest string")
    sums = rows.where("key is not null").groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.min("ok").alias("ok"),
        *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")])
    counted = [F.when(F.col("ok"), F.col(c)).otherwise(F.lit(0)).alias(c)
               for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    whole = sums.join(digests, "key").select(
        "doc_id", *counted, F.when(F.col("ok"), F.col("digest")).otherwise(F.lit("")).alias("groups_sha256"))
    return short.unionByName(whole)
