"""Token ids of whole texts with a public byte-level BPE file (``tokenizers`` library).

A byte-level BPE never merges across the blank that starts a word, so a text can be cut in
front of every blank that is followed by a non-blank and the pieces encoded on their own.
Words repeat, so each worker keeps the ids of recent words and asks the library only for
words it has not seen; the ids are those of the library for the whole text.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np

END_ID = 0
CACHE_WORDS = 1_200_000     # words a worker remembers
CACHE_IDS = 12_000_000     # ids of those words
BATCH_CHARS = 1_000_000     # characters encoded at a time

_LOOSE_BLANK = re.compile(r" (?!\S)")
_CUT = re.compile(r" (?=\S)")


_STOPS = ".,"


def _lead(byte: int) -> str:
    """A character whose UTF-8 form begins with the byte."""
    size = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
    second = {0xE0: 0xA0, 0xF0: 0x90}.get(byte, 0x80)
    return bytes([byte, second, 0x80, 0x80][:size]).decode()


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def words_of(text: str) -> list[str]:
    """The text cut in front of blanks; every piece but the first has lost one leading blank."""
    return _CUT.split(text) if _LOOSE_BLANK.search(text) else text.split(" ")


class Encoder:
    """Ids of texts, each followed by ``end_id``."""

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.end_id = end_id
        self.model = self.tokenizer.model
        show = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {b: show(chr(b))[0][0] for b in range(1, 128)}
        self.shown |= {b: show(bytes([hi, b]).decode())[0][0][1] for hi, b in
                       [(0xC3, b) for b in range(0x80, 0xC0)]}
        self.shown |= {b: show(_lead(b))[0][0][0] for b in range(0xC2, 0xF5)}
        self.stops = {c: self.model.token_to_id(c) for c in _STOPS}
        self.line_end = self.model.token_to_id(show("\n")[0][0])
        self._reset()

    def _reset(self) -> None:
        self.slot: dict = {None: 0}                     # None stands for the end of a text
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.flat[0] = self.end_id
        self.used = 1
        self.first = np.zeros(1 << 14, dtype=np.int64)
        self.size = np.zeros(1 << 14, dtype=np.int64)
        self.size[0] = 1

    def _word(self, word: str) -> list[int]:
        """Ids of letters, with or without a blank before: one word for the byte-level cutter,
        so the model alone finds them."""
        if word.isascii():
            shown = word.replace(" ", self.shown[32])
        else:
            shown = word.encode().decode("latin-1").translate(self.shown)
        return [t.id for t in self.model.tokenize(shown)]

    def _plain(self, key: str, blank: str = " ") -> list[int] | None:
        """Ids of letters and perhaps a full stop or comma, and of such lines; else None."""
        if key.isalpha():
            return self._word(blank + key)
        if key[-1:] in _STOPS and key[:-1].isalpha():
            slot = self.slot.get(key[:-1]) if blank else None
            if slot is None:
                return self._word(blank + key[:-1]) + [self.stops[key[-1]]]
            at = int(self.first[slot])
            return [*self.flat[at:at + int(self.size[slot])].tolist(), self.stops[key[-1]]]
        head, line_end, rest = key.partition("\n")
        if line_end:
            before, after = self._plain(head, blank), self._plain(rest, "")
            if before and after:
                return [*before, self.line_end, *after]
        return None

    def _ids(self, keys: list) -> list[list[int]]:
        out: list = [None if isinstance(key, tuple) else self._plain(key) for key in keys]
        rest = [i for i, ids in enumerate(out) if ids is None]
        found = self.tokenizer.encode_batch_fast(
            [keys[i][0] if isinstance(keys[i], tuple) else " " + keys[i] for i in rest],
            add_special_tokens=False)
        for i, e in zip(rest, found):
            out[i] = e.ids
        return out

    def _learn(self, keys: list) -> None:
        ids = self._ids(keys)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        total, n = int(sizes.sum()), len(self.slot)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(keys) > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used:self.used + total] = np.fromiter(
            itertools.chain.from_iterable(ids), dtype=np.uint32, count=total)
        self.first[n:n + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + len(keys)] = sizes
        self.used += total
        self.slot.update(zip(keys, range(n, n + len(keys))))

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.slot) > CACHE_WORDS or self.used > CACHE_IDS:
            self._reset()
        keys: list = []
        ends = np.zeros(len(texts) + 1, dtype=np.int64)
        for i, text in enumerate(texts):
            if text:
                parts = words_of(text)
                keys.append((parts[0],))
                keys += parts[1:]
            keys.append(None)
            ends[i + 1] = len(keys)
        slots = np.fromiter(map(self.slot.get, keys, itertools.repeat(-1)),
                            dtype=np.int64, count=len(keys))
        unknown = np.flatnonzero(slots < 0)
        if len(unknown):
            self._learn(list(dict.fromkeys(keys[i] for i in unknown)))
            slots[unknown] = [self.slot[keys[i]] for i in unknown]
        sizes = self.size[slots]
        after = np.zeros(len(slots) + 1, dtype=np.int64)
        np.cumsum(sizes, out=after[1:])
        at = np.repeat(self.first[slots] - after[:-1], sizes) + np.arange(after[-1])
        return self.flat[at], after[ends]

    def encode(self, texts: list[str | None]):
        """Yields (ids, offsets) for consecutive runs of the texts; a null text is empty.
        Ids of the i-th text of a run are ``ids[offsets[i]:offsets[i + 1]]``, end id included."""
        run, chars = [], 0
        for text in texts:
            run.append(text or "")
            chars += len(run[-1])
            if chars >= BATCH_CHARS:
                yield self._encode(run)
                run, chars = [], 0
        if run:
            yield self._encode(run)


@functools.lru_cache(maxsize=2)
def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path, end_id)
