"""Token ids of the public word-level BPE tokenizer, a batch of texts at once.

The tokenizer lower-cases, splits into words and encodes each word by itself.
So a batch is split into words in numpy, distinct words are encoded once (by
the tokenizer's own model) and kept in a table, and ids are gathered from it.
Texts with characters outside ``SAFE``, or with a special token's mark, go
through the tokenizer whole. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import unicodedata
from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from .common import CHUNK, span_hashes

#: code points below this are their own normal form
SAFE = 0x250
MAX_WORDS = 1 << 21
LETTER, NUMBER, OTHER, BLANK = 1, 2, 3, 0
#: what the tokenizer's pattern takes as one word after an apostrophe
TAILS = ("s", "t", "re", "ve", "m", "ll", "d")


def _kinds() -> np.ndarray:
    out = np.full(SAFE, OTHER, np.int8)
    for i in range(SAFE):
        kind = unicodedata.category(chr(i))[0]
        out[i] = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
    out[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = BLANK
    return out


KINDS = _kinds()


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the rest from code point 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Encoder:
    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.alphabet = {b: c for b, c in enumerate(byte_alphabet()) if c != chr(b)}
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the known words
        self.at = np.zeros(0, np.int64)  # their places in ``ids``
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.slots = np.full(1 << 22, -1, np.int32)  # hash table: first places to look

    def word(self, w: str) -> list[int]:
        return [t.id for t in self.whole.model.tokenize(w.encode().decode("latin-1").translate(self.alphabet))]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash in ``keys``; -1: not there."""
        mask = np.uint64(len(self.slots) - 1)
        out = np.full(len(h), -1, np.int64)
        todo, slot = np.arange(len(h)), (h & mask).astype(np.int64)
        while len(todo):
            k = self.slots[slot]
            same = (k >= 0) & (self.keys[np.maximum(k, 0)] == h[todo]) if len(self.keys) else np.zeros(len(todo), bool)
            out[todo[same]] = k[same]
            on = (k >= 0) & ~same
            todo, slot = todo[on], (slot[on] + 1) & int(mask)
        return out

    def _learn(self, h: np.ndarray, words: list[str]) -> None:
        ids = [self.word(w) for w in words]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        start = len(self.ids) + np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        first = len(self.keys)
        self.keys = np.concatenate((self.keys, h))
        self.at, self.size = np.concatenate((self.at, start)), np.concatenate((self.size, size))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))))
        mask = len(self.slots) - 1
        todo = np.arange(first, first + len(h))
        slot = (h & np.uint64(mask)).astype(np.int64)
        while len(todo):  # linear probing; of several at one place the last stays
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            on = self.slots[slot] != todo
            todo, slot = todo[on], (slot[on] + 1) & mask

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids (uint32) of each whole text, no special tokens added; null:
        none."""
        out: list = [None] * len(texts)
        parts: list[tuple[int, np.ndarray]] = []
        size = 0
        for i, t in enumerate(texts):
            low = (t or "").lower()
            c = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)
            if len(c) and (int(c.max()) >= SAFE or "<|" in low):
                out[i] = np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32)
                continue
            out[i] = []
            a = 0
            while a < len(c):  # a long text in pieces that end at a blank
                b = min(a + CHUNK, len(c))
                while b < len(c) and KINDS[c[b]] != BLANK:
                    b += 1
                parts.append((i, c[a:b]))
                size += b - a + 1
                a = b
                if size >= CHUNK:
                    self._encode(parts, out)
                    parts, size = [], 0
        self._encode(parts, out)
        return [x if isinstance(x, np.ndarray) else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def _encode(self, parts: list[tuple[int, np.ndarray]], out: list) -> None:
        if not parts:
            return
        blank = np.array([32], np.uint32)
        c = np.concatenate([x for _, p in parts for x in (p, blank)])
        ends = np.cumsum([len(p) + 1 for _, p in parts])
        kind = KINDS[c]
        new = np.concatenate(([True], kind[1:] != kind[:-1])) | (kind == NUMBER)
        for q in np.flatnonzero(new & (c == 39)):  # an apostrophe that opens a word
            rest = "".join(map(chr, c[q + 1:q + 3]))
            tail = next((t for t in TAILS if rest.startswith(t)), None)
            if tail:
                new[q + 1] = False
                if kind[q + 1 + len(tail)] == LETTER:
                    new[q + 1 + len(tail)] = True
        # what follows the tail opens a word as well, and blanks close one
        start = np.flatnonzero(new & (kind != BLANK))
        stop = np.flatnonzero(new)
        stop = np.append(stop, len(c))[np.searchsorted(stop, start, side="right")]
        h = span_hashes(c, start, stop)
        place = self._find(h)
        lost = np.flatnonzero(place < 0)
        if len(lost):
            if len(self.keys) + len(lost) > MAX_WORDS and len(self.keys):
                self.clear()
                lost = np.arange(len(h))
            hs, first = np.unique(h[lost], return_index=True)
            at = lost[first]
            text = c.tobytes().decode("utf-32-le", "surrogatepass")
            self._learn(hs, [text[a:b] for a, b in zip(start[at].tolist(), stop[at].tolist())])
            place[lost] = self._find(h[lost])
        size = self.size[place]
        after = np.cumsum(size)
        ids = self.ids[np.repeat(self.at[place] - after + size, size) + np.arange(after[-1] if len(after) else 0)]
        cut = np.concatenate(([0], after))[np.searchsorted(start, ends)]
        for (i, _), piece in zip(parts, np.split(ids, cut[:-1])):
            out[i].append(piece)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder a worker."""
    return Encoder(path)
