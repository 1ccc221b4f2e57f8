"""Word hashes of many texts at once, as numpy arrays over a record batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Odd multipliers (fixed values) of the byte, gram and mixing hashes, modulo 2**64.
BYTE, GRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all bits."""
    h = (h ^ (h >> np.uint64(33))) * MIX1
    h = (h ^ (h >> np.uint64(33))) * MIX2
    return h ^ (h >> np.uint64(33))


class Words:
    """Words (runs of non-space bytes) of the texts of an Arrow string array.

    ``hash``: one 64-bit number per word; ``doc``: its row; ``first``: the index
    of each row's first word (one more entry closes the last row); ``begin`` and
    ``end``: its place in ``data``, the joined UTF-8 bytes.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        at, raw = np.zeros(1, np.int64), np.zeros(0, np.uint8)
        if n:
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
            if at[-1] > at[0]:
                raw = np.frombuffer(texts.buffers()[2], np.uint8)[at[0]:at[-1]]
        lengths = np.diff(at)
        # a space after every text keeps the words of two texts apart
        data = np.full(len(raw) + n, 32, np.uint8)
        keep = np.ones(len(data), bool)
        keep[np.cumsum(lengths) + np.arange(n)] = False
        data[keep] = raw
        self.data = data
        space = _SPACE[data]
        inside = ~space
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        self.begin, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        starts = np.cumsum(lengths + 1) - lengths - 1  # of each text in the joined bytes
        self.first = np.append(np.searchsorted(self.begin, starts), len(self.begin)).astype(np.int64)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        # polynomial of a word's bytes, one byte of all words still going at a time
        lengths, h, going = self.end - self.begin, np.zeros(len(self.begin), np.uint64), np.arange(len(self.begin))
        k = 0
        while len(going):
            h[going] = h[going] * BYTE + data[self.begin[going] + k] + np.uint64(1)
            k += 1
            going = going[lengths[going] > k]
        self.hash = mix(h)

    def grams(self, size: int) -> np.ndarray:
        """A hash for each run of ``size`` words by its first word; those that
        would leave their text are among them (see ``fits``)."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out, power = np.zeros(n, np.uint64), GRAM
        with np.errstate(over="ignore"):
            for k in range(size):
                out += self.hash[k:k + n] * power
                power = power * GRAM
        return mix(out)

    def fits(self, size: int) -> np.ndarray:
        """Whether the run of ``size`` words from each word lies in one text."""
        n = len(self.hash) - size + 1
        return self.doc[:n] == self.doc[size - 1:] if n > 0 else np.zeros(0, bool)

    def joined(self, kept: np.ndarray) -> pa.Array:
        """The kept words of each text (a flag per word) joined by one space."""
        n = len(self.first) - 1
        mark = np.zeros(len(self.data) + 1, np.int8)
        mark[self.begin[kept]] += 1
        mark[self.end[kept]] -= 1
        keep = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
        data = self.data.copy()
        data[self.end] = 32  # the space after a word; every text ends in one
        docs, ends = self.doc[kept], self.end[kept]
        inner = np.ones(len(docs), bool)
        inner[np.flatnonzero(np.diff(docs, append=n))] = False  # the last kept word of its text
        keep[ends[inner]] = True
        sizes = np.bincount(docs, weights=(ends - self.begin[kept] + inner), minlength=n).astype(np.int64)
        offsets = np.zeros(n + 1, np.int64)
        np.cumsum(sizes, out=offsets[1:])
        return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(data[keep])).cast(pa.string())
