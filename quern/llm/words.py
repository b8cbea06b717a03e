"""Words of many texts at once, as numpy arrays of 64-bit hashes.

Texts are laid end to end in one byte array; words are found by a table of byte classes, and hashed
eight bytes at a time through unaligned 64-bit loads. There is no Python loop over words.
"""

from __future__ import annotations

import hashlib

import numpy as np

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_31, _29, _32 = np.uint64(31), np.uint64(29), np.uint64(32)
#: Of n bytes, the first n of a little-endian number.
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)

#: Words of more bytes are hashed one by one.
LONG_WORD = 4096

#: U+0020 and U+0009 to U+000D.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[32, *range(9, 14)]] = True
#: Other than ASCII letters and digits and bytes of characters beyond ASCII.
NO_LETTER = np.ones(256, bool)
for _span in ((48, 58), (65, 91), (97, 123), (128, 256)):
    NO_LETTER[slice(*_span)] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all."""
    x = (x ^ (x >> _31)) * _C1
    x = (x ^ (x >> _29)) * _C2
    return x ^ (x >> _32)


class Words:
    """The words of texts: start, length and document of each, in order; counts by document."""

    def __init__(self, texts: list[bytes], between: np.ndarray = WHITE_SPACE) -> None:
        self.data = b"\n".join(texts) + b"\n" + b"\0" * 8
        raw = np.frombuffer(self.data, np.uint8)[:-8]
        gap = between[raw]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(raw) and not gap[0]:
            edge = np.concatenate([[0], edge])
        self.start, end = edge[0::2], edge[1::2]
        self.length = end - self.start
        lengths = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
        #: Where each text begins, and beyond the last.
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.first = np.searchsorted(self.start, self.bounds)
        self.counts = np.diff(self.first)
        self._eight = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """Of whole words. Words of up to 8 bytes never collide with others of their length."""
        h = mixed((self._eight[self.start] & MASKS[np.minimum(self.length, 8)]) + self.length.astype(np.uint64) * _C2)
        for i in np.flatnonzero(self.length > LONG_WORD).tolist():
            # A word of megabytes would be as many steps; there are few of them in a text.
            start = int(self.start[i])
            h[i] = int.from_bytes(hashlib.blake2b(self.data[start : start + int(self.length[i])], digest_size=8).digest(), "little")
        at, done = np.flatnonzero((self.length > 8) & (self.length <= LONG_WORD)), 8
        while len(at):
            left = self.length[at] - done
            h[at] = mixed((h[at] * _C1) ^ (self._eight[self.start[at] + done] & MASKS[np.minimum(left, 8)]))
            at, done = at[left > 8], done + 8
        return h

    def prefixes(self, n: int) -> np.ndarray:
        """Hashes of words' first n (up to 8) bytes, apart from those of whole words; 0 for words that aren't longer."""
        h = mixed((self._eight[self.start] & MASKS[n]) ^ mixed(np.uint64([n]))[0])
        h[self.length <= n] = 0
        return h


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, and how many each document has.

    A document of fewer words has one run, all of them; one without words has none.
    """
    h, counts = words.hashes(), words.counts
    if not len(h):
        return h, counts * 0
    padded = np.concatenate([h, np.zeros(n - 1, np.uint64)])
    full = h.copy()
    for k in range(1, n):
        full = (full ^ (full >> _29)) * _C1 + padded[k : k + len(h)]
    full = mixed(full)
    runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    out, first = np.empty(runs.sum(), np.uint64), words.first
    ends = np.cumsum(runs)
    within = np.arange(len(out)) - np.repeat(ends - runs, runs)
    at = np.repeat(first[:-1], runs) + within
    out[:] = full[at]
    for d in np.flatnonzero((counts > 0) & (counts < n)):
        one = np.uint64(counts[d])
        for x in h[first[d] : first[d + 1]]:
            one = mixed(np.array([one], np.uint64) * _C2 + x)[0]
        out[ends[d] - 1] = one
    return out, runs
