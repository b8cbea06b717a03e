"""Token ids by the tokenizers library, with the ids of pieces that come back remembered.

A tokenizer that splits its text before it merges gives each split's ids whatever stands around it.
So a text is cut where no split can cross, and only pieces that this worker has not met lately go to
the library. Two ways of cutting:

- drop: white space is no part of any token (word vocabularies): cut at runs of ASCII white space;
- lead: white space before a word belongs to it (byte-level vocabularies): cut before each such run.

Both also cut between ASCII punctuation and the letters around it, in texts where that is sure to be a
split: those without apostrophes (contractions), without runs of white space, and without characters beyond ASCII
other than Latin-1 letters. A text with white space on which libraries differ, or with a string that is a special token, goes to the
library whole. What comes out is always the library's own ids of the whole text.

Texts of a batch lie end to end in one byte array, and numpy finds the pieces, looks them up and gathers
their ids; there is no Python loop over pieces. A piece of up to 16 bytes is its own key, so nothing rests on a hash.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from tokenizers import Tokenizer

from .words import MASKS, mixed

#: Remembered pieces, and ids of them; beyond that a worker begins anew.
REMEMBERED, HELD_IDS = 1 << 19, 1 << 23
#: Bytes of texts that are cut at once, about.
SLICE = 1 << 20
#: Pieces that are sent to the library as one text.
TOGETHER = 512
#: Bytes that raise no question: ASCII letters, digits and marks other than the apostrophe, the space and the line end.
_SAFE = bytes(c for c in range(32, 127) if c != ord("'")) + b"\n"
#: UTF-8 of white space outside ASCII, and ASCII controls that only some libraries count as such.
_ODD = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x81\x9f|\xe3\x80\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")
#: What makes cuts at punctuation unsure: a control, an apostrophe, or a character that is neither ASCII nor a Latin-1 letter.
_UNSURE = re.compile(rb"[\x00-\x09\x0b-\x1f\x7f'\xc2\xc4-\xff]|\xc3[\x97\xb7]")
_RUNS = (b"  ", b"\n\n", b" \n", b"\n ")
_LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
_MARKS = rb"[!-&(-/:-@\[-`{-~]+"
#: Classes of bytes: white space, ASCII marks, others.
_SPACE, _MARK, _OTHER = range(3)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = _MARK
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_NO_MARKS = np.where(_CLASS == _SPACE, _SPACE, _OTHER).astype(np.uint8)


class Table:
    """Pairs of 64-bit keys to numbers: open addressing, for arrays of keys at once."""

    def __init__(self, size: int = 1 << 16) -> None:
        self.a, self.b, self.number, self.n = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32), 0

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (mixed(a ^ (b * np.uint64(0x9E3779B97F4A7C15))) & np.uint64(len(self.a) - 1)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it isn't there."""
        slot = self._slot(a, b)
        out = self.number[slot]
        left = np.flatnonzero((out >= 0) & ((self.a[slot] != a) | (self.b[slot] != b)))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & (len(self.a) - 1)
            got = self.number[slot]
            out[left] = got
            go = (got >= 0) & ((self.a[slot] != a[left]) | (self.b[slot] != b[left]))
            left, slot = left[go], slot[go]
        return out

    def add(self, a: np.ndarray, b: np.ndarray, number: np.ndarray) -> None:
        """Different keys that aren't there yet."""
        if 2 * (self.n + len(a)) > len(self.a):
            at, size = np.flatnonzero(self.number >= 0), len(self.a)
            while 2 * (self.n + len(a)) > size:
                size *= 2
            a, b, number = (np.concatenate(x) for x in ((self.a[at], a), (self.b[at], b), (self.number[at], number)))
            self.__init__(size)
        self.n += len(a)
        slot, left = self._slot(a, b), np.arange(len(a))
        while len(left):
            free = left[self.number[slot[left]] < 0]
            self.number[slot[free]] = number[free]  # one of those that want a place has it
            free = free[self.number[slot[free]] == number[free]]
            self.a[slot[free]], self.b[slot[free]] = a[free], b[free]
            left = left[self.number[slot[left]] != number[left]]
            slot[left] = (slot[left] + 1) & (len(self.a) - 1)


class Pieces:
    """Where texts that lie end to end are cut."""

    def __init__(self, texts: list[bytes], leads: bool, marks: bool) -> None:
        self.data = b"".join(texts) + b"\0" * 16
        kind = (_CLASS if marks else _NO_MARKS)[np.frombuffer(self.data, np.uint8)[:-16]]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        cut = np.empty(len(kind), bool)
        # Where the class changes; if white space leads, not between it and what follows.
        cut[1:] = kind[1:] != kind[:-1]
        if leads:
            cut[1:] &= kind[:-1] != _SPACE
        cut[bounds[:-1][bounds[:-1] < len(kind)]] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(kind)))
        if not leads:
            own = kind[start] != _SPACE
            start, length = start[own], length[own]
        self.start, self.length = start, length
        self.first = np.searchsorted(start, bounds)
        eight = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        self.a = eight[start] & MASKS[np.minimum(length, 8)]
        self.b = eight[start + 8] & MASKS[np.clip(length - 8, 0, 8)]

    def bytes_of(self, at: np.ndarray) -> list[bytes]:
        return [self.data[s : s + n] for s, n in zip(self.start[at].tolist(), self.length[at].tolist())]


class Ids:
    """Texts to their ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, white_space: str) -> None:
        if white_space not in ("drop", "lead"):
            raise ValueError(white_space)
        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        self.leads = white_space == "lead"
        #: Whether the tokenizer lower-cases its text itself, so that doing it for A-Z before changes nothing.
        self.lower = not self.leads and "Lowercase" in str(t.normalizer)
        #: Strings that the library takes for one token wherever they stand.
        self.special = [x.content.encode() for x in t.get_added_tokens_decoder().values()]
        # Ids that end a split (drop), or begin one (lead): they tell apart pieces that were encoded together.
        vocabulary, suffix = t.get_vocab(), getattr(t.model, "end_of_word_suffix", None)
        self.border = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.border[i] = token.startswith("Ġ") if self.leads else bool(suffix) and token.endswith(suffix)
        self.plain = re.compile(b"%s(?:%s|%s)" % (b" " if self.leads else b"", _LETTERS, _MARKS))
        self._forget()

    def _forget(self) -> None:
        self.table, self.long = Table(), {}
        #: The ids of all remembered pieces; of each piece, where its ids begin and how many they are.
        self.pool, self.begin, self.count = np.empty(1 << 16, "<u4"), np.empty(1 << 16, np.int32), np.empty(1 << 16, np.int32)
        self.used = self.known = 0

    def _library(self, pieces: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([x.decode() for x in pieces], add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _together(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Pieces that are one split each, encoded as one text; one by one if their borders don't tell them apart."""
        found = self.tokenizer.encode_batch_fast([(b"" if self.leads else b" ").join(pieces).decode()], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        at = np.flatnonzero(self.border[ids])
        if len(at) != len(pieces) or self.leads and at[0] != 0 or not self.leads and at[-1] != len(ids) - 1:
            return self._library(pieces)
        ends = (np.append(at[1:], len(ids)) if self.leads else at + 1).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of pieces that aren't remembered yet, from now on."""
        found: list = [None] * len(pieces)
        plain, other = [], []
        for i, x in enumerate(pieces):
            (plain if self.plain.fullmatch(x) else other).append(i)
        for some, most, encode in ((plain, TOGETHER, self._together), (other, 4096, self._library)):
            for k in range(0, len(some), most):
                at = some[k : k + most]
                for i, ids in zip(at, encode([pieces[i] for i in at])):
                    found[i] = ids
        counts = np.array([len(x) for x in found], np.int64)
        numbers = np.arange(self.known, self.known + len(pieces))
        new = np.concatenate(found) if found else np.empty(0, "<u4")
        self.pool, self.begin, self.count = (_roomy(x, n) for x, n in ((self.pool, self.used + len(new)), (self.begin, self.known + len(pieces)), (self.count, self.known + len(pieces))))
        self.pool[self.used : self.used + len(new)] = new
        self.begin[numbers], self.count[numbers] = self.used + np.cumsum(counts) - counts, counts
        self.used, self.known = self.used + len(new), self.known + len(pieces)
        return numbers

    def _cut(self, texts: list[bytes], marks: bool) -> list[bytes]:
        """Texts by their pieces."""
        pieces = Pieces(texts, self.leads, marks)
        number = self.table.find(pieces.a, pieces.b)
        long = np.flatnonzero(pieces.length > 16)
        number[long] = -1
        new = np.flatnonzero((number < 0) & (pieces.length <= 16))
        if len(new):
            _, one = np.unique(np.stack([pieces.a[new], pieces.b[new]], 1).view("V16").ravel(), return_index=True)
            one = new[one]
            self.table.add(pieces.a[one], pieces.b[one], self._learn(pieces.bytes_of(one)).astype(np.int32))
            number[new] = self.table.find(pieces.a[new], pieces.b[new])
        if len(long):
            words = pieces.bytes_of(long)
            unknown = [x for x in dict.fromkeys(words) if x not in self.long]
            self.long.update(zip(unknown, self._learn(unknown).tolist()))
            number[long] = [self.long[x] for x in words]
        counts = self.count[number]
        ends = np.cumsum(counts, dtype=np.int64)
        ids = self.pool[np.repeat(self.begin[number] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[pieces.first].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]

    def of(self, texts: list[bytes]) -> list[bytes]:
        if self.known > REMEMBERED or self.used > HELD_IDS:
            self._forget()
        out: list[bytes] = [b""] * len(texts)
        groups: tuple[list[int], ...] = ([], [], [])
        lower = [t.lower() for t in texts] if self.lower else texts
        for i, t in enumerate(lower):
            odd = t.translate(None, _SAFE)
            if any(x in t for x in self.special) or odd and _ODD.search(odd):
                groups[2].append(i)
            else:
                groups[bool(odd and _UNSURE.search(odd)) or self.leads and any(x in t for x in _RUNS)].append(i)
        for k, at in enumerate(groups[:2]):
            if at:
                for i, x in zip(at, self._cut([lower[i] for i in at], k == 0)):
                    out[i] = x
        for i in groups[2]:
            out[i] = self._library([texts[i]])[0].tobytes()
        return out


def _roomy(x: np.ndarray, n: int) -> np.ndarray:
    """x with room for n, and half as much again if it has to grow."""
    return x if n <= len(x) else np.concatenate([x, np.empty(n + n // 2 - len(x), x.dtype)])


_MADE: dict[tuple[str, str], Ids] = {}


def ids_by(path: str, white_space: str) -> Ids:
    """The one of this worker process, which remembers words across tasks."""
    if (path, white_space) not in _MADE:
        _MADE[path, white_space] = Ids(path, white_space)
    return _MADE[path, white_space]


def crc32(ids: bytes) -> int:
    return zlib.crc32(ids) & 0xFFFFFFFF
