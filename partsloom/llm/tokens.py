"""Texts of a batch as one stream of tokens, in arrays.

Code points of all texts are laid side by side, with boundary marks between them, and cut
into tokens by vectorised comparisons: a run of letters (with apostrophes inside), a run of
digits, a run of line breaks, or any other single character; CJK characters stand alone.
Every token has a 64-bit code of its folded form; digits share one code, and so do ends of
sentences, line breaks and the ends of a text. Spans given as entities are one token each.
"""

from __future__ import annotations

import numpy as np

PAD = 4
SPACE, LETTER, DIGIT, BREAK, SINGLE, EDGE, ENTITY, TICK = range(8)
_STOP = frozenset(".!?;。！？…")
_DASH = frozenset("-–—")
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def combine(tag: int, *parts: np.ndarray) -> np.ndarray:
    """One code of several token codes, in order."""
    out = np.full(len(parts[0]), tag + 1, dtype=np.uint64)
    for p in parts:
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + p)
    return out


class Alphabet:
    """Class, folded code point and case of every code point seen so far."""

    def __init__(self):
        n = 0x110000
        self.known = np.zeros(n, dtype=bool)
        self.kind = np.zeros(n, dtype=np.uint8)
        self.mixed = np.zeros(n, dtype=np.uint64)  # of the folded code point
        self.upper = np.zeros(n, dtype=bool)
        self.lower = np.zeros(n, dtype=bool)
        self.stop = np.zeros(n, dtype=bool)
        self.dash = np.zeros(n, dtype=bool)

    def see(self, points: np.ndarray) -> None:
        present = np.flatnonzero(np.bincount(points, minlength=1))
        for p in present[~self.known[present]].tolist():
            c = chr(p)
            self.known[p] = True
            if c == "\x00":
                kind = EDGE
            elif c in "'’":
                kind = TICK
            elif c == "\n":
                kind = BREAK
            elif c.isspace():
                kind = SPACE
            elif c.isdecimal():
                kind = DIGIT
            elif c.isalnum():
                kind = SINGLE if "぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" or c == "々" else LETTER
            else:
                kind = SINGLE
            self.kind[p] = kind
            low = c.lower()
            self.mixed[p] = _scalar(ord(low) if len(low) == 1 else p)
            self.upper[p] = c.isupper()
            self.lower[p] = c.islower()
            self.stop[p] = c in _STOP
            self.dash[p] = c in _DASH


_alphabet: list[Alphabet] = []


def alphabet() -> Alphabet:
    if not _alphabet:
        _alphabet.append(Alphabet())
    return _alphabet[0]


def code_of(word: str) -> int:
    """The code of a token that is a folded word or a single character."""
    h = 0
    for c in reversed(word):
        h = (h * 0xD6E8FEB86659FD93 + _scalar(ord(c))) & _MASK
    return _finish(h)


def _scalar(x: int) -> int:
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
    return x ^ (x >> 29)


_finish = _scalar

#: Codes of tokens that stand for a class.
B, ZERO, E, A, N = (np.uint64(_scalar(0x7000000000000000 + i)) for i in range(5))
NAMES = {int(B): "<b>", int(ZERO): "0", int(E): "<e>", int(A): "<a>", int(N): "<n>"}
FOLDED = {"email": E, "address": A, "number": N}


class Stream:
    """Tokens of `texts`; `entities` are (text, start, end, kind) without overlaps."""

    def __init__(self, texts: list[str], entities: list[tuple[int, int, int, str]]):
        pad = "\x00" * PAD
        self.joined = pad + pad.join(texts) + pad
        points = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        abc = alphabet()
        abc.see(points)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        #: Where each text begins in the joined one.
        self.base = PAD + np.concatenate([[0], np.cumsum(lengths + PAD)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
        kind = abc.kind[points]
        tick = np.flatnonzero(kind == TICK)
        inside = (kind[tick - 1] == LETTER) & (kind[np.minimum(tick + 1, len(kind) - 1)] == LETTER)
        kind[tick] = np.where(inside, LETTER, SINGLE)
        starts = np.ones(len(kind), dtype=bool)
        starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == SINGLE) | (kind[1:] == EDGE)
        folded = {}
        for t, a, b, what in entities:
            x, y = int(self.base[t]) + a, int(self.base[t]) + b
            kind[x:y] = ENTITY
            starts[x:y] = False
            starts[x] = True
            if y < len(starts):
                starts[y] = True
            folded[x] = FOLDED[what]
        begin = np.flatnonzero(starts)
        end = np.append(begin[1:], len(kind))
        place = np.arange(len(kind), dtype=np.int32)
        place -= np.repeat(begin.astype(np.int32), end - begin)
        powers = np.full(int(place.max()) + 1 if len(place) else 1, 0xD6E8FEB86659FD93, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        terms = abc.mixed[points]
        terms *= powers[place]
        code = _mix(np.add.reduceat(terms, begin))
        k, first = kind[begin], points[begin]
        code[k == DIGIT] = ZERO
        spaced = np.zeros(len(begin), dtype=bool)
        dash = np.flatnonzero(abc.dash[first] & (k == SINGLE))
        spaced[dash] = np.isin(kind[begin[dash] - 1], (SPACE, BREAK)) & np.isin(kind[np.minimum(end[dash], len(kind) - 1)], (SPACE, BREAK, EDGE))
        code[(k == BREAK) | (k == EDGE) | (abc.stop[first] & (k == SINGLE)) | spaced] = B
        for i in np.flatnonzero(k == ENTITY):
            code[i] = folded.get(int(begin[i]), N)
        keep = k != SPACE
        self.begin, self.end, self.code, self.kind = begin[keep], end[keep], code[keep], k[keep]
        self.n = len(self.begin)
        self.word = (self.kind == LETTER) & (self.end - self.begin > 1)
        self.cap = abc.upper[points[self.begin]]
        self.dot = points[self.begin] == ord(".")
        self.all_upper = ~np.logical_or.reduceat(abc.lower[points], begin)[keep]

    def owner(self, i):
        """The text a token belongs to."""
        return np.searchsorted(self.base, self.begin[i], side="right") - 1

    def at(self, i: np.ndarray) -> np.ndarray:
        """Codes at token places, the end of a text beyond the first and last."""
        ok = (i >= 0) & (i < self.n)
        return np.where(ok, self.code[np.clip(i, 0, max(self.n - 1, 0))] if self.n else B, B)

    def show(self, i: int) -> str:
        """The folded form of a token."""
        if not 0 <= i < self.n:
            return "<b>"
        return NAMES.get(int(self.code[i])) or self.joined[self.begin[i] : self.end[i]].lower()

    def raw(self, i: int) -> str:
        return self.joined[self.begin[i] : self.end[i]]

    def token_at(self, point: np.ndarray) -> np.ndarray:
        """The first token that begins at or after a place of the joined text."""
        return np.searchsorted(self.begin, point)


def run_end(inside: np.ndarray) -> np.ndarray:
    """For every place the next place at or after it where `inside` is false (the length at most)."""
    n = len(inside)
    out = np.append(np.flatnonzero(~inside), n)
    return out[np.searchsorted(out, np.arange(n))]
