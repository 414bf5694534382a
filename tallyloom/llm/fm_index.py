"""A bidirectional FM-index over a set of words, searched for many patterns at once.

The text is the words one after the other, each with a delimiter before it, read
as a ring. Its sorted rotations and those of the reversed text are kept as
wavelet matrices, which count a symbol, and the smaller ones, before any place.
A match is an interval of ranks in both orders; it grows by a letter to the left
or to the right, and one interval follows from the other. All searches of a call
take a step together, so each step is a few array operations.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DELIMITER = 0


class WaveletMatrix:
    """Counts of symbols in the front of a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (symbols >> bit) & 1
            zeros = np.concatenate([[0], np.cumsum(one == 0)]).astype(np.int32)
            self.levels.append((bit, zeros))
            order = np.argsort(one, kind="stable")
            symbols = symbols[order]

    def before(self, symbol: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often ``symbol``, and smaller ones, come in the first ``place`` symbols."""
        first, less = np.zeros_like(place), np.zeros_like(place)
        for bit, zeros in self.levels:
            one = ((symbol >> bit) & 1).astype(bool)
            z_first, z_place = zeros[first], zeros[place]
            less += np.where(one, z_place - z_first, 0)
            first = np.where(one, zeros[-1] + first - z_first, z_first)
            place = np.where(one, zeros[-1] + place - z_place, z_place)
        return place - first, less


def sorted_rotations(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``text`` in order, by prefix doubling; no two may be equal."""
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        key = rank * len(text) + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(len(text), dtype=np.int64)
        new[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if new[order[-1]] == len(text) - 1 or width >= len(text):
            return order
        rank, width = new, 2 * width


@dataclass
class Matches:
    """Intervals of ranks: ``lo`` in the text's rotations, ``back`` in the reversed text's, ``width`` in both."""

    lo: np.ndarray
    back: np.ndarray
    width: np.ndarray

    def take(self, at: np.ndarray) -> Matches:
        return Matches(self.lo[at], self.back[at], self.width[at])


class FmIndex:
    """``words`` are distinct and not empty; letters are numbered from 1 in code-point order."""

    def __init__(self, words: list[str]):
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.letters = np.unique(points)
        length = np.array([len(w) for w in words], dtype=np.int64)
        begin = np.concatenate([[0], np.cumsum(length + 1)])
        text = np.zeros(begin[-1], dtype=np.int64)
        inside = np.ones(len(text), dtype=bool)
        inside[begin[:-1]] = False
        text[inside] = np.searchsorted(self.letters, points) + 1
        owner = np.repeat(np.arange(len(words)), length + 1)
        bits = max(1, int(len(self.letters)).bit_length())
        self.size = len(text)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.letters) + 1))])
        order = sorted_rotations(text)
        self.owner = owner[order]  # of the rotation at each rank
        self.left = WaveletMatrix(text[order - 1], bits)
        mirrored = text[::-1].copy()
        order = sorted_rotations(mirrored)
        self.follows = mirrored[order - 1]  # the letter to the right of a match, by the reversed text's ranks
        self.right = WaveletMatrix(self.follows, bits)

    def encode(self, points: np.ndarray) -> np.ndarray:
        """Numbers of letters; -1 for one that no word has."""
        at = np.minimum(np.searchsorted(self.letters, points), max(0, len(self.letters) - 1))
        known = self.letters[at] == points if len(self.letters) else np.zeros(len(points), dtype=bool)
        return np.where(known, at + 1, -1)

    def everywhere(self, n: int) -> Matches:
        return Matches(np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.full(n, self.size, dtype=np.int64))

    def _step(self, side: WaveletMatrix, start: np.ndarray, other: np.ndarray, width: np.ndarray, symbol: np.ndarray):
        known = np.maximum(symbol, 0)
        low, low_less = side.before(known, start)
        high, high_less = side.before(known, start + width)
        return self.smaller[known] + low, other + high_less - low_less, np.where(symbol >= 0, high - low, 0)

    def to_the_left(self, m: Matches, symbol: np.ndarray) -> Matches:
        lo, back, width = self._step(self.left, m.lo, m.back, m.width, symbol)
        return Matches(lo, back, width)

    def to_the_right(self, m: Matches, symbol: np.ndarray) -> Matches:
        back, lo, width = self._step(self.right, m.back, m.lo, m.width, symbol)
        return Matches(lo, back, width)

    def next_letters(self, m: Matches) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``m`` and the different letters, delimiters left out, that follow their matches."""
        kinds = len(self.letters) + 1
        wide = m.width > kinds
        narrow = np.flatnonzero(~wide)
        row = np.repeat(narrow, m.width[narrow])
        step = np.arange(len(row)) - np.repeat(np.cumsum(m.width[narrow]) - m.width[narrow], m.width[narrow])
        pair = np.unique(row * kinds + self.follows[m.back[row] + step])
        some = np.flatnonzero(wide)
        every = (some[:, None] * kinds + np.arange(1, kinds)).ravel()
        pair = np.concatenate([pair[pair % kinds != DELIMITER], every])
        return pair // kinds, pair % kinds

    def one_error(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (pattern, word of the index) one insertion, deletion or change apart, each once, of those
        that have the pattern's first ``exact`` letters in common."""
        length = np.array([len(w) for w in words], dtype=np.int64)
        begin = np.concatenate([[0], np.cumsum(length)])
        # one more place, so that a look past the last letter finds something
        letters = np.append(self.encode(np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")), -1)
        row, m = np.arange(len(words)), self.everywhere(len(words))
        for step in range(int(exact.max(initial=0)) + 1):  # the exact part from its last letter on, then its delimiter
            left = exact[row] - step
            at = np.flatnonzero(left >= 0)
            symbol = np.where(left[at] > 0, letters[begin[row[at]] + np.maximum(left[at] - 1, 0)], DELIMITER)
            grown = self.to_the_left(m.take(at), symbol)
            m.lo[at], m.back[at], m.width[at] = grown.lo, grown.back, grown.width
            keep = m.width > 0
            row, m = row[keep], m.take(keep)
        place = exact[row]
        late_row, late_place, late = row[:0], place[:0], m.take(np.arange(0))  # with the error behind them
        hits: list[tuple[np.ndarray, np.ndarray]] = []
        while len(row) or len(late_row):
            due = late_place < length[late_row]
            symbol = np.where(due, letters[np.minimum(begin[late_row] + late_place, len(letters) - 1)], DELIMITER)
            late = self.to_the_right(late, symbol)
            done = np.flatnonzero(~due & (late.width > 0))
            hits.append((late_row[done], self.owner[late.lo[done]]))
            go = np.flatnonzero(due & (late.width > 0))
            rows, places, grown = [late_row[go]], [late_place[go] + 1], [late.take(go)]
            # the error: another letter, one more (behind a run of the same letter), one less (the last of a run)
            expected = np.where(place < length[row], letters[np.minimum(begin[row] + place, len(letters) - 1)], DELIMITER)
            source, other = self.next_letters(m)
            differs = other != expected[source]
            source, other = source[differs], other[differs]
            more = self.to_the_right(m.take(source), other)
            inside = place[source] < length[row[source]]
            rows += [row[source], row[source][inside]]
            places += [place[source], place[source][inside] + 1]
            grown += [more, more.take(inside)]
            following = np.where(place + 1 < length[row], letters[np.minimum(begin[row] + place + 1, len(letters) - 1)], DELIMITER)
            less = np.flatnonzero((place < length[row]) & (following != expected) | ((place + 1 == length[row])))
            rows.append(row[less])
            places.append(place[less] + 1)
            grown.append(m.take(less))
            late_row, late_place = np.concatenate(rows), np.concatenate(places)
            late = Matches(*(np.concatenate([getattr(g, f) for g in grown]) for f in ("lo", "back", "width")))
            on = np.flatnonzero(place < length[row])
            m = self.to_the_right(m.take(on), expected[on])
            row, place = row[on], place[on] + 1
            keep = m.width > 0
            row, place, m = row[keep], place[keep], m.take(keep)
        pattern = np.concatenate([h[0] for h in hits]) if hits else np.zeros(0, dtype=np.int64)
        word = np.concatenate([h[1] for h in hits]) if hits else np.zeros(0, dtype=np.int64)
        pair = np.unique(pattern * max(1, self.size) + word)
        return pair // max(1, self.size), pair % max(1, self.size)
