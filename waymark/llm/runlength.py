"""A run-length index: the Burrows-Wheeler transform of many short strings as runs, searched backwards.

Positions are sorted by their first `width` symbols only; that order takes a backward search of up to `width` symbols
as the full order does, and among equal strings it is free to put those with equal symbols before them together, which
makes copies one run.  Each run has a sample at its head, the smallest label of the strings that it comes from.

`matches` streams strings past the index from their ends to their starts: a step takes the interval of the match so
far, shortens it at its end where it has `width` symbols already (to the interval of its first `width` - 1, which is
kept), and extends it by the symbol before with two ranks over the runs.  The matching statistic at a position is the
length of the longest match that starts there, `width` at most, and the smallest sample of its interval.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def changes(x: np.ndarray) -> np.ndarray:
    """Where a sorted array changes, its start included."""
    return np.flatnonzero(np.r_[len(x) > 0, x[1:] != x[:-1]])


def ranked(key: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones."""
    order = np.argsort(key)
    out = np.empty(len(key), np.uint64)
    ordered = key[order]
    out[order] = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]]).view(np.uint64)
    return out


@dataclass
class RunLengthIndex:
    width: int
    n: int
    rows: np.ndarray  # of the runs, by symbol and place: symbol * (n + 1) + place
    before: np.ndarray  # how many of the run's symbol stand before it
    sizes: np.ndarray
    begins: np.ndarray  # of each symbol's interval
    deep: np.ndarray  # per row, the interval of its first `width` symbols
    flat: np.ndarray  # per row, the start of the interval of its first `width` - 1 symbols
    flat_end: np.ndarray
    least: np.ndarray  # per deep interval, the smallest sample of its runs
    alphabet: np.ndarray  # symbol of each byte

    @classmethod
    def of(cls, strings: list[bytes], labels: np.ndarray, width: int) -> RunLengthIndex:
        used = np.bincount(np.frombuffer(b"".join(strings), np.uint8), minlength=256) > 0
        alphabet = np.cumsum(used) * used  # 0 ends a string
        lanes = 8 if used.sum() < 256 else 4
        text, label = laid_out(strings, alphabet, labels)
        n = len(text)
        packed = np.zeros(n, np.uint64)
        for i in range(lanes):
            packed = packed << np.uint64(64 // lanes) | np.roll(text, -i).astype(np.uint64)
        part = ranked(packed)
        while 2 * lanes <= width - 1:
            part, lanes = ranked(part << np.uint64(32) | np.roll(part, -lanes)), 2 * lanes
        rest, shorter = np.roll(part, lanes - width), np.roll(part, lanes - width + 1)  # of the last symbols of `width`, and of one less
        previous = np.roll(text, 1).astype(np.uint64)
        bits = np.uint64(int(part.max()).bit_length())
        if 2 * int(bits) + 9 > 64:
            raise ValueError("takes fewer symbols at a time")
        key = (part << bits | rest) << np.uint64(9) | previous
        order = np.argsort(key)
        key, label = key[order], label[order]
        previous, whole, shorter = (key & np.uint64(511)).astype(np.int64), key >> np.uint64(9), part[order] << np.uint64(32) | shorter[order]
        heads = changes(key)  # runs end where intervals do, so that samples are theirs
        sample = np.minimum.reduceat(label, heads)
        starts = changes(whole)
        least = np.minimum.reduceat(sample, np.searchsorted(heads, starts))
        flat = changes(shorter)
        spans = np.diff(np.r_[flat, n])
        symbol, sizes = previous[heads], np.diff(np.r_[heads, n])
        by_symbol = np.argsort(symbol, kind="stable")
        symbol, sizes = symbol[by_symbol], sizes[by_symbol]
        total = np.cumsum(sizes) - sizes
        begins = np.r_[0, np.cumsum(np.bincount(text, minlength=258))][:258]
        return cls(
            width, n, symbol * (n + 1) + heads[by_symbol], total - begins[symbol], sizes, begins,
            np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n])), np.repeat(flat, spans), np.repeat(flat + spans, spans), least, alphabet,
        )

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How many of each symbol stand before each place of the transform."""
        at = np.searchsorted(self.rows, symbol * (self.n + 1) + place, side="right") - 1
        found = (at >= 0) & (self.rows[at] >= symbol * (self.n + 1))
        return np.where(found, self.before[at] + np.minimum(symbol * (self.n + 1) + place - self.rows[at], self.sizes[at]), 0)

    def matches(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(string, position, length, sample) of every position: its matching statistic; sample is -1 for shorter matches.

        The strings hold no symbols but the index's; a symbol that it lacks ends the match.
        """
        sizes = np.array([len(s) for s in strings], np.int64)
        text = self.alphabet[np.frombuffer(b"".join(strings), np.uint8)]
        starts = np.cumsum(sizes) - sizes
        place, length = sizes.copy(), np.zeros(len(sizes), np.int64)
        low, high = np.zeros(len(sizes), np.int64), np.full(len(sizes), self.n)
        out = []
        some = np.flatnonzero(place)
        while len(some):
            place[some] -= 1
            symbol = text[starts[some] + place[some]]
            full = length[some] == self.width
            here = low[some]
            a, b = np.where(full, self.flat[np.minimum(here, self.n - 1)], here), np.where(full, self.flat_end[np.minimum(here, self.n - 1)], high[some])
            a, b = self.begins[symbol] + self.rank(symbol, a), self.begins[symbol] + self.rank(symbol, b)
            lost = (symbol == 0) | (a >= b)
            length[some] = np.where(lost, 0, np.minimum(length[some] + 1, self.width))
            low[some], high[some] = np.where(lost, 0, a), np.where(lost, self.n, b)
            sample = np.where(length[some] == self.width, self.least[self.deep[np.where(lost, 0, a)]], -1)
            out.append((some, place[some], length[some], sample))
            some = some[place[some] > 0]
        empty = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (empty,) * 4


def laid_out(strings: list[bytes], alphabet: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the strings one after the other, each ended by 0, and the label of each symbol's string."""
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    text = np.zeros(int(sizes.sum()), np.uint16)
    inside = np.ones(len(text), bool)
    inside[np.cumsum(sizes) - 1] = False
    text[inside] = alphabet[np.frombuffer(b"".join(strings), np.uint8)]
    return text, np.repeat(labels, sizes)
