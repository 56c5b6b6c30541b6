"""A wavelet matrix over the character classes of UTF-8 texts.

Each byte gets one of eight classes. The matrix answers how many bytes of a class stand before
a position (`rank`) for any number of positions at once, in one step for each of its three levels.
Ranks of several classes together count the boundaries of a unit: characters, words, sentences or
lines. Bisection on these counts finds where a unit begins.
"""

from __future__ import annotations

import numpy as np

#: Continuation byte; lead byte of a plain character, and of one of several bytes; end of a sentence; gap and
#: newline, each without and with a word right after it.
INNER, PLAIN, WIDE, STOP, GAP, GAP_WORD, NEWLINE, NEWLINE_WORD = range(8)
LEVELS = 3

#: Classes of which a unit is counted by. Characters begin with such a byte; the others end after one.
UNITS = {
    "chars": (PLAIN, WIDE, STOP, GAP, GAP_WORD, NEWLINE, NEWLINE_WORD),
    "words": (GAP_WORD, NEWLINE_WORD),
    "sentences": (STOP,),
    "lines": (NEWLINE, NEWLINE_WORD),
}


def _by_byte() -> np.ndarray:
    table = np.full(256, PLAIN, np.uint8)
    table[0x80:0xC0] = INNER
    table[0xC0:] = WIDE
    table[list(b".!?")] = STOP
    table[list(b" \t\x0b\x0c\r")] = GAP
    table[0x0A] = NEWLINE
    return table


BY_BYTE = _by_byte()


def classes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each byte of texts that stand one after another and end before `ends`."""
    codes = BY_BYTE[data]
    gap = (codes == GAP) | (codes == NEWLINE)
    before_word = gap.copy()
    before_word[:-1] &= ~gap[1:]
    # a gap at the end of a text stands before no word
    before_word[ends[ends > 0] - 1] = False
    return codes + before_word


class Bits:
    """Ones before any position of a row of bits."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    def __init__(self, codes: np.ndarray, levels: int = LEVELS) -> None:
        self.size = len(codes)
        self.levels = []
        for shift in range(levels - 1, -1, -1):
            bit = (codes >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bit)))
            codes = np.concatenate([codes[~bit], codes[bit]])

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """How many bytes of the class stand before each position."""
        start, end = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for shift, bits in self.levels:
            low, high = bits.ones(start), bits.ones(end)
            if code >> shift & 1:
                start, end = bits.zeros + low, bits.zeros + high
            else:
                start, end = start - low, end - high
        return end - start

    def count(self, unit: str, at: np.ndarray) -> np.ndarray:
        """How many bytes that a unit is counted by stand before each position."""
        wanted = UNITS[unit]
        others = [c for c in range(1 << LEVELS) if c not in wanted]
        if len(others) < len(wanted):
            return np.asarray(at, np.int64) - sum(self.rank(c, at) for c in others)
        return sum(self.rank(c, at) for c in wanted)

    def units(self, unit: str, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many units each text has; what follows the last boundary is one too."""
        counted = self.count(unit, ends) - self.count(unit, starts)
        if unit == "chars":
            return counted
        last = self.count(unit, np.maximum(ends - 1, starts))
        open_end = (ends > starts) & (self.count(unit, ends) == last)
        return counted + open_end

    def cut(self, unit: str, starts: np.ndarray, ends: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """Where each text is cut so that `nth` units stand before, by bisection on the counts."""
        target = self.count(unit, starts) + nth
        low, high = starts.copy(), ends.copy()
        if unit == "chars":
            # the last position with no more characters before it: no character is split
            while (open_ := low < high).any():
                mid = (low + high + 1) >> 1
                fits = self.count(unit, mid) <= target
                low, high = np.where(open_ & fits, mid, low), np.where(open_ & ~fits, mid - 1, high)
            return low
        # the first position after the nth boundary; beyond the last one it is the end
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            fits = self.count(unit, mid) >= target
            low, high = np.where(open_ & ~fits, mid + 1, low), np.where(open_ & fits, mid, high)
        return low
