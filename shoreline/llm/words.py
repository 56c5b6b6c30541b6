"""Word hashes of whole texts, computed on Arrow buffers.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is a polynomial over its
bytes modulo 2**64, read off prefix sums, so a block of text costs a few array operations
and no Python step per word. Blocks end between words; a text of any length is read in
pieces of about BLOCK bytes and keeps 8 bytes per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_STEP = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _byte_values(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
    if fold:
        values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit integers (splitmix64)."""
    x = x.astype(_U, copy=True)
    high = x >> _U(30)
    x ^= high
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, _U(27), out=high)
    x *= _U(0x94D049BB133111EB)
    x ^= np.right_shift(x, _U(31), out=high)
    return x


_VALUES = {fold: _byte_values(fold) for fold in (False, True)}
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_IN_WORD = ~_IS_SPACE
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


def _hash_block(data: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of one block."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.take(_IN_WORD, data, out=inside[1:-1])
    places = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = places[::2], places[1::2]
    up, down = _powers(len(data) + 1)
    terms = np.take(values, data)
    terms *= up[: len(data)]
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(terms, out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(_U) * _U(0x632BE59BD9B4E019)), starts, ends


def _blocks(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            tail = np.flatnonzero(_IS_SPACE[data[at:end]])
            if len(tail):
                end = at + int(tail[-1]) + 1
                break
            end = min(end + BLOCK, len(data))
        yield at, data[at:end]
        at = end


def hash_words(data: np.ndarray, fold: bool = False, spans: bool = False):
    """Word hashes of one text given as bytes, with byte starts and ends if `spans`.

    `fold` takes A-Z as a-z.
    """
    values = _VALUES[fold]
    parts = [(h, s + at, e + at) for at, block in _blocks(data) for h, s, e in [_hash_block(block, values)]]
    if not parts:
        empty = np.zeros(0, dtype=np.int64)
        return (empty.astype(_U), empty, empty) if spans else empty.astype(_U)
    if not spans:
        return parts[0][0] if len(parts) == 1 else np.concatenate([p[0] for p in parts])
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


def texts_as_bytes(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each text of an Arrow column, without a copy; None for null."""
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        kind = np.int64 if pa.types.is_large_string(chunk.type) else np.int32
        _, offsets, data = chunk.buffers()
        at = np.frombuffer(offsets, dtype=kind)[chunk.offset : chunk.offset + len(chunk) + 1] if len(chunk) else []
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        valid = chunk.is_valid().to_numpy(zero_copy_only=False)
        for i in range(len(chunk)):
            yield raw[at[i] : at[i + 1]] if valid[i] else None


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; of the whole sequence if it is shorter but not empty.

    A run's polynomial is put together from those of shorter runs, of 1, 2, 4, ... words.
    """
    if not len(words):
        return words
    n = min(n, len(words))
    run, length = words, 1
    total, done = None, 0

    def after(one: np.ndarray, a: int, two: np.ndarray, b: int) -> np.ndarray:
        joined = one[: len(words) - a - b + 1] * _U(pow(_STEP, b, 1 << 64))
        joined += two[a : len(words) - b + 1]
        return joined

    while True:
        if n & length:
            total, done = (run, length) if total is None else (after(total, done, run, length), done + length)
        if done == n:
            return mix(total + _U(n))
        run, length = after(run, length, run, length), 2 * length


def give_back() -> None:
    """Return what this worker has freed to the system; an idle worker would keep it beside the other one's tasks."""
    pa.default_memory_pool().release_unused()
    # only glibc has it
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a task; after the last one its worker gives memory back."""
    try:
        yield from rows
    finally:
        give_back()
