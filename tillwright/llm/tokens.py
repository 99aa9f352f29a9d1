"""Words of many texts at once, as arrays of 64-bit hashes.

Texts stay in their Arrow buffers: word bounds, hashes and word sequences are
array operations over the bytes of a piece of at most a few megabytes, so the
memory of a task is bounded by the piece or its one longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240712)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def spaced() -> np.ndarray:
    """Byte table of words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; 0 ends a word."""
    table = _folded()
    table[[0x20, *range(0x09, 0x0E)]] = 0
    # A NUL byte is a word character; it gets a value of its own.
    table[0] = 256
    return table


def alphanumeric() -> np.ndarray:
    """Byte table of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    table = _folded()
    letters = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
    keep = np.zeros(256, bool)
    keep[letters] = True
    table[~keep] = 0
    return table


def _folded() -> np.ndarray:
    table = np.arange(256, dtype=np.uint16)
    table[0x41:0x5B] += 0x20
    return table


@dataclass
class Words:
    """``hashes[bounds[d]:bounds[d + 1]]`` are the words of text ``d``."""

    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def pieces(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with at most ``limit`` bytes of text, or one row."""
    if not batch.num_rows:
        return
    _, offsets = _buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first, last = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    held = np.frombuffer(data, np.uint8)[first:last] if data is not None else np.zeros(0, np.uint8)
    return held, offsets - first


def words(texts: pa.Array, table: np.ndarray) -> Words:
    """Word hashes of ``texts``; a null text has no words."""
    data, offsets = _buffers(texts)
    codes = table[data]
    inside = codes != 0
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    with np.errstate(over="ignore"):
        values = _BYTE[codes & 0xFF] + (codes >> 8).astype(np.uint64)
        totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            values * _powers(_BASE, len(data)), dtype=np.uint64)])
        hashes = (totals[ends] - totals[starts]) * _powers(_INVERSE, len(data) + 1)[starts]
    return Words(mixed(hashes), np.searchsorted(starts, offsets).astype(np.int64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends); a null text is empty."""
    return _buffers(texts)


def stretches(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from each of ``starts`` to the next one, of the last to the end."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_BYTE[data] * _powers(_BASE, len(data)), starts)
        return mixed(sums * _powers(_INVERSE, len(data) + 1)[starts])


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base ** 2, ... modulo 2 ** 64."""
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        held = np.cumprod(steps, dtype=np.uint64)
        _POWERS[int(base)] = held
    return held[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from every position that has so many words after it."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(size, np.uint64)
        for k in range(n):
            total += mixed(hashes[k:k + size] + _STEP[k % 64] * np.uint64(k // 64 + 1)) * _STEP[k % 64]
    return mixed(total + np.uint64(n))


def running(hashes: np.ndarray) -> np.ndarray:
    """Sums from which :func:`stretch` hashes any stretch of words in one step."""
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(
            hashes * _powers(_BASE, len(hashes)), dtype=np.uint64)])


def stretch(sums: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each of ``starts``."""
    with np.errstate(over="ignore"):
        return mixed((sums[starts + n] - sums[starts]) * _powers(_INVERSE, len(sums))[starts]
                     + _STEP[0] * np.uint64(n))
