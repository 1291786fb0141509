"""Words of whole texts as numpy arrays: boundaries and 64-bit hashes without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes that end a word: the ASCII space and the controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of words made of letters and digits only; every byte of a non-ASCII character counts as a letter.
NOT_ALNUM = np.array([not (chr(b).isalnum() and b < 128 or b >= 128) for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for k, base in enumerate((_MULTIPLIER, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


class Words:
    """The words of some texts: byte ranges, hashes and, for each text, where its words begin."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE, lower: bool = True):
        self.raw = LOWER[raw] if lower else raw
        self._held = None
        inside = ~separators[raw]
        before, after = np.empty_like(inside), np.empty_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        if len(raw):
            before[0] = after[-1] = False
            inner = offsets[1:-1]
            before[inner[inner < len(raw)]] = False
            after[inner[inner > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.of_text = np.searchsorted(self.start, offsets)  # len(texts) + 1 offsets into the words

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        if self._held is None:
            n = len(self.raw)
            power, inverse = _power_tables(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
            self._held = sums, inverse
        return self._held

    def _hashes_to(self, end: np.ndarray) -> np.ndarray:
        sums, inverse = self._sums()
        found = (sums[end] - sums[self.start]) * inverse[self.start]
        return mix(found + (end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def hashes(self) -> np.ndarray:
        return self._hashes_to(self.end)

    def prefix_hashes(self, n: int) -> np.ndarray:
        """Hashes of the first n bytes of each word, or of all of a shorter one."""
        return self._hashes_to(np.minimum(self.end, self.start + n))
