"""Vectorised numpy kernels over the UTF-8 buffers of Arrow columns.

Texts of a batch stay in one byte buffer with offsets; words, shingles and windows are index
ranges of it.  All hashes are 64-bit, wrap modulo 2**64 and end in a non-linear mix.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa

U = np.uint64
_GOLD = U(0x9E3779B97F4A7C15)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; ``h`` may be changed in place."""
    h = h + _GOLD
    h ^= h >> U(30)
    h *= _M1
    h ^= h >> U(27)
    h *= _M2
    h ^= h >> U(31)
    return h


_LETTER = mix(np.arange(256, dtype=U) + U(977)) | U(1)
_LETTER_FOLDED = _LETTER.copy()
_LETTER_FOLDED[65:91] = _LETTER[97:123]
_BASE = 0x2545F4914F6CDD1D
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64, for i below n (kept between calls)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            out = np.ones(size, U)
            done, step = 1, b
            while done < size:
                more = min(done, size - done)
                out[done : done + more] = out[:more] * U(step)
                step = step * step % (1 << 64)
                done += more
            both.append(out)
        have = _powers[base] = (both[0], both[1])
    return have


_kept: dict[Any, Any] = {}


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """What ``make`` makes, one for all tasks of a worker until a map with another key, or with none, begins there."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def lean(run: Callable[..., Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A map of batches that leaves its worker small.

    Spark goes on with the same workers in later stages, so what is held after a map stands beside the next one's.  Before it, what
    others have ``kept`` goes, unless the map ``keeps`` something itself; after it, Arrow gives unused memory back.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _kept.clear()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return wrapped


#: Bytes that separate words: space and \t \n \v \f \r.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE = np.zeros(256, bool)
SPACE[list(SPACES)] = True
NOT_SPACE = ~SPACE


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):  # no rows, or more than one chunk can hold
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def pieces(offsets: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Row ranges whose texts hold about ``most`` bytes together; a longer text stands alone."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        out.append((i, min(j, n)))
        i = out[-1][1]
    return out


def words(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and one past the last): words never span rows."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    at = offsets[:-1]
    before[at[at < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = before  # the buffer is used again
    after[:-1] = inside[1:]
    after[-1] = False
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """A hash of each word's bytes; ``fold``: A-Z count as a-z."""
    if not len(starts):
        return np.zeros(0, U)
    up, down = powers(_BASE, len(buf) + 1)
    total = np.empty(len(buf) + 1, U)
    total[0] = 0
    letters = (_LETTER_FOLDED if fold else _LETTER)[buf]
    letters *= up[: len(buf)]
    np.cumsum(letters, out=total[1:])
    h = total[ends]
    h -= total[starts]
    h *= down[starts]
    return mix(h ^ (ends - starts).astype(U))


def windows(h: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values of ``h``."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    up, down = powers(base, len(h) + 1)
    total = np.zeros(len(h) + 1, U)
    np.cumsum(h * up[: len(h)], out=total[1:])
    w = total[width:] - total[:n]
    w *= down[:n]
    return mix(w)


def inside_rows(first: np.ndarray, width: int, total: int) -> np.ndarray:
    """True for each of ``total`` positions at which a window of ``width`` stays in its row.

    ``first``: the first position of each row, and the end.
    """
    ok = np.zeros(total + 1, np.int32)
    lo, hi = first[:-1], first[1:] - width + 1
    good = hi > lo
    np.add.at(ok, lo[good], 1)
    np.add.at(ok, hi[good], -1)
    return np.cumsum(ok[:total]) > 0


def covered(starts: np.ndarray, width: int, total: int) -> np.ndarray:
    """True for each of ``total`` positions inside a window [s, s + width) of ``starts``."""
    d = np.zeros(total + 1, np.int32)
    d[starts] += 1
    np.subtract.at(d, np.minimum(starts + width, total), 1)
    return np.cumsum(d[:total]) > 0
