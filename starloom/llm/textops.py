"""Work on whole columns of texts inside a task: Arrow buffers in, numpy arrays out.

Words are the runs of bytes other than space and tab to carriage return. Their hashes are polynomials over bytes modulo
2**64 with a final mix, so they are the same on every machine and need no table of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18  # bytes that are worked on at once; their arrays stay in the processor's cache

_random = np.random.default_rng(20240601)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings or binaries, and where each value begins; null is empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, text: str = "text", size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about ``size`` bytes of text; a longer text is alone."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def _powers(n: int, cache: list[np.ndarray] = [np.ones(1, np.uint64)]) -> np.ndarray:  # noqa: B006
    if len(cache[0]) < n:
        with np.errstate(over="ignore"):
            cache[0] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 64) - 1, _BASE)]).astype(np.uint64))
    return cache[0]


def _piece(data: np.ndarray, begins: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    inside = np.flatnonzero(~SPACE[data])
    if not len(inside):
        return np.zeros(0, np.uint64), inside
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    new = np.empty(len(inside), bool)
    new[0] = True
    new[1:] = (np.diff(inside) > 1) | first[inside[1:]]
    at = np.flatnonzero(new)
    place = np.arange(len(inside)) - np.repeat(at, np.diff(np.append(at, len(inside))))
    letters = data[inside]
    if lower:
        letters = LOWER[letters]
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_BYTE[letters] * _powers(int(place.max()) + 1)[place], at)
    return mix(sums), inside[at]


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where it begins. Long data is cut between words."""
    hashes, places, at = [], [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not SPACE[data[end]]:
            gap = np.flatnonzero(SPACE[data[end : end + PIECE]])
            end = end + int(gap[0]) if len(gap) else min(end + PIECE, len(data))
        begins = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end, "right")] - at
        h, p = _piece(data[at:end], begins, lower)
        hashes.append(h)
        places.append(p + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def rows_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which value each place lies in."""
    return np.searchsorted(offsets, places, "right") - 1


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` (one per byte) in each value."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def six_bytes(x: np.ndarray) -> bytes:
    """Numbers of 48 bits in six bytes each."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def from_six_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel().astype(np.uint64)


def begins_run(*keys: np.ndarray) -> np.ndarray:
    """Whether a row begins a run of equal keys; the arrays are sorted."""
    first = np.zeros(len(keys[0]), bool)
    first[:1] = True
    for k in keys:
        first[1:] |= k[1:] != k[:-1]
    return first
