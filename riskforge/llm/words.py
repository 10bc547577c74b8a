"""Words of UTF-8 texts, found and hashed in numpy on Arrow's own buffers.

A word is a longest run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became
a-z: ASCII digits and letters and every byte of a non-ASCII code point, so the
bytes of the text can be classed one by one. A word's 64-bit hash is a
polynomial of its bytes, mixed; two different words share one with a chance of
about 1 in 10^19.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BYTE = np.zeros(256, np.uint8)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
    _BYTE[_b] = _b
_BYTE[65:91] = np.arange(97, 123)

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_SLICE = 1 << 21
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        size = max(n, _SLICE + (1 << 12))
        for name, base in (("p", _P), ("q", _P_INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["p"], _powers["q"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit values (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends.
    A null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def find(
    data: np.ndarray, at: np.ndarray, as_read: np.ndarray = _BYTE, kinds: np.ndarray = _BYTE != 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of every word, and the number of words
    before each text (one more entry than texts). By other tables: ``kinds``
    gives each byte's kind (0: between words; a word is a run of one kind),
    ``as_read`` the byte that enters the hash."""
    hashes, starts, ends = [], [], []
    low, n = 0, len(data)
    while low < n:
        high = min(n, low + _SLICE)
        while high < n and kinds[data[high]]:  # a cut falls on a byte outside words
            step = data[high : high + 4096]
            stop = np.flatnonzero(kinds[step] == 0)
            high += int(stop[0]) if len(stop) else len(step)
        part = as_read[data[low:high]]
        kind = kinds[data[low:high]]
        inner = at[(at > low) & (at < high)] - low
        edge = np.empty(len(part) + 1, bool)  # a run of one kind may begin or end before this byte
        edge[0] = edge[-1] = True
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[inner] = True
        word = kind != 0
        s = np.flatnonzero(word & edge[:-1])
        e = np.flatnonzero(word & edge[1:]) + 1
        p, q = _power(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * p[: len(part)], out=sums[1:])
        hashes.append(mix64((sums[e] - sums[s]) * q[s]))
        starts.append(s + low)
        ends.append(e + low)
        low = high
    empty = np.zeros(0, np.int64)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else empty
    e = np.concatenate(ends) if ends else empty
    return h, s, e, np.searchsorted(s, at)


def groups(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive ranges of rows whose sizes sum to about ``most``; a larger
    row is a range of its own."""
    out, low, total = [], 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and total + size > most:
            out.append((low, i))
            low, total = i, 0
        total += size
    if low < len(sizes):
        out.append((low, len(sizes)))
    return out


def ordered_ids(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, each value's place among them)."""
    n = len(values)
    bits = max(1, int(n - 1).bit_length()) if n else 1
    low = np.uint64((1 << bits) - 1)
    packed = np.sort((values & ~low) | np.arange(n, dtype=np.uint64))  # value's high bits and row in one sort
    row = (packed & low).astype(np.int64)
    in_order = values[row]
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = in_order[1:] != in_order[:-1]
    if n and np.any(new[1:] & (packed[1:] >> np.uint64(bits) == packed[:-1] >> np.uint64(bits))):
        return np.unique(values, return_inverse=True)  # two values share the high bits
    ids = np.empty(n, np.int64)
    ids[row] = np.cumsum(new) - 1
    return in_order[new], ids
