"""DartMinHash signatures of weighted sets of word shingles.

Every shingle owns a plane of weight times rank, cut along the weight into
cells [0, 1), [1, 2), [2, 4), ... Into each cell hashed darts fall as a Poisson
process of unit rate, the same for every document: a dart is the sum of
exponential gaps drawn from hashes of (shingle, cell, number). A document sees
the darts below its weights (partly covered cells keep the darts whose hashed
weight is covered) and below a rank that lets about k (ln k + 4) darts
through, so only few are generated whatever the document's length. Each dart
belongs to one of k coordinates; the earliest of each coordinate is kept. Two
documents keep the same dart with the chance of their weighted Jaccard
similarity, sum of minima over sum of maxima.
"""

from __future__ import annotations

import numpy as np

from riskforge.llm.words import find, mix64

SHINGLE = 5
BANDS, ROWS = 32, 5
K = BANDS * ROWS
#: Documents in one batch, and bits of a shingle: together one sorting key.
BATCH = 1 << 12
_BITS = np.uint64(52)
_LOW = np.uint64((1 << 52) - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = mix64(np.arange(1, 17, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingle hashes (52 bits, repeated as often as they occur) of every
    text, and where each text's begin. A text of fewer words, but not none, has
    one shingle. At most ``BATCH`` texts."""
    h, _, _, first = find(data, at)
    n = np.diff(first)
    own = np.maximum(n - SHINGLE + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(own)])
    doc = np.repeat(np.arange(len(n)), own)
    place = np.arange(begin[-1]) - begin[doc] + first[doc]
    padded = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    value = np.zeros(len(place), np.uint64)
    for j in range(SHINGLE):
        inside = j < n[doc]  # a short text's words only
        value += np.where(inside, padded[place + j] * _FACTORS[j], np.uint64(0))
    value = mix64(value) & _LOW
    key = np.sort(doc.astype(np.uint64) << _BITS | value)
    return key & _LOW, begin


def _throw(element, cell, level, theta, doc, weight, slots, k):
    """Throw all darts of rank below theta into cells, keep the earliest."""
    width = np.ldexp(1.0, np.maximum(level - 1, 0))
    low = np.where(level == 0, 0.0, width)
    seed = mix64(element * _ODD + cell)
    expected = theta * width
    for a, b in ((0, 2), (2, 8), (8, 32), (32, 128), (128, 512), (512, 2048), (2048, np.inf)):
        rows = np.flatnonzero((expected >= a) & (expected < b))
        step = int(np.ceil(min(max(expected[rows].max(initial=1), 1) * 1.2, 4096))) + 1 if len(rows) else 1
        done, past = 0, np.zeros(len(rows))
        while len(rows):
            # blocks of rows keep the matrix of darts small
            stay, ends = [], []
            size = max(1, (1 << 19) // step)
            for lo in range(0, len(rows), size):
                r = rows[lo : lo + size]
                x = mix64(seed[r][:, None] + (np.arange(done, done + step, dtype=np.uint64) * _ODD)[None, :])
                gaps = -np.log(((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
                gaps[:, 0] += past[lo : lo + size]
                time = np.cumsum(gaps, axis=1)
                rank = time / width[r][:, None]
                i, j = np.nonzero(rank < theta[r][:, None])
                dart, e = x[i, j], r[i]
                covered = weight[e] >= low[e] + width[e]
                if not covered.all():
                    part = (mix64(dart) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                    covered |= low[e] + part * width[e] < weight[e]
                e, dart, ranks = e[covered], dart[covered], rank[i, j][covered]
                coordinate = ((dart & np.uint64(0x7FF)) * np.uint64(k) >> np.uint64(11)).astype(np.int64)
                np.minimum.at(slots, doc[e] * k + coordinate, ranks)
                more = rank[:, -1] < theta[r]
                stay.append(r[more])
                ends.append(time[more, -1])
            rows, past, done = np.concatenate(stay), np.concatenate(ends), done + step
            step = max(4, step // 2)


def signatures(values: np.ndarray, begin: np.ndarray, k: int = K, extra: float = 4.0) -> np.ndarray:
    """One row of k ranks for each text; texts without shingles get NaN."""
    if k > 1 << 11:
        raise ValueError("a dart's coordinate has 11 bits")
    texts = len(begin) - 1
    slots = np.full(texts * k, np.inf)
    doc = np.repeat(np.arange(texts), np.diff(begin))
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.concatenate([at, [len(values)]])).astype(np.float64)
    element, doc = values[at], doc[at]
    total = np.diff(begin).astype(np.float64)
    theta = k * (np.log(k) + extra) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        mine = todo[doc]
        level = 0
        while True:
            # level 0 is [0, 1), level c is [2^(c-1), 2^c)
            rows = mine & (weight > (0 if level == 0 else 2.0 ** (level - 1)))
            if not rows.any():
                break
            d = doc[rows]
            _throw(element[rows], np.uint64(level), np.full(len(d), level), theta[d], d, weight[rows], slots, k)
            level += 1
        todo = todo & np.isinf(slots.reshape(texts, k)).any(axis=1)
        theta = np.where(todo, theta * 2, theta)
    out = slots.reshape(texts, k)
    out[total == 0] = np.nan
    return out


def bands(signature: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    bits = signature.view(np.uint64).reshape(len(signature), n_bands, rows)
    key = np.zeros((len(signature), n_bands), np.uint64)
    for j in range(rows):
        key = mix64(key * _ODD + bits[:, :, j])
    return mix64(key + np.arange(1, n_bands + 1, dtype=np.uint64)[None, :] * _ODD).view(np.int64)


def odd_sketches(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity bitmaps of the texts' shingles, in 64-bit words, and where each
    text's begin. Every occurrence flips one bit of at least four a shingle, so
    two bitmaps differ in no more bits than the sets have unshared shingles: a
    bound without loss. Sizes are powers of two; halves of a bitmap combined by
    exclusive or are the bitmap of half the size."""
    n = np.diff(begin)
    doc = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(values))
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    number = at - np.maximum.accumulate(np.where(new, at, 0)) if len(at) else at
    words = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(n, 1) * 4 / 64)).clip(0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(words)])
    place = mix64(values + number.astype(np.uint64) * _ODD) & (words[doc] * 64 - 1).astype(np.uint64)
    out = np.zeros(first[-1], np.uint64)
    np.bitwise_xor.at(out, first[doc] + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out, first


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted arrays with repeats."""
    if not len(a) or not len(b):
        return 0.0
    x, m = np.unique(a, return_counts=True)
    y, n = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    shared = float(np.minimum(m[i], n[j]).sum())
    return shared / (len(a) + len(b) - shared)
