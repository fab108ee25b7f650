"""Column-wise construction of a collection's Burrows-Wheeler transform.

All strings are read from their last symbol to their first, one symbol of each
in every round. A round writes the symbols in front of the suffixes that were
inserted last, finds where the suffixes longer by one symbol belong (the rank of
the symbol among its equals), and merges them into two columns: the transform
and the lengths of the common prefixes of neighbours. Both columns are passed
through in order only, once a round.

A symbol may be several bytes: where only prefixes of ``length`` bytes count, a
symbol is as many bytes as divide that length, up to ``WIDEST``. Each string is
then there once for each of its last bytes left out, so that every suffix begins
with a whole symbol; there are as many suffixes as with single bytes, in a
fraction of the rounds. Symbols need one order, whichever it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

END = 0
WIDEST = 5


def _minima(lcp: np.ndarray) -> np.ndarray:
    """Row k: the smallest of each ``2 ** k`` consecutive values."""
    out = np.empty((len(lcp).bit_length(), len(lcp)), np.uint8)
    out[0] = lcp
    for k in range(1, len(out)):
        w = 1 << k - 1
        np.minimum(out[k - 1, : len(lcp) - 2 * w + 1], out[k - 1, w : len(lcp) - w + 1], out=out[k, : len(lcp) - 2 * w + 1])
    return out


def _least(minima: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Smallest of the values from ``first`` to before ``last``, none of these spans empty: of two that cover it."""
    level = np.frexp(last - first)[1].astype(np.int64) - 1
    row, flat = level * minima.shape[1], minima.ravel()
    return np.minimum(flat[row + first], flat[row + last - (1 << level)])


def build(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(transform, common prefixes) of the strings ``data[start:start + size]`` of bytes below 255 and of sizes below 255.

    The transform has a byte plus 1 for each symbol and ``END`` in front of whole
    strings. It starts with the empty suffixes, in the strings' order.
    """
    symbols, places, lcp = _columns(data, starts + sizes, sizes, 1)
    bwt = np.full(len(lcp), END, np.uint8)
    bwt[places] = symbols + 1
    return bwt, lcp


def _columns(symbols: np.ndarray, ends: np.ndarray, counts: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of the transform in order, their places, common prefixes). The ``j``-th last of a string's ``counts`` symbols stands at ``end - j * step``."""
    m, n, total = len(ends), len(ends), len(ends) + int(counts.sum())
    bits = total.bit_length()
    kind = np.int32 if (int(symbols.max(initial=0)) + 1) << bits < 1 << 31 else np.int64
    place = kind((1 << bits) - 1)
    lcp = np.zeros(m + 1, np.uint8)  # and a zero at its end
    sorted_ = np.empty(0, kind)  # (symbol, place) of each symbol of the transform, as one number, in order: their ranks
    at, left = np.arange(m, dtype=kind), counts  # of the strings that go on, in the order of their longest suffixes
    for j in range(1, int(counts.max(initial=0)) + 1):
        if (left < j).any():
            on = left >= j
            at, left, ends = at[on], left[on], ends[on]
        key = symbols[ends - j * step].astype(kind) << kind(bits) | at
        turn = np.argsort(key)
        key, at, left, ends = key[turn], at[turn], left[turn], ends[turn]
        symbol = key >> kind(bits)
        rank = np.searchsorted(sorted_, key) + np.arange(len(at))
        sorted_ = _with(sorted_, rank, key)
        before = sorted_[rank - 1]
        k = np.flatnonzero((rank > 0) & (before >> kind(bits) == symbol))
        minima, ahead = _minima(lcp), np.zeros(len(at), np.uint8)
        if len(k):
            ahead[k] = _least(minima, (before[k] & place) + 1, at[k] + 1) + np.uint8(1)
        after = sorted_[np.minimum(rank + 1, len(sorted_) - 1)]
        k = np.flatnonzero((rank + 1 < len(sorted_)) & (after >> kind(bits) == symbol))
        behind = _least(minima, at[k] + 1, (after[k] & place) + 1) + np.uint8(1) if len(k) else np.empty(0, np.uint8)
        new = rank + m  # empty suffixes come first
        shift = np.repeat(np.arange(len(new) + 1, dtype=kind), np.diff(new - np.arange(len(new)), prepend=0, append=n))
        sorted_ += shift.take(sorted_ & place, mode="clip")  # places move by the suffixes that are inserted before them
        lcp = _with(lcp, new, ahead)
        lcp[new[k] + 1] = behind
        at, n = new.astype(kind), n + len(new)
    return sorted_ >> kind(bits), sorted_ & place, lcp[:n]


def _with(column: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The column with values inserted, which stand ``at`` these places then."""
    out, old = np.empty(len(column) + len(at), column.dtype), np.ones(len(column) + len(at), bool)
    old[at] = False
    out[old] = column
    out[at] = values
    return out


def _wide(flat: np.ndarray, step: int) -> np.ndarray:
    """A number for the ``step`` bytes from each place on, equal ones for equal bytes."""
    if step == 1:
        return flat
    code = np.zeros(max(0, len(flat) - step + 1), np.uint64)
    for i in range(step):
        code <<= np.uint64(8)
        code |= flat[i : i + len(code)]
    return pa.array(code).dictionary_encode().indices.to_numpy()


def classes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(size of the suffix, strings, class) for every suffix size of ``length`` on: equal classes share their first ``length`` bytes."""
    step = next(k for k in range(WIDEST, 0, -1) if length % k == 0)
    m, ends = len(starts), np.cumsum(sizes)
    flat = data[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
    less = np.repeat(np.arange(step), m)  # bytes left out at the end
    counts = np.maximum(np.tile(sizes, step) - less, 0) // step
    _, places, lcp = _columns(_wide(flat, step), np.tile(ends, step) - less, counts, step)
    rank = np.empty(len(lcp), np.int64)
    rank[places] = np.arange(len(counts), len(lcp))
    group = np.cumsum(lcp < length // step)
    strings, place, out = np.arange(len(counts)), np.arange(len(counts)), []
    for j in range(1, int(counts.max(initial=0)) + 1):  # from each string's empty suffix to its longer ones
        on = counts[strings] >= j
        strings, place = strings[on], rank[place[on]]
        if j * step >= length:
            cuts = np.searchsorted(strings, np.arange(step + 1) * m).tolist()
            out += [(j * step + k, strings[a:b] - k * m, group[place[a:b]]) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    return out
