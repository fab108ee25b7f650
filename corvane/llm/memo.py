"""Encoding many texts word by word: each distinct word once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Characters of text whose distinct words are gathered together, and words spelt at a time.
GROUP_BYTES = 8 << 20
_WORDS = 1 << 19


#: About what a remembered word costs besides its bytes and its ids: two objects and their place in the table.
_ENTRY_BYTES = 200
#: Words longer than this are made anew each time.
LONGEST = 256


class Memo(dict):
    """A table that makes what it lacks, of two generations of at most ``most_bytes`` each, keys and values included.

    What is used again moves on, the rest is forgotten. Results never depend on what is remembered.
    """

    def __init__(self, make: Callable, most_bytes: int):
        self.make, self.most_bytes, self.held, self.old = make, most_bytes, 0, {}

    def __missing__(self, key):
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        self._keep(key, value)
        return value

    def _keep(self, key, value) -> None:
        if (n := len(key)) > LONGEST:
            return
        if self.held >= self.most_bytes:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        self.held += n + len(value) + _ENTRY_BYTES

    def forget(self) -> None:
        self.clear()
        self.held, self.old = 0, {}

    def many(self, keys: list) -> list:
        """Values of distinct keys; ``make`` is called once, with all the keys that are lacking."""
        found = list(map(self.get, keys))
        lacking = [i for i, v in enumerate(found) if v is None]
        for i in lacking:
            found[i] = self.old.get(keys[i])
        new = [i for i in lacking if found[i] is None]
        for i, v in zip(new, self.make([keys[i] for i in new]), strict=True):
            found[i] = v
        for i in lacking:
            self._keep(keys[i], found[i])
        return found


def groups(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of a string array of about ``GROUP_BYTES`` each, at least one text; nulls become empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + GROUP_BYTES, side="right")) - 1)
        yield texts.slice(i, j - i)
        i = j


def spell(per_text: np.ndarray, words: pa.Array, make: Callable[[list[bytes]], Iterable[bytes]]) -> Iterator[np.ndarray]:
    """Unsigned 32-bit ids of each text. ``per_text``: offsets of texts in ``words``; ``make``: ids of distinct words as bytes."""
    coded = words.dictionary_encode()
    parts = list(make(coded.dictionary.to_pylist()))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat, starts = np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes
    which = coded.indices.to_numpy(zero_copy_only=False)
    i, n = 0, len(per_text) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(per_text, per_text[i] + _WORDS, side="right")) - 1)
        w = which[per_text[i] : per_text[j]]
        size = sizes[w]
        ends = np.cumsum(size)
        at = np.repeat(starts[w] - (ends - size), size)
        at += np.arange(len(at))
        ids = flat[at]
        cuts = np.concatenate(([0], ends))[per_text[i : j + 1] - per_text[i]]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield ids[a:b]
        i = j
