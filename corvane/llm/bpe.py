"""Byte-level BPE encoding and decoding.

A pre-token's bytes form a doubly linked list of symbols. A priority queue
holds the merge rank of each neighbouring pair; the lowest rank, leftmost on
ties, is applied first, and an entry whose pair has changed meanwhile is stale
and skipped. Decoding concatenates the vocabulary's byte strings.

Texts are cut before white space that follows other characters, where a
pre-token always ends, so each piece encodes alone and repeated pieces are
remembered in a table of bounded size (which only saves time).

Defined results: a null text counts as empty; an empty text has no ids and
decodes to an empty text; the strings of special tokens inside a text become
those tokens; repeated rows are encoded alike and all kept; texts of any length
are encoded whole; an empty table gives an empty result. Extra columns of the
input are not carried.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

from .memo import Memo, groups, spell

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of each generation of pre-tokens that one worker remembers.
MEMORY_BYTES = 64 << 20
#: Rows encoded before they are handed on.
ROWS = 1000
#: Bits of an id, and of a place in a pre-token, in the numbers below.
_ID, _AT = 20, 32
_ID_MASK, _AT_MASK = (1 << _ID) - 1, (1 << _AT) - 1

_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PRE_TOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


def tokenizer_file(name_or_path: str) -> str:
    """A path as it is, or the place of a named public tokenizer on this machine."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    def __init__(self, name_or_path: str = TOKENIZER):
        import regex

        with open(tokenizer_file(name_or_path), encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_symbols()
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"])
        # the pair's ids, and its rank with the id that it makes, as one number each
        self.merges = {vocab[a] << _ID | vocab[b]: rank << _ID | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.of_byte = [vocab[s] for s in symbols]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special_bytes = [t.encode() for t in self.special]
        self.pre_token = regex.compile(_PRE_TOKEN)
        back = {s: b for b, s in enumerate(symbols)}
        strings = vocab | self.special
        self.strings = [b""] * (max(strings.values()) + 1)
        for s, i in strings.items():
            self.strings[i] = bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.memo = Memo(lambda t: array("i", self.merge(t.encode())).tobytes(), MEMORY_BYTES)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        of_byte, merged = self.of_byte, self.merges.get
        ids = [of_byte[b] for b in data]
        n = len(ids)
        if n < 2:
            return ids
        prev, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = [m << _AT | i for i in range(n - 1) if (m := merged(ids[i] << _ID | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i, m = entry & _AT_MASK, entry >> _AT
            j = after[i]
            if ids[i] < 0 or j < 0 or merged(ids[i] << _ID | ids[j]) != m:
                continue  # stale
            new = m & _ID_MASK
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k >= 0:
                prev[k] = i
                if (m := merged(new << _ID | ids[k])) is not None:
                    heapq.heappush(queue, m << _AT | i)
            if (h := prev[i]) >= 0 and (m := merged(ids[h] << _ID | new)) is not None:
                heapq.heappush(queue, m << _AT | h)
        return [x for x in ids if x >= 0]

    def _pieces(self, pieces: list[bytes]) -> Iterator[bytes]:
        find, known = self.pre_token.findall, self.memo
        for p in pieces:
            yield b"".join([known[t] for t in find(p.decode())])

    def _plain(self, texts: pa.Array) -> Iterator[np.ndarray]:
        return spell(*cut_pieces(texts), self._pieces)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a string array."""
        for some in groups(texts):
            spelt = self._plain(some)
            found = [i for i, t in enumerate(some) if any(s in t.as_py() for s in self.special_bytes)] if any(s in memoryview_of(some) for s in self.special_bytes) else []
            for i, ids in enumerate(spelt):
                if i in found:  # special tokens are cut out first
                    parts = self._special.split(some[i].as_py().decode())
                    plain = iter(list(self._plain(pa.array([p.encode() for p in parts[::2]], pa.large_binary()))))
                    ids = np.concatenate([[self.special[p]] if k % 2 else next(plain) for k, p in enumerate(parts)])
                yield ids.astype(np.int32)

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_ASCII_WS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def memoryview_of(texts: pa.Array) -> bytes:
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    return bytes(texts.buffers()[2] or b"")[offsets[texts.offset] : offsets[texts.offset + len(texts)]]


def cut_pieces(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of texts in their pieces, and the pieces; cut before ASCII white space that follows no white space.

    Bytes that may end other white space count as such, so that nothing is cut inside it.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    ends = ends - ends[0]
    data = np.frombuffer(memoryview_of(texts), np.uint8)
    space = _ASCII_WS[data]
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    tail = np.zeros(len(data), bool)  # last byte of U+0085, U+00A0, U+1680, U+2000 to U+205F or U+3000
    tail[1:] = (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
    if len(data) > 2:
        tail[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81) | (data[1:-1] == 0x9A))
    cut[1:] &= ~tail[:-1]
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return np.searchsorted(starts, ends), pieces


@lru_cache(maxsize=2)
def codec(name_or_path: str) -> Codec:
    return Codec(name_or_path)


def _ids_array(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows), pa.int32()))


def encode(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """id and ``ids`` (array of int) for each row; with ``decoded`` also the text that the ids decode to."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                some = b.slice(i, ROWS)
                rows = list(c.encode(some.column(1)))
                more = [pa.array([c.decode(x.tolist()) for x in rows], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([some.column(0), _ids_array(rows), *more], names=[id_col, "ids", "decoded"][: 2 + decoded])

    src = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return in_arrow(src, run, f"`{id_col}` {src.dtypes[0][1]}, ids array<int>" + ", decoded string" * decoded, 10 * ROWS)


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id") -> DataFrame:
    """id and the ``decoded`` text of ``ids``; null ids decode to an empty text."""

    def run(batches):
        c = codec(tokenizer)
        for b in batches:
            texts = pa.array([c.decode(x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else []) for x in b.column(1)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), texts], names=[id_col, "decoded"])

    src = encoded.select(id_col, "ids")
    return in_arrow(src, run, f"`{id_col}` {src.dtypes[0][1]}, decoded string")


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, decoded=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
