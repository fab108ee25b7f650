"""Packing by power-of-two decomposition.

Each document's ids are split into pieces whose lengths are powers of two: as
many full sequences as fit, then the binary digits of the rest, longest first.
Pieces of one length form a bucket and every piece is a sequence of its own, so
no sequence crosses documents and none is padded. Sequences of a bucket are
numbered on from one another.

Defined results: a null or empty text is the end id alone, one piece of length
1; texts of any length are split whole; repeated rows are packed each for
itself; an empty table gives an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import tokenizer_file
from .common import in_arrow, materialise
from .memo import Memo, groups, spell

TOKENIZER = "word_bpe_49k.json"
SEQUENCE = 2048
#: Rows whose distinct words are gathered together, if the session allows as many.
ROWS = 10_000
END_ID = 1
#: Bytes of each generation of words that one worker remembers.
MEMORY_BYTES = 64 << 20
#: Counts (part, length) of at most this many rows, of 24 bytes each, are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000

#: How a tokenizer must normalise and split for words to be encoded apart (fixed values).
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": _SPLIT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

#: A Latin letter, but for the one whose small letter ends in an accent of its own, and a mark of punctuation behind it.
_APART = r"([A-Za-z\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}\x{00F8}-\x{012F}\x{0131}-\x{017F}])([,.!?;:*#%$&)])"


def word_by_word(spec: dict) -> bool:
    """Whether a tokenizer's specification lets ``WordIds`` encode each run of non-space bytes for itself."""
    special = all("<|" in t["content"] and not re.search(r"\s", t["content"]) and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec.get("added_tokens", []))
    return special and spec.get("normalizer") == _NORMALIZER and spec.get("pre_tokenizer") == _PRE_TOKENIZER and spec["model"].get("dropout") is None


class WordIds:
    """Ids by the tokenizers library.

    A tokenizer specified as ``word_by_word`` tells drops white space, and no
    token or normalisation reaches across it, so each distinct run between ASCII
    white space is encoded once. Nor does any reach from a letter to a mark of
    punctuation that forms no contraction and takes no accent (``_APART``), and case
    is lowered: a space between the former, and lower case in runs of ASCII alone
    in which no special token can be, change no id and leave fewer distinct runs. Other runs stay as they are: characters are
    composed first, and some small letters compose with a mark while their
    capitals don't. With any other tokenizer each text is encoded whole.
    """

    def __init__(self, name_or_path: str, memory: int | None = None):
        from tokenizers import Tokenizer

        path = tokenizer_file(name_or_path)
        with open(path, encoding="utf-8") as f:
            self.apart = word_by_word(json.load(f))
        self.t = Tokenizer.from_file(path)
        self.t.no_padding()
        self.t.no_truncation()
        self.memo = Memo(self._words, memory or MEMORY_BYTES)

    def _words(self, words: list[bytes]) -> Iterator[bytes]:
        for i in range(0, len(words), 4096):
            for e in self.t.encode_batch_fast([w.decode() for w in words[i : i + 4096]], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        for some in groups(texts):
            if not self.apart:
                yield from (np.frombuffer(x, "<u4") for t in some for x in self._words([t.as_py()]))
                continue
            apart = pc.replace_substring_regex(some.cast(pa.large_string()), _APART, r"\1 \2")
            split = pc.ascii_split_whitespace(apart)
            words = split.flatten()
            plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
            words = pc.if_else(plain, pc.ascii_lower(words), words)
            yield from spell(split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py(), words.cast(pa.large_binary()), self.memo.many)


@lru_cache(maxsize=2)
def word_ids(name_or_path: str, memory: int | None = None) -> WordIds:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(name_or_path, memory)


def piece_lengths(n: int, sequence: int = SEQUENCE) -> list[int]:
    """Powers of two that sum to ``n``, the largest first."""
    rest = n % sequence
    return [sequence] * (n // sequence) + [1 << i for i in reversed(range(rest.bit_length())) if rest >> i & 1]


def cut(docs: DataFrame, tokenizer: str = TOKENIZER, sequence: int = SEQUENCE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", memory: int | None = None) -> DataFrame:
    """Pieces: id, start, length, ``ids`` (little-endian unsigned 32-bit), doc_tokens. A narrow step, whose workers remember ``memory`` bytes of words in each generation."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        t, part = word_ids(tokenizer, memory), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for b in batches:
            at, start, length, ids, total, nth = [], [], [], [], [], []
            for row, found in enumerate(t.encode(b.column(1))):
                data, done = found.tobytes() + end, 0
                n = len(data) // 4
                for k in piece_lengths(n, sequence):
                    at.append(row), start.append(done), length.append(k), total.append(n), nth.append(seen.get(k, 0))
                    ids.append(data[4 * done : 4 * (done + k)])
                    seen[k] = nth[-1] + 1
                    done += k
            arrays = [b.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array([part] * len(at), pa.int64()), pa.array(nth, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "start", "length", "ids", "doc_tokens", "part", "nth"])
        t.memo.forget()

    src = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return in_arrow(src, run, f"`{id_col}` {src.dtypes[0][1]}, start long, length long, ids binary, doc_tokens long, part long, nth long", ROWS)


def number(pieces: DataFrame) -> DataFrame:
    """Replaces ``part`` and ``nth`` by ``sequence_id`` and ``offset``. ``pieces`` must be materialised.

    A piece is the ``nth`` of its length in its task's part; each part numbers on
    from the parts before it, by a running sum over the counts of each length.
    Only the totals (a row per length) reach the driver. The running sums are
    broadcast up to ``BROADCAST_ROWS`` and joined by shuffle beyond.
    """
    counts = materialise(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    before, total = {}, 0
    for r in sorted(counts.groupBy("length").agg(F.sum("n").alias("n")).collect(), reverse=True):
        before[r["length"]] = total
        total += r["n"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.lit(None).cast("long")
    for length, at in before.items():
        start = F.when(F.col("length") == length, at).otherwise(start)
    first = counts.select("length", "part", (start + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("first"))
    numbered = pieces.join(F.broadcast(first) if counts.count() <= BROADCAST_ROWS else first, ["length", "part"])
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    return numbered.select(*kept, (F.col("first") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def pack(docs: DataFrame, digest: bool = False, **options) -> DataFrame:
    """Numbered pieces with their ``ids``; with ``digest`` their CRC-32 instead, so ids are never stored."""
    pieces = cut(docs, **options)
    return number(materialise(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids") if digest else pieces))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, digest=True).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
