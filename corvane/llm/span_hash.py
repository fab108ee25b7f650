"""Document fingerprints from prefix polynomial hashes.

A text's code points ``c`` give prefix arrays ``P[i] = sum c[j] * B**j`` modulo
a prime, for two bases. ``P[r] - P[l]``, divided by ``B**l``, is then the hash of
the span from ``l`` to ``r``: any two spans are compared in constant time, and
the longest common extension of two positions is found by binary search.

A fingerprint is a text's length, the hash of the whole of it, and its smallest
span hashes, over the spans at every position; equal texts have equal ones, and
different texts differ by the hash of the whole.

The likeness of two texts is the part of their code points that common spans
cover: ``2 * covered / (n_a + n_b)``, each side's covered points counted. Common
spans are the longest common extensions, in both directions, of the texts'
beginnings, of their ends, and of the anchors that both have. Anchors are the
spans of ``SPAN`` code points whose hash is the smallest of ``WINDOW``
neighbouring ones, so every common passage of ``SPAN + WINDOW - 1`` code points
holds one; of an anchor that a text repeats the first place counts. What is
shorter and lies inside may be missed, so likeness is a lower bound of the part
that is shared.

Defined results: null and empty texts have the empty fingerprint, which is like
itself (1.0) and like no other (0.0); a text shorter than four spans has shorter
ones in its fingerprint, and one shorter than a span is compared by its ends
alone; repeated rows are each other's next document; ids tie by text, a null id
comes last; a table of one row is its own next document; an empty table gives
an empty result. Extra columns are not carried.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, shuffle_width

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_000_003_579, 754_974_721)
SPAN = 24
KEEP = 64
#: Positions of which the one with the smallest hash is an anchor.
WINDOW = 64
#: Code points of the texts that are compared together, at least one text.
TOGETHER = 1 << 17
_ROWS = 1000
_HEX = 12


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the Mersenne prime 2**31 - 1, for x below 2**63; in place."""
    for _ in range(2):
        hi = x >> np.uint64(31)
        x &= PRIME
        x += hi
    x[x >= PRIME] -= PRIME
    return x


class _Powers:
    """Powers of a base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        p = int(PRIME)
        self.base, self.up, self.down = base % p, np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.inverse = pow(self.base, p - 2, p)

    def grow(self, n: int) -> None:
        p = int(PRIME)
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate((self.up, _mod(self.up * np.uint64(pow(self.base, k, p)))))
            self.down = np.concatenate((self.down, _mod(self.down * np.uint64(pow(self.inverse, k, p)))))


_POWERS = [_Powers(b) for b in BASES]


class PrefixHash:
    """Prefix arrays of one string."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        codes += np.uint64(1)
        self.n = n = len(codes)
        self.prefix = []
        for w in _POWERS:
            w.grow(n + 1)
            out = np.zeros(n + 1, np.uint64)
            np.cumsum(_mod(codes * w.up[:n]), out=out[1:])
            self.prefix.append(_mod(out))

    def spans(self, left, right) -> np.ndarray:
        """62-bit hashes of the spans [left, right), each an index array or a slice."""
        out = None
        for w, p in zip(_POWERS, self.prefix, strict=True):
            h = p[right] + (PRIME - p[left])
            h = _mod(_mod(h) * w.down[: self.n + 1][left])
            out = h if out is None else (out << np.uint64(31)) | h
        return out

    def equal(self, left, other_left, size) -> np.ndarray:
        """Whether the spans of ``size`` from two positions are equal; index arrays."""
        left, other_left, size = np.broadcast_arrays(np.atleast_1d(left), other_left, size)
        return self.spans(left, left + size) == self.spans(other_left, other_left + size)

    def common_extension(self, left, other_left, most, back: bool = False) -> np.ndarray:
        """Lengths, up to ``most``, of the longest common spans that begin at both positions, or with ``back`` end there; by binary search, for all at once."""
        left, other_left, high = np.broadcast_arrays(np.atleast_1d(left), other_left, most)
        low, high = np.zeros(len(left), np.int64), high.astype(np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_] + 1) // 2
            step = mid if back else 0
            same = self.equal(left[open_] - step, other_left[open_] - step, mid)
            low[open_] = np.where(same, mid, low[open_])
            high[open_] = np.where(same, high[open_], mid - 1)
        return low

    def mixed(self, start: int, end: int, w: int) -> np.ndarray:
        """Mixed 48-bit hashes of the spans of ``w`` that lie in [start, end), by position."""
        if end - start < w:
            return np.empty(0, np.uint64)
        h = self.spans(slice(start, end - w + 1), slice(start + w, end + 1))
        h += np.uint64(w)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h >>= np.uint64(64 - 4 * _HEX)
        return h


def _running(x: np.ndarray, width: int, of: np.ufunc) -> np.ndarray:
    """Minimum or maximum of each ``width`` consecutive values."""
    n, step, m = len(x) - width + 1, 1, x
    while 2 * step <= width:
        m = of(m[:-step], m[step:])
        step *= 2
    return m[:n] if step == width else of(m[:n], m[width - step : width - step + n])


def _covered(starts: np.ndarray, ends: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
    """Positions in the union of spans, for each of ``n`` disjoint ranges that the spans lie in."""
    order = np.argsort(starts, kind="stable")
    starts, ends, which = starts[order], ends[order], which[order]
    upto = np.append(0, np.maximum.accumulate(ends)[:-1]) if len(ends) else ends
    return np.bincount(which, np.maximum(0, ends - np.maximum(starts, upto)), n)


class Texts:
    """Some texts, one after the other under one prefix hash, so that what is asked of all is answered at once."""

    def __init__(self, texts: list[str]):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.hash = PrefixHash("".join(texts))
        self.h = self.hash.mixed(0, self.hash.n, SPAN)
        self.whole = self.hash.spans(self.starts, self.ends).tolist()
        self._anchors = None

    def smallest(self, i: int, keep: int = KEEP) -> np.ndarray:
        """The smallest ``keep`` mixed hashes of the distinct spans of a text, sorted."""
        a, n = int(self.starts[i]), int(self.sizes[i])
        if not n:
            return np.empty(0, np.uint64)
        h = self.h[a : a + n - SPAN + 1] if n >= 4 * SPAN else self.hash.mixed(a, a + n, max(1, n // 4))
        few = np.unique(np.partition(h, 2 * keep)[: 2 * keep] if len(h) > 4 * keep else h)
        if len(few) < keep < len(h):
            few = np.unique(h)
        return few[:keep]

    def fingerprint(self, i: int) -> str:
        """Length, hash of the whole text and smallest span hashes; empty for an empty text."""
        return f"{self.sizes[i]:x}-{self.whole[i]:016x}-{self.smallest(i).astype('>u8').tobytes().hex()}" if self.sizes[i] else ""

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, hash, first position) of the spans whose hash is the smallest of some window of its text's positions, or of all if these are fewer."""
        if self._anchors is None:
            h, count = self.h, np.maximum(self.sizes - SPAN + 1, 0)
            text = np.repeat(np.arange(len(count)), count)
            at = np.arange(len(text)) + (self.starts - (np.cumsum(count) - count))[text]  # of each span that lies in one text
            chosen = np.zeros(len(h), bool)
            if len(h) >= WINDOW:
                least = _running(h, WINDOW, np.minimum)
                whole = at[at + (WINDOW + SPAN - 1) <= self.ends[text]]  # windows in one text
                most = np.zeros(len(h) + WINDOW - 1, np.uint64)  # the largest minimum of the windows that hold a position
                most[WINDOW - 1 + whole] = least[whole]
                chosen = _running(most, WINDOW, np.maximum) == h
            for i in np.flatnonzero((count > 0) & (count < WINDOW)).tolist():
                own = h[self.starts[i] : self.starts[i] + count[i]]
                chosen[self.starts[i] : self.starts[i] + count[i]] = own == own.min()
            on = chosen[at]
            text, at = text[on], at[on]
            order = np.lexsort((at, h[at], text))
            text, at = text[order], at[order]
            first = np.ones(len(at), bool)
            first[1:] = (h[at[1:]] != h[at[:-1]]) | (text[1:] != text[:-1])
            self._anchors = text[first], h[at[first]], at[first]
        return self._anchors

    def likeness(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of texts (indices; none twice in ``a``, nor in ``b``): the part of the code points of both that their common spans cover."""
        text, h, at = self.anchors()
        sides = []
        for side in (a, b):
            pair = np.full(len(self.sizes), -1)
            pair[side] = np.arange(len(side))
            on = np.flatnonzero(pair[text] >= 0)
            sides.append((pair[text[on]].astype(np.uint64) << np.uint64(4 * _HEX) | h[on], at[on]))
        key, i, j = np.intersect1d(sides[0][0], sides[1][0], assume_unique=True, return_indices=True)
        pair, x, y = (key >> np.uint64(4 * _HEX)).astype(np.int64), sides[0][1][i], sides[1][1][j]
        same = self.hash.equal(x, y, SPAN)  # the hash of an anchor is short
        pair, x, y = (np.concatenate((v[same], w)) for v, w in ((pair, np.arange(len(a))), (x, self.starts[a]), (y, self.starts[b])))
        ahead = self.hash.common_extension(x, y, np.minimum(self.ends[a[pair]] - x, self.ends[b[pair]] - y))
        back = self.hash.common_extension(x, y, np.minimum(x - self.starts[a[pair]], y - self.starts[b[pair]]), back=True)
        tail = self.hash.common_extension(self.ends[a], self.ends[b], np.minimum(self.sizes[a], self.sizes[b]), back=True)
        pair = np.append(pair, np.arange(len(a)))
        covered = sum(_covered(np.append(v - back, end - tail), np.append(v + ahead, end), pair, len(a)) for v, end in ((x, self.ends[a]), (y, self.ends[b])))
        both, some = self.sizes[a] + self.sizes[b], (self.sizes[a] > 0) & (self.sizes[b] > 0)
        return np.where(some, covered / np.maximum(both, 1), (both == 0).astype(float))


def likeness(a: str, b: str) -> float:
    return float(Texts([a, b]).likeness(np.array([0]), np.array([1]))[0])


def fingerprint_of(text: str) -> str:
    return Texts([text]).fingerprint(0)


def estimate(a: str, b: str, keep: int = KEEP) -> float:
    """From two fingerprints alone: the Dice coefficient of the span sets, by the smallest hashes of their union (error about ``1 / sqrt(keep)``)."""
    a, b = (np.frombuffer(bytes.fromhex(x.rpartition("-")[2]), ">u8").astype(np.uint64) for x in (a, b))
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:keep]
    shared = np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)
    j = shared.sum() / len(both)
    return float(2 * j / (1 + j))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars and fingerprint of each row; a narrow step."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                texts = [t.as_py() or "" for t in b.column(1).slice(i, _ROWS)]
                made = [fingerprint_of(t) for t in texts]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, _ROWS), pa.array([len(t) for t in texts], pa.int64()), pa.array(made, pa.string())], names=[id_col, "n_chars", "fingerprint"])

    src = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    return in_arrow(src, run, f"`{id_col}` {src.dtypes[0][1]}, n_chars long, fingerprint string")


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows dealt into ranges of ids and sorted there, each range followed by the row that comes after it (``after`` > 0).

    Only cut points of the ranges and their smallest ids reach the driver. The
    texts are shuffled once.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    ids, width = src.select("id").filter("id is not null"), shuffle_width(spark)
    cuts = np.unique(np.array(ids.approxQuantile("id", [i / width for i in range(1, width)], 0.1 / width), np.float64))
    top = len(cuts) + 1  # of null ids

    def range_of(x: pd.Series) -> np.ndarray:
        return np.where(x.isna(), top, np.searchsorted(cuts, x.fillna(0).to_numpy(np.float64), side="right"))

    part = F.pandas_udf(lambda x: pd.Series(range_of(x).astype(np.int32)), "int")
    firsts = sorted((r["p"], r["m"]) for r in src.select("id").groupBy(part("id").alias("p")).agg(F.min("id").alias("m")).collect())
    order = [p for p, _ in firsts]
    before = {m: (order[i - 1], i == 0) for i, (_, m) in enumerate(firsts)}  # of a range's smallest id: the range that it follows

    def places(x: pd.Series) -> pd.Series:
        own = range_of(x).tolist()
        keys = [None if pd.isna(v) else int(v) for v in x]
        return pd.Series([[[p, 0], [before[v][0], 2 if before[v][1] else 1]] if v in before else [[p, 0]] for p, v in zip(own, keys, strict=True)])

    dealt = src.withColumn("place", F.explode(F.pandas_udf(places, "array<array<int>>")("id")))
    dealt = dealt.select("id", "text", F.col("place")[0].alias("range"), F.col("place")[1].alias("after"))
    return dealt.repartitionById(top + 1, F.col("range")).sortWithinPartitions("range", "after", F.col("id").asc_nulls_last(), "text")


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _compared(pairs: list[tuple]) -> pa.RecordBatch:
    """The result's rows for consecutive (id, text, next text)."""
    m = len(pairs)
    texts = [t for _, t, _ in pairs]
    after = np.empty(m, np.int64)  # the next text is the following pair's own, or one more
    for k, (_, _, nxt) in enumerate(pairs):
        if k + 1 < m and pairs[k + 1][1] is nxt:
            after[k] = k + 1
        else:
            after[k] = len(texts)
            texts.append(nxt)
    edited = [t[: len(t) - len(t) // 2] + nxt[: len(t) // 2] for _, t, nxt in pairs]
    first = len(texts)
    every = Texts(texts + edited)
    own = np.arange(m)
    near_edited, near_next = every.likeness(own, first + own), every.likeness(own, after)
    columns = [
        [i for i, _, _ in pairs], [len(t) for _, t, _ in pairs], [hashlib.sha256(e.encode()).hexdigest() for e in edited],
        [every.fingerprint(k) for k in range(m)], [every.fingerprint(first + k) for k in range(m)], near_edited, near_next,
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _OUT, strict=True)], names=[n for n, _ in _OUT])


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, with its likeness to the edited and to the next document's."""

    def run(batches):
        last, pairs, held = None, [], 0  # the row before: id, text, range, after
        for b in batches:
            for i, text, range_, after in zip(*(c.to_pylist() for c in b.columns), strict=True):
                done = last is None or last[2] != range_ or last[3]
                if done and after:
                    continue
                if not done:
                    pairs.append((last[0], last[1], text))
                    held += len(last[1])
                    if held >= TOGETHER:
                        yield _compared(pairs)
                        pairs, held = [], 0
                last = (i, text, range_, after)
        if pairs:
            yield _compared(pairs)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_arrow(in_order(docs, id_col, text_col), run, schema)


def query(spark, sf_dir):
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
