"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its lower-cased words and the beginnings of longer words,
hashed to a fixed number of buckets. A second-order factorization machine gives
each bucket a weight and a vector; the inner product of two vectors weighs the
pair, so an insult next to the mention of a group can count for more, or less,
than the two apart.

The machine is fitted on the driver to a bounded sample of labelled rows: those
with the smallest hash, up to ``most_rows`` rows and ``most_bytes`` of text
(of a row only its distinct buckets are sent, compressed); texts of over ``longest`` bytes teach nothing and are scored like any.
Parameters are given to buckets that differ between the classes by themselves,
and to those of pairs of frequent buckets that differ more together than either
does alone. Scoring is a narrow step over every whole text. Labels, languages,
sources and ids are never inputs of a score.

Defined results: null and empty texts get the score of a text without terms;
repeated rows get equal scores and teach once; rows of equal hash tie and go
together; labels that are null or held out teach nothing,
and without both classes every score is the share of toxic rows (0 if none);
a null id is not held out; an empty table gives an empty result. Extra columns
are not carried.
"""

from __future__ import annotations

from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, in_arrow

BUCKETS = 1 << 20
THRESHOLD = 0.3
#: Bounds of the sample: rows, bytes of text together, and bytes of one text.
MOST_ROWS = 20_000
MOST_BYTES = 96 << 20
LONGEST = 1 << 20
PREFIXES = (4, 5)
#: Buckets that may get parameters: those whose share differs most between the classes.
FEATURES = 8192
LEAST_Z = 3.0
#: Frequent buckets whose pairs are screened, the least difference of a pair, how far it must exceed its members', and buckets taken so.
PAIR_TERMS, PAIR_Z, PAIR_GAIN, PAIR_FEATURES = 1024, 6.0, 2.0, 512
FACTORS = 8
#: Rows scored before they are handed on.
ROWS = 1000
_WORD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD).split()


def buckets_of(word: bytes, n: int = BUCKETS) -> list[int]:
    return [crc32(word) % n, *(crc32(b"^" + word[:k]) % n for k in PREFIXES if len(word) > k)]


def terms(text: str | None, n: int = BUCKETS) -> np.ndarray:
    """Distinct buckets of a text."""
    return np.unique(np.array([b for w in set(words(text)) for b in buckets_of(w, n)], np.int32))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _pack(t: np.ndarray) -> bytes:
    """Ascending numbers as their count and the compressed byte planes of their differences."""
    planes = np.diff(t, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return len(t).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(planes).ravel(), "zstd", asbytes=True)


def _open(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    planes = np.frombuffer(pa.decompress(packed[4:], 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int32)


def sample(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES, longest: int = LONGEST) -> tuple[list[np.ndarray], np.ndarray]:
    """Terms and labels of a bounded number of distinct rows that aren't held out."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most_rows)  # pairs of numbers
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = rows.select(F.xxhash64("doc_id", "toxic", "text").alias("key"), "toxic", "text", F.octet_length("text").alias("size")).filter(F.col("size") <= longest)
    sizes = rows.groupBy("key").agg(F.max("size").alias("size")).orderBy("key").limit(most_rows).collect()  # an id may have any number of rows
    n = int(np.searchsorted(np.cumsum([r["size"] for r in sizes]), most_bytes, side="right"))
    if not n:
        return [], np.empty(0)

    def run(batches):
        seen = set()
        for b in batches:
            some = [(k, y, _pack(terms(x))) for k, y, x in zip(*(c.to_pylist() for c in b.columns), strict=True) if not (k in seen or seen.add(k))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in some], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["key", "toxic", "terms"])

    chosen = rows.filter(F.col("key") <= sizes[n - 1]["key"]).select("key", "toxic", "text")
    found = sorted(map(tuple, in_arrow(chosen, run, "key long, toxic int, terms binary").dropDuplicates(["key"]).collect()))
    return [_open(t) for _, _, t in found], np.array([float(y > 0) for _, y, _ in found])


class Machine:
    """A fitted factorization machine over ``features`` (sorted buckets)."""

    def __init__(self, features, bias, weight, vectors):
        self.features, self.bias, self.weight, self.vectors = features, bias, weight, vectors

    def logit(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """Of n texts; (rows, cols): which feature positions each holds, rows ascending."""
        out = np.full(n, self.bias)
        out += np.bincount(rows, self.weight[cols], n)
        for v in self.vectors.T:
            s, q = np.bincount(rows, v[cols], n), np.bincount(rows, v[cols] ** 2, n)
            out += 0.5 * (s * s - q)
        return out

    def scores(self, present: list[list[int]]) -> np.ndarray:
        rows = np.repeat(np.arange(len(present)), [len(p) for p in present])
        cols = np.array([c for p in present for c in p], np.int64)
        return 1 / (1 + np.exp(-np.clip(self.logit(rows, cols, len(present)), -30, 30)))


def _places(found: list[np.ndarray], features: np.ndarray) -> list[np.ndarray]:
    """Of each row the positions, in sorted ``features``, of those that it holds."""
    place = np.full(BUCKETS, -1, np.int32)
    place[features] = np.arange(len(features))
    return [p[p >= 0] for p in (place[t] for t in found)]


def _difference(pos: np.ndarray, neg: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Standard errors by which shares of the classes differ; 0 for what fewer than three rows hold."""
    share = (pos + neg) / (n1 + n0)
    z = np.abs(pos / n1 - neg / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    z[pos + neg < 3] = 0
    return z


def _telling_pairs(found: list[np.ndarray], y: np.ndarray, z: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Buckets of pairs whose joint share differs more between the classes than either bucket's; ``rows``: rows of each bucket."""
    often = np.sort(np.argsort(-rows, kind="stable")[:PAIR_TERMS])
    often = often[rows[often] >= 3]
    both, places = np.zeros((2, len(often), len(often)), np.float32), _places(found, often)
    for label in (0, 1):
        some = [p for p, k in zip(places, y, strict=True) if bool(k) == bool(label)]
        for i in range(0, len(some), 1000):
            held = np.zeros((len(some[i : i + 1000]), len(often)), np.float32)
            for row, p in zip(held, some[i : i + 1000], strict=True):
                row[p] = 1
            both[label] += held.T @ held
    apart = _difference(both[1], both[0], max(1.0, y.sum()), max(1.0, len(y) - y.sum()))
    single = z[often]
    a, b = np.nonzero(np.triu((apart >= PAIR_Z) & (apart >= np.maximum(single[:, None], single) + PAIR_GAIN), 1))
    order = np.argsort(-apart[a, b], kind="stable")
    return often[list(dict.fromkeys(np.stack((a[order], b[order]), 1).ravel().tolist()))[:PAIR_FEATURES]]


def select_features(found: list[np.ndarray], y: np.ndarray, most: int = FEATURES, least_z: float = LEAST_Z) -> np.ndarray:
    """Buckets whose document shares differ between the classes by ``least_z`` standard errors, and those of telling pairs."""
    pos, neg = np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)
    for t, k in zip(found, y, strict=True):  # a row names each bucket once
        (pos if k else neg)[t] += 1
    z = _difference(pos, neg, max(1.0, y.sum()), max(1.0, len(y) - y.sum()))
    best = np.argsort(-z, kind="stable")[:most]
    return np.union1d(best[z[best] >= least_z], _telling_pairs(found, y, z, pos + neg))


def fit(found: list[np.ndarray], y: np.ndarray, factors: int = FACTORS, epochs: int = 40, rate: float = 0.03, decay: float = 2e-4, seed: int = 7) -> Machine:
    """Logistic loss, Adam over mini-batches, squared penalty."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Machine(np.empty(0, np.int64), float(np.log(max(share, 1e-12) / max(1 - share, 1e-12))), np.empty(0), np.empty((0, factors)))
    features = select_features(found, y)
    m, rng = len(features), np.random.default_rng(seed)
    cols = _places(found, features)
    theta = np.concatenate([np.zeros((m + 1, 1)), rng.normal(0, 0.02, (m + 1, factors))], 1)
    theta[m] = 0
    theta[m, 0] = np.log(y.mean() / (1 - y.mean()))
    mean, square, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 512):
            part = order[i : i + 512]
            rows = np.repeat(np.arange(len(part)), [len(cols[j]) for j in part])
            at = np.concatenate([cols[j] for j in part])
            v = theta[at, 1:]
            total = np.stack([np.bincount(rows, x, len(part)) for x in v.T], 1)
            squares = np.bincount(rows, (v * v).sum(1), len(part))
            z = theta[m, 0] + np.bincount(rows, theta[at, 0], len(part)) + 0.5 * ((total * total).sum(1) - squares)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]) / len(part)
            grad = np.zeros_like(theta)
            grad[:m] = decay * theta[:m]
            grad[:, 0] += np.bincount(at, err[rows], m + 1)
            for k, x in enumerate((err[rows, None] * (total[rows] - v)).T, 1):
                grad[:, k] += np.bincount(at, x, m + 1)
            grad[m, 0] = err.sum()
            step += 1
            mean += 0.1 * (grad - mean)
            square += 0.001 * (grad * grad - square)
            theta -= rate * (1 - epoch / epochs) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Machine(features, float(theta[m, 0]), theta[:m, 0].copy(), theta[:m, 1:].copy())


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Machine:
    machine = fit(*sample(docs, labels, most_rows))
    give_back()
    return machine


def score(docs: DataFrame, machine: Machine, keep: list[str] | None = None) -> DataFrame:
    """doc_id and ``score`` of each row, with the columns of ``keep``. A narrow step over whole texts."""
    position = {int(b): i for i, b in enumerate(machine.features)}

    def run(batches):
        @lru_cache(maxsize=100_000)
        def of_word(w: bytes) -> tuple[int, ...]:
            return tuple(position[b] for b in buckets_of(w) if b in position)

        for b in batches:
            for i in range(0, b.num_rows, ROWS):
                some = b.slice(i, ROWS)
                present = [list(set().union(*map(of_word, set(words(t.as_py()))))) for t in some.column(at)]
                yield pa.RecordBatch.from_arrays([*some.columns[: len(kept)], pa.array(machine.scores(present))], names=[*kept, "score"])

    kept = keep or ["doc_id"]
    src = docs.select(*kept, *([] if "text" in kept else ["text"]))
    src = src.withColumn("text", F.col("text").cast("string"))
    at = src.columns.index("text")
    schema = ", ".join(f"`{n}` {t}" for n, t in src.dtypes[: len(kept)]) + ", score double"
    return in_arrow(src, run, schema)


def query(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, train(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
