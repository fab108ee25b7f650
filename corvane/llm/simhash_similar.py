"""Near copies by the similarity of their word shingles, found by SimHash signatures.

Two texts are linked if the Jaccard similarity of their sets of shingles (five
words, or the whole of a shorter text) is at least 0.8. At that similarity about
15 % of fingerprint bits differ, too many for 64 bits in two segments; so a
fingerprint of some hundred bits is cut into many short segments, of which some
differ by at most one bit with the probability that is wanted. Of each segment
variants are indexed with one of its ``WILD`` weakest bits wildcarded, the bits
whose counts are closest to half, as these are the likeliest to differ. Texts
that share a variant are joined by equality, compared by all of ``COMPARED``
bits, and verified on their whole sets, so no link is wrong.

Segments are as long as lets a variant of unrelated texts meet seldom
(``2 ** length`` is over four times the number of rows), and as many as find
``recall`` of simulated pairs exactly at the threshold; closer pairs are found
more surely (README: recall on real texts).

A variant's texts are first compared with the smallest of them. Only where that
leaves several components, texts of different components are compared too; of
these the join emits only pairs that differ in few enough bits, whose distances
to the smallest one allow that. So a large group of near copies isn't expanded
into pairs. Equal sets are one.

Defined results: texts without words have equal sets; rows that repeat an id and
its text are one; a null id never is a group's smallest while another is there;
texts of any length are hashed whole; sets are told apart by 64-bit hashes; an
empty table gives an empty result. Extra columns are carried.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialise, remove_path, shared_path
from .graph import connected_components
from .simhash import keep_least, row_keys

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.95
#: Bits of a segment that may be the wildcard.
WILD = 6
#: Bits that are compared before sets are, at least.
COMPARED = 2048
#: Pairs are verified if no more bits differ than are expected at the threshold, and so many standard deviations.
DEVIATIONS = 2.5
SEED = 42
#: Bits of the table that tells which rows a verification may need.
BITMAP = 1 << 24
_ROWS = 512
_SUM = 255
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def segments_for(rows: int, similarity: float = SIMILARITY, recall: float = RECALL, wild: int = WILD, pairs: int = 20_000) -> tuple[int, int]:
    """(bits of a segment, segments), for pairs of sets of equal size exactly at ``similarity``."""
    length = min(32, max(12, math.ceil(math.log2(max(rows, 2))) + 2))
    r, rho = np.random.default_rng(5), 2 * similarity / (1 + similarity)
    x = r.standard_normal((pairs, length))
    y = rho * x + (1 - rho * rho) ** 0.5 * r.standard_normal((pairs, length))
    different, may = (x > 0) != (y > 0), np.ones((pairs, length), bool)
    for z in (x, y):
        weak = np.zeros((pairs, length), bool)
        np.put_along_axis(weak, np.argsort(np.abs(z), 1)[:, :wild], True, 1)
        may &= weak
    n = different.sum(1)
    found = (((n == 0) & may.any(1)) | ((n == 1) & (different & may).any(1))).mean()
    return length, max(1, math.ceil(math.log(max(1 - recall, 1e-9)) / math.log1p(-min(max(float(found), 1e-6), 1 - 1e-9))))


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; none for a text without words."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z alone, and exactly space and 9 to 13
    if not words:
        return np.zeros(0, "<i8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1)[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_digest
    return np.unique(np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=False)]), "<i8"))


def bit_counts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """How many shingles set each of ``bits`` bits; 64 of them are made of each shingle's hash at a time."""
    words = -(-bits // 64)
    odd = np.arange(1, 2 * words, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    total = np.zeros(words * 64, np.int64)
    for i in range(0, len(hashes), _SUM):  # sums of 255 bits fit a byte
        h = hashes[i : i + _SUM].view(np.uint64)[:, None] * odd
        for m in _MIX:
            h ^= h >> np.uint64(30)
            h *= m
        h ^= h >> np.uint64(31)
        total += np.unpackbits(h.view(np.uint8), axis=1).sum(0, dtype=np.uint8)
    return total[:bits]


def words_for(length: int, segments: int) -> int:
    """64-bit words of a fingerprint, whose first bits make the segments."""
    return -(-max(length * segments, COMPARED) // 64)


def most_different(bits: int, similarity: float = SIMILARITY) -> int:
    """Differing bits of a pair that is verified."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * share + DEVIATIONS * (bits * share * (1 - share)) ** 0.5)


def signature(hashes: np.ndarray, length: int, segments: int, wild: int = WILD) -> tuple[np.ndarray, bytes]:
    """(the bits, in words; the ``wild`` weakest places of each segment, a byte each)."""
    n, count = len(hashes), bit_counts(hashes, 64 * words_for(length, segments))
    weak = np.argsort(np.abs(2 * count[: length * segments] - n).reshape(segments, length), axis=1, kind="stable")[:, :wild]
    return np.packbits(2 * count > n).view("<i8"), weak.astype(np.uint8).tobytes()


def _hashed(docs: DataFrame, id_col: str, text_col: str, shingle: int, extra: Callable[[np.ndarray], tuple], columns: dict[str, str], only: np.ndarray | None = None) -> DataFrame:
    """id, key (of the set), n, the ``columns`` (name and type) that ``extra`` makes of the hashes, k0 and k1; with ``only``, a bitmap, of rows whose k0 is in it.

    Hashes take as much room as texts; they are made anew where needed instead of being stored.
    """
    import xxhash

    kinds = [pa.binary() if t == "binary" else pa.list_(pa.int64()) for t in columns.values()]

    def run(batches):
        for b in batches:
            if only is not None:
                at = b.column(2).to_numpy() & (BITMAP - 1)
                b = b.filter(pa.array((only[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for i in range(0, b.num_rows, _ROWS):
                some = b.slice(i, _ROWS)
                sets = [shingles(t.as_py(), shingle) for t in some.column(1)]
                key = np.array([xxhash.xxh64_intdigest(h.tobytes(), SEED) for h in sets], np.uint64).view(np.int64)
                more = [pa.array(c, t) for c, t in zip(zip(*map(extra, sets), strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(key), pa.array([len(h) for h in sets], pa.int64()), *more, *some.columns[2:]], names=["id", "key", "n", *columns, "k0", "k1"])

    k0, k1 = row_keys(id_col, text_col)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), k0.alias("k0"), k1.alias("k1"))
    return in_arrow(src, run, "id long, key long, n long, " + "".join(f"{n} {t}, " for n, t in columns.items()) + "k0 long, k1 long")


def variants(distinct: DataFrame, length: int, segments: int, wild: int = WILD) -> DataFrame:
    """(h, key, n): the variants of each set's segments. ``h`` holds the segment, the wildcard and the other bits."""

    def run(batches):
        weights = np.int64(1) << np.arange(length, dtype=np.int64)
        for b in batches:
            for i in range(0, b.num_rows, _ROWS):
                some = b.slice(i, _ROWS)
                rows = some.num_rows
                bits = np.unpackbits(some.column(2).flatten().to_numpy().reshape(rows, -1).view(np.uint8), axis=1)[:, : length * segments]
                value = bits.reshape(rows, segments, length) @ weights
                weak = np.frombuffer(b"".join(some.column(3).to_pylist()), np.uint8).reshape(rows, segments, -1).astype(np.int64)
                place = np.arange(segments)[None, :, None] * 32 + weak
                h = place << 32 | value[:, :, None] & ~(np.int64(1) << weak)
                at = pa.array(np.repeat(np.arange(rows), h[0].size))
                yield pa.RecordBatch.from_arrays([pa.array(h.ravel()), some.column(0).take(at), some.column(1).take(at)], names=["h", "key", "n"])

    return in_arrow(distinct.select("key", "n", "fp", "weak"), run, "h long, key long, n long")


def _distance(a: Column, b: Column, words: int) -> Column:
    return sum(F.bit_count(F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w)))) for w in range(words))


def _with_distance(pairs: DataFrame, distinct: DataFrame, words: int) -> DataFrame:
    """``pairs`` (a, b) with ``d``, the number of bits in which their fingerprints differ."""
    a, b = (distinct.select(F.col("key").alias(f"key_{x}"), F.col("fp").alias(f"fp_{x}")) for x in "ab")
    both = pairs.join(a, F.col("a") == F.col("key_a")).join(b, F.col("b") == F.col("key_b"))
    return both.select(*pairs.columns, _distance(F.col("fp_a"), F.col("fp_b"), words).alias("d"))


def _verified(hashed: Callable, one: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar; written to the shared folder. ``one``: key and k0 of a row of each set."""
    needed = materialise(one.join(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi"))
    at = F.col("k0").bitwiseAND(BITMAP - 1)
    bits = needed.select(F.shiftright(at, 15).alias("block"), at.bitwiseAND(32767).alias("bit")).groupBy("block").agg(F.expr("bitmap_construct_agg(bit)").alias("bits"))
    only = np.zeros(BITMAP // 8, np.uint8)  # 2 MB at most
    for r in bits.collect():
        only[r["block"] * 4096 : (r["block"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    held = hashed(only).select("key", "k0", "hashes").join(needed, ["key", "k0"], "left_semi").dropDuplicates(["key"])
    a, b = (held.select(F.col("key").alias(f"key_{x}"), F.col("hashes").alias(f"hashes_{x}")) for x in "ab")
    both = pairs.join(a, F.col("a") == F.col("key_a")).join(b, F.col("b") == F.col("key_b"))
    shared, n = F.size(F.array_intersect("hashes_a", "hashes_b")), F.size("hashes_a") + F.size("hashes_b")
    return materialise(both.filter(shared >= similarity * (n - shared) - 1e-9).select("a", "b"))


def links(hashed: Callable, distinct: DataFrame, length: int, segments: int, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) keys of similar sets, enough of them to connect all that were found similar. ``distinct``: key, n, fp, weak and k0 of each set; ``hashed`` makes the hashes."""
    words = words_for(length, segments)
    most = most_different(64 * words, similarity)
    alike = lambda m, n: F.least(m, n) >= similarity * F.greatest(m, n) - 1e-9
    rows = variants(distinct, length, segments).repartition(F.col("h"))
    groups = rows.groupBy("h").agg(F.min(F.struct("key", "n")).alias("first"), F.max("key").alias("last")).filter("first.key < last")
    shared = rows.join(groups.select("h", "first"), "h").filter(F.col("key") != F.col("first.key"))
    shared = materialise(shared.select("h", "key", "n", F.col("first.key").alias("lead"), F.col("first.n").alias("lead_n")))
    stars = shared.filter(alike(F.col("n"), F.col("lead_n"))).select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
    stars = materialise(_with_distance(stars, distinct, words))
    one = distinct.select("key", "k0")
    found = _verified(hashed, one, materialise(stars.filter(F.col("d") <= most).select("a", "b")), similarity)
    comp = connected_components(found)
    placed = shared.join(comp, F.col("key") == F.col("node"), "left").select("h", "key", "n", "lead", F.coalesce("component", "key").alias("c"))
    mixed = placed.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("h")
    rest = placed.join(mixed, "h", "left_semi")  # pairs with the lead are settled
    rest = rest.join(stars.select(F.col("a").alias("lead"), F.col("b").alias("key"), "d"), ["lead", "key"], "left").join(distinct.select("key", "fp"), "key")
    rest = materialise(rest.select("h", "key", "n", "c", "d", "fp"))
    a, b = (rest.select(*[F.col(c).alias(f"{c}_{x}") for c in rest.columns]) for x in "ab")
    col = F.col
    may: Column = alike(col("n_a"), col("n_b")) & F.coalesce(F.abs(col("d_a") - col("d_b")) <= most, F.lit(True)) & (_distance(col("fp_a"), col("fp_b"), words) <= most)
    across = a.join(b, (col("h_a") == col("h_b")) & (col("key_a") < col("key_b")) & (col("c_a") != col("c_b")) & may)
    across = materialise(across.select(col("key_a").alias("a"), col("key_b").alias("b")).distinct())
    return found.unionByName(_verified(hashed, one, across, similarity))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component, each once; those without an id stay unless they link to one with."""
    spark = docs.sparkSession
    length, segments = segments_for(docs.count(), similarity, recall)
    made = _hashed(docs, id_col, text_col, shingle, lambda h: signature(h, length, segments), {"fp": "array<bigint>", "weak": "binary"})
    made.write.parquet(path := shared_path(spark, "sets"))
    sets = spark.read.parquet(path)
    least = F.min(F.struct(F.col("id").isNull(), "id", "k0")).alias("least")
    distinct = sets.groupBy("key").agg(least, F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("weak").alias("weak"))
    distinct = materialise(distinct.select("key", "n", "fp", "weak", F.col("least.id").alias("rep"), F.col("least.k0").alias("k0")))
    hashed = lambda only: _hashed(docs, id_col, text_col, shingle, lambda h: (h,), {"hashes": "array<bigint>"}, only)
    comp = connected_components(links(hashed, distinct, length, segments, similarity))
    placed = distinct.join(comp, F.col("key") == F.col("node"), "left").select("key", "rep", F.coalesce("component", "key").alias("c"))
    found = placed.join(placed.groupBy("c").agg(F.min("rep").alias("component_id")), "c").select("key", "component_id")
    rows = materialise(sets.select("id", "key", "k0", "k1").join(found, "key").select(F.col("id").alias(id_col), "component_id", "k0", "k1"))
    remove_path(spark, path)
    return keep_least(docs, rows, id_col, text_col)
