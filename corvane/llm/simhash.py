"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments of 32 bits. Of two fingerprints
that differ in at most three bits one segment differs in at most one, so both
have a variant of it, one bit wildcarded, in common. All 64 variants of each
distinct fingerprint are indexed, joined by equality and verified; each pair is
reported at one variant only. Documents with one fingerprint are represented by
their smallest id, so copies are never expanded into pairs.

Defined results: null and empty texts, and texts of white space alone, have
fingerprint zero and are linked like any other; texts of any length are hashed
whole; rows that repeat an id are one document; a null id gets a null component
unless its fingerprint links to an id; an empty table gives an empty result.
Extra columns are not carried. ``simhash_similar`` finds near copies by the
similarity of their shingles with the same signatures.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, materialise
from .graph import connected_components

SHINGLE = 3
SEED = 42
BITS = 3
_ROWS = 255


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned fingerprint: a bit is 1 if set in over half the shingle hashes."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z alone, and exactly space and 9 to 13
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1)[shingle - 1 :].tolist() or [len(joined)]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts, ends, strict=False)])
    n = len(ends)
    counts = np.zeros(64, np.int64)
    grid = np.frombuffer(hashes, np.uint8).reshape(n, 8)
    for i in range(0, n, _ROWS * 64):  # sums of 255 bits fit a byte
        bits = np.unpackbits(grid[i : i + _ROWS * 64], axis=1)
        full = len(bits) // _ROWS * _ROWS
        if full:
            counts += bits[:full].reshape(-1, _ROWS, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        counts += bits[full:].sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, keys: tuple[Column, ...] = ()) -> DataFrame:
    """id, ``fp`` (the fingerprint's bits as a signed long) and ``k0``, ``k1``... (long ``keys``) for each row."""
    names = [f"k{i}" for i in range(len(keys))]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], names=[id_col, "fp", *names])

    src = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"), *[k.alias(n) for k, n in zip(keys, names, strict=True)])
    return in_arrow(src, run, f"`{id_col}` long, fp long" + "".join(f", {n} long" for n in names))


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Distinct (a, b): the ``rep`` of each two rows of (fp, rep) whose fingerprints differ in at most ``bits`` (0 to 3) bits."""
    if not 0 <= bits <= 3:
        raise ValueError("two segments find up to three differing bits")
    segments = F.posexplode(F.array(F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(0xFFFFFFFF)))
    cut = distinct.select("fp", "rep", segments.alias("segment", "value"))
    variant = cut.select("fp", "rep", "segment", "value", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("wild"))
    masked = F.expr("value & ~shiftleft(1L, wild)")
    key = F.expr("shiftleft(cast(segment * 32 + wild as bigint), 32)").bitwiseOR(masked)
    rows = variant.select(key.alias("key"), "fp", "rep")
    a = rows.select("key", F.col("fp").alias("fa"), F.col("rep").alias("a"))
    b = rows.select(F.col("key").alias("key_b"), F.col("fp").alias("fb"), F.col("rep").alias("b"))
    # equal segments share all 32 variants, and are reported at the first alone
    once = F.expr("shiftrightunsigned(key, 32) % 32 = 0 or (shiftrightunsigned(fa ^ fb, if(shiftrightunsigned(key, 37) = 0, 32, 0)) & 4294967295L) <> 0")
    # sizes are estimated without the 64 rows that a fingerprint makes: unhinted, the variants of a table of under Spark's broadcast threshold are all sent to the driver
    pairs = a.hint("merge").join(b.hint("merge"), (F.col("key") == F.col("key_b")) & (F.col("fa") < F.col("fb")) & (F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= bits) & once)
    return pairs.select("a", "b").distinct()


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, keys: tuple[Column, ...] = ()) -> DataFrame:
    """id, fp and ``component_id``, the smallest id reachable by links, and the ``keys`` of ``fingerprints``."""
    fp = materialise(fingerprints(docs, id_col, text_col, keys=keys))
    distinct = fp.groupBy("fp").agg(F.min(id_col).alias("rep"))
    comp = connected_components(links(distinct.filter("rep is not null"), bits))
    found = distinct.join(comp, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fp.join(found, "fp").select(id_col, "fp", "component_id", *[c for c in fp.columns if c not in (id_col, "fp")])


def row_keys(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two hashes of id and text, by which rows are told apart."""
    return F.xxhash64(id_col, text_col), F.xxhash64(F.lit("row"), text_col, id_col)


def keep_least(docs: DataFrame, comp: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is their ``component_id``, each once. ``comp``: id, component_id and the ``row_keys`` k0, k1.

    Texts are shuffled once, by the keys.
    """
    names = ("__k0", "__k1")
    keys = row_keys(id_col, text_col)
    keep = comp.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col("k0").alias("__k0"), F.col("k1").alias("__k1")).distinct()
    found = docs.withColumns(dict(zip(names, keys, strict=True))).join(keep.hint("merge"), list(names), "left_semi")
    once = found.withColumn("__nth", F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1)))).filter("__nth = 1")
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir):
    out = components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
