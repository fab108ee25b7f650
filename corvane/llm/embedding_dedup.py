"""Embedding near-duplicates by collision-counting projections.

Every vector is projected on many random directions, and each direction is a
one-dimensional list, sorted by cells as wide as a window. A vector queries the
``tops`` directions (of either sign) on which it lies farthest out, where the
list is thin: all vectors within ``window`` of its own projection, which lie in
its cell or the two beside it, collide with it. Collisions are counted per
pair, from both sides, and pairs that reach the calibrated count are verified by
their cosine in double precision, so nothing below the threshold is linked.

The count is calibrated on simulated pairs that lie exactly at the threshold:
the largest count that still finds ``recall`` of them. As the directions are
random, this holds for any pair of vectors; closer pairs are found more surely.
Window collisions grow with the square of the rows, times how thin the tails
are; so the number of directions grows with the root of the rows.

Equal vectors are collapsed to their smallest id before any of this and counted,
so copies are never expanded into pairs.

Defined results: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing; components of any finite size are
scaled (by a power of two, exactly) before they are multiplied; a cosine of
exactly the threshold links; nor do vectors of different lengths
link with one another; a row without an id links with nothing and keeps a null
component; repeated ids are rows of their own; an empty table gives an empty
result. Extra columns are not carried.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, materialise
from .graph import connected_components

THRESHOLD = 0.9
#: Directions that are drawn and applied at a time.
BLOCK = 4096
#: Vectors that are projected on four blocks; their number grows with the root of the rows.
ROWS_OF_FOUR = 50_000
TOPS = 6
WINDOW = 0.5
RECALL = 0.99
_ROWS = 64


def blocks_for(rows: int) -> int:
    return max(1, round(4 * (rows / ROWS_OF_FOUR) ** 0.5))


@lru_cache(maxsize=4)
def directions(dim: int, block: int, seed: int = 11) -> np.ndarray:
    """A block of random directions; a random unit vector's projections have mean 0 and deviation 1."""
    r = np.random.default_rng([seed, dim, block]).standard_normal((BLOCK, dim))
    return np.ascontiguousarray((r / np.linalg.norm(r, axis=1, keepdims=True) * dim**0.5).T, np.float32)


def _outer(z: np.ndarray, tops: int) -> np.ndarray:
    """Positions of the ``tops`` largest |z| of each row."""
    return np.argpartition(-np.abs(z), tops - 1, axis=1)[:, :tops]


def calibrate(dim: int, threshold: float, blocks: int, tops: int, window: float, recall: float, pairs: int = 1000, seed: int = 5) -> tuple[float, int]:
    """(smallest |z| that is listed, count): of simulated pairs at the threshold, ``recall`` reach the count, which is 1 at least.

    Nearly all windows lie above the first whole; what the others lose is in the count.
    """
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    o = rng.standard_normal((pairs, dim))
    o -= (o * x).sum(1, keepdims=True) * x
    o /= np.maximum(np.linalg.norm(o, axis=1, keepdims=True), 1e-300)
    y, kept = threshold * x + (1 - threshold**2) ** 0.5 * o, []
    for i in range(0, pairs, _ROWS):
        some = [v[i : i + _ROWS].astype(np.float32) for v in (x, y)]
        best = [np.empty((len(some[0]), 0)) for _ in range(4)]  # of x its own outermost and the other's there, and of y
        for block in range(blocks):
            zx, zy = (v @ directions(dim, block) for v in some)
            for k, (a, b) in enumerate(((zx, zy), (zy, zx))):
                at = _outer(a, tops)
                za, zb = (np.concatenate((best[2 * k + m], np.take_along_axis(z, at, 1)), 1) for m, z in ((0, a), (1, b)))
                at = _outer(za, tops)
                best[2 * k], best[2 * k + 1] = np.take_along_axis(za, at, 1), np.take_along_axis(zb, at, 1)
        kept.append(best)
    own_x, there_x, own_y, there_y = (np.concatenate(k) for k in zip(*kept, strict=True))
    low = float(np.quantile(np.abs(np.concatenate((own_x, own_y))).min(1), 0.05)) - window
    met = lambda za, zb: ((np.abs(za - zb) <= window) & (np.sign(za) == np.sign(zb)) & (np.abs(zb) >= low)).sum(1)
    counts = met(own_x, there_x) + met(own_y, there_y)
    return low, max(1, int(np.sort(counts)[int((1 - recall) * pairs)]))


def usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda s, t: s * t), F.lit(0.0), lambda s, t: s + t)


def scaled(v: Column) -> Column:
    """The vector with its largest component between 1 and 2, or slightly beyond: products neither overflow nor vanish."""
    size = F.pow(F.lit(2.0), F.floor(F.log2(F.array_max(F.transform(v, F.abs)))))
    return F.transform(v, lambda x: x / size)


def project(distinct: DataFrame, blocks: int, tops: int, lows: dict[int, float]) -> DataFrame:
    """Of (id, v): rows (direction, z, id, asks) with |z|; ``asks`` marks a vector's outermost directions."""

    def run(batches):
        for b in batches:
            ids, vectors = b.column(0).to_numpy(), b.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat, starts = vectors.values.to_numpy(), vectors.offsets.to_numpy()[:-1]
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                for i in range(0, len(rows), _ROWS):
                    some = rows[i : i + _ROWS]
                    v = flat[starts[some][:, None] + np.arange(dim)]
                    v = v / np.abs(v).max(1, keepdims=True)
                    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
                    found = []
                    for block in range(blocks):
                        z = v @ directions(dim, block)
                        listed = np.abs(z) >= lows[dim]
                        np.put_along_axis(listed, _outer(z, tops), True, 1)
                        k, d = np.nonzero(listed)
                        found.append((k, d + block * BLOCK, z[k, d]))
                    k, d, z = map(np.concatenate, zip(*found, strict=True))
                    order = np.lexsort((-np.abs(z), k))
                    k, d, z = k[order], d[order], z[order]
                    asks = np.arange(len(k)) - np.searchsorted(k, k) < tops
                    key = (np.int64(dim) << 40) + d.astype(np.int64) * 2 + (z < 0)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.abs(z)), pa.array(ids[some][k]), pa.array(asks)], names=["direction", "z", "id", "asks"])

    return in_arrow(distinct.select("id", "v"), run, "direction long, z float, id long, asks boolean")


def links(distinct: DataFrame, threshold: float = THRESHOLD, blocks: int | None = None, tops: int = TOPS, window: float = WINDOW, recall: float = RECALL) -> DataFrame:
    """Verified pairs (a < b) of (id, v), v an array of double, each id once."""
    dims = {r["d"]: r["n"] for r in distinct.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    blocks = blocks or blocks_for(max(dims.values(), default=1))
    fitted = {d: calibrate(d, threshold, blocks, tops, window, recall) for d in dims}
    least = min((count for _, count in fitted.values()), default=1)
    listed = materialise(project(distinct, blocks, tops, {d: low for d, (low, _) in fitted.items()}))
    cell = F.floor(F.col("z") / window)
    listed = listed.select("direction", F.col("z").cast("double").alias("z"), "id", "asks", cell.alias("cell"))
    q = listed.filter("asks").select(F.col("direction").alias("q_direction"), F.col("z").alias("q_z"), F.col("id").alias("q_id"), F.explode(F.sequence(F.col("cell") - 1, F.col("cell") + 1)).alias("q_cell"))
    near = (F.col("direction") == F.col("q_direction")) & (F.col("cell") == F.col("q_cell")) & (F.abs(F.col("z") - F.col("q_z")) <= window) & (F.col("id") != F.col("q_id"))
    met = q.join(listed.drop("asks"), near).select(F.least("id", "q_id").alias("a"), F.greatest("id", "q_id").alias("b"))
    counted = met.groupBy("a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= least).select("a", "b")
    sized = distinct.select("id", scaled(F.col("v")).alias("v"))
    sized = materialise(sized.select("id", "v", F.sqrt(_dot(F.col("v"), F.col("v"))).alias("norm")))
    va, vb = (sized.select(F.col("id").alias(x), F.col("v").alias(f"v{x}"), F.col("norm").alias(f"norm_{x}")) for x in "ab")
    cosine = _dot(F.col("va"), F.col("vb")) / (F.col("norm_a") * F.col("norm_b"))
    return counted.join(va, "a").join(vb, "b").filter((F.size("va") == F.size("vb")) & (cosine >= threshold)).select("a", "b")


def deduplicate(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, **options) -> DataFrame:
    """id, n_links, component_id and kept of each row."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    good = rows.filter(usable(F.col("v")) & F.col("vec_id").isNotNull())
    distinct = materialise(good.groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    by_id = distinct.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").limit(1)
    if by_id.count():  # different vectors share an id: number the vectors, and take the id back at the end
        distinct = materialise(distinct.withColumnRenamed("id", "least_id").withColumn("id", F.monotonically_increasing_id()))
    else:
        distinct = distinct.withColumn("least_id", F.col("id"))
    pairs = materialise(links(distinct, threshold, **options))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(distinct.select(F.col("id").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("linked"))
    comp = connected_components(pairs)
    least = comp.join(distinct.select(F.col("id").alias("node"), "least_id"), "node").groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = (
        distinct.join(others, F.col("id") == F.col("a"), "left")
        .join(comp, F.col("id") == F.col("node"), "left")
        .join(least, "component", "left")
        .select(F.col("v").alias("found_v"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"))
    )
    ok = good.join(found, F.col("v") == F.col("found_v")).select("vec_id", "n_links", "component_id")
    bad = rows.filter(~usable(F.col("v")) | F.col("vec_id").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = ok.unionByName(bad)
    return out.select(F.col("vec_id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir):
    return deduplicate(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_DOT = "list_sum(list_transform(range(1, len({0}) + 1), lambda i: {0}[i] * {1}[i]))"
ORACLE = f"""
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v, {_DOT.format("(embedding::DOUBLE[])", "(embedding::DOUBLE[])")} AS n2 FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM e x JOIN e y ON x.vec_id <> y.vec_id AND x.n2 > 0 AND y.n2 > 0
      AND {_DOT.format("x.v", "y.v")} >= 0.9 * sqrt(x.n2) * sqrt(y.n2)),
r AS (SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM e JOIN c ON e.vec_id = c.a LEFT JOIN n ON n.a = e.vec_id
"""
