import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corvane.llm import graph, simhash
from corvane.llm import span_hash as sh


def _fp(t):
    w = (t or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(fps):
    """{id: smallest id reachable} of [(id, fingerprint)]."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(fps)}


def test_simhash_query(spark):
    d = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    fps = [(i, _fp(t)) for i, t in text.items()]
    want, rows = _components(fps), simhash.query(spark, d).collect()
    assert len(rows) == len(text)
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {i: (f, want[i]) for i, f in fps}


def test_simhash_fixture(spark):
    texts = [None, "", " \t\n", "One", "one", "a b", "A B", "x y z w " * 3000, "x y z", "X\x1cY z"]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, "One", 1)], "doc_id long, text string, fp int")
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.components(docs).collect()}
    want = _components([(i, _fp(t)) for i, t in enumerate(texts)])
    assert got == {i: (_fp(t), want[i]) for i, t in enumerate(texts)}
    assert simhash.components(docs.limit(0)).count() == 0


def test_links_against_brute_force(spark):
    rnd = random.Random(1)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        for k in (0, 1, 2, 3, 4, 5):
            fps.add(f ^ sum(1 << b for b in rnd.sample(range(64), k)))
    fps = sorted(fps)
    rows = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f, i) for i, f in enumerate(fps)], "fp long, rep long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.links(rows).collect()}
    assert got == {(i, j) for j in range(len(fps)) for i in range(j) if (fps[i] ^ fps[j]).bit_count() <= 3}


def test_variants_are_not_broadcast(spark):
    """Fingerprints under the broadcast threshold, whose variants take 64 times that room: no side of the join is gathered by the driver."""
    fps = spark.range(3000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("rep"))
    pairs = simhash.links(fps.groupBy("fp").agg(F.min("rep").alias("rep")))
    pairs.collect()
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)] + [(900, 900)]
    comp = {}
    for a, b in edges:
        comp.setdefault(a, a), comp.setdefault(b, b)
    for _ in comp:
        for a, b in edges:
            comp[a] = comp[b] = min(comp[a], comp[b])
    got = graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(comp) and {r.node: r.component for r in got} == comp


def test_components_of_odd_edges(spark):
    """Nulls are left out; loops, repeated and reversed edges, and no edges at all."""
    edges = spark.createDataFrame([(None, 1), (1, None), (None, None), (5, 5), (7, 6), (6, 7), (6, 7)], "a long, b long")
    assert {r.node: r.component for r in graph.connected_components(edges).collect()} == {5: 5, 6: 6, 7: 6}
    assert graph.connected_components(edges.limit(0)).count() == 0


def test_edges_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    edges = spark.range(20).selectExpr("id as a", "id + 1 as b").mapInArrow(count, "a long, b long")
    assert {r.component for r in graph.connected_components(edges).collect()} == {0} and seen.value == 20


def test_shared_folder(spark, monkeypatch):
    import tempfile
    from types import SimpleNamespace

    import pytest

    from corvane.sources import shared

    made = []
    session = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None, setCheckpointDir=made.append))
    monkeypatch.setattr(tempfile, "mkdtemp", lambda prefix: f"/tmp/{prefix}x")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(RuntimeError):
            shared.shared_dir(session(master))
    assert not made and shared.shared_dir(session("local[4]")) == made[0]


def test_prefix_hash():
    rnd = random.Random(3)
    t = "".join(rnd.choice("abé😀") for _ in range(300)) * 2
    p = sh.PrefixHash(t)
    for _ in range(300):
        i, j = rnd.randrange(len(t)), rnd.randrange(len(t))
        n = rnd.randrange(0, len(t) - max(i, j) + 1)
        assert bool(p.equal(i, j, n)[0]) == (t[i : i + n] == t[j : j + n])
        k, most = 0, rnd.randrange(len(t) - max(i, j) + 1)
        while k < most and t[i + k] == t[j + k]:
            k += 1
        assert p.common_extension(i, j, most).tolist() == [k]
        k, most = 0, rnd.randrange(min(i, j) + 1)
        while k < most and t[i - k - 1] == t[j - k - 1]:
            k += 1
        assert p.common_extension(i, j, most, back=True).tolist() == [k]


def _plain_anchors(t):
    """First place of each span of 24 code points whose hash is the smallest of some 64 neighbouring ones."""
    h = sh.PrefixHash(t).mixed(0, len(t), sh.SPAN)
    at = set()
    for i in range(max(1, len(h) - sh.WINDOW + 1)):
        some = h[i : i + sh.WINDOW]
        at |= {i + k for k in np.flatnonzero(some == some.min()).tolist()} if len(some) else set()
    first = {}
    for i in sorted(at):
        first.setdefault(t[i : i + sh.SPAN], i)
    return first


def _plain_likeness(a, b):
    """Character by character, without hashes of spans but for the choice of anchors."""
    if not a or not b:
        return float(a == b)
    x, y = _plain_anchors(a), _plain_anchors(b)
    cov_a, cov_b, done = set(), set(), set()
    for i, j in [(x[s], y[s]) for s in x if s in y] + [(0, 0), (len(a), len(b))]:
        lo, hi = 0, 0
        if (i, i - j) in done:
            continue
        while i - lo > 0 and j - lo > 0 and a[i - lo - 1] == b[j - lo - 1]:
            lo += 1
        while i + hi < len(a) and j + hi < len(b) and a[i + hi] == b[j + hi]:
            hi += 1
        cov_a |= set(range(i - lo, i + hi))
        cov_b |= set(range(j - lo, j + hi))
        done |= {(k, i - j) for k in range(i - lo, i + hi)}
    return (len(cov_a) + len(cov_b)) / (len(a) + len(b))


def test_likeness_against_plain_comparison():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdé😀") for _ in range(rnd.randrange(1, 9)))
    long = " ".join(word() for _ in range(600))
    texts = ["", "a", "aaaa" * 100, "ab" * 300, long, long[:40], long[500:900], long[: len(long) // 2] + "zz" + long[len(long) // 2 :], "x" * 200 + long[300:1200] + "y" * 200 + long[300:700], long[1500:] + long[:1500]]
    for a in texts:
        for b in texts:
            got = sh.likeness(a, b)
            assert abs(got - _plain_likeness(a, b)) < 1e-12 and got == sh.likeness(b, a)
            assert (got == 1.0) >= (a == b)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(sh.SPAN + sh.WINDOW - 1))
    for _ in range(50):  # a passage of this length is always found
        a, b = ("".join(rnd.choice("ijklmnop ") for _ in range(rnd.randrange(500))) + passage + "".join(rnd.choice("qrstuvw ") for _ in range(300)) for _ in range(2))
        assert sh.likeness(a, b) >= 2 * len(passage) / (len(a) + len(b))


def test_fingerprints():
    mark = sh.fingerprint_of
    rnd = random.Random(4)
    a, b = ("".join(rnd.choice("abcdefgh ") for _ in range(4000)) for _ in range(2))
    assert mark(a) == mark(a[:]) and len({mark(t) for t in (a, b, a[:-1], a[:2000] + "X" + a[2001:], "", "a", "aa", "aaaa" * 500, "aaaa" * 501)}) == 9
    smallest = sorted({int(x) for x in sh.PrefixHash(a).mixed(0, len(a), sh.SPAN)})[: sh.KEEP]
    assert mark(a).rpartition("-")[2] == "".join(f"{x:016x}" for x in smallest)
    several = sh.Texts(["", a, "short", b, a])
    assert [several.fingerprint(k) for k in range(5)] == [mark(t) for t in ("", a, "short", b, a)]
    assert sh.estimate(mark(a), mark(a)) == 1.0 and sh.estimate(mark(a), mark(b)) == 0.0
    assert abs(sh.estimate(mark(a), mark(a[:2000] + b[:2000])) - 0.5) < 0.2
    assert sh.estimate(mark(""), mark("")) == 1.0 and sh.estimate(mark(""), mark(a)) == 0.0


def _edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        marks = [sh.fingerprint_of(x) for x in (t, edited)]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *marks, *(round(_plain_likeness(t, x), 12) for x in (edited, nxt))))
    return sorted(out, key=str)


@pytest.mark.parametrize("n,together", [(0, 1), (1, 1), (2, 1 << 17), (40, 1), (40, 500), (40, 1 << 17)])
def test_edited(spark, monkeypatch, n, together):
    monkeypatch.setattr(sh, "TOGETHER", together)
    rows = [(i * 7 % 50, t) for i, t in enumerate([None, "", "é😀abc", "x" * 9000, "tie", "abc def " * 30] * 7)][:n]
    rows += [(7, "tie"), (7, "other"), (None, "no id"), (None, None)] if n == 40 else []
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, range int").repartition(3)
    got = sh.compare_edited(docs).collect()
    assert sorted(((*r[:5], round(r.near_edited, 12), round(r.near_next, 12)) for r in got), key=str) == _edited(rows)


def test_edited_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sh.query(spark, d).collect()
    assert sorted(((*r[:5], round(r.near_edited, 12), round(r.near_next, 12)) for r in got), key=str) == _edited(rows)
    assert np.mean([r.near_edited for r in got]) > 0.45 > 0.1 > np.mean([r.near_next for r in got])
