import numpy as np
import pytest

from corvane.llm import embedding_dedup as ed


def _brute(rows):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, root = len(ok), list(range(len(ok)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = (v / np.abs(v).max() for v in (ok[i][1], ok[j][1]))
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, (i, _) in enumerate(ok):
        least[find(k)] = min(least.get(find(k), i), i)
    out = [(i, links[k], least[find(k)], i == least[find(k)]) for k, (i, _) in enumerate(ok)]
    bad = [(i, 0, i, True) for i, v in rows if not (i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v))]
    return sorted(out + bad, key=str)


def _run(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], f"vec_id long, embedding array<{kind}>, component_id int").repartition(3)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.deduplicate(df).collect()), key=str)


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for c in range(40):
        base = rng.standard_normal(32)
        for k in range(int(rng.integers(1, 7))):
            rows.append(base + rng.standard_normal(32) * rng.choice([0, 0.05, 0.2, 0.3]))
    rows = [(1000 - i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 32), (2003, [float("nan")] * 32), (2004, [None, 1.0]), (2005, [float("inf")] + [0.0] * 31), (None, rows[0][1]), (2006, [x * 3 for x in rows[5][1]]), (2007, [1.0, 2.0]), (2008, [1.0, 2.1])]
    assert _run(spark, rows) == _brute(rows)


def test_huge_and_tiny_components(spark):
    big, tiny = 1e200, 1e-200
    rows = [(1, [big, 0.0]), (2, [big, 0.8 * big]), (3, [tiny, 0.0]), (4, [tiny, 0.1 * tiny]), (5, [1.7e308, 1.7e308]), (6, [5e-324, 5e-324]), (7, [1.0, 1.0]), (8, [0.0, -tiny]), (9, [big, tiny])]
    got = _run(spark, rows, "double")
    assert got == _brute(rows)
    assert {r[0]: r[2] for r in got} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 2, 6: 2, 7: 2, 8: 8, 9: 1}


def test_recall_in_clusters(spark):
    """Vectors spread around common centres: links of all strengths above the threshold, in groups."""
    rng = np.random.default_rng(8)
    rows = []
    for _ in range(25):
        centre = rng.standard_normal(64)
        rows += [centre + rng.standard_normal(64) * s for s in rng.uniform(0.15, 0.45, 24)]
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cos = np.triu(x @ x.T, 1)
    want = set(zip(*(i.tolist() for i in np.nonzero(cos >= 0.9)), strict=True))
    near = {p for p in want if cos[p] < 0.92}
    got = {(p.a, p.b) for p in ed.links(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")).collect()}
    assert got <= want and len(want) > 500 and len(near) > 100
    assert len(got) >= 0.97 * len(want) and len(got & near) >= 0.97 * len(near)


def test_repeated_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.1]), (3, [1.0, 0.0, 0.0]), (0, [-1.0, 0.0, 0.0])]
    assert _run(spark, rows) == _brute(rows)
    assert _run(spark, []) == []


@pytest.mark.parametrize("cos,blocks", [(0.9, None), (0.93, None), (0.9, 2), (0.9, 4), (0.9, 9)])
def test_recall_at_the_threshold(spark, cos, blocks):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    o = rng.standard_normal((300, 64))
    o -= (o * x).sum(1, keepdims=True) * x
    y = (cos + 1e-6) * x + (1 - cos**2) ** 0.5 * o / np.linalg.norm(o, axis=1, keepdims=True)
    rows = [(2 * i, v.tolist()) for i, v in enumerate(x)] + [(2 * i + 1, v.tolist()) for i, v in enumerate(y)]
    pairs = ed.links(spark.createDataFrame(rows, "id long, v array<double>"), blocks=blocks).collect()
    assert sum(1 for p in pairs if p.b == p.a + 1 and p.a % 2 == 0) >= 0.97 * 300


def test_blocks_grow_with_the_root_of_the_rows():
    assert [ed.blocks_for(n) for n in (0, 10_000, 50_000, 200_000, 5_000_000)] == [1, 2, 4, 8, 40]
