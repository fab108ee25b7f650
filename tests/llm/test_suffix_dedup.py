import hashlib
import random

import numpy as np
import pytest

from corvane.llm import collection_bwt as cb
from corvane.llm import suffix_dedup as sd


def _strings(rnd):
    return [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 12))) for _ in range(rnd.randrange(1, 8))]


def _packed(strings):
    sizes = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(sizes) - sizes, sizes


def test_transform_against_sorted_suffixes():
    rnd = random.Random(1)
    for _ in range(60):
        s = _strings(rnd)
        suffixes = sorted(([c + 1000 for c in x[k:]] + [i], i, k) for i, x in enumerate(s) for k in range(len(x) + 1))

        def common(x, y):
            return next((n for n in range(min(len(x), len(y))) if x[n] != y[n] or x[n] < 1000), 0)

        bwt, lcp = cb.build(*_packed(s))
        assert bwt.tolist() == [s[i][k - 1] + 1 if k else 0 for _, i, k in suffixes]
        assert lcp.tolist() == [0] + [common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:])]


@pytest.mark.parametrize("length", [1, 3])
def test_classes(length):
    rnd = random.Random(2)
    for _ in range(30):
        s = _strings(rnd)
        got = {}
        for size, strings, group in cb.classes(*_packed(s), length):
            got.update({(i, len(s[i]) - size): g for i, g in zip(strings.tolist(), group.tolist())})
        want = {(i, k): x[k : k + length] for i, x in enumerate(s) for k in range(len(x) - length + 1)}
        assert set(got) == set(want)
        assert len(set(zip(got.values(), (want[q] for q in got)))) == len(set(want.values())) == len(set(got.values()))


def brute(rows, length=50):
    rows = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in rows:
        if i is not None:
            for k in range(len(t) - length + 1):
                w = t[k : k + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            j = first.get(t[k : k + length])
            if j is not None and (i is None or j < i):
                gone[k : k + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()) if len(t) else 0, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id long, text string, g int, kept binary").repartition(3)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in sd.remove_repeats(docs, **options).collect()), key=str)


def _fixture(seed=5):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéß中") for _ in range(rnd.randrange(1, 8))) for _ in range(200)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = [text(k) for k in (8, 15, 30, 60)]
    rows = [(i, " ".join(rnd.choice([text(rnd.randrange(30)), rnd.choice(shared)]) for _ in range(rnd.randrange(5)))) for i in rnd.sample(range(1000), 120)]
    rows += [(2000, None), (2001, ""), (2002, "x" * 49), (2003, "x" * 50), (2004, "x" * 700), (2005, "x" * 51), (2006, "ab" * 300), (2007, "ba" * 300), (None, shared[3]), (None, shared[2]), (2008, text(9000)), (2008, shared[3]), (2008, shared[3])]
    rows += [(3000 + i, f"{i} " + shared[3] + f" {i}") for i in range(20)]
    return rows


@pytest.mark.parametrize("options", [{}, {"hot_groups": 0}])
def test_against_brute_force(spark, monkeypatch, options):
    rows = _fixture()
    assert _run(spark, rows, **options) == brute(rows)


def test_many_groups(spark, monkeypatch):
    monkeypatch.setattr(sd, "GROUP_BYTES", 4000)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 9000)
    rows = _fixture(6)
    assert _run(spark, rows) == brute(rows)
    assert _run(spark, rows, hot_groups=2) == brute(rows)
    assert _run(spark, rows, hot_groups=0) == brute(rows)


def test_hot_pieces_come_from_few_senders(spark, monkeypatch):
    """A passage in every group: merged on the way, with the same result."""
    monkeypatch.setattr(sd, "GROUP_BYTES", 500)
    rnd = random.Random(8)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(300))
    rows = [(i, "".join(rnd.choice("ijklm ") for _ in range(200)) + passage + "".join(rnd.choice("nopq ") for _ in range(60))) for i in range(150)]
    assert _run(spark, rows, hot_groups=20) == brute(rows)


@pytest.mark.parametrize("merge_groups", [0, 10**9])
def test_hot_keys_with_and_without_merging(spark, monkeypatch, merge_groups):
    """Keys of many groups are divided either way; unless pieces are merged on the way, nothing is written and read again for them."""
    monkeypatch.setattr(sd, "GROUP_BYTES", 4000)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 9000)
    seen, write = [], sd.materialise
    monkeypatch.setattr(sd, "materialise", lambda df: seen.append(df) or write(df))
    rows = _fixture(9)
    assert _run(spark, rows, hot_groups=2, merge_groups=merge_groups) == brute(rows) and len(seen) == (merge_groups == 0)
    seen.clear()
    if merge_groups:
        assert _run(spark, rows, hot_groups=2) == brute(rows) and not seen  # by default at this number of groups


@pytest.mark.parametrize("length", [50, 49, 51, 20, 23])
def test_wide_symbols(monkeypatch, length):
    """Classes by symbols of several bytes are those of single bytes, in fewer rounds."""
    rnd = random.Random(length)
    long = bytes(rnd.choice(b"ab") for _ in range(40)) * 6
    s = [long[i : i + rnd.randrange(length - 1, 2 * length - 1)] for i in (rnd.randrange(100) for _ in range(60))] + [b"", b"ab", bytes([0, 254]) * 45]
    rounds, minima = [], cb._minima
    monkeypatch.setattr(cb, "_minima", lambda lcp: rounds.append(1) or minima(lcp))
    got = {(i, len(s[i]) - size): g for size, strings, group in cb.classes(*_packed(s), length) for i, g in zip(strings.tolist(), group.tolist())}
    want = {(i, k): x[k : k + length] for i, x in enumerate(s) for k in range(len(x) - length + 1)}
    assert set(got) == set(want) and len(set(zip(got.values(), (want[q] for q in got)))) == len(set(want.values())) == len(set(got.values()))
    step = next(k for k in (5, 4, 3, 2, 1) if length % k == 0)
    assert len(rounds) == max(map(len, s)) // step


def test_large_keys_are_divided(monkeypatch):
    """One key for all pieces, divided by further hashes or not: the same smallest ids."""
    import pyarrow as pa

    rnd = random.Random(3)
    common = bytes(rnd.choice(b"abc") for _ in range(20))
    pieces = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(15, 30))) + common + bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(15, 30))) for _ in range(200)]
    pieces = sorted({p for x in pieces for p in (x, x[3:], x[:-2], b"zzz" + x) if 50 <= len(p) <= 98})
    ids = np.array(rnd.sample(range(10_000), len(pieces)), np.int64)
    least = {}
    for p, i in zip(pieces, ids.tolist()):
        for k in range(len(p) - 49):
            least[p[k : k + 50]] = min(least.get(p[k : k + 50], i), i)
    want = [[least[p[k : k + 50]] for k in range(len(p) - 49)] for p in pieces]
    for most in (1 << 20, 3000, 10):
        monkeypatch.setattr(sd, "DIVIDE_BYTES", most)
        got = sd.smallest_ids(pa.array(pieces, pa.binary()), np.full(len(pieces), 8, np.uint64), ids, 50)
        assert [g.tolist() for g in got] == want


def test_empty(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, None)]) == brute([(1, None)])


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in sd.query(spark, d).collect()), key=str) == brute(rows)
