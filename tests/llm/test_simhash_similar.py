"""Near copies by five-word shingles against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from corvane.llm import simhash_similar as similar


def _set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def _linked(texts):
    """Pairs (i, j), i < j, of similar texts with their similarity; ``texts``: {id: text}."""
    sets, holders = {i: _set(t) for i, t in texts.items()}, defaultdict(list)
    empty = [i for i in sets if not sets[i]]
    out = {(min(empty), i): 1.0 for i in empty if i != min(empty)}
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, j in {(i, j) for h in holders.values() for i in h for j in h if i < j}:
        both = len(sets[i] & sets[j])
        if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
            out[i, j] = both / (len(sets[i]) + len(sets[j]) - both)
    return out


def _kept(texts):
    """Ids that are the smallest of their component."""
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in _linked(texts):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return {i for i in texts if find(i) == i}


def _edited(rnd, words, n):
    out = list(words)
    for i in rnd.sample(range(len(out)), n):
        out[i] = f"e{rnd.randrange(10**9)}"
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    texts, common = ["", " \n", "one", "One", "a b c d e", "a b c d e f"], [f"c{i}" for i in range(60)]
    for n in (6, 20, 100, 100, 400):
        for _ in range(6):
            words = [f"w{rnd.randrange(10**9)}" for _ in range(n)] + common * rnd.randrange(2)
            texts += [" ".join(words), *(" ".join(_edited(rnd, words, k)) for k in {1, max(1, n // 50), max(1, n // 25)})]
    chain = [f"k{i}" for i in range(300)]  # each close to the next, the ends far apart
    for k in range(12):
        texts.append(" ".join([f"x{i}" if i < 8 * k else w for i, w in enumerate(chain)]))
    rnd.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = _kept(dict(enumerate(texts)))
    got = {r.doc_id for r in similar.deduplicate(docs).collect()}
    assert want <= got and len(got - want) <= 0.02 * len(texts)  # no link is wrong, few are missed
    assert {r.doc_id for r in similar.deduplicate(docs, recall=0.99999).collect()} == want


def test_recall_at_the_threshold(spark):
    """Pairs of random sets at similarities of 0.8 to 0.9, with as many segments as a large table has."""
    rnd, texts, near = random.Random(7), [], []
    for _ in range(300):
        words = [f"w{rnd.randrange(10**9)}" for _ in range(rnd.choice([60, 300, 900]))]
        other = list(words)
        for at in rnd.sample(range(0, len(words) - 5, 5), max(1, round(len(words) * 0.02))):
            other[at] = f"e{rnd.randrange(10**9)}"
        texts += [" ".join(words), " ".join(other)]
    want = {p: s for p, s in _linked(dict(enumerate(texts))).items()}
    assert len(want) == 300 and min(want.values()) < 0.83
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = len(texts) - similar.deduplicate(docs).count()
    assert 0.95 * len(want) <= got <= len(want)


def test_a_large_group_is_not_expanded(spark, monkeypatch):
    """Near copies of one text: candidate pairs grow with their number, not with its square."""
    rnd = random.Random(5)
    words = [f"w{rnd.randrange(10**9)}" for _ in range(400)]
    texts = [" ".join(_edited(rnd, words, 3)) for _ in range(600)] + [" ".join(f"w{rnd.randrange(10**9)}" for _ in range(400)) for _ in range(300)]
    seen, checked = [], similar._verified
    monkeypatch.setattr(similar, "_verified", lambda hashed, one, pairs, s: seen.append(pairs.count()) or checked(hashed, one, pairs, s))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id for r in similar.deduplicate(docs).collect()}
    assert got == {0, *range(600, 900)} and sum(seen) < 20 * 600


def test_segments():
    assert [similar.segments_for(n)[0] for n in (0, 1000, 250_000, 10**9, 10**12)] == [12, 12, 20, 32, 32]
    sizes = [similar.segments_for(250_000, s)[1] for s in (0.95, 0.9, 0.8, 0.7)]
    assert sizes == sorted(sizes) and sizes[-1] < 200


def test_signature():
    import hashlib

    h = np.sort(np.frombuffer(b"".join(hashlib.md5(b"%d" % i).digest()[:8] for i in range(700)), "<i8"))
    counts = similar.bit_counts(h, 500)
    assert np.array_equal(counts, similar.bit_counts(h[:300], 500) + similar.bit_counts(h[300:], 500)) and abs(counts - 350).max() < 80
    fp, weak = similar.signature(h, 20, 25)
    assert len(fp) == 32 and np.array_equal(np.unpackbits(fp.view(np.uint8))[:500], 2 * counts > 700)
    margin = abs(2 * counts - 700).reshape(25, 20)
    for m, w in zip(margin, np.frombuffer(weak, np.uint8).reshape(25, 6)):
        assert len(set(w.tolist())) == 6 and sorted(m[w].tolist()) == sorted(m.tolist())[:6]


def test_on_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    got, want = [r.doc_id for r in similar.deduplicate(docs).collect()], _kept({r.doc_id: r.text for r in docs.collect()})
    assert len(got) == len(set(got)) and want <= set(got) and len(got) <= len(want) + 2


def test_fixture(spark):
    rows = [(1, "a b c d"), (2, "a b c d"), (2, "other words here"), (2, "other words here"), (None, "a b c d"), (None, "alone it is"), (None, "alone it is"), (7, None), (8, "")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, key int")
    got = similar.deduplicate(docs)
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([(1, "a b c d"), (2, "other words here"), (None, "alone it is"), (7, None)], key=str)
    assert got.columns == docs.columns and similar.deduplicate(docs.limit(0)).count() == 0
