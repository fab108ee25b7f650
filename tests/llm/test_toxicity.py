import random
import zlib

import numpy as np
from corvane.llm import toxicity as tox


def test_pair_interaction():
    """Two terms that are harmless apart and toxic together."""
    rnd = random.Random(1)
    texts, y = [], []
    for _ in range(1500):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        texts.append(" ".join([f"w{rnd.randrange(300)}" for _ in range(8)] + ["insult"] * a + ["group"] * b))
        y.append(float(a and b))
    m = tox.fit([tox.terms(t) for t in texts], np.array(y))
    at = {int(b): i for i, b in enumerate(m.features)}
    s = m.scores([[at[b] for b in tox.terms(t).tolist() if b in at] for t in ("insult here", "group here", "insult group", "")])
    assert s[2] > 0.7 and max(s[0], s[1], s[3]) < 0.3
    i, j = (at[tox.buckets_of(w)[0]] for w in (b"insult", b"group"))
    assert m.vectors[i] @ m.vectors[j] > 0.5


def test_terms_that_matter_only_together():
    """Either of two terms is as frequent in both classes; a text is toxic if it holds both or neither."""
    rnd = random.Random(2)
    texts, y = [], []
    for _ in range(3000):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        texts.append(" ".join([f"w{rnd.randrange(300)}" for _ in range(8)] + ["insult"] * a + ["group"] * b))
        y.append(float(a == b))
    m = tox.fit([tox.terms(t) for t in texts], np.array(y))
    at = {int(b): i for i, b in enumerate(m.features)}
    assert all(tox.buckets_of(w)[0] in at for w in (b"insult", b"group"))
    s = m.scores([[at[b] for b in tox.terms(t).tolist() if b in at] for t in ("insult here", "group here", "insult group", "")])
    assert min(s[2], s[3]) > 0.7 and max(s[0], s[1]) < 0.3


def test_logit_is_the_sum_over_pairs():
    r = np.random.default_rng(4)
    m = tox.Machine(np.arange(30), 0.3, r.standard_normal(30), r.standard_normal((30, 8)))
    present = [[], [3], [1, 2], sorted(r.choice(30, 12, replace=False).tolist()), list(range(30))]
    got = m.logit(np.repeat(np.arange(5), [len(p) for p in present]), np.array([c for p in present for c in p]), 5)
    for p, z in zip(present, got, strict=True):
        plain = 0.3 + sum(m.weight[i] for i in p) + sum(float(m.vectors[i] @ m.vectors[j]) for i in p for j in p if i < j)
        assert abs(z - plain) < 1e-9
    assert np.allclose(m.scores(present), 1 / (1 + np.exp(-got)))


def test_sample_is_bounded(spark):
    """Any number of rows of one id, repeated rows, and long texts."""
    docs = spark.range(50_000).selectExpr("if(id % 2 = 0, 1L, id) as doc_id", "concat('text ', id) as text")
    docs = docs.unionByName(docs.limit(100)).unionByName(spark.createDataFrame([(7, "long " * 300_000)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (7, 0), (9, None)], "doc_id long, toxic int")
    found, y = tox.sample(docs, labels, most_rows=1000)
    again, _ = tox.sample(docs.repartition(7), labels, most_rows=1000)
    assert len(found) == len(y) == 1000 and all(map(np.array_equal, found, again))
    assert max(map(len, found)) < 10
    few, _ = tox.sample(docs, labels, most_bytes=1000)
    assert 50 < len(few) < 150 and not tox.sample(docs, labels, most_bytes=3)[0]


def test_fixture(spark):
    docs = spark.createDataFrame([(i, "you moron" if i % 3 == 0 else f"fine text {i}", "x", 0.5) for i in range(300)] + [(900, None, "x", 0.5), (901, "", "x", 0.5), (902, "a " * 200_000, "x", 0.5), (None, "moron", "x", 0.5), (3, "you moron", "x", 0.5)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(300)] + [(900, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = tox.score(docs, tox.train(docs, labels)).collect()
    assert len(rows) == 305
    s = {r.doc_id: r.score for r in rows}
    assert min(s[i] for i in range(0, 300, 3)) > 0.6 and max(s[i] for i in range(1, 300, 3)) < 0.3
    assert s[900] == s[901] and all(0 <= x <= 1 for x in s.values())
    none = tox.train(docs, labels.limit(0))
    assert max(r.score for r in tox.score(docs, none).collect()) < 1e-6
    toxic = tox.train(docs, labels.filter("toxic = 1"))
    assert min(r.score for r in tox.score(docs, toxic).collect()) > 1 - 1e-6
    assert tox.score(docs.limit(0), none).count() == 0


def test_held_out_labels_teach_nothing(spark):
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)], "doc_id long, toxic int")
    found, y = tox.sample(docs, labels)
    assert len(y) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(50))
    assert len(tox.sample(docs, labels, most_rows=5)[1]) == 5


def test_query(spark):
    d = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in tox.query(spark, d).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) for i, r in rows.items())
    held = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    auc = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])
    assert auc > 0.97 and np.mean([n >= 0.3 for n in neg]) < 0.02
