"""Each stage against brute force, on its own input."""

import corpus_pipeline as cp
import numpy as np
import public_tokenizers as P
import pytest
from test_simhash_similar import _kept
from test_suffix_dedup import brute
from tokenizers import Tokenizer

from corvane.llm import toxicity

D = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), []
    for name, stage in cp.STAGES:
        path = f"file://{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, D).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def test_toxicity(spark, stages):
    before, after = stages[0]
    labels = spark.read.parquet(f"{D}/labels.parquet")
    score = {r.doc_id: r.score for r in toxicity.score(before, toxicity.train(before, labels)).collect()}
    assert after.columns == cp.COLUMNS
    assert sorted(map(tuple, after.collect())) == sorted(tuple(r) for r in before.collect() if score[r.doc_id] < 0.3)


def test_near_duplicates(stages):
    before, after = stages[1]
    rows = {r.doc_id: tuple(r) for r in before.collect()}
    want, got = _kept({i: r[1] for i, r in rows.items()}), sorted(map(tuple, after.collect()))
    assert after.columns == cp.COLUMNS and got == sorted(rows[r[0]] for r in got)
    assert want <= {r[0] for r in got} and len(got) <= len(want) + 2  # signatures find nearly all links


def test_repeated_passages(stages):
    before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want, got = {r[0]: r for r in brute(rows)}, {r.doc_id: r for r in after.collect()}
    assert set(want) == set(got) and after.columns == cp.COLUMNS
    for i, t in rows:
        n = len(t.encode()) - len(got[i].text.encode())
        assert want[i][2] <= n <= want[i][2] + 6 * want[i][3] and got[i].n_chars == len(got[i].text)


def test_packing(stages):
    before, after = stages[3]
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    by_doc = {}
    for r in after.collect():
        by_doc.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert after.select("sequence_id").distinct().count() == after.count()
    for r in before.collect():
        assert b"".join(b for _, b in sorted(by_doc.pop(r.doc_id))) == np.array([*t.encode(r.text, add_special_tokens=False).ids, 1], "<u4").tobytes()
    assert not by_doc


def test_odd_rows(spark, tmp_path):
    """Nulls in any column, repeated rows, shared ids, a long text and columns with clashing names, through every stage."""
    rows = [(1, "a b c d e f g h", "x", "s", 15), (1, "a b c d e f g h", "x", "s", 15), (2, "A b c d e f g h", None, None, None), (3, None, "x", "s", None), (4, "", None, "s", 0), (None, "no id here at all", "x", None, 3), (None, None, None, None, None), (5, "long text " * 50_000, "x", "s", 500_000), (6, "é中😀 " * 40, "x", "s", 1), (6, "another text of the same id", "x", "s", 2)]
    docs = spark.createDataFrame([(*r, 0.5, "fp", b"k") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, kept binary").repartition(3)
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, None, None), (77, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    out = {}
    for name, stage in cp.STAGES:
        path = f"file://{tmp_path}/{name}"
        stage(spark, docs, f"file://{tmp_path}").write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    ids = lambda d: sorted((r.doc_id for r in d.collect()), key=str)
    assert out["toxicity"].columns == out["near_duplicates"].columns == out["repeated_passages"].columns == cp.COLUMNS
    assert ids(out["toxicity"]) == sorted((r[0] for r in rows), key=str)
    assert ids(out["near_duplicates"]) == ids(out["repeated_passages"]) == sorted([1, 3, 5, 6, 6, None], key=str)
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ends = out["packing"].groupBy("doc_id", "doc_tokens").sum("length").collect()
    texts = [r for r in out["repeated_passages"].collect()]
    assert sorted((str(r[0]), r[1], r[2]) for r in ends) == sorted((str(r.doc_id), n, n) for r in texts for n in [len(t.encode(r.text or "").ids) + 1])


def test_run_leaves_one_table(spark, tmp_path, monkeypatch):
    made = []
    monkeypatch.setattr(cp, "shared_path", lambda s, what: made.append(f"file://{tmp_path}/{what}") or made[-1])
    for t in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"file://{tmp_path}/{t}.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() > 0
    assert sorted(p.name for p in tmp_path.iterdir() if p.name.startswith("pipeline-")) == ["pipeline-packing"] and len(made) == 4


def test_empty(spark, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{D}/{t}.parquet").limit(0).write.parquet(f"file://{tmp_path}/{t}.parquet")
    assert cp.run(spark, f"file://{tmp_path}").count() == 0
