import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from corvane.llm import bpe, packing

TEXTS = [
    (0, "Hello  world,\n\n it's 1234 don't\t\ttab  "),
    (1, None),
    (2, ""),
    (3, "naïve Ünïcödé 中文字符    xᰜ!! 'S we'LL"),
    (4, "a <|endoftext|> b<|endoftext|><|endoftext|>  c"),
    (5, "!\x1c\x1d? \x85 　end\r\n"),
    (6, "abcdefghij" * 5000),
    (7, "word " * 9000),
    (8, "Hello  world,\n\n it's 1234 don't\t\ttab  "),
    (9, "   \n  "),
    (10, "é İstanbul ΣΑΣ 😀😀 ﬁ"),
    (10, "same id"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in TEXTS], "doc_id long, text string, ids string, length int").repartition(3)


def test_bpe_equals_library(spark, docs):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = sorted((r.doc_id, list(r.ids), r.decoded) for r in bpe.encode(docs, decoded=True).collect())
    want = []
    for i, x in TEXTS:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, ids, t.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    again = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((r.doc_id, r.decoded) for r in again) == sorted((i, x) for i, _, x in want)


def test_bpe_on_documents(spark):
    d = "/root/testdata/sf0.001"
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = bpe.query(spark, d).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = t.encode(text[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(t.decode(ids, skip_special_tokens=False))


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert bpe.decode(bpe.encode(none)).count() == 0
    assert packing.pack(none).count() == 0


def test_piece_lengths():
    for n in [*range(1, 300), 2047, 2048, 2049, 10_000]:
        k = packing.piece_lengths(n)
        assert sum(k) == n and max(k) <= 2048 and all(x & (x - 1) == 0 for x in k)


def _check_pieces(rows, want):
    by_doc, seqs = {}, set()
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.offset == 0 and r.sequence_id not in seqs
        seqs.add(r.sequence_id)
    assert seqs == set(range(len(seqs)))
    return by_doc


def test_packing_fixture(spark, docs):
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = packing.pack(docs).collect()
    by_doc = _check_pieces(rows, TEXTS)
    for i, x in TEXTS:
        if i == 10:
            continue
        want = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        mine = sorted(by_doc[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in mine) == want
        assert all(r.doc_tokens == len(want) // 4 for r in mine)
    assert len({r.doc_tokens for r in by_doc[10]}) == 2


def test_packing_query(spark):
    d = "/root/testdata/sf0.001"
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    by_doc = _check_pieces(packing.query(spark, d).collect(), text)
    assert set(by_doc) == set(text)
    for i, mine in by_doc.items():
        ids = np.array([*t.encode(text[i], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids) == mine[0].doc_tokens


def test_memory_and_groups_change_nothing(monkeypatch):
    import pyarrow as pa

    from corvane.llm import memo

    monkeypatch.setattr(memo, "GROUP_BYTES", 40)
    monkeypatch.setattr(memo, "_WORDS", 7)
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 1000)
    monkeypatch.setattr(packing, "MEMORY_BYTES", 1000)
    texts = [t for _, t in TEXTS if t is None or len(t) < 1000] * 3
    b, w = bpe.Codec(), packing.WordIds("word_bpe_49k.json")
    tb, tw = (Tokenizer.from_file(P.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    for mine, lib in ((b.encode, tb), (w.encode, tw)):
        got = [x.tolist() for x in mine(pa.array(texts, pa.string()))]
        assert got == [lib.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_white_space_never_cut():
    """Random mixes of white space, letters, digits and marks against the library."""
    import random

    import pyarrow as pa

    rnd = random.Random(9)
    chars = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0   ​   　aZé1٣!'’s中́"
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(40))) for _ in range(1500)]
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = [x.tolist() for x in bpe.Codec().encode(pa.array(texts))]
    assert got == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_set_apart_change_no_id():
    """Random mixes of letters of every case, marks, commas, stops and pieces of special tokens against the library."""
    import random

    import pyarrow as pa

    rnd = random.Random(3)
    parts = [*"aEÉéIİıKßẞ.,1٣中 \nΣ…!?;:*#%$&)('<=>|Ōž\u0338", "É", "́", "..", "'s", "'S", "'LL", "<|", "|>", "<|STARTOFTEXT|>", "<|endoftext|>", "x.", "Y,"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(25))) for _ in range(3000)]
    lib, mine = Tokenizer.from_file(P.path("word_bpe_49k.json")), packing.WordIds("word_bpe_49k.json")
    for some in ([t for t in texts if "<|" not in t], texts):
        for got, t in zip(mine.encode(pa.array(some)), some, strict=True):
            assert got.tolist() == lib.encode(t, add_special_tokens=False).ids


def test_capitals_with_marks_keep_their_ids():
    import pyarrow as pa

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = [f"{w} Plain WORD, {w}x A{w}." for w in ("J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "\u00c9", "E\u0301")]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    for other in ([], ["<|endoftext|> A<|B"]):
        got = list(packing.word_ids(packing.TOKENIZER).encode(pa.array(texts + other)))
        assert [g.tolist() for g in got] == want + [t.encode(x, add_special_tokens=False).ids for x in other]


def test_memory_is_bounded_in_bytes():
    from corvane.llm.memo import LONGEST, Memo

    made = []
    m = Memo(lambda k: made.append(k) or k.encode(), 10_000)
    for i in range(1000):
        assert m[f"word{i}"] == b"word%d" % i
        assert m["x" * (LONGEST + 1)] == b"x" * (LONGEST + 1)
        assert sum(len(k) for t in (m, m.old) for k in t) < 20_000 and len(m) + len(m.old) <= 100
    assert made.count("x" * (LONGEST + 1)) == 1000


def test_long_distinct_words(spark):
    """Words too long to be remembered, all different."""
    import random

    rnd = random.Random(1)
    texts = [" ".join("".join(rnd.choice("abcXYZ019+/") for _ in range(10_000)) for _ in range(3)) for _ in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tb, tw = (Tokenizer.from_file(P.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    assert {r.doc_id: list(r.ids) for r in bpe.encode(docs).collect()} == {i: tb.encode(t).ids for i, t in enumerate(texts)}
    assert all(r.doc_tokens == len(tw.encode(texts[r.doc_id]).ids) + 1 for r in packing.pack(docs).collect())


def test_other_tokenizer_encodes_whole_texts(spark, docs):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert not packing.word_ids("byte_bpe_50k.json").apart and packing.word_ids(packing.TOKENIZER).apart
    by_doc = _check_pieces(packing.pack(docs, tokenizer="byte_bpe_50k.json").collect(), TEXTS)
    for i, x in TEXTS[:10]:
        want = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4").tobytes()
        assert b"".join(bytes(r.ids) for r in sorted(by_doc[i], key=lambda r: r.start)) == want


def test_numbers_by_shuffle_are_the_same(spark, docs, monkeypatch):
    want = sorted((r.doc_id, r.start, r.length, r.sequence_id) for r in packing.pack(docs.repartition(5, "doc_id")).collect())
    monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
    rows = packing.pack(docs.repartition(5, "doc_id")).collect()
    _check_pieces(rows, TEXTS)
    assert sorted((r.doc_id, r.start, r.length, r.sequence_id) for r in rows) == want
