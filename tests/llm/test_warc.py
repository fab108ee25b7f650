import io

from corvane.llm import warc

PAGES = [
    (5, "http://a/", "same", 1),
    (2, "http://b/ x\r\ny", "same", 1),
    (9, None, "same", 1),
    (1, "http://c/", None, 1),
    (3, "http://d/", "", 1),
    (7, "http://e/", "é" * 200_000, 1),
    (2, "http://b/", "same", 1),
    (8, "http://f/", "WARC/1.1\r\nnot a record\r\n\r\n", 1),
    (None, "http://g/", "same", 1),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, path int").repartition(3)
    m = warc.write(pages, f"file://{tmp_path}/w")
    rows = warc.read(m).collect()
    assert all(r.kind == "record" for r in rows) and len(rows) == len(PAGES)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in rows), key=str)
    want = []
    for p, _, html, _ in PAGES:
        raw = (html or "").encode()
        first = min(q for q, _, h, _ in PAGES if (h or "") == (html or "") and q is not None)
        want.append((p, "response" if p == first else "revisit", None if p == first else first, len(raw), warc.sha1_base32(raw)))
    assert got == sorted(want, key=str)
    assert {bytes(r.payload) for r in rows if r.record_type == "response"} == {(h or "").encode() for _, _, h, _ in PAGES}


def test_min_bytes(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:5], "page_id long, url string, html string, path int")
    rows = warc.read(warc.write(pages, f"file://{tmp_path}/m", min_bytes=5)).collect()
    assert {r.record_type for r in rows} == {"response"}


def test_empty(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(pages, f"file://{tmp_path}/e")).count() == 0


def _members():
    raws = [f"payload {i}".encode() * 50 for i in range(4)]
    return [warc.member(warc.record(i, "u", r, warc.sha1_base32(r))) for i, r in enumerate(raws)]


def test_salvage_gzip():
    m = _members()
    broken = bytearray(m[1])
    broken[len(broken) // 2] ^= 0xFF
    data = b"junk" + m[0] + bytes(broken) + m[2] + m[3][:-20]
    out = list(warc.salvage(io.BytesIO(data)))
    assert [x[1]["x-page-id"] for x in out if x[0] == "record"] == ["0", "2"]
    gaps = [(a, b) for k, a, b, *_ in out if k == "gap"]
    one = 4 + len(m[0])
    assert gaps == [(0, 4), (one, one + len(m[1])), (one + len(m[1]) + len(m[2]), len(data))]


def test_salvage_plain():
    raw = b"body"
    r = [warc.record(i, "u", raw, warc.sha1_base32(raw)) for i in range(3)]
    bad = r[1].replace(b"body\r\n\r\n", b"bodX\r\n\r\n")
    out = list(warc.salvage(io.BytesIO(r[0] + bad + r[2])))
    assert [x[1]["x-page-id"] for x in out if x[0] == "record"] == ["0", "2"]
    assert [x[1:3] for x in out if x[0] == "gap"] == [(len(r[0]), len(r[0] + bad))]


def test_long_headers_and_payloads_in_plain_archives():
    """A URL longer than the reader's window, before and after a damaged record."""
    raw = b"body" * 100_000
    url = "http://a/" + "x" * 300_000
    r = [warc.record(i, url, raw, warc.sha1_base32(raw)) for i in range(4)]
    bad = r[1].replace(b"bodybody", b"bodXbody", 1)
    out = list(warc.salvage(io.BytesIO(r[0] + bad + r[2] + r[3])))
    assert [x[1]["x-page-id"] for x in out if x[0] == "record"] == ["0", "2", "3"]
    assert [x[1:3] for x in out if x[0] == "gap"] == [(len(r[0]), len(r[0] + bad))]


def test_revisits_by_shuffle_are_the_same(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, path int").repartition(3)
    want = sorted(map(tuple, warc.plan(pages).collect()), key=str)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, warc.plan(pages).collect()), key=str) == want


def test_a_gap_fails_the_query(spark, monkeypatch, tmp_path):
    import pytest

    pages = spark.createDataFrame(PAGES[:5], "page_id long, url string, html string, path int")
    pages.select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    assert warc.query(spark, str(tmp_path)).count() == 5
    made = warc.write

    def damaged(pages, folder):
        manifest = made(pages, folder)
        for r in manifest.collect():
            with open(r.path.removeprefix("file:"), "r+b") as f:
                f.seek(30)
                f.write(b"\0\0\0\0")
        return manifest

    monkeypatch.setattr(warc, "write", damaged)
    with pytest.raises(Exception, match="can't be read back"):
        warc.query(spark, str(tmp_path)).collect()
