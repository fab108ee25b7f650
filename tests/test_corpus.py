"""Scans, identifiers, agreement, cadence and ingestion on a small corpus of JSON files."""

import json

import pytest
from pyspark.sql import functions as F

from corvane.operators import agreement, cadence, identifiers, match, metrics
from corvane.sources import connectors, corpus
from corvane.streaming import ingest


def observation(i, business, date, **more):
    return {"check_id": i, "date_utc": date, "business": business, "engine": "gemini", "run_channel": "api", "run_status": "OK", "business_mentioned": None, "competitors_mentioned": [], "sources_cited": [], "answer_verbatim": ""} | more


ROWS = [
    observation("A_1", "Acme", "2026-08-05", business_mentioned=True, sources_cited=["a", "b"]),
    observation("A_2", "Acme", "2026-08-06", run_status="QUOTA_BLOCKED", session_note="error detail: QUOTA: gemini HTTP 429: x"),
    observation("B_1", "Bolt", "2026-08-05", sources_cited=["a"]),
    observation("B_1_r10", "Bolt", "2026-08-05", sources_cited=["a"]),
    observation("B_1_r2", "Bolt", "2026-08-05", sources_cited=["c"]),
    observation("C_1", "Cog", "2026-08-07"),
    observation("D_1", "Dot", "2026-08-01", competitors_mentioned=["x"]),
    observation("D_2", "Dot", "2026-08-02", competitors_mentioned=["y"], serp_diagnostics={"html_bytes": 5, "extraction_ok": False}),
    observation("E_1", "Elk", "2026-08-01", sources_cited=list("abc")),
    observation("E_2", "Elk", "2026-08-02", sources_cited=list("def")),
    observation("Z_1", "", "2026-08-01"),
    observation("Z_2", None, "2026-08-01"),
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("corpus")
    for r in ROWS:
        (d / f"{r['check_id']}.json").write_text(json.dumps(r, indent=1))
    (d / "bad.json").write_text('{"check_id": ')
    (d / "skip.txt").write_text("no")
    return str(d)


def test_scan(spark, folder, tmp_path):
    rows, corrupt = corpus.scan(spark, folder)
    got = rows.collect()
    assert len(got) == 10 and all(r.file_name == f"{r.check_id}.json" for r in got)
    assert [r.file_name for r in corrupt.collect()] == ["bad.json"]
    corpus.compact(rows, f"{tmp_path}/p")
    corpus.compact(rows, f"{tmp_path}/p")
    assert corpus.scan_compact(spark, f"{tmp_path}/p").count() == 20
    corpus.write_json(rows, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 10


def test_cadence(spark, folder):
    rows, _ = corpus.scan(spark, folder)
    got = {r.business: r for r in cadence.plan(rows).collect()}
    assert {b: r.cadence for b, r in got.items()} == {"Acme": "hot", "Bolt": "warm", "Cog": "warm", "Dot": "hot", "Elk": "hot"}
    assert got["Acme"].signals == ["LOST THE NAMING: engine named this business before and does not now", "SOURCES DROPPED (2): a, b"]
    assert got["Bolt"].signals == ["SOURCES DROPPED (1): a", "NEW SOURCES (1): c"]  # r10 sorts before r2
    assert got["Cog"].compared is None and got["Cog"].reason.startswith("only 1 dated")
    assert got["Dot"].signals == ["NEW COMPETITOR NAMED: y", "COMPETITOR DROPPED OUT: x"]
    assert got["Elk"].reason == "large source churn (6) suggests the answer is being rebuilt"
    strict = {r.business: r.cadence for r in cadence.plan(rows, strict=True).collect()}
    assert strict["Acme"] == "warm"


def test_rates_and_taxonomy(spark, folder):
    rows, _ = corpus.scan(spark, folder)
    r = {x.business: x for x in metrics.rate(rows, ["business"]).collect()}["Acme"]
    assert (r.n_rows, r.n_ok, r.rate_pct, r.naive_pct) == (2, 1, 100.0, 50.0)
    assert [tuple(x) for x in metrics.failure_taxonomy(rows).collect()] == [("QUOTA_BLOCKED", "gemini", 429, 1)]


ANSWERS = [("Acme", 1, "gemini", "OK", "We like Port Avon Painters, then Harrow Painting LLC a lot", True), ("Acme", 2, "openai", "OK", "ask Harrow Painting or Blue Mill Co today", None), ("Acme", 3, "gemini", "OK", "nothing here", False), ("Acme", 4, "anthropic", "FAILED", "x", None), ("Acme", 5, "anthropic", "OK", "", None)]


def test_agreement(spark):
    rows = spark.createDataFrame([(*a, []) for a in ANSWERS], "business string, ord int, engine string, run_status string, answer_verbatim string, business_mentioned boolean, sources_cited array<string>")
    got = {(r.order_a, r.order_b): r for r in agreement.pair_agreement(rows, ["business"], "ord").collect()}
    assert set(got) == {(1, 2), (2, 3)}
    p = got[1, 2]
    assert (p.terser_engine, p.containment_pct, p.shared_count, p.naming_disagreement) == ("gemini", 50.0, 1, True)
    q = got[2, 3]
    assert (q.terser_engine, q.containment_pct, q.terser_entity_count, q.zero_shared, q.extraction_suspect) == ("gemini", None, 0, False, False)
    met = agreement.pairs(rows, ["business"], "ord")
    met.collect()
    assert "ReusedExchange" in met._jdf.queryExecution().executedPlan().toString()  # names are extracted once
    row = agreement.agreement_rows(rows, ["business"], "ord").first()
    assert row.engines_compared == ["gemini", "openai"] and row.engines_usable == 3 and len(row.pairs) == 2 and row.pairs[0].shared_count == 1
    alone = agreement.agreement_rows(rows.filter("ord = 1"), ["business"], "ord").first()
    assert alone.pairs == []


# two lists of names -> shared, only in the first, only in the second
OVERLAP = [
    ([], [], [], [], []),
    (["Harrow Painting"], ["Harrow Painting LLC", "Orlo"], ["Harrow Painting"], [], ["Orlo"]),
    (["Orlo", "Orlo"], ["ORLO Inc"], ["Orlo"], [], []),  # the repeated name counts as shared too
    (["Inc", "The Co"], ["Ltd"], [], [], []),  # nothing identifies these
    (["Orchard", "Orchard Supply"], ["Orchard Supply", "Orchard"], ["Orchard", "Orchard Supply"], [], []),
    (["Old Mill Works", "Mill"], ["Mill Works", "Quay"], ["Old Mill Works"], ["Mill"], ["Quay"]),
    (["Brindle"], ["Big Brindle", "Brindle"], ["Brindle"], [], ["Brindle"]),  # the first that fits is taken
    ([], ["Quay", "Co"], [], [], ["Quay"]),
]


def test_overlap(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(OVERLAP)], "i long, a array<string>, b array<string>")
    got = {r.i: tuple(r.o) for r in df.select("i", match.overlap(F.col("a"), F.col("b")).alias("o")).collect()}
    assert got == {i: tuple(want) for i, (_, _, *want) in enumerate(OVERLAP)}


def test_entity_join(spark):
    from test_text import NAMES

    left, right = (spark.createDataFrame([(n,) for n in [*NAMES, NAMES[3], None]], f"{c} string") for c in "ab")
    got = sorted(map(tuple, match.entity_join(left, right, "a", "b", ["a"], ["b"]).collect()))
    every = left.crossJoin(right).filter(match.same_entity(F.col("a"), F.col("b")))
    assert got == sorted(map(tuple, every.collect())) and len(got) > len(NAMES)
    plan = match.entity_join(left, right, "a", "b", ["a"], ["b"])._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_entity_join_meets_on_rare_words(spark, monkeypatch):
    """Names that all begin with one word don't all become candidates."""
    left = spark.range(2000).selectExpr("concat('Harrow ', id, ' Painting') as a")
    right = spark.range(2000).selectExpr("concat('The Harrow ', id, ' Painting LLC') as b")
    seen, compare = [], match.same_canonical
    monkeypatch.setattr(match, "same_canonical", lambda x, y: seen.append(1) or F.lit(True))
    assert match.entity_join(left, right, "a", "b", ["a"], ["b"]).count() == 2000 and seen
    monkeypatch.setattr(match, "same_canonical", compare)
    assert match.entity_join(left, right, "a", "b", ["a"], ["b"]).count() == 2000


def test_assign_ids(spark):
    existing = spark.createDataFrame([("X",), ("X_r3",), ("Y_r2",)], "check_id string")
    new = spark.createDataFrame([("X", 1), ("X", 2), ("X", 3), ("Y", 1), ("Z", 1), ("Z", 2)], "base string, at int")
    got = {(r.base, r["at"]): r.check_id for r in identifiers.assign_ids(new, existing, "base", ["at"]).collect()}
    assert got == {("X", 1): "X_r2", ("X", 2): "X_r4", ("X", 3): "X_r5", ("Y", 1): "Y", ("Z", 1): "Z", ("Z", 2): "Z_r2"}


def test_assign_ids_against_one_by_one(spark):
    import random

    rnd = random.Random(4)
    taken = {b: set(rnd.sample(range(1, 30), rnd.randrange(20))) for b in "PQRS"}
    new = [(b, i) for b in "PQRST" for i in range(rnd.randrange(1, 40))]
    existing = spark.createDataFrame([(b if n == 1 else f"{b}_r{n}",) for b, t in taken.items() for n in t] * 2, "check_id string")
    rows = spark.createDataFrame(new, "base string, at int").repartition(3)
    want = {}
    for b, i in new:
        used = taken.setdefault(b, set())
        n = next(k for k in range(1, 1000) if k not in used)
        used.add(n)
        want[b, i] = (n, b if n == 1 else f"{b}_r{n}")
    got = identifiers.assign_ids(rows, existing, "base", ["at"]).collect()
    assert {(r.base, r["at"]): (r.run, r.check_id) for r in got} == want and len(got) == len(new)
    pages = identifiers.guard_ids(rows, existing, "base", ["at"]).collect()
    assert {(r.base, r["at"]): (r.run, r.check_id) for r in pages} == {k: (1, i) for k, (_, i) in want.items()}


def test_rotation_is_a_permutation(spark):
    for n in (1, 2, 7):
        df = identifiers.rotate(spark.range(n), ["id"], F.lit("2026-08-05"))
        turn = sum(map(ord, "2026-08-05")) % n
        assert {r.id: r.position for r in df.collect()} == {(turn + i) % n: i for i in range(n)}


def test_statuses(spark):
    df = spark.createDataFrame([(True, None, ["u"]), (False, "QUOTA: x", []), (False, "boom", None), (True, "", [])], "ok boolean, e string, o array<string>")
    got = df.select(identifiers.call_status(F.col("ok"), F.col("e")).alias("c"), identifiers.page_status(F.col("ok"), F.col("o")).alias("p")).collect()
    assert [tuple(r) for r in got] == [("OK", "OK"), ("QUOTA_BLOCKED", "FAILED"), ("FAILED", "FAILED"), ("OK", "EXTRACTION_FAILED")]


def test_documents_of_lines(spark, tmp_path):
    (tmp_path / "roster.json").write_text(json.dumps({"roster": [{"business": "A", "active": True}, {"business": "B", "active": None}, {"business": "C"}]}))
    assert [r.business for r in corpus.roster(spark, f"{tmp_path}/roster.json").collect()] == ["A"]
    (tmp_path / "index.json").write_text(json.dumps({"rows": [{"check_id": f"NB-CZ-000{i}"} for i in range(1, 6)] + [{"check_id": "NB-CZ-FIX-1"}]}))
    assert identifiers.next_index_id(corpus.index_rows(spark, f"{tmp_path}/index.json")).first().next_id == "NB-CZ-0006"
    jobs = tmp_path / "jobs"
    jobs.mkdir()
    (jobs / "a.md").write_text("WORKER_FAILED: HTTP Error 429: Too Many")
    (jobs / "b.md").write_text("fine\ntext")
    got = corpus.worker_outputs(spark, str(jobs)).collect()
    assert {r.file_name: (r.failed, r.http_code) for r in got} == {"a.md": (True, 429), "b.md": (False, None)} and len(got) == 2
    (tmp_path / "beat.log").write_text("2026-08-03T13:00Z alive\n\nno date\n2026-08-24 alive\n")
    beats = corpus.heartbeat(spark, f"{tmp_path}/beat.log")
    assert beats.count() == 2 and metrics.date_gaps(beats, "at", 7).first().gap_days == 21


def test_connectors(spark):
    ok = json.dumps({"choices": [{"message": {"content": "hi"}}], "citations": ["u"]})
    assert connectors.parse("perplexity", 200, ok) == (True, "hi", ["u"], "")
    assert connectors.parse("openai", 200, ok)[2] == []
    assert connectors.parse("gemini", 429, "x" * 400)[3] == "QUOTA: gemini HTTP 429: " + "x" * 300
    assert not connectors.parse("anthropic", 200, "[]")[0] and not connectors.parse("gemini", 200, "{")[0]
    calls = iter([(200, "short"), (200, "y" * 2000)])
    assert connectors.fetch_page("q", lambda e, p: next(calls)) == (True, "y" * 2000, "")
    assert connectors.fetch_page("q", lambda e, p: (500, "no"))[0] is False
    df = spark.createDataFrame([("perplexity", "q"), ("nobody", "q")], "engine string, prompt_text string")

    def transport(engine, prompt):
        return 200, '{"choices": [{"message": {"content": "hi"}}]}'

    got = {r.engine: (r.ok, r.answer, r.error) for r in connectors.collect(df, transport).collect()}
    assert got == {"perplexity": (True, "hi", ""), "nobody": (False, "", "nobody unknown engine")}


def test_ingest(spark, folder, tmp_path):
    out, mark = f"{tmp_path}/out", f"{tmp_path}/mark"
    ingest.ingest(spark, folder, out, mark)
    ingest.ingest(spark, folder, out, mark)
    assert spark.read.parquet(out).filter("check_id is not null").count() == 10
    late = spark.createDataFrame([("N", "2020-01-01", "N"), ("M", "2030-01-01", "M"), ("A_1", "2030-01-01", "A")], "check_id string, date_utc string, business string")
    assert [r.check_id for r in ingest.append_batch(late, out).collect()] == ["N"]
    assert ingest.cadence_now(spark, out).filter("business = 'Elk'").first().cadence == "hot"


def test_late_rows_are_kept_apart(spark, tmp_path):
    day = lambda i, d: json.dumps(observation(i, "Acme", d))
    src, out, late = tmp_path / "src", f"{tmp_path}/out", f"{tmp_path}/late"
    src.mkdir()
    (src / "a.json").write_text(day("A_1", "2026-08-05"))
    ingest.ingest(spark, str(src), out, f"{tmp_path}/mark", late_path=late)
    (src / "b.json").write_text(day("A_0", "2026-08-01"))
    (src / "c.json").write_text(day("A_2", "2026-08-06"))
    (src / "d.json").write_text(day("A_1", "2026-08-05"))
    ingest.ingest(spark, str(src), out, f"{tmp_path}/mark", late_path=late)
    ids = lambda p: sorted(r.check_id for r in ingest.stored(spark, p).collect())
    assert ids(out) == ["A_1", "A_2"] and ids(late) == ["A_0"]
    ingest.ingest(spark, str(src), out, f"{tmp_path}/other", late_path=late)  # all files again
    assert ids(out) == ["A_1", "A_2"] and "A_0" in ids(late)


def test_windowed_counts(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src.write.parquet(f"{tmp_path}/in")
    q = ingest.windowed_counts(spark.readStream.schema(src.schema).parquet(f"{tmp_path}/in"), "1 day").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from counted").first()[0] == src.count()


def test_rank_to_citation(spark):
    pages = spark.createDataFrame([("q", ["https://www.harrow-painting.com/", "https://other.org/"])], "business string, organic_top_results array<string>")
    answers = spark.createDataFrame([("q", ["Harrow Painting"]), ("q", ["Harrow Painting", "x"]), ("q", ["Harrow Painting"]), ("q", ["Nobody"]), ("z", ["Other"])], "business string, names array<string>")
    got = {r["rank"]: r.n_answers for r in metrics.rank_to_citation(pages, answers, ["business"]).collect()}
    assert got == {1: 3, 2: 0}


def test_flip_rate(spark):
    rows = spark.createDataFrame([("a", 1, True, "x"), ("a", 2, None, "x"), ("a", 3, False, "y"), ("a", 4, True, "y")], "k string, run int, business_mentioned boolean, answer_verbatim string")
    assert tuple(metrics.flip_rate(rows, ["k"], ["run"]).first()) == (1, 1, 1)
