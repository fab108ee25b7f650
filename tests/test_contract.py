"""Every registered query of the core engine against its oracle, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from corvane.plans import catalog

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def _rows(rows):
    value = lambda v: round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(map(value, r)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    found = catalog.QUERIES[name](spark, D)
    columns = sorted(found.columns)
    rows = found.select(*[f"`{c}`" for c in columns]).collect()
    if name in catalog.ORACLES:
        want = db.execute(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES[name]})").fetchall()
        assert _rows(map(tuple, rows)) == _rows(want)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_only_a_missing_part_is_tolerated(monkeypatch):
    import __spark_entry__ as e

    def missing(name):
        def load(asked):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

        return load

    for name in ("corvane.llm", "corpus_pipeline"):
        monkeypatch.setattr(e, "import_module", missing(name))
        assert e._optional("corvane.llm.catalog") is None
    monkeypatch.setattr(e, "import_module", missing("xxhash"))
    with pytest.raises(ModuleNotFoundError):
        e._optional("corvane.llm.catalog")


def test_core_alone(tmp_path):
    """Without the optional part the entry imports and has the core's queries."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    shutil.copytree(root / "corvane", tmp_path / "corvane", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pair_agreement' in q and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in q); print(len(q), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr
    n, with_sql = map(int, out.stdout.split())
    assert n == with_sql == len(catalog.QUERIES)
