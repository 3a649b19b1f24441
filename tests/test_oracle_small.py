"""The core queries against their DuckDB twins at sf0.001 (the driver runs sf0.01).

The optional subpackage's queries are tested in ``tests/llm``."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import frame_rows  # noqa: E402

from fleetlake.plans import oracle, registry  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), oracle.oracle_sql()
FAST = [k for k in QUERIES if not k.startswith(("upsert_", "stream_")) and k not in (
    "gold_roundtrip", "hour_overwrite", "flatten_positions", "silver_roundtrip", "hour_partition",
    "silver_job_late_documents", "target_job_roundtrip")]
SLOW = ["flatten_positions", "silver_job_late_documents", "target_job_roundtrip", "upsert_linhas_abaixo_meta",
        "hour_overwrite", "stream_hourly_recompute", "stream_hourly_watermark", "stream_pipeline"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "part", "pages"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", FAST + SLOW)
def test_query_matches_oracle(spark, con, key):
    got = QUERIES[key](spark, SF).toPandas()
    want = con.sql(SQL[key]).df()
    gc, gr = frame_rows(got)
    wc, wr = frame_rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 868
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_core_stands_without_the_optional_folder(tmp_path):
    """A copy without fleetlake/llm still registers every core query (the pipeline needs the folder and goes with it)."""
    import shutil
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(root, name)):
            shutil.copy(os.path.join(root, name), tmp_path)
    shutil.copytree(os.path.join(root, "fleetlake"), tmp_path / "fleetlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as E; print(*E.queries()); assert set(E.queries()) == set(E.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert set(out.stdout.split()) == set(QUERIES)
