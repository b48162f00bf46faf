"""Every registered query of the engine against its SQL on the smallest driver tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# Results in an order, and what orders them; a minus means downwards.
ORDERED = {
    **dict.fromkeys(["activity_series_60", "activity_series_300", "activity_series_900", "activity_series_3600",
                     "activity_trimmed", "kpi_sparkline"], ["t"]),
    "activity_top": ["-moves", "station_id"], "districts": ["arr"], "history_daily": ["date"],
    "history_profile": ["hour"], "business_rebalance": ["-moves", "station_id"], "business_sinks": ["-net", "station_id"],
    "business_sources": ["net", "station_id"], "top_active": ["-moves", "station_id"],
    "bottom_active": ["moves", "station_id"], "station_search": ["rank", "station_id"],
}
OWN = [name for name in QUERIES if name != "pipeline" and not name.startswith("op")]


def test_every_own_query_has_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORDERED))
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_results_come_in_order(spark, name, threshold):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k, None) for k in keys]
    try:
        for key in keys:
            spark.conf.set(key, threshold)
        found = [tuple(-r[c[1:]] if c[0] == "-" else r[c] for c in ORDERED[name])
                 for r in QUERIES[name](spark, SF_DIR).collect()]
    finally:
        for key, value in zip(keys, before):
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found == sorted(found)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_the_comparison_sees_differences(spark, con):
    df = QUERIES["business_totals"](spark, SF_DIR)
    sql = SQL["business_totals"]
    assert difference(df, con, f"SELECT * REPLACE (to_move + 1 AS to_move) FROM ({sql})")
    assert difference(df, con, f"SELECT * RENAME (to_move AS moved) FROM ({sql})")
    assert difference(df, con, f"SELECT * FROM ({sql}) WHERE false")


ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["dockflow/llm"], ["dockflow/llm", "tests/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_queries_without_the_corpus_package(tmp_path, gone):
    """The rest imports and registers its queries where that package was taken out."""
    copy = tmp_path / "copy"
    skipped = [Path(g).name for g in gone]
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if n in (".git", "__pycache__") or (n in skipped and str(Path(folder, n).relative_to(ROOT)) in gone)])
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert said.returncode == 0, said.stderr
    n_queries, n_sql = map(int, said.stdout.split())
    assert n_sql >= len(OWN) and (n_queries == len(OWN) or gone == ["corpus_pipeline.py"])


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "moves" in df.columns
