"""Plans are what we would want: pruned scans, equi-joins only, no Python where none is needed."""

import pytest

from parcelwright.plans.registry import QUERIES
from parcelwright.sinks import files
from parcelwright.sources import tables

PYTHON = {"q_traced"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_joins_are_equi_joins(spark, data, name):
    plan = plan_of(QUERIES[name](spark, data))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["q_match_nearest"])
def test_sides_without_a_bound_are_not_broadcast(spark, data, name):
    assert "Broadcast" not in plan_of(QUERIES[name](spark, data))


@pytest.mark.parametrize("name", ["q_final_summary", "q_output_union", "q_match_cascade", "q_observations", "q_orphan_polygons"])
def test_roles_and_parcels_are_not_broadcast(spark, data, name):
    assert "Broadcast" not in plan_of(QUERIES[name](spark, data))


def test_commune_is_pushed_to_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "2", "3", 4.0)], "comuna int, manzana string, predio string, value double").write.parquet(str(tmp_path / "h"))
    plan = plan_of(tables.historic_parquet(spark, str(tmp_path / "h"), 1))
    assert "EqualTo(comuna,1)" in plan and "value" not in plan.split("ReadSchema")[1]


def test_staged_tables_last_as_long_as_their_scope(spark):
    from parcelwright.plans import staging

    outer = staging.stage(spark.range(3), "outer")
    with staging.scope():
        inner = staging.stage(spark.range(5), "inner")
        assert inner.count() == 5
    assert outer.count() == 3 and not files.exists(spark, inner._staged_path)
    staging.release(outer)
    assert not files.exists(spark, outer._staged_path)


def test_no_folder_of_its_own_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from parcelwright.plans import staging

    absent = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        staging.shared_dir(absent)


def test_queries_without_the_llm_folder(tmp_path):
    """The entry imports, and the other queries are there, when llm and its pipeline are gone or a module they need is."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    for missing in ("llm", "zstandard"):
        copy = tmp_path / missing
        shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *(["llm", "corpus_pipeline.py"] if missing == "llm" else [])))
        code = "import sys; sys.modules['zstandard'] = None if len(sys.argv) > 1 else sys.modules.get('zstandard'); import __spark_entry__ as e; print(len(e.queries()), [q for q in e.queries() if q[:2] == 'op'])"
        out = subprocess.run([sys.executable, "-c", code, *(["x"] if missing == "zstandard" else [])], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)}, capture_output=True, text=True)
        assert out.stdout.strip().endswith("[]") and int(out.stdout.split()[0]) >= 60, out.stderr[-500:]
