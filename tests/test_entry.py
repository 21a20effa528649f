"""The driver contract: entry runs, every query has an oracle, names line up."""

import os

import __spark_entry__ as E
from sensorqc.plans import registry


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "metric_value" in df.columns and "status" in df.columns


def test_every_query_has_oracle_sql():
    """All of the library's own; the training-data operators say for themselves which SQL cannot express."""
    q, sql = E.queries(), E.oracle_sql()
    assert set(registry.queries()) <= set(sql) <= set(q)


def test_queries_run_on_smallest_fixture(spark):
    for name, fn in registry.queries().items():
        df = fn(spark, "/root/testdata/sf0.001")
        assert df.schema.fields and df.limit(1).count() == 1, name


def test_entry_works_without_the_training_data_operators(tmp_path):
    """In a copy of the repository without them, the entry imports and registers the rest."""
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in ("__spark_entry__.py", "oracle_queries.py"):
        shutil.copy(f"{root}/{name}", tmp_path)
    shutil.copytree(f"{root}/sensorqc", tmp_path / "sensorqc", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    assert out.split() == [str(len(registry.queries()))] * 2


def test_workers_get_the_package_from_the_session(spark, tmp_path):
    """Started from another folder, workers still import it."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(E.__file__))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "import __spark_entry__ as e\n"
            "from sensorqc.session import local_session\n"
            "s = local_session(cores=2, shuffle_partitions=2, extra={'spark.driver.memory': '1g'})\n"
            "print('rows', e.queries()['arrival_window'](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "rows 1000" in out.stdout, out.stderr[-2000:]
