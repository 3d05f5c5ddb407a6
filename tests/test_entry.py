"""The driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as entry_mod
from ledgerlens.plans.registry import QUERIES


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ProductName", "ProductCategory", "Years", "Revenue", "COGS", "GrossProfit"]


def test_every_query_has_an_oracle():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(QUERIES) <= set(o) <= set(q)
    assert len(q) >= 57


def test_every_survey_statement_is_registered():
    ids = {name.split("_")[0][1:] + "." + name.split("_")[1] for name in QUERIES}
    expected = {f"{f:02d}.{i}" for f, n in [(1, 8), (2, 8), (3, 7), (4, 5), (5, 6), (6, 5), (7, 10), (8, 8)]
                for i in range(1, n + 1)}
    assert expected <= ids


def test_bench_prints_one_json_line(sf_small):
    import json
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "BENCH_SF_DIR": sf_small, "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py"), "q01_1", "q07_8"],
                         env=env, capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert set(result["queries"]) == {"q01_1_revenue_by_period", "q07_8_pareto_customers"}


def test_entry_without_the_training_data_package(tmp_path):
    """The other queries import and register when the package and the pipeline are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path
    root = Path(entry_mod.__file__).parent
    shutil.copytree(root / "ledgerlens", tmp_path / "ledgerlens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert said.stdout.split() == [str(len(QUERIES))] * 2, said.stderr
