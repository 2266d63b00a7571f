"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF0001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_CPUS="2",
               BENCH_QUERIES="topk_price,describe,sample_exact")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert res.returncode == 0 and len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == 0.001 and "errors" not in out
    assert set(out["queries"]) == {"topk_price", "describe", "sample_exact"}
    assert out["value"] == round(sum(out["queries"].values()), 3)


def test_queries_run_from_another_directory(tmp_path):
    """Loaded by file path from elsewhere (as a harness does), the Python
    workers still import the package: it is shipped with addPyFile."""
    script = tmp_path / "run.py"
    script.write_text(
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('e', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').getOrCreate()\n"
        "q = E.queries()\n"
        f"print('rows', q['mlp_predict'](spark, {SF0001!r}).count(),"
        f" q['ols_pvalues'](spark, {SF0001!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "rows" in res.stdout
