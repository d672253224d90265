"""The library without its training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as contract

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q)); assert set(e.oracle_sql()) <= set(q)"


@pytest.mark.parametrize("with_pipeline_file", [True, False])
@pytest.mark.parametrize("left", ["nothing", "compiled files"])
def test_the_rest_loads_without_the_subpackage(tmp_path, with_pipeline_file, left):
    shutil.copy(os.path.join(HERE, "__spark_entry__.py"), tmp_path)
    if with_pipeline_file and os.path.exists(pipeline := os.path.join(HERE, "corpus_pipeline.py")):
        shutil.copy(pipeline, tmp_path)
    shutil.copytree(os.path.join(HERE, "cadenza"), tmp_path / "cadenza", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if left == "compiled files":
        (tmp_path / "cadenza" / "llm" / "__pycache__").mkdir(parents=True)
    env = {**os.environ, "PYTHONPATH": ""}
    found = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env, capture_output=True, text=True, check=True)
    others = [n for n in contract.queries() if not n.startswith("op") and n != "pipeline"]
    assert found.stdout.split() == [str(len(others)), "0"]
