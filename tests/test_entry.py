"""The driver's entry module with and without the optional subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(sorted(n.split('_')[0] for n in e.queries()).count('q'), set(e.oracle_sql()) <= set(e.queries()))"


def shown(folder):
    env = {**os.environ, "PYTHONPATH": str(folder)}
    return subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=folder, env=env, capture_output=True, text=True)


@pytest.mark.parametrize("left_out", [("llm", "corpus_pipeline.py"), ("llm",), ("corpus_pipeline.py",)])
def test_main_queries_do_not_need_the_subpackage(tmp_path, left_out):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "fareflow"), copy / "fareflow", ignore=lambda _, names: [n for n in names if n in left_out or n == "__pycache__"])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy / name)
    found = shown(copy)
    assert found.returncode == 0, found.stderr
    assert int(found.stdout.split()[0]) > 100 and found.stdout.split()[1] == "True"


def test_a_fault_inside_the_subpackage_shows(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(os.path.join(ROOT, "fareflow"), copy / "fareflow", ignore=lambda _, names: [n for n in names if n in ("llm", "__pycache__")])
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy / "__spark_entry__.py")
    (copy / "fareflow" / "llm").mkdir()
    (copy / "fareflow" / "llm" / "__init__.py").write_text("")
    (copy / "fareflow" / "llm" / "queries.py").write_text("import surely_not_there\n")
    assert "surely_not_there" in shown(copy).stderr
