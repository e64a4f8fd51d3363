"""The library without the optional subpackage: a copy without it still imports, registers and collects."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [["tessera/llm", "tests/llm", "corpus_pipeline.py"], ["tessera/llm", "tests/llm"]])
def test_rest_stands_without_the_subpackage(tmp_path, gone):
    def left_out(folder, names):
        here = os.path.relpath(folder, ROOT)
        return [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or os.path.normpath(os.path.join(here, n)) in gone]

    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != ROOT)
    ask = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q, len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", ask], cwd=copy, env=env, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, llm, pipeline, n_sql = said.stdout.split()
    assert int(n) > 150 and int(n_sql) > 100 and (llm, pipeline) == ("False", "False")
    said = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "-p", "no:cacheprovider", "--ignore=tests/test_boundary.py", "tests"],
                          cwd=copy, env=env, capture_output=True, text=True)
    assert said.returncode == 0, said.stdout[-2000:]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "tessera").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tessera.llm" not in path.read_text().replace("``tessera.llm``", "") and "from ..llm" not in path.read_text(), path
