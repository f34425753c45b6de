"""The driver's contract holds with and without the optional subpackage and its pipeline."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def registered(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(set(e.oracle_sql()) - set(e.queries())))"
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    names, stray = run.stdout.split("\n")[:2]
    assert stray == ""
    return set(names.split())


def test_without_the_optional_parts(tmp_path):
    bare = tmp_path / "bare"
    for name in ("footfall", "checks"):
        shutil.copytree(os.path.join(ROOT, name), bare / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), bare)
    without = registered(bare)
    assert "traffic_5m" in without and not any(n.startswith("op") or n == "pipeline" for n in without)
    assert registered(ROOT) >= without
