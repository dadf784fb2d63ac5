"""The driver's contract, and that the library stands without the text subpackage."""

import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).parents[1]


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_without_the_text_subpackage(tmp_path):
    import shutil

    for name in ("gridloom", "__spark_entry__.py"):
        source = ROOT / name
        shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__")) if source.is_dir() else shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, check=True)
    a, b = map(int, said.stdout.split())
    assert a == b >= 27
