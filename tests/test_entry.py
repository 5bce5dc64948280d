"""The entry without its optional part."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__  # noqa: F401  registers the queries
from kpiloom.catalog.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_the_corpus_operators(tmp_path):
    """A copy without the two folders imports and registers every other query."""
    shutil.copytree(ROOT / "kpiloom", tmp_path / "kpiloom", ignore=lambda d, names: [n for n in names if n in ("llm", "__pycache__")])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), e.__file__)"
    # Nothing of the environment leads back to the whole library.
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env={"PYTHONPATH": "", "PATH": "/usr/bin"}, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), str(tmp_path / "__spark_entry__.py")]
