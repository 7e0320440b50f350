"""The entry serves the library's queries where the training-data subpackage is not there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import __spark_entry__ as e, json
from greenledger.plans import queries as q
assert set(e.queries()) == set(q.queries()) and set(e.oracle_sql()) == set(q.oracle_sql()), sorted(e.queries())
print(len(e.queries()))
"""


def copy_without(tmp_path, *names):
    root = tmp_path / "copy"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "__pycache__", *names))
    return subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, capture_output=True, text=True, timeout=120, check=False)


def test_without_the_subpackage(tmp_path):
    for i, names in enumerate((["llm"], ["llm", "corpus_pipeline.py"], ["corpus_pipeline.py"])):
        done = copy_without(tmp_path / str(i), *names)
        assert done.returncode == 0, done.stderr
        assert int(done.stdout) >= 39


def test_another_copy_on_the_path(tmp_path, monkeypatch):
    monkeypatch.setenv("PYTHONPATH", ROOT)
    done = copy_without(tmp_path, "corpus_pipeline.py")
    assert done.returncode == 0, done.stderr


def test_without_a_module_that_only_the_subpackage_needs(tmp_path):
    broken = copy_without(tmp_path)  # complete copy: the training-data queries are there
    assert broken.returncode != 0 and "AssertionError" in broken.stderr
    root = tmp_path / "copy"
    (root / "xxhash.py").write_text("raise ImportError('not installed')")
    (root / "greenledger" / "llm" / "queries.py").write_text("import xxhash\n")
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, capture_output=True, text=True, timeout=120, check=False)
    assert done.returncode == 0, done.stderr
