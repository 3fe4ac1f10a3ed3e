import ast
import os
import pathlib
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_llm_folders(tmp_path):
    code = f"""
import sys, importlib.abc
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name == 'corpus_pipeline' or name.startswith('lanemesh.llm'):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone()); sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
assert e.queries() and not any(n.startswith('op') or n == 'pipeline' for n in e.queries() if n[2:3].isdigit())
"""
    subprocess.run([sys.executable, "-c", code], check=True)


def test_nothing_else_imports_llm():
    for f in (ROOT / "lanemesh").rglob("*.py"):
        if "llm" not in f.relative_to(ROOT).parts:
            for node in ast.walk(ast.parse(f.read_text())):
                if isinstance(node, (ast.Import, ast.ImportFrom)):
                    assert "llm" not in ast.dump(node), f


def test_the_rest_works_in_a_copy_without_the_llm_folders(tmp_path):
    gone = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=gone)
    run = [sys.executable, "-m", "pytest", "-q", "tests/test_hull.py", "tests/test_queries.py", "-k", "hull or county or chains_sorted", "-p", "no:cacheprovider"]
    subprocess.run(run, check=True, cwd=tmp_path / "copy", env=os.environ | {"PYTHONPATH": str(tmp_path / "copy")})
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and set(e.oracle_sql()) <= set(e.queries()); import lanemesh; assert 'copy' in lanemesh.__file__"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path / "copy", env=os.environ | {"PYTHONPATH": str(tmp_path / "copy")})
