"""The entry file without the training-data operators."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_everything_else_imports_without_them(tmp_path):
    shutil.copytree(f"{REPO}/feedloom", tmp_path / "feedloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n.startswith('op') for n in q))"
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    n, of_them = map(int, out.stdout.split())
    assert n > 40 and of_them == 0, out.stderr


def test_an_import_error_inside_them_is_not_swallowed(tmp_path):
    shutil.copytree(f"{REPO}/feedloom", tmp_path / "feedloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "feedloom" / "llm").mkdir()
    (tmp_path / "feedloom" / "llm" / "__init__.py").write_text("")
    (tmp_path / "feedloom" / "llm" / "registry.py").write_text("import no_such_module")
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    env = {**os.environ, "PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode and "no_such_module" in out.stderr
