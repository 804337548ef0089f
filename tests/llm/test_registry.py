"""The queries are registered, and nothing outside needs this subpackage."""

import ast
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[2]


def test_one_query_for_each_operator():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_nothing_else_imports_the_subpackage():
    for path in [*(ROOT / "kpiforge").rglob("*.py"), *(ROOT / "tests").glob("*.py"), ROOT / "bench.py"]:
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, (ast.Import, ast.ImportFrom)) else []
            module = getattr(node, "module", None) or ""
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in [*names, module]), path


def test_absent_subpackage(tmp_path):
    import os
    import shutil
    import subprocess
    import sys
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sum(k.startswith('op') "
                           "and k[2:3].isdigit() for k in e.queries()), len(e.oracle_sql()))"],
                          cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, ops, twins = map(int, said.stdout.split())
    assert n >= 76 and ops == 0 and twins >= 76
