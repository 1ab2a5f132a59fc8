"""The driver's file: every SQL has its query, and the rest stands without the llm package."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_every_sql_belongs_to_a_query():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_rest_imports_without_llm(tmp_path):
    import shutil

    shutil.copytree(ROOT / "marlstone", tmp_path / "marlstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'p1_found' in q and not any(k.startswith(('p6', 'p7', 'p8', 'p9')) for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
