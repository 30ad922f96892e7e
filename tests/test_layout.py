import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    shutil.rmtree(copy / "obsflow" / "llm", ignore_errors=True)
    shutil.rmtree(copy / "tests" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and set(e.oracle_sql()) <= set(q); assert not any(k.startswith('op') or k == 'pipeline' for k in q)"
    for keep in (True, False):
        if not keep:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=os.environ | {"PYTHONPATH": str(copy)})
