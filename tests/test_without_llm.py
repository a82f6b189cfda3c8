"""The library works without the llm subpackage and corpus_pipeline.py."""

import os
import shutil
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_llm_folders():
    copy = os.path.join(tempfile.mkdtemp(prefix="gridpulse-no-llm-"), "repo")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'metric_daily' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": copy}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry_imports_without_the_llm_libraries():
    for name in ("xxhash", "public_tokenizers", "zstandard"):
        code = f"import sys; sys.modules['{name}'] = None\nimport __spark_entry__ as e; assert 'metric_daily' in e.queries() and 'pipeline' not in e.queries()"
        done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr


def test_nothing_outside_imports_llm():
    for folder, _, files in os.walk(os.path.join(ROOT, "gridpulse")):
        if os.sep + "llm" in folder:
            continue
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as text:
                    assert "gridpulse.llm" not in text.read()
