"""The driver's entry module with and without the optional subpackage."""
import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(k.startswith('op') for k in e.queries()))"


def _counts(folder):
    said = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True)
    n, oracles, llm = said.stdout.split()[-3:]
    return int(n), int(oracles), llm == "True"


def test_core_queries_remain_without_the_optional_folders(tmp_path):
    kept = tmp_path / "repo"
    shutil.copytree(ROOT, kept, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    n, oracles, llm = _counts(kept)
    assert n >= 38 and oracles >= 36 and not llm
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), kept)
    if os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        shutil.copy(os.path.join(ROOT, "corpus_pipeline.py"), kept)
        assert _counts(kept) == (n, oracles, False)
