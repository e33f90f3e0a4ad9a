"""The entry module with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

from trolley.catalog import REGISTRY

ROOT = Path(__file__).resolve().parent.parent


def test_queries_without_the_operators(tmp_path):
    """What is left after both folders and the pipeline are gone, or the folders alone, still lists every other query."""
    shutil.copytree(ROOT / "trolley", tmp_path / "trolley", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    pipeline = ROOT / "corpus_pipeline.py"
    for name in ("none", pipeline.name):
        if name == pipeline.name and pipeline.exists():
            shutil.copy(pipeline, tmp_path)
        found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
        assert found.stdout.split() == [str(len(REGISTRY)), str(sum(e.sql is not None for e in REGISTRY.values()))]
