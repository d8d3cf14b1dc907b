"""The entry module where a package that only the training-data operators need is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("missing", ["zstandard", "sparkmart.llm", "corpus_pipeline"])
def test_the_other_queries_stay(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None  # importing it raises ImportError
import __spark_entry__ as entry
from sparkmart.registry import QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
assert "pipeline" not in entry.queries()
"""
    subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, check=True, timeout=120)
