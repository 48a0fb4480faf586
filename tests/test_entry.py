"""The entry module with and without what it may lack."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as entry
from checks.all_queries import QUERIES
names = set(entry.queries())
assert set(QUERIES) <= names and set(entry.oracle_sql()) <= names
print(sorted(names - set(QUERIES)))
"""


@pytest.mark.parametrize("blocked", [["venueflow.llm"], ["venueflow.llm.queries"], ["xxhash"], ["sentencepiece", "xxhash"], ["corpus_pipeline"]])
def test_other_queries_survive_a_failed_import(blocked):
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert "pipeline" not in run.stdout
