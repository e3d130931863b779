"""The entry file with and without what the operators on training text need."""

import subprocess
import sys
from pathlib import Path

import pytest

from registry import oracles
from registry.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent
COUNT = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), "pipeline" in entry.queries())
"""


@pytest.mark.parametrize("blocked", [["xxhash"], ["lakeassay.llm"], ["corpus_pipeline"], ["regex", "xxhash", "tiktoken"]])
def test_core_queries_do_not_need_the_text_operators(blocked):
    done = subprocess.run([sys.executable, "-c", COUNT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == [str(len(QUERIES)), str(len(oracles.oracle_sql())), "False"]
    assert "without the operators on training text" in done.stderr
