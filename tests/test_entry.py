"""The entry module holds the base's queries whatever else is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CHECK = """
import sys, warnings
warnings.simplefilter("ignore")
sys.modules[{name!r}] = None
import __spark_entry__ as entry
from heldout.plans import ORACLE_SQL, QUERIES
assert set(entry.queries()) == set(QUERIES), sorted(entry.queries())
assert set(entry.oracle_sql()) == set(ORACLE_SQL)
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "tokenizers", "regex", "xxhash", "sentencepiece", "tiktoken", "heldout.llm", "heldout.llm.queries"])
def test_a_missing_library_costs_the_document_queries_only(name):
    run = subprocess.run([sys.executable, "-c", CHECK.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
