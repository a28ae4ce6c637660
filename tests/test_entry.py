"""The entry module without the optional part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("missing", ["tiktoken", "public_tokenizers", "pairloom.llm"])
def test_core_queries_without(missing):
    """A library, or the folder itself, that cannot be imported."""
    code = f"""
import sys, warnings
sys.modules[{missing!r}] = None
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
names = set(entry.queries())
assert "rule_filter" in names and "pipeline" not in names and not [n for n in names if n.startswith("op")], names
assert set(entry.oracle_sql()) <= names
print(len([w for w in said if "left out" in str(w.message)]))
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert run.stdout.strip() == ("0" if missing == "pairloom.llm" else "1")
