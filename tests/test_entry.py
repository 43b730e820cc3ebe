"""The entry works where the corpus operators, or a package that they need, are missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
for name in {hidden!r}:
    sys.modules[name] = None
import __spark_entry__ as entry
names = entry.queries()
assert "dbscan_labels" in names and set(entry.oracle_sql()) <= set(names)
assert not [n for n in names if n.startswith("op") or n == "pipeline"], "corpus operators are there"
"""


@pytest.mark.parametrize("hidden", [("zstandard",), ("tokenizers",), ("cohorta.llm",)])
def test_entry_without(hidden):
    if "cohorta.llm" not in hidden:
        pytest.importorskip("cohorta.llm", reason="not installed here, so nothing can be hidden from it")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", CODE.format(hidden=hidden)], capture_output=True, text=True,
                          cwd=ROOT)
    assert done.returncode == 0, done.stderr
