"""The driver's entry, with and without its optional parts."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from loomvec.plans.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCK = """
import sys
sys.path.insert(0, {root!r})
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("names", [("loomvec.llm",), ("regex",), ("loomvec.llm", "corpus_pipeline")])
def test_core_queries_do_without_what_is_optional(names):
    code = BLOCK.format(root=ROOT, names=names)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True)
    if os.path.isdir(f"{ROOT}/loomvec/llm") or names[0] == "loomvec.llm":
        assert done.stdout.split() == [str(len(QUERIES))] * 2
    assert ("left out" in done.stderr) == (names == ("regex",) and os.path.isdir(f"{ROOT}/loomvec/llm"))
