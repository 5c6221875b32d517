"""The driver's entry without the optional training-data operators or one of their packages."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

HIDE = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise {error}
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(k.startswith("op") for k in e.queries()))
"""


@pytest.mark.parametrize(
    ("name", "error"),
    [
        ("fareline.llm", "ModuleNotFoundError('gone', name=name)"),
        ("corpus_pipeline", "ModuleNotFoundError('gone', name=name)"),
        ("pyarrow", "ModuleNotFoundError('gone', name=name)"),
        ("fareline.llm", "ImportError('an empty folder is left')"),
    ],
)
def test_core_queries_survive(name, error):
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", HIDE.format(name=name, error=error)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    from fareline.plans.catalog import QUERIES

    assert out.stdout.split() == [str(len(QUERIES))] * 2 + ["False"], out.stderr
