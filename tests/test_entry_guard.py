"""The entry registers every library query even when a text library or the text subpackage cannot be imported."""

import importlib
import subprocess
import sys

import pytest

PROBE = """
import sys, importlib.abc
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if any(name == b or name.startswith(b + '.') for b in {blocked!r}):
            raise ImportError('blocked ' + name)
sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from tillscope.plans.catalog import registered
names = set(e.queries())
assert set(registered()) <= names, 'library queries lost'
print(len(names), sorted(n for n in names if n.startswith('op') or n == 'pipeline'))
"""


@pytest.mark.parametrize("blocked", [("public_tokenizers",), ("xxhash",), ("regex",), ("zstandard",), ("tillscope.llm", "corpus_pipeline")])
def test_library_queries_survive_a_missing_text_module(blocked):
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = PROBE.format(blocked=set(blocked), root=root)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
