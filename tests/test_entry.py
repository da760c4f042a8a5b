"""The entry without the text operators, or without a library that they need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {names}:
            raise {error}(name, name=name)
sys.meta_path.insert(0, Absent())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
assert len(e.queries()) >= 80 and set(e.oracle_sql()) <= set(e.queries())
assert not [q for q in e.queries() if q.startswith("op") or q == "pipeline"]
"""


@pytest.mark.parametrize("names,error", [(["sitelens.llm", "corpus_pipeline"], "ModuleNotFoundError"), (["public_tokenizers"], "ModuleNotFoundError"),
                                         (["xxhash"], "ImportError"), (["sitelens.llm.textops"], "ImportError")])
def test_other_queries_stay(names, error):
    code = BLOCK.format(names=set(names), error=error, root=ROOT)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT)
    assert done.returncode == 0, done.stderr[-2000:]
