"""The driver's contract without what is optional."""

import subprocess
import sys

import pytest

HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r} or name.startswith({name!r} + "."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as e
from covaria.plans.catalogue import QUERIES
assert set(e.queries()) >= set(QUERIES) and len(QUERIES) > 100, len(e.queries())
assert not any(n.startswith("op1") for n in e.queries()) and "pipeline" not in e.queries()
assert set(e.oracle_sql()) <= set(e.queries())
"""


@pytest.mark.parametrize("name", ["covaria.llm", "regex", "xxhash"])
def test_other_queries_stay_without_the_subpackage_or_its_needs(name):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
