"""The contract without what only some of its queries need."""

import subprocess
import sys

import pytest

import __spark_entry__

HIDE = """
import sys, warnings
warnings.simplefilter("ignore")
hidden = {name!r}
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == hidden or name.startswith(hidden + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
from quern.plans.registry import QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()) - len(QUERIES))
"""


@pytest.mark.parametrize("name", __spark_entry__.OPTIONAL)
def test_core_queries_stay(name):
    done = subprocess.run([sys.executable, "-c", HIDE.format(name=name)], capture_output=True, text=True,
                          cwd=__spark_entry__.__file__.rsplit("/", 1)[0])
    assert done.returncode == 0, done.stderr


def test_other_errors_are_raised():
    done = subprocess.run([sys.executable, "-c", HIDE.format(name="numpy")], capture_output=True, text=True,
                          cwd=__spark_entry__.__file__.rsplit("/", 1)[0])
    assert done.returncode != 0
