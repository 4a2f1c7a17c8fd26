"""The entry module with and without the optional subpackage."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
BLOCKED = """
import sys

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in {blocked}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Blocked())
from __spark_entry__ import oracle_sql, queries
print(len(queries()), len(oracle_sql()))
"""


def imported(*blocked):
    code = BLOCKED.format(blocked=set(blocked) or "()")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert not done.returncode, done.stderr
    return tuple(map(int, done.stdout.split()))


def test_core_queries_do_not_need_the_optional_subpackage():
    from hourboard.checks.oracle import ORACLE
    from hourboard.checks.queries import REGISTRY

    core = (len(REGISTRY), len(ORACLE))
    assert imported("hourboard.llm") == core
    assert imported("hourboard.llm", "corpus_pipeline") == core
    assert imported("hourboard.llm.shared") == core


def test_an_import_error_of_something_else_is_raised():
    code = BLOCKED.format(blocked={"hourboard.schemas"})
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "hourboard.schemas" in done.stderr and done.returncode
