"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as registered
from check import difference, duck
from conftest import SF
from visitmart import catalog


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_equals_sql(spark, name):
    assert name in registered.oracle_sql()
    assert difference(spark, duck(SF), name, SF) is None


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns[:2] == ["anonymous_id", "event_at"]
    assert frame.count() > 0


def test_a_missing_package_leaves_out_its_queries_only():
    """Without a third-party package the operators that need it are left out, with a warning; a fault of the library's own is raised."""
    import subprocess
    import sys

    code = """
import sys, warnings
sys.modules["ahocorasick"] = None
import __spark_entry__ as registered
from visitmart import catalog, oracle
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    assert set(registered.queries()) == set(catalog.QUERIES)
    assert set(registered.oracle_sql()) >= set(oracle.statements())
try:
    sys.modules["visitmart.functions.daywindow"] = None
    del sys.modules["visitmart.plans.visits"]
    registered._optional("visitmart.plans.visits")
    raise SystemExit("nothing raised")
except ModuleNotFoundError:
    pass
"""
    root = registered.__file__.rsplit("/", 1)[0]
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=100)
    assert done.returncode == 0, done.stderr
