"""Every registered query against its SQL, on the smallest given tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402
from gaugeflow.verification.spark_side import REGISTERED  # noqa: E402
from gaugeflow.verification.sql_side import oracle  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not found")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


def test_each_query_has_its_sql():
    """The operators on text are an optional part with tests of their own."""
    assert set(REGISTERED) == set(oracle())
    assert set(REGISTERED) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_agrees(spark, con, name):
    assert compare.compare(spark, con, SF_DIR, name) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r.leituras >= r.falhas for r in rows)
