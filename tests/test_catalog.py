"""Every registered query against its SQL, on the smallest tables; those without SQL must run."""

import os

import pytest

from catalog import CHECKS, QUERIES
from catalog.check import check, connect

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert check(spark, con, FOLDER, name) is None


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).first()["decision"] in ("ml", "remediate")
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_files_of_a_load_are_written_by_the_whole_cluster():
    from types import SimpleNamespace

    from catalog import flow
    session = lambda n: SimpleNamespace(sparkContext=SimpleNamespace(defaultParallelism=n))
    assert flow._files(session(2)) == 5 and flow._files(session(12)) == 12
