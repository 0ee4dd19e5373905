import os

import pytest

from catalog.check import connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables")
    return SMALL


@pytest.fixture(scope="session")
def con(small):
    return connect(small)


@pytest.fixture(scope="session")
def agrees(spark, con, small):
    """Compare a registered query with its SQL."""
    from catalog.check import differences
    from plumbline.llm.queries import ORACLES, QUERIES

    def check(name):
        relation = con.sql(ORACLES[name])
        return differences(QUERIES[name](spark, small), relation.df(), dict(zip(relation.columns, map(str, relation.types))))

    return check
