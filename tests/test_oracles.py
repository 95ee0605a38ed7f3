"""Every registered query against its oracle on the smallest tables."""

import oracle_check
import pytest

from strandframe.plans import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    return oracle_check.connect(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    ok, text, _ = oracle_check.compare(spark, con, name, SF)
    assert ok or text == "oracle is empty", text


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 200
