"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

from docketry.plans.catalogue import ORACLES, QUERIES
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"
# Ten suppliers share no nation at this size, so nothing is linked.
MAY_BE_EMPTY = {"linked_peers", "pair_combinations", "anti_join", "anti_join_null_aware", "external_merge"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, SF).count() > 0
        return
    problem = differences(spark, con, SF, QUERIES[name], ORACLES[name])
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["state", "is_valid", "records", "balance"]
    assert df.count() > 0
