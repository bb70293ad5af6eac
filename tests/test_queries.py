"""Every registered query against its SQL counterpart, on whole tables."""

import re
from functools import cache

import pytest

from __spark_entry__ import oracle_sql, queries
from ledgerlink.plans.queries import QUERIES, Case
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def cases(spark):
    """One set of fixtures per configuration, so shared steps run once."""
    return cache(lambda cfg: Case(spark, SF_DIR, cfg))


@pytest.fixture(scope="module")
def con():
    with duck(SF_DIR) as c:
        yield c


def test_every_query_has_sql():
    own = {name for name in queries() if name != "pipeline" and not re.match(r"op\d+_", name)}
    assert own == set(QUERIES) and own <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(name, cases, con):
    build, cfg = QUERIES[name]
    assert differences(build(cases(cfg)), con, oracle_sql()[name]) is None
