"""Registered queries against their SQL on the smallest scale."""

from __future__ import annotations

import os

import pytest

import check_queries
from catalog import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"
# These all start from the full matrix, which matrix_full compares column by column.
FROM_FULL = {"report_ranges", "prune_constant", "prune_empty", "prune_binned", "matrix_head", "matrix_everything"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check_queries.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(CHECKS) - FROM_FULL))
def test_equals_sql(spark, con, name):
    problem = check_queries.compare(spark, con, SF_DIR, name)
    assert problem in ("", "equal but empty")


def test_every_check_has_its_query():
    assert set(CHECKS) <= set(QUERIES)
    assert not [n for n in QUERIES if "pipeline" in n]
