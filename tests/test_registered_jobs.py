"""Every registered job with a SQL check gives the rows of its check."""

import pytest

import __spark_entry__ as entry_points
from beaconry.plans import ORACLES, QUERIES
from compare import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_job(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir) is None


def test_every_job_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
