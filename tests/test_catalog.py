"""Every published query against its DuckDB twin."""

import os

import pytest

import __spark_entry__ as contract
from compare import difference
from shoreline.catalog.oracles import ORACLES
from shoreline.catalog.history import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_twin(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    assert difference(df, FOLDER, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_shared_folder_comes_from_the_session(spark):
    from shoreline.session import cut_lineage, scratch_path, shared_folder

    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert cut_lineage(spark.range(3)).count() == 3
