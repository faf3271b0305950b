"""Every registered query against its SQL form, on the smallest test tables."""

import os

import pytest

from tillstar_checks import compare, oracle, registry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return compare.duck(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def code_generation(spark):
    """These run the code a cluster runs."""
    settings = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_every_query_has_a_sql_form():
    assert set(registry.registry()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", registry.registry())
def test_equal(spark, connection, name):
    assert compare.compare(spark, connection, FOLDER, name, oracle.oracle_sql()[name]) is None
