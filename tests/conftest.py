import shutil
import tempfile

import pytest

from tillstar.schemas import RAW
from tillstar.session import get_session
from tillstar.sources.warehouse import Warehouse


@pytest.fixture(scope="session")
def spark():
    # Tiny data: start-up, planning and compilation are all the cost there is.
    session = get_session(
        app_name="tests", cores=2,
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1 -XX:+UseSerialGC",
        spark__sql__codegen__wholeStage="false",
        spark__sql__codegen__factoryMode="NO_CODEGEN",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def fresh(spark, tmp_path_factory):
    """A created, empty warehouse; tests work on copies of its folder."""
    return Warehouse(spark, tmp_path_factory.mktemp("fresh") / "star").create()


@pytest.fixture
def new_warehouse(spark, fresh, tmp_path):
    def make(name):
        shutil.copytree(fresh.root, tmp_path / name)
        return Warehouse(spark, tmp_path / name)

    return make


@pytest.fixture
def warehouse(new_warehouse):
    return new_warehouse("star")


LINE = {
    "InvoiceNo": "536365", "StockCode": "85123A", "Description": "LANTERN", "Quantity": 6,
    "InvoiceDate": "12/1/2010 8:26", "UnitPrice": 2.55, "CustomerID": 17850.0,
    "Country": "United Kingdom",
}


@pytest.fixture
def lines(spark):
    """Raw rows from changes to one standard line."""

    def make(*changes):
        rows = [{**LINE, **change} for change in changes]
        return spark.createDataFrame([[r[n] for n in RAW.fieldNames()] for r in rows], RAW)

    return make


@pytest.fixture
def values():
    """A column's values, sorted, missing ones last."""

    def take(df, column):
        found = [r[0] for r in df.select(column).collect()]
        return sorted(found, key=lambda v: (v is None, v if v is not None else 0))

    return take
