from datetime import datetime

from tillstar import settings
from tillstar.__main__ import run
from tillstar.session import partitions_for
from tillstar.sources.warehouse import Warehouse

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def test_settings_come_from_arguments_then_environment_then_defaults():
    chosen = settings.parse([], {})
    assert (chosen.source, chosen.warehouse) == ("data/raw/data.csv", "warehouse")
    chosen = settings.parse([], {"TILLSTAR_SOURCE": "a", "TILLSTAR_WAREHOUSE": "b"})
    assert (chosen.source, chosen.warehouse) == ("a", "b")
    chosen = settings.parse(["--source", "c", "--seed", "2010-01-01"], {"TILLSTAR_SOURCE": "a"})
    assert (chosen.source, chosen.seed) == ("c", datetime(2010, 1, 1))


def test_the_job_creates_loads_and_reruns(spark, tmp_path):
    source = tmp_path / "d.csv"
    source.write_text(HEADER + "1,A,X,6,12/1/2010 8:26,2.55,1,France\n")
    chosen = settings.parse(["--source", str(source), "--warehouse", str(tmp_path / "w")], {})
    assert run(spark, chosen) and run(spark, chosen)
    warehouse = Warehouse(spark, tmp_path / "w")
    assert warehouse.star().fact.count() == 1 and warehouse.state().load_id == 2


def test_the_job_fails_without_a_source_and_on_a_bad_batch(spark, tmp_path):
    absent = settings.parse(["--source", str(tmp_path / "no"), "--warehouse", str(tmp_path / "w")], {})
    assert not run(spark, absent)
    empty = tmp_path / "e.csv"
    empty.write_text(HEADER)
    nothing = settings.parse(["--source", str(empty), "--warehouse", str(tmp_path / "w")], {})
    assert not run(spark, nothing)
    assert Warehouse(spark, tmp_path / "w").star().fact.count() == 0


def test_shuffles_are_sized_by_the_input():
    assert partitions_for(0) == 200
    assert partitions_for(100 * 1024**4) == 409_600
