"""What a load without a mark reads of the facts that are there."""

import re

from tillstar.operators import facts
from tillstar.plans.load import load_batch


def _files(frame):
    return {re.search(r"SalesMonth=(\d+)", name)[1] for name in frame.inputFiles()}


def test_only_the_months_of_a_batch_are_read(spark, lines, warehouse):
    days = ["1/5/2010", "6/5/2010", "1/5/2011", "2/5/2011", "12/5/2011"]
    load_batch(lines(*[{"InvoiceNo": str(i), "InvoiceDate": f"{day} 8:26"} for i, day in enumerate(days)]), warehouse)
    known = warehouse.read("fact_sales")
    batch = known.filter("SalesMonth IN (201001, 201112)").select("DateKey", "InvoiceNo", "Quantity", "RowHash")
    months = facts.months_of(batch)
    assert months == [201001, 201112]
    left = facts.not_loaded(batch, known, months)
    assert left.count() == 0
    # One old row and one new one: the months between are pruned, not scanned and filtered.
    # The filters are read whole: they are cut by length, and column numbers grow with the session.
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        text = left._jdf.queryExecution().simpleString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert any("SalesMonth" in f and "201001" in f and "201112" in f for f in filters)
    assert not any(">=" in f and "201001" in f and "SalesMonth" in f and "IN" not in f for f in filters)
    assert _files(known) == {"201001", "201006", "201101", "201102", "201112"}
