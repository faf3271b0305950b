"""What lookups and loads read, shuffle and write."""

from tillstar.operators import cleaning, facts, lookup
from tillstar.plans.load import load_batch

EARLIER = {"StockCode": "10002", "Description": "DOLL", "UnitPrice": 3.456}


def test_rows_are_written_before_their_hot_keys_are_counted(spark, lines, warehouse):
    raw = lines({}, EARLIER)
    load_batch(raw, warehouse)
    star = warehouse.star()
    spark.conf.set(lookup.BROADCAST_ROWS_SETTING, "0")
    try:
        found = facts.resolve(cleaning.clean(raw), star.products, star.customers)
        assert [file for file in found.inputFiles() if file.split("/")[-2] == "rows"]
        found = {r.StockCode: (r.ProductKey, r.CustomerKey, r.Reason) for r in found.collect()}
    finally:
        spark.conf.unset(lookup.BROADCAST_ROWS_SETTING)
    assert found == {"10002": (1, 1, None), "85123A": (2, 1, None)}


def load_noting(raw, warehouse, monkeypatch, **options):
    written = {}
    write = warehouse.write_working

    def noted(name, rows):
        written[name] = rows.columns
        return write(name, rows)

    monkeypatch.setattr(warehouse, "write_working", noted)
    report = load_batch(raw, warehouse, **options)
    monkeypatch.setattr(warehouse, "write_working", write)
    return report, written


def test_rows_that_have_their_keys_are_not_written_again(lines, warehouse, monkeypatch):
    unfit = {**EARLIER, "InvoiceNo": "9" * 21}
    report, written = load_noting(lines({}, EARLIER, unfit), warehouse, monkeypatch)
    assert "resolved" not in written
    assert not set(cleaning.DERIVED) & set(written["cleaned"])
    assert (report.added["fact_sales"], report.rejected) == (2, 1)
    reject = warehouse.read("rejects").first()
    assert (reject.Reason, reject.Description) == ("InvoiceNo longer than 20", "DOLL")
    sold = {r.DateKey: (str(r.UnitPrice), str(r.TotalSalesAmount)) for r in warehouse.read("fact_sales").filter("Quantity = 6 AND UnitPrice > 3").collect()}
    assert sold == {20101201: ("3.46", "20.74")}


def test_rows_without_a_key_are_told_by_lookups(lines, warehouse, monkeypatch):
    nowhere = {"StockCode": "s" * 51}
    report, written = load_noting(lines({}, nowhere), warehouse, monkeypatch)
    assert "resolved" in written
    assert report.added["fact_sales"] == 1
    reasons = sorted((r.TargetTable, r.Reason) for r in warehouse.read("rejects").collect())
    assert reasons == [("dim_product", "StockCode longer than 50"), ("fact_sales", "missing product key")]


def test_dimensions_that_lack_a_key_after_all_are_noticed(lines, warehouse, monkeypatch):
    monkeypatch.setattr("tillstar.plans.load._insert_products", lambda load: (0, []))
    report, written = load_noting(lines({}), warehouse, monkeypatch)
    assert "resolved" in written
    assert (report.added["fact_sales"], report.rejected) == (0, 1)
