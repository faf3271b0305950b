from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.operators import cleaning, membership, quality
from tillstar.operators.lookup import BROADCAST_ROWS_SETTING
from tillstar.plans import load
from tillstar.plans.load import HISTORY, load_batch
from tillstar.sources.warehouse import Warehouse


def facts_of(warehouse):
    """Facts with business keys, sorted, without SalesKey."""
    star = warehouse.star()
    rows = star.fact.join(star.products, "ProductKey").join(
        star.customers.select("CustomerKey", "CustomerID"), "CustomerKey"
    ).select("InvoiceNo", "DateKey", "StockCode", "CustomerID", "Quantity", "UnitPrice",
             "TotalSalesAmount", "Country")
    return sorted(map(tuple, rows.collect()))


def sizes(warehouse):
    star = warehouse.star()
    return [t.count() for t in (star.dates, star.products, star.customers, star.fact)]


def batch(lines):
    return lines(
        {"InvoiceNo": "1", "InvoiceDate": "12/1/2010 8:26"},
        {"InvoiceNo": "2", "InvoiceDate": "12/2/2010 8:26", "StockCode": "B", "CustomerID": 1.0},
        {"InvoiceNo": "3", "InvoiceDate": "12/3/2010 8:26", "StockCode": "A", "CustomerID": 2.0},
    )


def test_a_load_reports_what_it_wrote(lines, warehouse):
    report = load_batch(batch(lines), warehouse)
    assert report.added == {"dim_date": 3, "dim_product": 3, "dim_customer": 3, "fact_sales": 3}
    assert report.rejected == 0 and report.mark == datetime(2010, 12, 3, 8, 26)
    star = warehouse.star()
    products = star.products.orderBy("ProductKey").collect()
    assert [(p.ProductKey, p.StockCode) for p in products] == [(1, "85123A"), (2, "A"), (3, "B")]
    customers = star.customers.orderBy("CustomerKey").collect()
    assert [(c.CustomerKey, c.CustomerID) for c in customers] == [(1, 1), (2, 2), (3, 17850)]
    assert warehouse.get_watermark() == datetime(2010, 12, 3, 8, 26)
    audit = {r.step: r.removed for r in warehouse.read("load_audit").collect()}
    assert set(audit.values()) == {0}


def test_a_second_run_adds_nothing(lines, warehouse):
    load_batch(batch(lines), warehouse)
    before = sizes(warehouse)
    report = load_batch(batch(lines), warehouse)
    assert set(report.added.values()) == {0}
    assert sizes(warehouse) == before


def test_the_mark_is_exclusive(lines, spark, tmp_path):
    warehouse = Warehouse(spark, tmp_path / "w").create(datetime(2010, 12, 1, 8, 26))
    load_batch(
        lines({"InvoiceDate": "12/1/2010 8:26"}, {"InvoiceDate": "12/1/2010 8:27"}), warehouse
    )
    assert warehouse.star().fact.count() == 1
    # The dimensions see the whole batch.
    assert warehouse.star().customers.first().FirstPurchaseDate == date(2010, 12, 1)


def test_the_mark_never_falls(lines, warehouse):
    load_batch(batch(lines), warehouse)
    report = load_batch(lines({"InvoiceDate": "1/1/2009 0:00", "InvoiceNo": "0"}), warehouse)
    assert report.mark == datetime(2010, 12, 3, 8, 26)
    assert report.added["fact_sales"] == 0 and report.added["dim_date"] == 1


def test_two_loads_give_the_facts_of_one(lines, new_warehouse):
    whole = new_warehouse("one")
    load_batch(batch(lines), whole)
    parts = new_warehouse("two")
    load_batch(batch(lines).filter("InvoiceNo = '1'"), parts)
    load_batch(batch(lines), parts)
    assert facts_of(parts) == facts_of(whole)
    keys = [r.SalesKey for r in parts.star().fact.collect()]
    assert len(set(keys)) == 3
    products = sorted(r.ProductKey for r in parts.star().products.collect())
    assert products == [1, 2, 3]


def test_a_known_customer_keeps_its_row(lines, warehouse):
    load_batch(lines({"InvoiceDate": "12/1/2010 8:26"}), warehouse)
    load_batch(lines({"InvoiceDate": "12/9/2010 8:26", "Country": "France"}), warehouse)
    row = warehouse.star().customers.first()
    assert (row.Country, row.LastPurchaseDate) == ("United Kingdom", date(2010, 12, 1))
    assert warehouse.star().fact.count() == 2


def test_amounts_come_from_the_unrounded_price(lines, warehouse):
    load_batch(lines({"UnitPrice": 0.001, "Quantity": 1000}), warehouse)
    row = warehouse.star().fact.first()
    assert (row.UnitPrice, row.TotalSalesAmount) == (Decimal("0.00"), Decimal("1.00"))
    rules = {r.rule: r.violations for r in quality.value_rules(warehouse.star().fact).collect()}
    assert rules["UnitPrice <= 0"] == 1


def test_rows_that_do_not_fit_are_set_aside_with_a_reason(lines, warehouse):
    good = {"InvoiceNo": "good"}
    report = load_batch(
        lines(
            good,
            {"InvoiceNo": "x" * 21},
            {"InvoiceNo": "amount", "Quantity": 2, "UnitPrice": 50_000_000.0},
            {"InvoiceNo": "price", "UnitPrice": 100_000_000.0},
            {"InvoiceNo": "huge", "UnitPrice": 1e15},
            {"InvoiceNo": "code", "StockCode": "s" * 51},
            {"InvoiceNo": "description", "StockCode": "D", "Description": "d" * 256},
            {"InvoiceNo": "land", "CustomerID": 5.0, "Country": "c" * 101},
            {"InvoiceNo": "id", "CustomerID": 3e9},
        ),
        warehouse,
    )
    rejects = {
        (r.TargetTable, r.InvoiceNo or r.StockCode or r.CustomerID): r.Reason
        for r in warehouse.read("rejects").collect()
    }
    assert rejects == {
        ("fact_sales", "x" * 21): "InvoiceNo longer than 20",
        ("fact_sales", "amount"): "TotalSalesAmount does not fit",
        ("fact_sales", "price"): "UnitPrice does not fit",
        ("fact_sales", "huge"): "UnitPrice does not fit",
        ("fact_sales", "code"): "missing product key",
        ("fact_sales", "description"): "missing product key",
        ("fact_sales", "land"): "missing customer key",
        ("fact_sales", "id"): "missing customer key",
        ("dim_product", "s" * 51): "StockCode longer than 50",
        ("dim_product", "D"): "Description longer than 255",
        ("dim_customer", 5): "Country longer than 100",
        ("dim_customer", 3_000_000_000): "CustomerID does not fit",
    }
    assert report.rejected == 12 and report.added["fact_sales"] == 1
    assert [r.InvoiceNo for r in warehouse.star().fact.collect()] == ["good"]


def test_a_bad_batch_changes_nothing(lines, warehouse):
    load_batch(batch(lines), warehouse)
    before, state = sizes(warehouse), warehouse.state()
    with pytest.raises(cleaning.BadBatch):
        load_batch(lines({"InvoiceNo": "9"}, {"InvoiceDate": "soon"}), warehouse)
    assert sizes(warehouse) == before and warehouse.state() == state


def test_a_lenient_load_sets_bad_rows_aside(lines, warehouse):
    report = load_batch(
        lines({}, {"InvoiceDate": "soon"}, {"CustomerID": 1.5}), warehouse, strict=False
    )
    assert report.added["fact_sales"] == 1
    reasons = sorted(r.Reason for r in warehouse.read("rejects").collect())
    assert reasons == ["bad InvoiceDate", "fractional CustomerID"]


def test_a_row_without_date_reaches_the_dimensions_but_not_the_facts(lines, warehouse):
    load_batch(lines({}, {"InvoiceDate": None, "StockCode": "N"}), warehouse)
    assert warehouse.star().fact.count() == 1
    assert warehouse.star().products.count() == 2
    assert warehouse.star().dates.count() == 1


def test_a_load_that_dies_half_way_is_invisible_and_can_be_replayed(
    lines, warehouse, monkeypatch
):
    load_batch(batch(lines).filter("InvoiceNo = '1'"), warehouse)
    before = sizes(warehouse)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(load, "_write_rejects", dies)
        with pytest.raises(RuntimeError, match="lost"):
            load_batch(batch(lines), warehouse)
    assert sizes(warehouse) == before
    load_batch(batch(lines), warehouse)
    assert sizes(warehouse) == [3, 3, 3, 3]
    failed = quality.unique_key_check(quality.star_tables(warehouse.star())).filter("duplicated > 0")
    assert failed.count() == 0


def test_what_a_dead_load_left_does_not_leak_into_a_different_one(lines, warehouse, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(load, "_write_rejects", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_batch(batch(lines), warehouse)
    load_batch(lines({"InvoiceDate": "1/1/1890 0:00"}), warehouse)
    assert sizes(warehouse) == [1, 1, 1, 0]


def test_a_repeated_batch_number_is_skipped(lines, warehouse):
    load_batch(batch(lines), warehouse, use_mark=False, batch=0)
    before = warehouse.state()
    load_batch(batch(lines), warehouse, use_mark=False, batch=0)
    assert warehouse.state() == before and warehouse.star().fact.count() == 3


def test_create_drops_what_was_there(lines, warehouse):
    load_batch(batch(lines), warehouse)
    warehouse.create(datetime(2010, 1, 1))
    assert sizes(warehouse) == [0, 0, 0, 0]
    mark = warehouse.watermark().collect()
    assert [tuple(r) for r in mark] == [("fact_sales", datetime(2010, 1, 1))]
    load_batch(batch(lines), warehouse)
    assert sizes(warehouse) == [3, 3, 3, 3]


def test_integrity_after_a_load(lines, warehouse):
    load_batch(batch(lines), warehouse)
    star = warehouse.star()
    tables = {**quality.star_tables(star), "watermark": warehouse.watermark()}
    assert quality.unique_key_check(tables).filter("duplicated > 0").count() == 0
    assert quality.not_null_check(tables).filter("null_count > 0").count() == 0
    assert quality.reference_check(star).filter("orphans > 0").count() == 0
    assert quality.limit_check(tables).filter("too_long > 0").count() == 0
    assert quality.value_rules(star.fact).filter("violations > 0").count() == 0


def test_the_lookup_beyond_the_broadcast_bound_loads_the_same(lines, spark, new_warehouse):
    plain = new_warehouse("a")
    load_batch(batch(lines), plain)
    spark.conf.set("spark.tillstar.broadcastRows", "1")
    try:
        salted = new_warehouse("b")
        load_batch(batch(lines), salted)
    finally:
        spark.conf.unset("spark.tillstar.broadcastRows")
    assert facts_of(salted) == facts_of(plain)


def test_a_hot_invoice_loads_whole(spark, warehouse):
    """One invoice holds a third of all rows."""
    from tillstar.schemas import RAW_COLUMNS

    hot = F.col("id") % 3 == 0
    raw = spark.range(3000).select(
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        F.concat(F.lit("S"), F.col("id") % 50).alias("StockCode"),
        F.lit("thing").alias("Description"),
        (F.col("id") + 1).cast("int").alias("Quantity"),
        F.lit("12/1/2010 8:26").alias("InvoiceDate"),
        F.lit(1.0).alias("UnitPrice"),
        F.when(hot, 1.0).otherwise((F.col("id") % 70).cast("double")).alias("CustomerID"),
        F.lit("France").alias("Country"),
    ).select(RAW_COLUMNS)
    report = load_batch(raw, warehouse)
    assert report.added["fact_sales"] == 3000
    assert warehouse.star().fact.filter("InvoiceNo = 'hot'").count() == 1000


def test_rejects_are_set_aside_once(lines, warehouse):
    bad = [{}, {"InvoiceNo": "x" * 21}, {"CustomerID": 5.0, "Country": "c" * 101}, {"InvoiceDate": "soon"}]
    for use_mark in (True, True, False):
        load_batch(lines(*bad), warehouse, strict=False, use_mark=use_mark)
    found = sorted((r.TargetTable, r.Reason) for r in warehouse.read("rejects").collect())
    assert found == [
        ("dim_customer", "Country longer than 100"), ("fact_sales", "InvoiceNo longer than 20"),
        ("fact_sales", "bad InvoiceDate"), ("fact_sales", "missing customer key"),
    ]
    assert warehouse.star().fact.count() == 1


def test_a_lenient_audit_closes(lines, warehouse):
    rows = [{}, {}, {"InvoiceDate": "soon"}, {"CustomerID": 1.5}, {"InvoiceDate": None}, {"InvoiceNo": None},
            {"InvoiceNo": "C1"}, {"Quantity": 0}, {"InvoiceNo": "x" * 21}]
    load_batch(lines(*rows), warehouse, strict=False)
    audit = [tuple(r) for r in warehouse.read("load_audit").collect()]
    assert audit[0][1] == len(rows) and audit[-1][2] == warehouse.star().fact.count() == 1
    assert [a[2] for a in audit[:-1]] == [a[1] for a in audit[1:]]
    assert {a[0]: a[3] for a in audit} == {
        "drop_null_keys": 1, "drop_duplicates": 1, "set_aside_bad_date": 1, "drop_cancelled": 1,
        "keep_positive": 1, "set_aside_fractional_id": 1, "skip_without_date": 1, "set_aside_unfit": 1,
    }


def test_old_rows_feed_the_dimensions_only(lines, warehouse):
    load_batch(lines({"InvoiceDate": "12/9/2010 8:26"}), warehouse)
    old = [
        {"InvoiceDate": "12/2/2010 8:26", "StockCode": "N", "Description": "second", "CustomerID": 7.0, "Country": None},
        {"InvoiceDate": "12/1/2010 8:26", "StockCode": "N", "Description": " first ", "CustomerID": 7.0, "Country": None},
        {"InvoiceDate": "12/3/2010 8:26", "StockCode": "N", "CustomerID": 7.0, "Country": " Spain "},
        {"InvoiceDate": "12/4/2010 8:26", "StockCode": "gone", "Quantity": 0},
        {"InvoiceDate": "12/10/2010 8:26", "StockCode": "N", "CustomerID": 7.0, "Country": "France"},
    ]
    report = load_batch(lines(*old, old[0]), warehouse)
    assert report.added == {"dim_date": 4, "dim_product": 1, "dim_customer": 1, "fact_sales": 1}
    star = warehouse.star()
    assert star.products.filter("StockCode = 'N'").first().Description == "first"
    customer = star.customers.filter("CustomerID = 7").first()
    assert (customer.Country, str(customer.FirstPurchaseDate), str(customer.LastPurchaseDate)) == (
        "Spain", "2010-12-01", "2010-12-10"
    )
    steps = {r.step: r.removed for r in warehouse.read_load("load_audit", 2).collect()}
    assert steps["skip_at_or_before_mark"] == 5


def test_old_rows_do_not_enter_the_shuffle(spark, lines, warehouse):
    many = spark.range(2000).join(lines({"InvoiceDate": "12/1/2010 8:26"})).withColumn("InvoiceNo", F.col("id").cast("string"))
    rows = cleaning.classify(many.drop("id"), datetime(2010, 12, 2))
    assert rows.count() == 1 and rows.first().Copies == 2000


def test_a_fractional_id_in_an_old_row_fails_the_batch(lines, warehouse):
    load_batch(batch(lines), warehouse)
    with pytest.raises(cleaning.BadBatch):
        load_batch(lines({"CustomerID": 1.5, "InvoiceDate": "12/1/2010 8:00"}), warehouse)


def test_the_flat_reports_see_every_load_and_no_failed_one(lines, warehouse):
    from tillstar.plans import flat

    load_batch(lines({"InvoiceNo": "1", "InvoiceDate": "12/1/2010 8:26", "UnitPrice": 1.0, "Quantity": 1}), warehouse)
    load_batch(lines({"InvoiceNo": "2", "InvoiceDate": "12/2/2010 8:26", "UnitPrice": 2.0, "Quantity": 1}), warehouse)
    with pytest.raises(cleaning.BadBatch):
        load_batch(lines({"InvoiceDate": "soon"}), warehouse)
    assert flat.top_customers(warehouse.star()).first().TotalSpent == Decimal("3.00")
    assert flat.top_products(warehouse.star()).first().TimesPurchased == 2


def test_views_follow_later_loads(spark, lines, warehouse):
    from tillstar.plans import views

    load_batch(batch(lines).filter("InvoiceNo = '1'"), warehouse)
    views.register(warehouse)
    count = "SELECT COUNT(*) FROM fact_sales"
    assert spark.sql(count).first()[0] == 1
    load_batch(batch(lines), Warehouse(spark, warehouse.root))
    assert spark.sql(count).first()[0] == 3
    assert spark.sql("SELECT SUM(DailyOrders) FROM vw_DailySalesSummary").first()[0] == 3


def test_compaction_changes_no_result(spark, lines, warehouse):
    for number in ("1", "2", "3"):
        load_batch(batch(lines).filter(F.col("InvoiceNo") == number), warehouse)
    before, mark = facts_of(warehouse), warehouse.get_watermark()
    for _ in range(2):
        warehouse.compact()
        assert facts_of(warehouse) == before and sizes(warehouse) == [3, 3, 3, 3]
        assert warehouse.get_watermark() == mark
    report = load_batch(batch(lines).union(lines({"InvoiceNo": "4", "InvoiceDate": "12/4/2010 8:26"})), warehouse)
    assert report.added["fact_sales"] == 1 and sizes(warehouse)[3] == 4
    keys = [r.SalesKey for r in warehouse.star().fact.collect()]
    assert len(set(keys)) == 4


def test_an_update_load_takes_over_later_values(lines, warehouse):
    load_batch(lines({"InvoiceDate": "12/1/2010 8:26"}, {"InvoiceNo": "2", "CustomerID": 2.0}), warehouse)
    later = {"InvoiceNo": "3", "InvoiceDate": "12/9/2010 8:26", "Country": "France"}
    report = load_batch(lines(later, {**later, "CustomerID": 3.0}), warehouse, customers="update")
    assert report.added["dim_customer"] == 1 and report.added["fact_sales"] == 2
    rows = {r.CustomerID: r for r in warehouse.star().customers.collect()}
    assert sorted(rows) == [2, 3, 17850]
    assert (rows[17850].Country, rows[17850].LastPurchaseDate) == ("France", date(2010, 12, 9))
    assert rows[17850].FirstPurchaseDate == date(2010, 12, 1)
    assert quality.reference_check(warehouse.star()).filter("orphans > 0").count() == 0


def test_working_tables_are_removed(lines, warehouse):
    import os

    load_batch(batch(lines), warehouse)
    assert not os.path.exists(f"{warehouse.root}/_working")


def test_a_reset_clears_the_state_first(lines, warehouse, monkeypatch):
    load_batch(batch(lines), warehouse)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.create()
    assert not warehouse.exists()


def test_shuffles_are_sized_by_what_is_read(spark, lines, tmp_path):
    from tillstar import session

    lines({}).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert 0 < session.input_bytes(rows) < 100_000
    assert session.input_bytes(lines({})) == 0
    assert session.partitions_for(10**12, 8) == 3726
    with session.sized_shuffles(rows, partitions=77):
        assert spark.conf.get(key) == "77"
    assert spark.conf.get(key) == before


def _versions(warehouse, customer=17850):
    rows = warehouse.read("customer_versions").filter(f"CustomerID = {customer}").collect()
    found = [(v.Country, v.ValidFrom, v.ValidTo, v.IsCurrent) for v in rows]
    return sorted(found, key=lambda v: v[1] or date(1, 1, 1))


def _countries_of_facts(warehouse):
    star = warehouse.star()
    met = star.fact.select("InvoiceNo", "CustomerKey").join(star.customers.select("CustomerKey", "Country"), "CustomerKey")
    return {r.InvoiceNo: r.Country for r in met.collect()}


def _sale(number, day, country="United Kingdom", **more):
    return {"InvoiceNo": str(number), "InvoiceDate": f"{day} 8:26", "Country": country, **more}


def test_history_gives_facts_the_version_of_their_date(lines, warehouse):
    first = _sale(1, "12/1/2010")
    load_batch(lines(first), warehouse)
    moved = _sale(3, "12/9/2010", "France")
    load_batch(lines(_sale(2, "12/2/2010")), warehouse, customers=HISTORY)
    # The source has grown: the first row comes again.
    load_batch(lines(first, moved, {**moved, "InvoiceNo": "4", "CustomerID": 5.0}), warehouse, customers=HISTORY)
    day = date(2010, 12, 9)
    assert _versions(warehouse) == [("United Kingdom", None, day, False), ("France", day, None, True)]
    assert _versions(warehouse, 5) == [("France", None, None, True)]
    load_batch(lines(_sale(5, "12/10/2010", "France")), warehouse, customers=HISTORY)
    assert len(_versions(warehouse)) == 2
    uk, france = "United Kingdom", "France"
    assert _countries_of_facts(warehouse) == {"1": uk, "2": uk, "3": france, "4": france, "5": france}
    customers = {(r.CustomerID, r.Country): r for r in warehouse.star().customers.collect()}
    assert customers[17850, "France"].LastPurchaseDate == date(2010, 12, 10)
    assert customers[17850, uk].LastPurchaseDate == date(2010, 12, 2)


def test_a_country_changes_within_a_batch_and_back(lines, warehouse):
    other = _sale(9, "3/1/2011", CustomerID=8.0)
    rows = [_sale(1, "3/1/2011", "France"), _sale(2, "3/20/2011", "Spain"), _sale(3, "3/25/2011", None), _sale(4, "4/2/2011", "France")]
    load_batch(lines(other, *rows), warehouse, customers=HISTORY)
    spain, back = date(2011, 3, 20), date(2011, 4, 2)
    assert _versions(warehouse) == [("France", None, spain, False), ("Spain", spain, back, False), ("France", back, None, True)]
    assert _countries_of_facts(warehouse) == {"9": "United Kingdom", "1": "France", "2": "Spain", "3": "Spain", "4": "France"}
    keys = [r.CustomerKey for r in warehouse.star().customers.collect()]
    assert sorted(keys) == [1, 2, 3, 4]


def test_versions_and_facts_do_not_depend_on_the_order_of_batches(lines, new_warehouse):
    batches = [
        [_sale(1, "1/5/2011", "France"), _sale(2, "2/5/2011", "France"), _sale(3, "5/5/2011", "France")],
        [_sale(4, "2/1/2011", "Spain"), _sale(5, "2/9/2011", None), _sale(6, "4/9/2011", "Spain")],
        [_sale(7, "1/1/2011", "Italy"), {**_sale(8, "2/5/2011", "Spain"), "InvoiceDate": "2/5/2011 7:00"}, _sale(9, "6/1/2011", None, CustomerID=4.0)],
    ]
    found = []
    for n, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 0, 2, 0])):
        warehouse = new_warehouse(f"order{n}")
        for i in order:
            load_batch(lines(*batches[i]), warehouse, customers=HISTORY, use_mark=False)
        assert quality.reference_check(warehouse.star()).filter("orphans > 0").count() == 0
        keys = [r.SalesKey for r in warehouse.star().fact.collect()]
        assert len(set(keys)) == len(keys) == 9
        found.append((_versions(warehouse), _versions(warehouse, 4), _countries_of_facts(warehouse)))
    assert found[0] == found[1] == found[2]
    versions, unknown, countries = found[0]
    assert [v[0] for v in versions] == ["Italy", "France", "Spain", "France"]
    assert unknown == [(None, None, None, True)] and countries["2"] == "Spain" and countries["9"] is None


def test_rewritten_months_replace_only_themselves(lines, warehouse):
    load_batch(lines(_sale(1, "1/5/2011", "France"), _sale(2, "2/5/2011", "France"), _sale(3, "3/5/2011", "France")), warehouse, customers=HISTORY)
    load_batch(lines(_sale(4, "2/1/2011", "Spain"), _sale(5, "3/1/2011", "France")), warehouse, customers=HISTORY, use_mark=False)
    state = warehouse.state()
    # From 5 February on there is a second French version; January stays as it was written.
    assert {k for k in state.bases if "/" in k} == {"fact_sales/201102", "fact_sales/201103"}
    assert _countries_of_facts(warehouse) == {"1": "France", "2": "France", "3": "France", "4": "Spain", "5": "France"}
    assert warehouse.star().fact.select("CustomerKey").distinct().count() == 3
    warehouse.compact()
    assert _countries_of_facts(warehouse) == {"1": "France", "2": "France", "3": "France", "4": "Spain", "5": "France"}
    assert not any("/" in k for k in warehouse.state().bases)
    load_batch(lines(_sale(6, "2/2/2011", "France")), warehouse, customers=HISTORY, use_mark=False)
    assert _countries_of_facts(warehouse)["2"] == "France" and len(_versions(warehouse)) == 3


def test_old_rows_of_a_late_start_say_what_was_before(lines, new_warehouse):
    warehouse = new_warehouse("late")
    load_batch(lines(_sale(1, "1/5/2011", CustomerID=2.0)), warehouse, customers=HISTORY)
    load_batch(lines(_sale(2, "1/2/2011", "France"), _sale(3, "2/5/2011", "Spain")), warehouse, customers=HISTORY)
    day = date(2011, 2, 5)
    assert _versions(warehouse) == [("France", None, day, False), ("Spain", day, None, True)]


def test_an_update_takes_the_latest_known_country_of_new_sales(lines, new_warehouse):
    old, new = _sale(1, "1/5/2011", "France"), _sale(2, "2/5/2011", "Spain")
    for name, second in {"grown": [old, new], "alone": [new]}.items():
        warehouse = new_warehouse(name)
        load_batch(lines(old), warehouse)
        load_batch(lines(*second, _sale(3, "2/6/2011", None)), warehouse, customers="update")
        assert [r.Country for r in warehouse.star().customers.collect()] == ["Spain"]
        # An earlier sale that comes later changes nothing but the dates.
        load_batch(lines(_sale(4, "1/1/2011", "Italy")), warehouse, customers="update", use_mark=False)
        row = warehouse.star().customers.first()
        assert (row.Country, row.FirstPurchaseDate) == ("Spain", date(2011, 1, 1))


def _moving_batches(lines):
    first = [_sale(i, f"{1 + i % 3}/{1 + i}/2011", "France", CustomerID=float(i % 5)) for i in range(20)]
    later = [_sale(100 + i, f"{1 + i % 3}/1/2011", "Spain", CustomerID=float(i % 5)) for i in range(12)]
    return lines(*first), lines(*later)


def _load_in_turn(warehouse, batches, monkeypatch):
    """Loads that keep history, and the plans of the months they have rewritten."""
    plans = []
    rewrite = load._rewritten

    def noted(stored, moved, months, few):
        rows = rewrite(stored, moved, months, few)
        plans.append((months, rows._jdf.queryExecution().executedPlan().toString()))
        return rows

    monkeypatch.setattr(load, "_rewritten", noted)
    for batch in batches:
        load_batch(batch, warehouse, customers=HISTORY, use_mark=False)
    monkeypatch.setattr(load, "_rewritten", rewrite)
    facts = warehouse.star().fact.select("InvoiceNo", "DateKey", "CustomerKey", "SalesKey")
    return plans, sorted(map(tuple, facts.collect())), _countries_of_facts(warehouse)


def test_facts_whose_version_changes_are_rewritten_where_they_lie(spark, lines, new_warehouse, monkeypatch):
    found = {}
    for bound in (1_000_000, 4, 0):
        spark.conf.set(BROADCAST_ROWS_SETTING, str(bound))
        try:
            found[bound] = _load_in_turn(new_warehouse(f"bound{bound}"), _moving_batches(lines), monkeypatch)
        finally:
            spark.conf.unset(BROADCAST_ROWS_SETTING)
    at_once, in_turn, shuffled = found.values()
    assert len(at_once[0]) == 1 and "hashpartitioning" not in at_once[0][0][1] and "REBALANCE" not in at_once[0][0][1]
    # Months whose moved days are beyond the bound by themselves are shuffled; none is left out or written twice.
    assert len(shuffled[0]) == 2 and all("hashpartitioning" in plan for _, plan in shuffled[0])
    for plans, _, _ in found.values():
        assert [m for months, _ in plans for m in months] == [201102, 201103]
    assert [f[:2] for f in at_once[1]] == [f[:2] for f in in_turn[1]] == [f[:2] for f in shuffled[1]]
    assert len(at_once[1]) == 32 and len({f[3] for f in in_turn[1]}) == 32
    assert at_once[2] == in_turn[2] == shuffled[2] and set(at_once[2].values()) == {"France", "Spain"}


def test_rows_that_all_fit_are_not_asked_for_their_prices_again(lines, warehouse, monkeypatch):
    """What the index and the counts of hot keys read, also where a version's day is looked up."""
    asked = []
    words = membership.words_of
    monkeypatch.setattr(membership, "words_of", lambda rows: asked.append(rows) or words(rows))
    load_batch(lines(_sale(1, "1/5/2011"), _sale(2, "2/5/2011")), warehouse, customers=HISTORY)
    load_batch(lines(_sale(3, "1/5/2011"), _sale(4, "2/5/2011")), warehouse, customers=HISTORY, use_mark=False)
    assert len(asked) == 2
    for rows in asked:
        # Days are told by DateKey: a lookup moves no moment.
        assert "InvoiceDate" not in rows.columns
        plan = rows.select("DateKey", "RowHash")._jdf.queryExecution().optimizedPlan().toString()
        assert "decimal(18,6)" not in plan.lower()
    assert warehouse.star().fact.count() == 4
