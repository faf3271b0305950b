from datetime import date
from decimal import Decimal

import pytest

from tillstar.plans import analysis, flat, views
from tillstar.plans.load import load_batch


@pytest.fixture
def loaded(new_warehouse, lines):
    def load(*changes):
        warehouse = new_warehouse("loaded")
        load_batch(lines(*changes), warehouse)
        return warehouse

    return load


def test_segment_bounds_are_exclusive(loaded):
    spends = {1.0: 5000.0, 2.0: 5000.01, 3.0: 1000.0, 4.0: 1000.01}
    star = loaded(
        *[{"CustomerID": c, "Quantity": 1, "UnitPrice": p} for c, p in spends.items()]
    ).star()
    found = {r.CustomerSegment: r.NumberOfCustomers for r in
             analysis.customer_segments(star).collect()}
    assert found == {"High Value": 1, "Medium Value": 2, "Low Value": 1}
    order = [r.CustomerSegment for r in analysis.customer_segments(star).collect()]
    assert order == ["High Value", "Medium Value", "Low Value"]


def test_price_dispersion_needs_more_than_five_lines(loaded):
    star = loaded(
        *[{"InvoiceNo": str(i), "StockCode": "five", "UnitPrice": 1.0 + i} for i in range(5)],
        *[{"InvoiceNo": str(i), "StockCode": "six", "UnitPrice": 1.0 + i} for i in range(6)],
    ).star()
    rows = analysis.price_dispersion(star).collect()
    assert [r.StockCode for r in rows] == ["six"]
    assert rows[0].PriceStdDev == pytest.approx(1.870829, abs=1e-6)
    assert (rows[0].MinPrice, rows[0].MaxPrice) == (Decimal("1.00"), Decimal("6.00"))


def test_top_lists_cut_and_break_ties_by_key(loaded):
    star = loaded(*[{"CustomerID": float(c), "StockCode": f"{c:02}"} for c in range(1, 26)]).star()
    assert [r.CustomerID for r in analysis.top_customers(star).collect()] == list(range(1, 21))
    assert [r.StockCode for r in analysis.top_products(star, n=3).collect()] == ["01", "02", "03"]
    assert analysis.revenue_by_country(star).first().UniqueCustomers == 25


def test_averages_are_per_line(loaded):
    star = loaded(
        {"StockCode": "A", "Quantity": 1, "UnitPrice": 1.0},
        {"StockCode": "B", "Quantity": 1, "UnitPrice": 2.0},
    ).star()
    row = analysis.overall_metrics(star).first()
    assert (row.TotalTransactions, row.UniqueProducts, row.UniqueCustomers) == (1, 2, 1)
    assert row.AvgTransactionValue == 1.5 and row.TotalRevenue == Decimal("3.00")
    assert (row.EarliestDate, row.LatestDate) == (date(2010, 12, 1), date(2010, 12, 1))
    top = analysis.top_products(star).first()
    assert top.RevenuePerTransaction == 2.0


def test_an_empty_star(warehouse):
    star = warehouse.star()
    row = analysis.overall_metrics(star).first()
    assert row.TotalTransactions == 0 and row.TotalRevenue is None
    assert row.AvgTransactionValue is None
    for query in (analysis.top_customers, analysis.top_products, analysis.monthly_trend,
                  analysis.customer_summary, analysis.product_performance):
        assert query(star).count() == 0


def test_weekdays_come_monday_first(loaded):
    star = loaded(*[
        {"InvoiceNo": str(d), "InvoiceDate": f"12/{d}/2010 8:00"} for d in range(1, 8)
    ]).star()
    assert [r.DayOfWeek for r in analysis.weekday_pattern(star).collect()] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"
    ]


def test_views_answer_sql_and_keep_unsold_rows(spark, loaded, lines):
    warehouse = loaded({"InvoiceDate": "12/5/2010 8:00"})
    # Older rows reach the dimensions only.
    load_batch(lines({"InvoiceDate": "12/1/2010 8:00", "StockCode": "U", "CustomerID": 9.0}),
               warehouse)
    views.register(warehouse)
    unsold = spark.sql(
        "SELECT * FROM vw_ProductPerformance WHERE TotalRevenue IS NULL"
    ).collect()
    assert [(r.StockCode, r.TimesPurchased, r.UniqueCustomersBought) for r in unsold] == [("U", 0, 0)]
    idle = spark.sql("SELECT * FROM vw_CustomerSummary WHERE TotalOrders = 0").collect()
    assert [(r.CustomerID, r.TotalSpent, r.CustomerLifespanDays) for r in idle] == [(9, None, 0)]
    daily = spark.sql("SELECT * FROM vw_DailySalesSummary").collect()
    assert [(r.FullDate, r.DayOfWeek, r.DailyOrders) for r in daily] == [
        (date(2010, 12, 5), "Sunday", 1)
    ]
    assert {"dim_date", "dim_product", "dim_customer", "fact_sales", "watermark"} <= set(
        views.list_tables(spark)
    )
    assert spark.sql("SELECT TableName FROM watermark").first()[0] == "fact_sales"


def test_flat_model(loaded):
    warehouse = loaded(
        {"CustomerID": 1.0, "UnitPrice": 1.0, "Quantity": 1},
        {"CustomerID": 2.0, "UnitPrice": 2.0, "Quantity": 1, "Country": "France"},
    )
    model = warehouse.star()
    assert [tuple(r) for r in flat.top_customers(model).collect()] == [
        (2, "France", Decimal("2.00")), (1, "United Kingdom", Decimal("1.00"))
    ]
    assert [r.Country for r in flat.top_countries(model, n=1).collect()] == ["France"]
    row = flat.top_products(model).first()
    assert (row.TimesPurchased, row.TotalRevenue) == (1, Decimal("3.00"))
