"""What the physical plans must and must not contain."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillstar_checks import registry
from tillstar.operators import cleaning, dimensions, facts
from tillstar.plans import analysis, flat

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return registry.full(spark, FOLDER).star()


@pytest.fixture(scope="module")
def cleaned(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("cleaned") / "rows")
    registry.cleaned_rows(spark, FOLDER).write.parquet(folder)
    return spark.read.parquet(folder)


def test_cleaning_shuffles_once_and_filters_in_the_scan(spark, lines, tmp_path):
    lines({}).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        found = plan(cleaning.clean(spark.read.parquet(str(tmp_path / "raw"))))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert found.count("Exchange hashpartitioning") == 1
    assert "GreaterThan(Quantity,0)" in found and "IsNotNull(InvoiceNo)" in found
    assert "Python" not in found


def test_condensing_shuffles_once_in_hash_aggregates(lines):
    found = plan(cleaning.classify(lines({})))
    assert found.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in found and "ObjectHashAggregate" not in found


def test_the_big_side_of_the_rollups_is_hash_aggregated(cleaned):
    for rollup in ("first_products", "customer_rollup"):
        found = plan(getattr(dimensions, rollup)(cleaned))
        below = found[found.rindex("SortAggregate"):] if "SortAggregate" in found else found
        assert below.count("HashAggregate") == 2, found


def test_facts_need_no_shuffle_for_lookups_with_small_dimensions(cleaned, star):
    found = plan(facts.fact_rows(facts.resolve(cleaned, star.products, star.customers)))
    assert found.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in found


def test_top_lists_do_not_sort_everything(star):
    for query in (analysis.top_customers, analysis.top_products, analysis.price_dispersion,
                  analysis.revenue_by_country):
        found = plan(query(star))
        assert "TakeOrderedAndProject" in found and "rangepartitioning" not in found


def test_a_date_filter_on_the_daily_view_prunes_fact_partitions(star):
    found = optimized(analysis.daily_sales_summary(star).filter("FullDate >= DATE '2000-01-01'"))
    assert "dynamicpruning" in found


def test_scans_read_only_what_they_need(star):
    found = plan(analysis.top_customers_short(star))
    schema = found[found.index("ReadSchema"):].split("\n")[0]
    assert schema == "ReadSchema: struct<CustomerKey:bigint,TotalSalesAmount:decimal(10,2)>"


def test_no_cross_joins_and_no_python(spark, star):
    queries = [
        analysis.overall_metrics, analysis.top_customers, analysis.customer_segments,
        analysis.top_products, analysis.price_dispersion, analysis.revenue_by_country,
        analysis.monthly_trend, analysis.weekday_pattern, analysis.daily_sales_summary,
        analysis.product_performance, analysis.customer_summary,
    ]
    plans = [plan(q(star)) for q in queries]
    plans += [plan(q(star)) for q in (flat.top_customers, flat.top_countries, flat.top_products)]
    for found in plans:
        assert "CartesianProduct" not in found and "NestedLoop" not in found
        assert "Python" not in found


def test_the_fact_layout_can_be_split_and_keeps_invoices_together(cleaned, star):
    rows = facts.fact_rows(facts.resolve(cleaned, star.products, star.customers))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(facts.lay_out(rows, 80, 8))


def test_product_performance_does_not_multiply_lines(star):
    assert "Expand" not in plan(analysis.product_performance(star))


def test_flat_reports_scan_the_facts_once(star):
    for query in (flat.top_customers, flat.top_countries, flat.top_products):
        found = optimized(query(star))
        assert found.count("TotalSalesAmount#") and found.count("Relation [SalesKey") == 1


def test_only_new_rows_enter_the_copy_removal(lines):
    """Old rows are blanked below the exchange, in the map-side part of the aggregate."""
    found = plan(cleaning.classify(lines({}), datetime(2010, 12, 1)))
    assert found.count("Exchange hashpartitioning") == 1
    below = found[found.index("Exchange hashpartitioning"):]
    assert "partial_count(1)" in below and "AS Old#" in below


def test_the_pass_over_old_rows_sums_up_each_moment_once(lines):
    """Without a position in a file, where a value is seen first is its earliest date."""
    old = cleaning.old_rows(lines({}), datetime(2011, 1, 1))
    values = dimensions.all_values(old)
    assert values.columns == ["part", "StockCode", "Description", "Country", "CustomerID", "FullDate", "seen", "earliest", "latest", "fractional"]
    assert plan(values).count("partial_min(") == 1
    # With one, both are asked for; the position decides.
    placed = old.withColumn("SourcePosition", F.lit(7))
    found = dimensions.all_values(placed)
    assert plan(found).count("partial_min(") == 2
    assert {r.seen for r in found.collect()} == {7}
    assert {r.seen == r.earliest for r in values.collect()} == {True}
