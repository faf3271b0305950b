"""Named views, so that the star can be queried with SQL."""

from tillstar.plans import analysis

VIEWS = {
    "vw_DailySalesSummary": analysis.daily_sales_summary,
    "vw_ProductPerformance": analysis.product_performance,
    "vw_CustomerSummary": analysis.customer_summary,
}


def register(warehouse):
    """Create or replace the table and summary views of the last published load.

    They follow each load that this session publishes in the warehouse.
    """
    warehouse.follow(register)
    star = warehouse.star()
    star.dates.createOrReplaceTempView("dim_date")
    star.products.createOrReplaceTempView("dim_product")
    star.customers.createOrReplaceTempView("dim_customer")
    star.fact.createOrReplaceTempView("fact_sales")
    warehouse.watermark().createOrReplaceTempView("watermark")
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)


def list_tables(spark):
    """Names of the tables and views a query can use."""
    return sorted(row.tableName for row in spark.sql("SHOW TABLES").collect())
