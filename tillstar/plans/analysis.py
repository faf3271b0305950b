"""Analysis queries on the star.

The fact side is always reduced before it meets a dimension: by surrogate key where the query
groups by the dimension row (a unique key means the same groups), by invoice where it counts
invoices. Joins then work on aggregate-sized inputs, and a hot product, customer, country or
month is split over tasks by the invoice in the grouping key and by map-side aggregation.

Averages come from decimal sums and counts, so they do not depend on row order. Reports with a
row limit break ties by business key.
"""

from pyspark.sql import functions as F

from tillstar.functions.dates import month_of_key, weekday_rank
from tillstar.functions.money import mean
from tillstar.operators.lookup import is_small

# Spend bounds and names of the customer segments.
HIGH_VALUE, MEDIUM_VALUE = 5000, 1000
SEGMENTS = ["High Value", "Medium Value", "Low Value"]


def _lines():
    return F.count(F.lit(1))


def with_dates(rows, dates, month="SalesMonth"):
    """Join rows that carry DateKey with the date dimension.

    Where the rows still have the fact table's partition column, it is part of the join, so a
    filter on any date attribute prunes fact partitions at run time.
    """
    if month in rows.columns:
        dates = dates.withColumn(month, month_of_key(F.col("DateKey")))
        on = ["DateKey", month]
    else:
        on = ["DateKey"]
    return rows.join(F.broadcast(dates) if is_small(dates) else dates, on)


def _per_invoice(fact, *keys):
    """Sums per grouping key, invoice and customer. Invoices lie together in the fact files, so
    most of the reduction happens map-side."""
    return fact.groupBy(*keys, "InvoiceNo", "CustomerKey").agg(
        F.sum("TotalSalesAmount").alias("amount"),
        F.sum("Quantity").alias("units"),
        _lines().alias("lines"),
    )


def overall_metrics(star):
    """Distinct invoices, customers and products, revenue, average line, date range."""
    invoices = with_dates(_per_invoice(star.fact, "DateKey", "SalesMonth"), star.dates)
    by_invoice = invoices.agg(
        F.countDistinct("InvoiceNo").alias("TotalTransactions"),
        F.countDistinct("CustomerKey").alias("UniqueCustomers"),
        F.lit(None).cast("bigint").alias("UniqueProducts"),
        F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
        mean(F.sum("amount"), F.sum("lines")).alias("AvgTransactionValue"),
        F.min("FullDate").alias("EarliestDate"),
        F.max("FullDate").alias("LatestDate"),
    )
    # Products are counted on their own pass over two narrow columns: one more distinct count
    # in the pass above would multiply its rows by every line of an invoice.
    products = with_dates(
        star.fact.select("DateKey", "SalesMonth", "ProductKey").distinct(), star.dates
    )
    by_product = products.agg(F.countDistinct("ProductKey").alias("UniqueProducts"))
    both = by_invoice.unionByName(by_product, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in by_invoice.columns])


def _customer_totals(fact):
    return fact.groupBy("CustomerKey").agg(
        F.sum("TotalSalesAmount").alias("amount"),
        _lines().alias("lines"),
        F.sum("Quantity").alias("units"),
        F.countDistinct("InvoiceNo").alias("orders"),
    )


def _lifespan():
    return F.date_diff("LastPurchaseDate", "FirstPurchaseDate").alias("CustomerLifespanDays")


def top_customers(star, n=20):
    """Customers by spend."""
    return (
        _customer_totals(star.fact)
        .join(star.customers, "CustomerKey")
        .select(
            "CustomerID",
            "Country",
            "FirstPurchaseDate",
            "LastPurchaseDate",
            _lifespan(),
            F.col("amount").alias("TotalSpent"),
            mean(F.col("amount"), F.col("lines")).alias("AvgOrderValue"),
            F.col("orders").alias("NumberOfOrders"),
        )
        .orderBy(F.desc("TotalSpent"), "CustomerID")
        .limit(n)
    )


def top_customers_short(star, n=20):
    """Customers by spend, three columns."""
    return (
        star.fact.groupBy("CustomerKey")
        .agg(F.sum("TotalSalesAmount").alias("TotalSpent"))
        .join(star.customers, "CustomerKey")
        .select("CustomerID", "Country", "TotalSpent")
        .orderBy(F.desc("TotalSpent"), "CustomerID")
        .limit(n)
    )


def customer_segments(star):
    """Number of customers and spend per spend band."""
    high, medium, low = SEGMENTS
    spent = F.col("TotalSpent")
    return (
        star.fact.groupBy("CustomerKey")
        .agg(F.sum("TotalSalesAmount").alias("TotalSpent"))
        .join(star.customers.select("CustomerKey"), "CustomerKey")
        .groupBy(
            F.when(spent > HIGH_VALUE, high)
            .when(spent > MEDIUM_VALUE, medium)
            .otherwise(low)
            .alias("CustomerSegment")
        )
        .agg(
            _lines().alias("NumberOfCustomers"),
            mean(F.sum("TotalSpent"), _lines()).alias("AvgSpentPerSegment"),
            F.min("TotalSpent").alias("MinSpent"),
            F.max("TotalSpent").alias("MaxSpent"),
        )
        .orderBy(F.desc("AvgSpentPerSegment"))
    )


def top_products(star, n=20):
    """Products by revenue."""
    return (
        star.fact.groupBy("ProductKey")
        .agg(
            F.countDistinct("InvoiceNo").alias("TimesPurchased"),
            F.sum("Quantity").alias("TotalQuantitySold"),
            mean(F.sum("UnitPrice"), _lines()).alias("AvgPrice"),
            F.sum("TotalSalesAmount").alias("TotalRevenue"),
        )
        .join(star.products, "ProductKey")
        .select(
            "StockCode",
            "Description",
            "TimesPurchased",
            "TotalQuantitySold",
            "AvgPrice",
            "TotalRevenue",
            mean(F.col("TotalRevenue"), F.col("TimesPurchased")).alias("RevenuePerTransaction"),
        )
        .orderBy(F.desc("TotalRevenue"), "StockCode")
        .limit(n)
    )


def _deviation(price):
    """Sample standard deviation from exact decimal sums, so that it does not depend on row order.

    Sums too large for the decimals' product go on as doubles. NULL for a single row.
    """
    count = _lines().cast("decimal(18,0)")
    total, squares = F.sum(price), F.sum(price * price)
    exact = F.try_subtract(F.try_multiply(count, squares), F.try_multiply(total, total)).cast("double")
    rough = count.cast("double") * squares.cast("double") - F.pow(total.cast("double"), 2)
    pairs = count.cast("double") * (count.cast("double") - 1)
    return F.sqrt(F.coalesce(exact, F.greatest(rough, F.lit(0.0))) / F.nullif(pairs, F.lit(0.0)))


def price_dispersion(star, n=30, min_lines=5):
    """Products whose price varies most, among those sold on more than min_lines lines."""
    return (
        star.fact.groupBy("ProductKey")
        .agg(
            F.min("UnitPrice").alias("MinPrice"),
            F.max("UnitPrice").alias("MaxPrice"),
            mean(F.sum("UnitPrice"), _lines()).alias("AvgPrice"),
            F.round(_deviation(F.col("UnitPrice")), 6).alias("PriceStdDev"),
            _lines().alias("TransactionCount"),
        )
        .filter(F.col("TransactionCount") > min_lines)
        .join(star.products, "ProductKey")
        .select(
            "StockCode", "Description", "MinPrice", "MaxPrice", "AvgPrice", "PriceStdDev",
            "TransactionCount",
        )
        .orderBy(F.desc("PriceStdDev"), "StockCode")
        .limit(n)
    )


def revenue_by_country(star, n=15):
    """Countries by revenue; the country is the one on the sale."""
    return (
        _per_invoice(star.fact, "Country")
        .groupBy("Country")
        .agg(
            F.countDistinct("CustomerKey").alias("UniqueCustomers"),
            F.countDistinct("InvoiceNo").alias("NumberOfOrders"),
            F.sum("lines").alias("LineItems"),
            F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
            mean(F.sum("amount"), F.sum("lines")).alias("AvgOrderValue"),
            F.sum("units").alias("TotalUnits"),
        )
        .orderBy(F.desc("TotalRevenue"), "Country")
        .limit(n)
    )


def monthly_trend(star):
    """Orders, customers and revenue per month."""
    return (
        with_dates(_per_invoice(star.fact, "DateKey", "SalesMonth"), star.dates)
        .groupBy("Year", "Month", "MonthName")
        .agg(
            F.countDistinct("InvoiceNo").alias("Orders"),
            F.countDistinct("CustomerKey").alias("UniqueCustomers"),
            F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
            mean(F.sum("amount"), F.sum("lines")).alias("AvgOrderValue"),
        )
        .orderBy("Year", "Month")
    )


def monthly_trend_short(star):
    """Orders and revenue per month."""
    return (
        with_dates(_per_invoice(star.fact, "DateKey", "SalesMonth"), star.dates)
        .groupBy("Year", "Month", "MonthName")
        .agg(
            F.countDistinct("InvoiceNo").alias("Orders"),
            F.sum("amount").cast("decimal(20,2)").alias("Revenue"),
        )
        .orderBy("Year", "Month")
    )


def weekday_pattern(star):
    """Orders and revenue per weekday, Monday first."""
    return (
        with_dates(_per_invoice(star.fact, "DateKey", "SalesMonth"), star.dates)
        .groupBy("DayOfWeek")
        .agg(
            F.countDistinct("InvoiceNo").alias("Orders"),
            F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
            mean(F.sum("amount"), F.sum("lines")).alias("AvgOrderValue"),
        )
        .orderBy(weekday_rank(F.col("DayOfWeek")))
    )


def daily_sales_summary(star):
    """View: sales per date and country."""
    return (
        with_dates(_per_invoice(star.fact, "DateKey", "SalesMonth", "Country"), star.dates)
        .groupBy("FullDate", "DayOfWeek", "Country")
        .agg(
            F.countDistinct("InvoiceNo").alias("DailyOrders"),
            F.countDistinct("CustomerKey").alias("DailyUniqueCustomers"),
            F.sum("units").alias("DailyQuantity"),
            F.sum("amount").cast("decimal(20,2)").alias("DailyRevenue"),
            mean(F.sum("amount"), F.sum("lines")).alias("AvgDailyOrderValue"),
        )
    )


def product_performance(star):
    """View: every product with its sales; unsold ones have no sums and zero counts."""
    # One distinct count per pass: two in one would multiply every line.
    sales = (
        star.fact.groupBy("ProductKey", "InvoiceNo")
        .agg(
            F.sum("Quantity").alias("units"),
            F.sum("TotalSalesAmount").alias("amount"),
            F.sum("UnitPrice").alias("prices"),
            _lines().alias("lines"),
        )
        .groupBy("ProductKey")
        .agg(
            F.sum("units").alias("TotalQuantitySold"),
            F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
            _lines().alias("TimesPurchased"),
            mean(F.sum("prices"), F.sum("lines")).alias("AvgUnitPrice"),
        )
    )
    buyers = (
        star.fact.select("ProductKey", "CustomerKey")
        .distinct()
        .groupBy("ProductKey")
        .agg(_lines().alias("UniqueCustomersBought"))
    )
    sales = sales.join(buyers, "ProductKey")
    return star.products.join(sales, "ProductKey", "left").select(
        "StockCode",
        "Description",
        "TotalQuantitySold",
        "TotalRevenue",
        F.coalesce("TimesPurchased", F.lit(0)).alias("TimesPurchased"),
        "AvgUnitPrice",
        F.coalesce("UniqueCustomersBought", F.lit(0)).alias("UniqueCustomersBought"),
    )


def customer_summary(star):
    """View: every customer with their sales; those without have no sums and zero orders."""
    return star.customers.join(_customer_totals(star.fact), "CustomerKey", "left").select(
        "CustomerID",
        "Country",
        "FirstPurchaseDate",
        "LastPurchaseDate",
        _lifespan(),
        F.coalesce("orders", F.lit(0)).alias("TotalOrders"),
        F.col("units").alias("TotalItemsPurchased"),
        F.col("amount").alias("TotalSpent"),
        mean(F.col("amount"), F.col("lines")).alias("AvgOrderValue"),
    )
