"""The older flat reports, answered from the published star.

A transaction of the flat model is a fact with its product's code and its customer's id; every
load counts. The facts are reduced by surrogate key before they meet a dimension.
"""

from pyspark.sql import functions as F


def top_customers(star, n=20):
    return (
        star.fact.groupBy("CustomerKey")
        .agg(F.sum("TotalSalesAmount").alias("TotalSpent"))
        .join(star.customers, "CustomerKey")
        .select(F.col("CustomerID").cast("long").alias("CustomerID"), "Country", "TotalSpent")
        .orderBy(F.desc("TotalSpent"), "CustomerID")
        .limit(n)
    )


def top_countries(star, n=15):
    return (
        star.fact.groupBy("Country", "CustomerKey")
        .agg(F.sum("TotalSalesAmount").alias("amount"))
        .groupBy("Country")
        .agg(
            F.count(F.lit(1)).alias("UniqueCustomers"),
            F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
        )
        .orderBy(F.desc("TotalRevenue"), "Country")
        .limit(n)
    )


def top_products(star, n=20):
    return (
        star.fact.groupBy("ProductKey", "InvoiceNo")
        .agg(F.sum("TotalSalesAmount").alias("amount"))
        .groupBy("ProductKey")
        .agg(
            F.count(F.lit(1)).alias("TimesPurchased"),
            F.sum("amount").cast("decimal(20,2)").alias("TotalRevenue"),
        )
        .join(star.products, "ProductKey")
        .select("StockCode", "Description", "TimesPurchased", "TotalRevenue")
        .orderBy(F.desc("TotalRevenue"), "StockCode")
        .limit(n)
    )
