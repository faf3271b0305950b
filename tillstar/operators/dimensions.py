"""Dimension rows from a cleaned batch.

Each rollup aggregates in two levels. The first groups by key and value with fixed-width buffers
only, so Spark can use a hash aggregate with a map-side pass over the big side; the second picks
the first value among the few distinct ones. A key that holds a third of all rows shrinks to one
row per task and value before anything is shuffled.
"""

from pyspark.sql import functions as F

from tillstar.functions import dates, text
from tillstar.schemas import DIM_DATE, SOURCE_POSITION


def row_order(df):
    """What "first" means: the position in the source file if known, else the invoice date."""
    return SOURCE_POSITION if SOURCE_POSITION in df.columns else "InvoiceDate"


def sale_dates(cleaned):
    """The dates that occur."""
    day = F.col("FullDate")
    return cleaned.select(F.to_date("InvoiceDate").alias("FullDate")).filter(day.isNotNull()).distinct()


def date_dimension(cleaned):
    """One row per date that occurs in the batch (not a calendar)."""
    return date_attributes(sale_dates(cleaned))


def date_attributes(days):
    day = F.col("FullDate")
    return days.select(
        dates.date_key(day).alias("DateKey"),
        day,
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
        F.quarter(day).alias("Quarter"),
        F.dayofmonth(day).alias("Day"),
        F.date_format(day, "EEEE").alias("DayOfWeek"),
        (F.weekday(day) >= 5).alias("IsWeekend"),
    ).select(DIM_DATE.fieldNames())


def product_values(cleaned):
    """The descriptions of each StockCode, and where each is seen first."""
    return cleaned.groupBy("StockCode", "Description").agg(F.min(row_order(cleaned)).alias("seen"))


def first_products(cleaned):
    """StockCode with the description of its first row; a missing description is kept.

    Rows that tie on the order are taken by description, missing last.
    """
    return products_of(product_values(cleaned))


def products_of(values):
    first = F.min_by(
        F.struct("Description"),
        F.struct(
            F.col("seen").isNull(), "seen", F.col("Description").isNull(), "Description"
        ),
    )
    return (
        values.groupBy("StockCode")
        .agg(first.alias("first"))
        .select("StockCode", F.col("first.Description").alias("Description"))
    )


def customer_values(cleaned):
    """The countries of each CustomerID, where each is seen first, and the dates it is sold on."""
    return cleaned.groupBy("CustomerID", "Country").agg(
        F.min(row_order(cleaned)).alias("seen"),
        F.min("InvoiceDate").alias("earliest"),
        F.max("InvoiceDate").alias("latest"),
    )


def customer_rollup(cleaned):
    """CustomerID with its first known country and its first and last purchase date."""
    return customers_of(customer_values(cleaned))


def customers_of(values):
    known = F.when(
        F.col("Country").isNotNull(), F.struct(F.col("seen").isNull(), "seen", "Country")
    )
    return values.groupBy("CustomerID").agg(
        F.min_by("Country", known).alias("Country"),
        F.to_date(F.min("earliest")).alias("FirstPurchaseDate"),
        F.to_date(F.max("latest")).alias("LastPurchaseDate"),
    )


def latest_countries(values):
    """The country each customer was last seen with, and when; of two at a time the later name."""
    known = F.when(F.col("Country").isNotNull(), F.struct("latest", "Country"))
    return values.groupBy("CustomerID").agg(F.max(known).alias("_last")).select(
        "CustomerID", F.col("_last.Country").alias("Country"), F.col("_last.latest").alias("SeenLast")
    )


def all_values(rows):
    """What product_values(), customer_values() and sale_dates() give of rows whose copies are not
    removed (copies change none of it), in one pass.

    Each result row belongs to one of them: `part` is product, customer or date. Every row has a stock
    code and a date. Rows flagged Fractional are left out, but counted as `fractional` in a row of
    part date.
    """
    keys = ["StockCode", "Description", "CustomerID", "Country", "FullDate"]
    good = ~F.col("Fractional")
    keyed = rows.select(
        "StockCode", "Description", "CustomerID", "Country",
        F.to_date("InvoiceDate").alias("FullDate"), "InvoiceDate", "Fractional",
        *[c for c in rows.columns if c == SOURCE_POSITION],
    )
    sets = [["StockCode", "Description"], ["CustomerID", "Country"], ["FullDate"]]
    grouped = keyed.groupingSets([[F.col(k) for k in own] for own in sets], *[F.col(k) for k in keys]).agg(
        # Without a position this is `earliest`, and summed up once for both.
        F.min(F.when(good, F.col(row_order(rows)))).alias("seen"),
        F.min(F.when(good, F.col("InvoiceDate"))).alias("earliest"),
        F.max(F.when(good, F.col("InvoiceDate"))).alias("latest"),
        F.count_if("Fractional").alias("fractional"),
    )
    part = (
        F.when(F.col("FullDate").isNotNull(), "date")
        .when(F.col("StockCode").isNotNull(), "product")
        .otherwise("customer")
    )
    kept = F.col("earliest").isNotNull()
    # Stripped after the aggregate, of which there are few rows.
    return grouped.select(
        F.when(kept, part).alias("part"),
        *[text.strip(F.col(c)).alias(c) for c in ("StockCode", "Description", "Country")],
        F.when(kept, F.col("CustomerID").cast("bigint")).alias("CustomerID"),
        "FullDate", "seen", "earliest", "latest", "fractional",
    )


def insert_if_absent(candidates, existing, key):
    """Candidates whose key the table does not hold yet."""
    return candidates.join(existing.select(key), key, "left_anti")
