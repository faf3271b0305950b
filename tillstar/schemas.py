"""Declared schemas. Nothing in this package infers types from data."""

from pyspark.sql import types as T

TEXT_COLUMNS = ["InvoiceNo", "StockCode", "Description", "Country"]
KEY_COLUMNS = ["InvoiceNo", "StockCode", "CustomerID"]

RAW = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)
RAW_COLUMNS = RAW.fieldNames()

# Optional raw columns: where the row stood in its source file, and the text of a line that
# cannot be read as one.
SOURCE_POSITION = "SourcePosition"
MALFORMED_LINE = "MalformedLine"
OPTIONAL_COLUMNS = [SOURCE_POSITION, MALFORMED_LINE]
# What tells a raw row from others after a load: a hash of its untouched columns.
ROW_HASH = T.StructField("RowHash", T.LongType())
# Why a clean row does not fit the fact table, whatever its keys; told once, when the row is classified.
UNFIT = "Unfit"

CLEAN = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
        T.StructField("TotalSalesAmount", T.DecimalType(29, 6)),
        T.StructField("InvoiceYear", T.IntegerType()),
        T.StructField("InvoiceMonth", T.IntegerType()),
        T.StructField("InvoiceDay", T.IntegerType()),
        T.StructField("DateKey", T.IntegerType()),
    ]
)
CLEAN_COLUMNS = CLEAN.fieldNames()

DIM_DATE = T.StructType(
    [
        T.StructField("DateKey", T.IntegerType(), False),
        T.StructField("FullDate", T.DateType(), False),
        T.StructField("Year", T.IntegerType(), False),
        T.StructField("Month", T.IntegerType(), False),
        T.StructField("MonthName", T.StringType(), False),
        T.StructField("Quarter", T.IntegerType(), False),
        T.StructField("Day", T.IntegerType(), False),
        T.StructField("DayOfWeek", T.StringType(), False),
        T.StructField("IsWeekend", T.BooleanType(), False),
    ]
)

DIM_PRODUCT = T.StructType(
    [
        T.StructField("ProductKey", T.LongType(), False),
        T.StructField("StockCode", T.StringType(), False),
        T.StructField("Description", T.StringType()),
    ]
)

DIM_CUSTOMER = T.StructType(
    [
        T.StructField("CustomerKey", T.LongType(), False),
        T.StructField("CustomerID", T.IntegerType(), False),
        T.StructField("Country", T.StringType()),
        T.StructField("FirstPurchaseDate", T.DateType()),
        T.StructField("LastPurchaseDate", T.DateType()),
    ]
)

# Versions of customers: valid from a date (from ever, if missing) to before another.
CUSTOMER_VERSIONS = T.StructType(
    [
        *DIM_CUSTOMER.fields,
        T.StructField("ValidFrom", T.DateType()),
        T.StructField("ValidTo", T.DateType()),
        T.StructField("IsCurrent", T.BooleanType(), False),
    ]
)

# What versions are made from: the days of a customer's sales, with the first known country of each.
CUSTOMER_DAYS = T.StructType(
    [
        T.StructField("CustomerID", T.LongType(), False),
        T.StructField("Day", T.DateType(), False),
        T.StructField("Moment", T.TimestampNTZType()),
        T.StructField("Country", T.StringType()),
    ]
)

FACT_SALES = T.StructType(
    [
        T.StructField("SalesKey", T.LongType(), False),
        T.StructField("InvoiceNo", T.StringType(), False),
        T.StructField("DateKey", T.IntegerType(), False),
        T.StructField("ProductKey", T.LongType(), False),
        T.StructField("CustomerKey", T.LongType(), False),
        T.StructField("Quantity", T.IntegerType(), False),
        T.StructField("UnitPrice", T.DecimalType(10, 2), False),
        T.StructField("TotalSalesAmount", T.DecimalType(10, 2), False),
        T.StructField("Country", T.StringType()),
    ]
)

# Words of the index of facts: the bits of the rows of one load and month whose hashes share a word.
FACT_INDEX = T.StructType(
    [
        T.StructField("SalesMonth", T.IntegerType(), False),
        T.StructField("Scale", T.IntegerType(), False),
        T.StructField("Word", T.LongType(), False),
        T.StructField("Mask", T.LongType(), False),
    ]
)

WATERMARK = T.StructType(
    [
        T.StructField("TableName", T.StringType(), False),
        T.StructField("LastLoadedDate", T.TimestampNTZType(), False),
    ]
)

REJECTS = T.StructType(
    [
        T.StructField("TargetTable", T.StringType(), False),
        T.StructField("Reason", T.StringType(), False),
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
        T.StructField("TotalSalesAmount", T.DecimalType(29, 6)),
        T.StructField("RawLine", T.StringType()),
        ROW_HASH,
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("step", T.StringType(), False),
        T.StructField("rows_in", T.LongType(), False),
        T.StructField("rows_out", T.LongType(), False),
        T.StructField("removed", T.LongType(), False),
    ]
)

# Text lengths of the star's VARCHAR columns, per table.
TEXT_LIMITS = {
    "dim_date": {"MonthName": 20, "DayOfWeek": 20},
    "dim_product": {"StockCode": 50, "Description": 255},
    "dim_customer": {"Country": 100},
    "fact_sales": {"InvoiceNo": 20, "Country": 100},
    "watermark": {"TableName": 100},
}

# Primary and unique keys of the star's tables.
UNIQUE_KEYS = {
    "dim_date": ["DateKey"],
    "dim_product": ["ProductKey", "StockCode"],
    "dim_customer": ["CustomerKey", "CustomerID"],
    "fact_sales": ["SalesKey"],
    "watermark": ["TableName"],
}

TABLES = {
    "dim_date": DIM_DATE,
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "fact_sales": FACT_SALES,
    "watermark": WATERMARK,
}

MONEY = T.DecimalType(10, 2)
