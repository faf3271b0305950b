"""Raw invoice lines derived from the order tables of the test data.

Each line item becomes one invoice line; plain arithmetic on the keys plants the dirt the
cleaning rules are about (missing ids, cancelled invoices, padded text, zero values, copies).
"""

from pyspark.sql import functions as F

from tillstar.schemas import RAW_COLUMNS


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_sales(spark, folder, varied=False):
    """One row per invoice line in the raw schema, exact copies included.

    varied: a product's description and a customer's country differ from line to line.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")

    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    cancelled = F.col("returned") & (order % 16 == 0)
    hour = F.lpad((order % 24).cast("string"), 2, "0")
    minute = F.lpad((order % 60).cast("string"), 2, "0")
    copies = F.when((line == 1) & (order % 20 == 0), 2).otherwise(1)
    needed = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", (F.col("l_returnflag") == "R").alias("returned")]
    lines = lines.select(*needed, *(["l_linenumber"] if varied else []), copies.alias("copies"))

    # The orders get their customer's country and the text of their day before they meet the lines,
    # which are many and narrow.
    nation = F.broadcast(nations.select("n_nationkey", "n_name"))
    sold = (
        orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_orderdate"))
        .join(customers.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"), "n_name")
    )
    joined = lines.join(parts.select("p_partkey", "p_name"), part == F.col("p_partkey")).join(
        sold, order == F.col("o_orderkey")
    )
    description = (
        F.when(part % 97 == 0, None)
        .when(part % 5 == 0, F.concat(F.lit("  "), "p_name", F.lit(" ")))
        .otherwise(F.col("p_name"))
    )
    country = F.concat("n_name", F.when(order % 7 == 0, " ").otherwise(""))
    if varied:
        numbered = F.concat("p_name", F.lit(" v"), (line % 3).cast("string"))
        description = F.when(order % 11 != 0, numbered)
        country = F.when(order % 9 != 0, F.when(order % 5 == 0, "Elsewhere").otherwise(F.col("n_name")))
    rows = joined.select(
        F.concat(
            F.when(cancelled, "C").otherwise(""), (order + 500000).cast("string")
        ).alias("InvoiceNo"),
        F.concat(
            (part + 10000).cast("string"), F.when(part % 10 == 0, "A").otherwise("")
        ).alias("StockCode"),
        description.alias("Description"),
        F.when(cancelled, -F.col("l_quantity"))
        .when(part % 1009 == 5, 0)
        .otherwise(F.col("l_quantity"))
        .cast("int")
        .alias("Quantity"),
        F.concat(
            "day", F.lit(" "), hour, F.lit(":"), minute,
        ).alias("InvoiceDate"),
        F.when(part % 1013 == 7, 0.0)
        .otherwise(F.col("l_extendedprice") / 1000)
        .alias("UnitPrice"),
        F.when(order % 4 != 3, (F.col("o_custkey") + 12000).cast("double")).alias("CustomerID"),
        country.alias("Country"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"),
    )
    return rows.select(RAW_COLUMNS)
