"""Quality and constraint checks.

Row-level checks are one pass of conditional counts per table. Key and reference checks shrink
the fact table to its distinct keys, with their row counts, before anything is joined.
"""

from functools import reduce

from pyspark.sql import functions as F

from tillstar.functions import money
from tillstar.schemas import TABLES, TEXT_LIMITS, UNIQUE_KEYS


def _as_rows(counts, names, values):
    """Turn a one-row frame of counts into rows, one per (labels, count) pair."""
    label_names = names[:-1]
    entries = [
        F.struct(
            *[F.lit(v).alias(n) for n, v in zip(label_names, labels, strict=True)],
            F.col(column).cast("bigint").alias(names[-1]),
        )
        for labels, column in values
    ]
    return counts.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def _union(parts):
    return reduce(lambda a, b: a.unionAll(b), parts)


def star_tables(star):
    return {
        "dim_date": star.dates,
        "dim_product": star.products,
        "dim_customer": star.customers,
        "fact_sales": star.fact,
    }


def duplicate_keys(df, key):
    """Key values that occur more than once, with their counts."""
    return df.groupBy(key).count().filter(F.col("count") > 1)


def unique_key_check(tables):
    """Duplicated values per primary or unique key, over all tables given."""
    parts = []
    for name, df in tables.items():
        for key in UNIQUE_KEYS[name]:
            counted = duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                _as_rows(counted, ["table_name", "key_column", "duplicated"], [((name, key), "n")])
            )
    return _union(parts)


def not_null_check(tables):
    """Missing values per NOT NULL column, one pass per table."""
    parts = []
    for name, df in tables.items():
        required = [f.name for f in TABLES[name] if not f.nullable]
        counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        parts.append(
            _as_rows(
                counted, ["table_name", "column_name", "null_count"],
                [((name, c), c) for c in required],
            )
        )
    return _union(parts)


def value_rules(fact):
    """Counts of fact rows with a value out of range."""
    counted = fact.agg(
        F.count_if(F.col("Quantity") <= 0).alias("q"),
        F.count_if(F.col("UnitPrice") <= 0).alias("p"),
        F.count_if(F.col("TotalSalesAmount") < 0).alias("a"),
    )
    return _as_rows(
        counted, ["rule", "violations"],
        [(("Quantity <= 0",), "q"), (("UnitPrice <= 0",), "p"), (("TotalSalesAmount < 0",), "a")],
    )


def orphans(fact, dimension, key):
    """Fact key values the dimension lacks, with the number of fact rows that use them."""
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return used.join(dimension.select(key), key, "left_anti")


def reference_check(star):
    """Orphaned fact rows per foreign key."""
    parts = []
    for key, dimension in [
        ("DateKey", star.dates), ("ProductKey", star.products), ("CustomerKey", star.customers),
    ]:
        counted = orphans(star.fact, dimension, key).agg(
            F.coalesce(F.sum("fact_rows"), F.lit(0)).alias("n")
        )
        parts.append(_as_rows(counted, ["foreign_key", "orphans"], [((key,), "n")]))
    return _union(parts)


def limit_check(tables):
    """Values beyond the length limits of the text columns, one pass per table."""
    parts = []
    for name, df in tables.items():
        limits = TEXT_LIMITS[name]
        counted = df.agg(
            *[F.count_if(F.length(c) > limit).alias(c) for c, limit in limits.items()]
        )
        parts.append(
            _as_rows(
                counted, ["table_name", "column_name", "length_limit", "too_long"],
                [((name, c, limit), c) for c, limit in limits.items()],
            )
        )
    return _union(parts)


def precision_check(cleaned):
    """Cleaned rows whose price or amount does not fit the fact table's decimals."""
    price = money.to_money(money.exact_price(F.col("UnitPrice")))
    counted = cleaned.agg(
        F.count_if(price.isNull() & F.col("UnitPrice").isNotNull()).alias("p"),
        F.count_if(
            money.to_money(F.col("TotalSalesAmount")).isNull() & F.col("UnitPrice").isNotNull()
        ).alias("a"),
    )
    return _as_rows(
        counted, ["column_name", "does_not_fit"], [(("UnitPrice",), "p"), (("TotalSalesAmount",), "a")]
    )


def date_range_check(star, first=None, last=None):
    """Date range of the facts and how many facts lie outside the bounds (default: the
    date dimension's own range)."""
    bounds = star.dates.agg(
        F.coalesce(F.lit(first).cast("date"), F.min("FullDate")).alias("lower_bound"),
        F.coalesce(F.lit(last).cast("date"), F.max("FullDate")).alias("upper_bound"),
    ).first()
    key = F.col("DateKey").cast("string")
    day = F.to_date(key, "yyyyMMdd")
    per_day = star.fact.groupBy("DateKey").agg(F.count(F.lit(1)).alias("n")).withColumn("day", day)
    lower, upper = F.lit(bounds["lower_bound"]), F.lit(bounds["upper_bound"])
    return per_day.agg(
        F.min("day").alias("min_date"),
        F.max("day").alias("max_date"),
        F.coalesce(
            F.sum(F.when((F.col("day") < lower) | (F.col("day") > upper), F.col("n"))), F.lit(0)
        ).alias("out_of_range"),
    )


# Labels of the quality summary, in report order, and what is counted under each.
SUMMARY_LABELS = {
    "Total fact_sales records": "n0",
    "Unique dates (dim_date)": "dim_date",
    "Unique products (dim_product)": "dim_product",
    "Unique customers (dim_customer)": "dim_customer",
    "Orphaned facts (missing product)": "n1",
    "Orphaned facts (missing customer)": "n2",
    "Orphaned facts (missing date)": "n3",
    "Invalid quantities (<=0)": "n4",
    "Invalid prices (<=0)": "n5",
    "Negative sales amounts": "n6",
}


def quality_summary(star):
    """Labelled counts over all tables, in report order; the fact table is read once for its seven.

    Four frames of one row each become one, so that one ordered array of all counts can be made.
    """
    counted = star.fact.agg(
        F.count(F.lit(1)).alias("n0"),
        F.count_if(F.col("ProductKey").isNull()).alias("n1"),
        F.count_if(F.col("CustomerKey").isNull()).alias("n2"),
        F.count_if(F.col("DateKey").isNull()).alias("n3"),
        F.count_if(F.col("Quantity") <= 0).alias("n4"),
        F.count_if(F.col("UnitPrice") <= 0).alias("n5"),
        F.count_if(F.col("TotalSalesAmount") < 0).alias("n6"),
    )
    tables = star_tables(star)
    for name in [n for n in SUMMARY_LABELS.values() if n in tables]:
        rows = tables[name].agg(F.count(F.lit(1)).alias(name))
        counted = counted.unionByName(rows, allowMissingColumns=True)
    counted = counted.agg(*[F.max(count).alias(count) for count in SUMMARY_LABELS.values()])
    names = ["QualityCheck", "RecordCount"]
    return _as_rows(counted, names, [((label,), count) for label, count in SUMMARY_LABELS.items()])
