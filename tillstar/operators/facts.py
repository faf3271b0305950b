"""Fact rows: increment, key lookup, narrowing, reject reasons."""

from pyspark.sql import functions as F

from tillstar.functions import dates, money
from tillstar.operators import history
from tillstar.operators.cleaning import KEPT
from tillstar.operators.lookup import attach_key, is_small, written_once
from tillstar.operators.membership import SAME
from tillstar.schemas import FACT_SALES, REJECTS, ROW_HASH, TEXT_LIMITS, UNFIT

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
# Below the first a price or amount fits DECIMAL(10,2), from the second on none does, however it was
# rounded: six decimals of the price are at most 2,000 in an amount. Between them decimals tell.
SURELY_FITS, SURELY_NOT = 90_000_000, 110_000_000


def is_due(mark):
    """Rows strictly after the mark; rows without a date never qualify. No mark: every dated row."""
    date = F.col("InvoiceDate")
    return date.isNotNull() if mark is None else date > F.lit(mark).cast("timestamp_ntz")


def increment(cleaned, mark):
    return cleaned.filter(is_due(mark))


def new_mark(cleaned):
    """Latest invoice date of the batch."""
    return cleaned.agg(F.max("InvoiceDate").alias("LastLoadedDate"))


def months_of(rows):
    """The months of dated rows, as YYYYMM numbers: as many as the calendar has at most."""
    found = rows.select(dates.month_of_key(F.col("DateKey")).alias("month")).filter("month IS NOT NULL").distinct()
    return sorted(r.month for r in found.collect())


def month_groups(rows, bound):
    """The months of dated rows in runs of at most `bound` rows, each with its number of rows; a month
    of more is a run of its own. At most as many as the calendar has months."""
    month = dates.month_of_key(F.col("DateKey")).alias("month")
    sizes = rows.groupBy(month).agg(F.count(F.lit(1)).alias("rows")).filter("month IS NOT NULL").collect()
    groups = []
    for r in sorted(sizes, key=lambda r: r.month):
        if groups and groups[-1][1] + r["rows"] <= bound:
            groups[-1] = ([*groups[-1][0], r.month], groups[-1][1] + r["rows"])
        else:
            groups.append(([r.month], r["rows"]))
    return groups


def not_loaded(rows, fact, months):
    """Rows that are not copies of published facts of these months.

    A copy has the same hash of its untouched columns; the columns that a fact keeps as they were
    are compared as well. The months are literals, so that other partitions are not even listed for
    reading, those between a late row's month and the others least of all. This is the whole
    comparison; with an index of the facts, membership.not_loaded() spares most of it.
    """
    known = fact.filter(F.col("SalesMonth").isin(months)).select(SAME)
    return rows.join(known, SAME, "left_anti")


def new_rejects(rejects, known):
    """Rejects that earlier loads have not set aside.

    What is new is told by hash, table and reason alone. If little is, that is broadcast and the
    rejects, which are wide, are not shuffled.
    """
    content = F.xxhash64(*REJECTS.fieldNames())
    same = ["_content", "TargetTable", "Reason"]
    seen = known.select(content.alias("_content"), *same[1:])
    keyed = rejects.withColumn("_content", content)
    new = written_once(keyed.select(same).join(seen, same, "left_anti").distinct())
    return keyed.join(F.broadcast(new) if is_small(new) else new, same, "left_semi").select(REJECTS.fieldNames())


def resolve(rows, products, customers, stored=False):
    """Cleaned rows with ProductKey, CustomerKey and the reason they cannot be loaded, if any.

    Rows that say already whether they fit need no Country, UnitPrice and TotalSalesAmount for it.
    stored: the rows are those of a written table. Others are written first where a dimension is too
    big to broadcast, as hot keys are counted before the join.
    """
    customers = customers.withColumn("CustomerID", F.col("CustomerID").cast("bigint"))
    if not (stored or is_small(products) and is_small(customers)):
        rows = written_once(rows)
    keyed = attach_key(rows, products, "StockCode", "ProductKey")
    keyed = attach_key(keyed, customers, "CustomerID", "CustomerKey", source=rows)
    return keyed.withColumn("Reason", reject_reason(rows))


def resolve_versions(rows, products, versions):
    """As resolve(), with the customer's version that is valid on the day of the row's DateKey."""
    keyed = attach_key(rows, products, "StockCode", "ProductKey")
    placed = attach_key(keyed, history.spans_of(versions), "CustomerID", "versions", source=rows)
    key = history.key_on(F.col("versions"), dates.day_of_key(F.col("DateKey")))
    return placed.withColumn("CustomerKey", key).drop("versions").withColumn("Reason", reject_reason(rows))


def reject_reason(rows):
    """First rule a row breaks on its way into the fact table; NULL for a good row."""
    missing = F.when(F.col("ProductKey").isNull(), "missing product key").when(
        F.col("CustomerKey").isNull(), "missing customer key"
    )
    return F.coalesce(missing, F.col(UNFIT) if UNFIT in rows.columns else unfit_reason())


def with_unfit(rows):
    """Cleaned rows, or the kept ones of classified rows, with what unfit_reason() says: turning prices
    into decimals is the dearest step of a row, and most steps of a load ask. The amount is that of
    the row's quantity and price."""
    reason = unfit_reason(F.col("Quantity") * F.col("UnitPrice"))
    return rows.withColumn(UNFIT, F.when(F.col("RowStatus") == KEPT, reason) if "RowStatus" in rows.columns else reason)


def _too_large(about, exact):
    """Whether a number does not fit. about: it as a double, which mostly says it without the decimal;
    not-a-number is above all numbers."""
    size = F.abs(about)
    return F.when(size < SURELY_FITS, False).when(size >= SURELY_NOT, True).otherwise(exact.isNull())


def unfit_reason(about=None):
    """As reject_reason(), of a row whose keys are known to be there. about: the amount as a double, if
    that is at hand."""
    amount = _amount().isNull() if about is None else _too_large(about, _amount())
    reason = F.when(_too_large(F.col("UnitPrice"), _price()), "UnitPrice does not fit").when(
        amount, "TotalSalesAmount does not fit"
    )
    limits = [
        F.when(F.length(column) > limit, f"{column} longer than {limit}")
        for column, limit in TEXT_LIMITS["fact_sales"].items()
    ]
    return F.coalesce(*limits, reason)


def _price():
    return money.to_money(money.exact_price(F.col("UnitPrice")))


def _amount():
    return money.to_money(F.col("TotalSalesAmount"))


def to_look_up(rows):
    """What a fact is made of, of rows that fit, in its types: the lookups shuffle no more than this."""
    kept = [c for c in rows.columns if c == ROW_HASH.name]
    return rows.select(
        "InvoiceNo", "DateKey", "StockCode", "CustomerID", "Quantity",
        _price().alias("UnitPrice"), _amount().alias("TotalSalesAmount"), "Country", *kept,
        F.lit(None).cast("string").alias(UNFIT),
    )


def fact_rows(resolved):
    """Loadable rows in the fact table's types, without SalesKey.

    The amount is rounded from the unrounded product, never recomputed from the rounded price.
    """
    return resolved.filter(F.col("Reason").isNull()).select(
        *[c for c in resolved.columns if c == ROW_HASH.name],
        "InvoiceNo",
        "DateKey",
        "ProductKey",
        "CustomerKey",
        "Quantity",
        _price().alias("UnitPrice"),
        _amount().alias("TotalSalesAmount"),
        "Country",
    )


def as_rejects(rows, target):
    """Rows with a Reason in the reject table's schema; absent columns become NULL."""
    columns = []
    for field in REJECTS:
        if field.name == "TargetTable":
            value = F.lit(target)
        elif field.name in rows.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.filter(F.col("Reason").isNotNull()).select(columns)


def product_reason():
    reason = F.lit(None).cast("string")
    for column, limit in TEXT_LIMITS["dim_product"].items():
        reason = F.coalesce(reason, F.when(F.length(column) > limit, f"{column} longer than {limit}"))
    return reason


def customer_reason():
    limit = TEXT_LIMITS["dim_customer"]["Country"]
    return F.when(
        ~F.col("CustomerID").between(INT_MIN, INT_MAX), "CustomerID does not fit"
    ).when(F.length("Country") > limit, f"Country longer than {limit}")


def lay_out(facts, months, partitions):
    """Distribute facts for writing: one month per file group, an invoice's lines together.

    REBALANCE lets AQE split months that are too large and merge small ones, so a hot month or
    a hot invoice does not end in one task. `months` is how many the increment can span; with
    about one (month, bucket) pair per partition, no task writes many small files.
    """
    buckets = max(1, partitions // max(1, months))
    return (
        facts.withColumn("SalesMonth", dates.month_of_key(F.col("DateKey")))
        .withColumn("_bucket", F.pmod(F.xxhash64("InvoiceNo"), F.lit(buckets)))
        .hint("rebalance", "SalesMonth", "_bucket")
        .drop("_bucket")
        .sortWithinPartitions("SalesMonth", "DateKey", "InvoiceNo")
    )


FACT_COLUMNS = FACT_SALES.fieldNames()
