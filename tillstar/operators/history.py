"""Versions of customers by change intervals.

What is kept is one row per customer and day with a sale: the country of the day's earliest sale
with a known country. Such rows merge in any order, so late, repeated and out-of-order rows end in
the same place. A customer's versions are the islands of equal countries over the days (gaps and
islands): a version is valid from its first day to before the next one's, the first one from ever.
Days of no known country go on in the version before them; the first known country also counts for the days
before it. A late row may so split a version, move its bounds, or join two.

Versions keep their keys as far as they go on: a stored key goes to the first new interval of its
country that it overlaps. A fact whose day is now another version's has to be given that key; the
days that move say which.
"""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.functions import dates
from tillstar.operators.keys import assign_surrogate_keys
from tillstar.schemas import CUSTOMER_DAYS, CUSTOMER_VERSIONS

# Stands for "from ever" among the days: what is known of a customer without a dated sale.
EVER = date(1000, 1, 1)

VERSION_COLUMNS = CUSTOMER_VERSIONS.fieldNames()
DAY_COLUMNS = CUSTOMER_DAYS.fieldNames()


def _first_known():
    known = F.when(F.col("Country").isNotNull(), F.struct("Moment", "Country"))
    return F.min(known).alias("_first")


def _by_day(rows):
    return rows.groupBy("CustomerID", "Day").agg(_first_known()).select(
        "CustomerID", "Day", F.col("_first.Moment").alias("Moment"), F.col("_first.Country").alias("Country")
    )


def sale_days(rows):
    """The days of sales of each customer in cleaned rows, with the country of each."""
    dated = rows.filter(F.col("InvoiceDate").isNotNull() & F.col("CustomerID").isNotNull())
    return _by_day(
        dated.select("CustomerID", F.to_date("InvoiceDate").alias("Day"), F.col("InvoiceDate").alias("Moment"), "Country")
    )


def from_ever(customers):
    """Days that say a customer has had a country from ever."""
    ever = F.lit(EVER).cast("date")
    return customers.select(
        F.col("CustomerID").cast("bigint").alias("CustomerID"), ever.alias("Day"),
        ever.cast("timestamp_ntz").alias("Moment"), "Country",
    )


def days_of_facts(facts, customers):
    """The days of customers whose loads so far kept no history: all of the dimension's country."""
    sold = facts.select("CustomerKey", "DateKey").distinct().join(customers.select("CustomerKey", "CustomerID", "Country"), "CustomerKey")
    day = dates.day_of_key(F.col("DateKey"))
    return sold.select(
        F.col("CustomerID").cast("bigint").alias("CustomerID"), day.alias("Day"), day.cast("timestamp_ntz").alias("Moment"), "Country"
    )


def merged(stored, added):
    """Days of both; of two rows of a day the earlier known country stays."""
    return _by_day(stored.select(DAY_COLUMNS).unionByName(added.select(DAY_COLUMNS)))


def changed_days(stored, added):
    """The added days that the stored ones do not say already."""
    old = stored.select("CustomerID", "Day", F.struct("Moment", "Country").alias("_old"))
    new = F.struct("Moment", "Country")
    met = added.join(old, ["CustomerID", "Day"], "left")
    says_more = F.col("Country").isNotNull() & (F.col("_old.Country").isNull() | (new < F.col("_old")))
    return met.filter(F.col("_old").isNull() | says_more).drop("_old")


def intervals(days):
    """(CustomerID, Country, dates of the first and last sale, ValidFrom, ValidTo) of each version.

    A window over a customer's days: one row a day at most, whatever the number of sales.
    """
    in_order = Window.partitionBy("CustomerID").orderBy("Day")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("Country", ignorenulls=True).over(so_far)
    starts = F.col("Country").isNotNull() & (F.col("Country") != F.col("_before"))
    numbered = days.withColumn("_before", before).withColumn("_version", F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(in_order))
    sold = F.when(F.col("Day") > F.lit(EVER), F.col("Day"))
    islands = numbered.groupBy("CustomerID", "_version").agg(
        F.max("Country").alias("Country"), F.min(sold).alias("FirstPurchaseDate"), F.max(sold).alias("LastPurchaseDate"), F.min("Day").alias("_since"),
    )
    following = F.lead("_since").over(Window.partitionBy("CustomerID").orderBy("_version"))
    return islands.select(
        "CustomerID", "Country", "FirstPurchaseDate", "LastPurchaseDate",
        F.when(F.col("_version") > 0, F.col("_since")).alias("ValidFrom"), following.alias("ValidTo"),
    )


def _since():
    return F.coalesce("ValidFrom", F.lit(EVER))


def keyed(new, stored):
    """New intervals with the keys of stored versions that go on in them, NULL for others."""
    new = new.withColumn("_since", _since())
    spans = stored.select(
        F.col("CustomerID").cast("bigint").alias("CustomerID"), "CustomerKey",
        F.col("Country").alias("_was"), _since().alias("_from"), F.col("ValidTo").alias("_to"),
    )
    overlap = (F.col("_to").isNull() | (F.col("_since") < F.col("_to"))) & (F.col("ValidTo").isNull() | (F.col("ValidTo") > F.col("_from")))
    same = F.col("_was").isNull() | F.col("Country").isNull() | (F.col("_was") == F.col("Country"))
    taken = new.join(spans, "CustomerID").filter(same & overlap).groupBy("CustomerID", "CustomerKey").agg(F.min("_since").alias("_since"))
    given = taken.groupBy("CustomerID", "_since").agg(F.min("CustomerKey").alias("CustomerKey"))
    return new.join(given, ["CustomerID", "_since"], "left")


def numbered(rows, last_key):
    """Keyed intervals as versions; those without a key get the next ones, by customer and date."""
    place = F.struct("CustomerID", "_since").alias("_place")
    new = rows.filter(F.col("CustomerKey").isNull()).drop("CustomerKey").select("*", place)
    fresh = assign_surrogate_keys(new, "_place", "CustomerKey", last_key)
    both = rows.filter(F.col("CustomerKey").isNotNull()).select("CustomerKey", *new.drop("_place").columns).unionByName(fresh.drop("_place"))
    return both.withColumn("IsCurrent", F.col("ValidTo").isNull()).select(VERSION_COLUMNS)


def spans_of(versions):
    """A customer's versions as one row, so that a lookup keeps the number of rows."""
    return versions.groupBy(F.col("CustomerID").cast("bigint").alias("CustomerID")).agg(
        F.collect_list(F.struct("CustomerKey", "ValidFrom", "ValidTo")).alias("versions")
    )


def key_on(versions, day):
    """The key of the version that is valid on a day, from a row of spans_of()."""
    valid = F.filter(
        versions,
        lambda v: (v["ValidFrom"].isNull() | (v["ValidFrom"] <= day)) & (v["ValidTo"].isNull() | (v["ValidTo"] > day)),
    )
    return F.get(valid, F.lit(0))["CustomerKey"]


def moved_days(stored_days, old, new):
    """(CustomerKey, DateKey, NewKey): whose facts of which days now belong to another version."""
    by_old = spans_of(old).withColumnRenamed("versions", "_old")
    by_new = spans_of(new).withColumnRenamed("versions", "_new")
    day = F.col("Day")
    placed = stored_days.filter(day > F.lit(EVER)).join(by_old, "CustomerID").join(by_new, "CustomerID").select(
        key_on(F.col("_old"), day).alias("CustomerKey"),
        (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).alias("DateKey"),
        key_on(F.col("_new"), day).alias("NewKey"),
    )
    return placed.filter(F.col("CustomerKey") != F.col("NewKey"))


def rekeyed(facts, moved):
    """Facts with the keys of their versions as they are now."""
    return facts.join(moved, ["CustomerKey", "DateKey"], "left").withColumn("CustomerKey", F.coalesce("NewKey", "CustomerKey")).drop("NewKey")
