"""Dimension updates, for users who want more than insert-if-absent.

The load keeps a known customer's row as it is. These operators fold a later rollup into the
dimension instead: in place (type 1) or as snapshots with history (type 2). Each is one full outer
join on the business key, dimension-sized on both sides. Versions by the dates of the sales
themselves are in history.py.
"""

from functools import reduce

from pyspark.sql import functions as F

from tillstar.operators.keys import assign_surrogate_keys

TRACKED = ["Country", "FirstPurchaseDate", "LastPurchaseDate"]


def merge_customers(existing, rollup):
    """Existing rows and a batch's rollup as one row per CustomerID: latest known country,
    widest date range. The key is NULL for a new customer."""
    old = existing.withColumn("CustomerID", F.col("CustomerID").cast("bigint")).alias("old")
    new = rollup.alias("new")
    return old.join(new, "CustomerID", "full_outer").select(
        "CustomerID",
        "CustomerKey",
        F.coalesce("new.Country", "old.Country").alias("Country"),
        F.least("old.FirstPurchaseDate", "new.FirstPurchaseDate").alias("FirstPurchaseDate"),
        F.greatest("old.LastPurchaseDate", "new.LastPurchaseDate").alias("LastPurchaseDate"),
    )


def update_in_place(existing, rollup, last_key):
    """Type 1: known customers keep their key and get the merged values, new ones get new keys."""
    merged = merge_customers(existing, rollup)
    known = merged.filter(F.col("CustomerKey").isNotNull())
    new = merged.filter(F.col("CustomerKey").isNull()).drop("CustomerKey")
    numbered = assign_surrogate_keys(new, "CustomerID", "CustomerKey", last_key)
    columns = ["CustomerKey", "CustomerID", *TRACKED]
    return known.select(columns).unionAll(numbered.select(columns))


def taking_over(rollup, existing, latest):
    """A batch's rollup with the country that known customers take over, NULL if they take none.

    latest: the customers' latest known countries among new sales, with the moment they were seen.
    A country seen before the last purchase that is known does not take over. Customers who are new
    get their latest country, or else the rollup's.
    """
    old = existing.select(
        F.col("CustomerID").cast("bigint").alias("CustomerID"), F.lit(True).alias("_known"),
        F.col("Country").alias("_was"), F.col("LastPurchaseDate").alias("_until"),
    )
    seen = latest.select("CustomerID", F.col("Country").alias("_now"), F.to_date("SeenLast").alias("_on"))
    met = rollup.join(seen, "CustomerID", "left").join(old, "CustomerID", "left")
    newer = F.col("_until").isNull() | (F.col("_on") >= F.col("_until"))
    country = F.when(F.col("_known") & F.col("_was").isNotNull(), F.when(newer, F.col("_now"))).otherwise(F.coalesce("_now", "Country"))
    return met.withColumn("Country", country).select(rollup.columns)


def start_history(rows, since):
    """A history table's first state: every row current since the given date."""
    return rows.select(
        "*",
        F.lit(since).cast("date").alias("ValidFrom"),
        F.lit(None).cast("date").alias("ValidTo"),
        F.lit(True).alias("IsCurrent"),
    )


def update_history(history, incoming, key, as_of, tracked=TRACKED):
    """Type 2: a changed row closes the current version and opens a new one.

    Keys that are absent from the incoming rows keep their current version.
    """
    current = history.filter("IsCurrent")
    closed = history.filter("NOT IsCurrent")
    today = F.lit(as_of).cast("date")
    columns = [key, *tracked, "ValidFrom", "ValidTo", "IsCurrent"]

    pairs = (
        current.select(key, F.struct(columns).alias("was"))
        .join(incoming.select(key, F.struct(key, *tracked).alias("now")), key, "full_outer")
    )
    changed = reduce(
        lambda a, b: a | b,
        [~F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}")) for c in tracked],
    )
    opened = F.struct(
        F.col(f"now.{key}").alias(key),
        *[F.col(f"now.{c}").alias(c) for c in tracked],
        today.alias("ValidFrom"),
        F.lit(None).cast("date").alias("ValidTo"),
        F.lit(True).alias("IsCurrent"),
    )
    ended = F.struct(
        F.col(f"was.{key}").alias(key),
        *[F.col(f"was.{c}").alias(c) for c in tracked],
        F.col("was.ValidFrom").alias("ValidFrom"),
        today.alias("ValidTo"),
        F.lit(False).alias("IsCurrent"),
    )
    versions = (
        F.when(F.col("was").isNull(), F.array(opened))
        .when(F.col("now").isNull() | ~changed, F.array("was"))
        .otherwise(F.array(ended, opened))
    )
    latest = pairs.select(F.explode(versions).alias("version")).select("version.*")
    return closed.select(columns).unionByName(latest)
