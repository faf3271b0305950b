"""Surrogate keys."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.session import shared_folder

# monotonically_increasing_id() keeps the partition number above bit 33 and the row below it.
_ROW_BITS = 33


def assign_surrogate_keys(rows, order_by, key, last_key=0):
    """Number rows last_key+1, last_key+2, ... in the order of a unique column, without gaps.

    Rows are range-partitioned and sorted in parallel; each partition counts for itself and is
    shifted by the sizes of the partitions before it. The checkpoint fixes which row is in which
    partition, so a lost executor cannot renumber anything. The window runs over one row per
    partition, never over the data.
    """
    shared_folder(rows.sparkSession)
    placed = (
        rows.repartitionByRange(order_by)
        .sortWithinPartitions(order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id")
        .checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(key, F.lit(last_key) + F.col("_shift") + F.col("_row") + 1)
        .drop("_part", "_row", "_shift")
    )


def assign_sales_keys(rows, last_key=0):
    """Unique keys above last_key, with gaps: no sort, no shuffle.

    Each task takes a range of 2^33 keys, so a table's life has room for a billion tasks.
    """
    return rows.withColumn(
        "SalesKey", F.lit(last_key) + F.monotonically_increasing_id() + F.lit(1)
    )
