"""Key lookups from big row sets into dimensions."""

import uuid

from pyspark.sql import functions as F

from tillstar.session import released_shuffles, shared_folder

# A lookup side has two columns, a key of at most 50 characters and a number. A million such
# rows stay well below 200 MB in memory on each executor.
DEFAULT_BROADCAST_ROWS = 1_000_000
BROADCAST_ROWS_SETTING = "spark.tillstar.broadcastRows"

# Of the first count of hot keys, for each partition: a bucket's fair share is a small part of its bound.
BUCKETS = 16


def broadcast_rows(spark):
    return int(spark.conf.get(BROADCAST_ROWS_SETTING, str(DEFAULT_BROADCAST_ROWS)))


def is_small(df, bound=None):
    """Whether the frame has at most `bound` rows. On a Parquet table the count reads footers only."""
    bound = broadcast_rows(df.sparkSession) if bound is None else bound
    return df.count() <= bound


def written_once(rows):
    """The rows as a table in the shared folder, for steps that pass over them several times."""
    spark = rows.sparkSession
    folder = f"{shared_folder(spark)}/tillstar-{uuid.uuid4().hex[:12]}/rows"
    with released_shuffles(spark):
        rows.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def attach_key(rows, dimension, on, key, source=None):
    """Left lookup of a surrogate key; rows without a match get NULL.

    A dimension proven small is broadcast: no shuffle of the rows. Beyond the bound the join
    shuffles both sides, with hot keys spread by salt. source: the frame to find hot keys in, if
    `rows` has come through other lookups since.
    """
    entries = dimension.select(on, key)
    if is_small(entries):
        return rows.join(F.broadcast(entries), on, "left")
    return salted_lookup(rows, entries, on, source=source)


def hot_keys(rows, on, partitions):
    """The keys that hold more than one partition's fair share of the rows, with their salts.

    The rows are counted by a hash of the key first, in BUCKETS buckets a partition: that many numbers
    a task, however many keys there are. Only in a bucket with more than the share can a key have
    more, so the keys of such buckets are counted, mostly none.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    bucket = F.pmod(F.xxhash64(on), F.lit(BUCKETS * partitions))
    sizes = {r.bucket: r["count"] for r in rows.groupBy(bucket.alias("bucket")).count().collect()}
    share = max(1, sum(sizes.values()) // partitions)
    full = [number for number, size in sizes.items() if size > share]
    if not full:
        return spark.range(0).select(F.lit(None).cast(rows.schema[on].dataType).alias(on), F.lit(1).alias("_salts"))
    counts = rows.filter(F.col(on).isNotNull() & bucket.isin(full)).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > share).select(
        on, F.ceil(F.col("_n") / share).cast("int").alias("_salts")
    ).checkpoint()


def salted_lookup(rows, entries, on, partitions=None, source=None):
    """Left join that splits each hot key over several tasks.

    A key is hot if it holds more than one partition's fair share of the rows, so there are never
    more hot keys than partitions and broadcasting them is bounded by construction. Hot rows get
    a salt from a hash of their own content (stable if a task is retried), and the one matching
    entry is repeated per salt. The rows are passed over once for the counts and once for the join:
    give it a table, or written_once() of a plan.
    """
    partitions = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(rows if source is None else source, on, partitions)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    content = F.xxhash64(*[F.col(c) for c in rows.columns])
    salted_rows = (
        rows.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.pmod(content, salts).cast("int"))
        .drop("_salts")
    )
    salted_entries = (
        entries.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return salted_rows.join(salted_entries, [on, "_salt"], "left").drop("_salt")
