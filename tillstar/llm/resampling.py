"""Importance resampling towards a target distribution.

Texts become hashed counts of runs of one or two words. An array of gains, one per bucket, says how
much likelier the target texts make the bucket than all texts do; a text's weight is the floored mean
of its features' gains. Weight plus Gumbel noise, a hash of the id, is the score; the highest scores
are a sample without replacement in proportion to the exponentials of the weights.

Ranks come from a distributed LSD radix sort of the composite key (score falling, id, number of
features): pass by pass, from the least significant digit, rows are counted by (digit, part of the
present order), prefix sums over the counts give each pair its first place, and a row's place is that
plus its number within the pair. Every pass is stable, one shuffle of a few numbers a row, and is
written to the shared folder; no task holds more than PART_ROWS rows of one pair, and nothing but
the gains passes through the driver.

Defined results: a null or empty text has no features, weight 0, and is too short to draw; a null
id counts as an empty text in the noise and as larger than any other in ties; rows that tie in all
outputs are interchangeable; a table without eligible rows has no ranks. With an empty target every
count of it is zero. Other columns are carried along. Texts are worked through in blocks.
"""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.llm.common import map_rows, written

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
RADIX_BITS = 11
PART_ROWS = 1 << 14
BLOCK_BYTES = 1_000_000

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9a-z\x80-\xff]")


def buckets_of(text, size=BUCKETS):
    """Yields arrays of the buckets of a text's features, and how many words each is of."""
    data, start, before = (text or "").encode().lower(), 0, None
    while start < len(data):
        found = _BETWEEN.search(data, start + BLOCK_BYTES)
        end = found.start() if found else len(data)
        words = _WORDS.findall(data, start, end)
        start = end
        if not words:
            continue
        single = list(map(zlib.crc32, words))
        led = [before, *single] if before is not None else single
        pairs = [zlib.crc32(w, zlib.crc32(b" ", a)) for a, w in zip(led, words[len(words) - len(led) + 1 :], strict=False)]
        before = single[-1]
        yield np.array(single + pairs, np.int64) % size, len(words)


def bucket_counts(df, text="text", size=BUCKETS):
    """Features by bucket over all texts, as an array."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                for found, _ in buckets_of(value.as_py(), size):
                    total += np.bincount(found, minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], ["bucket", "n"])

    rows = df.select(F.col(text)).mapInArrow(count, "bucket bigint, n bigint")
    totals = np.zeros(size, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():
        totals[bucket] = n
    return totals


def gains_of(source, target):
    """What a feature of each bucket adds, in thousandths, floored."""
    size = len(source)
    s_all, t_all = float(source.sum() + size), float(target.sum() + size)
    return np.array(
        [math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(source, target, strict=True)],
        np.int64,
    )


def noise(key, seed=SEED):
    """Gumbel noise of an id, in thousandths, floored."""
    text = "" if key is None else str(key)
    h = int(hashlib.sha256(f"{seed}:{text}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(text, gains):
    """Words, features and weight of a text."""
    words = features = total = 0
    for found, n in buckets_of(text, len(gains)):
        words += n
        features += len(found)
        total += int(gains[found].sum())
    return words, features, total // features if features else 0


def weights(df, gains, text="text", key="doc_id", seed=SEED, keep=None):
    """Rows with `n_words`, `n_features`, `weight` and `score`."""
    shared = df.sparkSession.sparkContext.broadcast(gains)

    def make():
        def work(texts, keys):
            found = [weigh(t, shared.value) for t in texts.to_pylist()]
            score = [w + noise(k, seed) for (_, _, w), k in zip(found, keys.to_pylist(), strict=True)]
            return [*(list(x) for x in zip(*found, strict=True)), score] if found else [[], [], [], []]

        return work

    columns = {"n_words": "bigint", "n_features": "bigint", "weight": "bigint", "score": "bigint"}
    return map_rows(df, [F.col(text), F.col(key)], make, columns, keep)


def _digit(columns, low, bits):
    """Bits low to low + bits of the number that (column, width) pairs make, least significant first."""
    parts, start = [], 0
    for column, width in columns:
        right, left = max(0, low - start), max(0, start - low)
        if start < low + bits and start + width > low:
            taken = min(width - right, bits - left)
            part = F.shiftright(F.col(column), right).bitwiseAND(F.lit((1 << taken) - 1))
            parts.append(F.shiftleft(part, left))
        start += width
    found = parts[0]
    for part in parts[1:]:
        found = found + part
    return found.cast("int")


def radix_ranks(df, keys, part_rows=PART_ROWS, bits=RADIX_BITS):
    """Rows with `rank`, from 1, by non-negative whole-number columns, the most significant first."""
    df = df.withColumn("at", F.monotonically_increasing_id())
    # Written, so that the numbers stay if a task is retried.
    rows = written(df.withColumn("part", F.floor(F.col("at") / part_rows).cast("long")), "radix")
    most = rows.agg(*[F.max(k).alias(k) for k in keys]).first()
    columns = [(k, int(most[k] or 0).bit_length()) for k in reversed(keys)]
    total = sum(width for _, width in columns)
    # One pass at least, so that places are without gaps.
    for low in range(0, max(1, total), bits):
        digit = _digit(columns, low, min(bits, total - low)) if total else F.lit(0)
        rows = rows.withColumn("digit", digit)
        counts = rows.groupBy("digit", "part").agg(F.count(F.lit(1)).alias("n"))
        counts = written(counts, "counts")
        before = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        # At most 2 ** bits rows.
        bases = counts.groupBy("digit").agg(F.sum("n").alias("n")).select(
            "digit", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
        )
        earlier = Window.partitionBy("digit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        firsts = counts.select("digit", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
        firsts = firsts.join(F.broadcast(bases), "digit").select("digit", "part", (F.col("base") + F.col("first")).alias("first"))
        within = Window.partitionBy("digit", "part").orderBy("at")
        placed = rows.withColumn("within", F.row_number().over(within)).join(firsts, ["digit", "part"])
        placed = placed.withColumn("at", F.col("first") + F.col("within") - 1)
        placed = placed.withColumn("part", F.floor(F.col("at") / part_rows).cast("long"))
        rows = written(placed.drop("digit", "within", "first"), "radix")
    return rows.withColumn("rank", F.col("at") + 1).drop("at", "part")


def resample(df, target, text="text", key="doc_id", target_text="text", percent=PERCENT,
             least_words=LEAST_WORDS, seed=SEED, size=BUCKETS, keep=None):
    """Rows with `n_words`, `n_features`, `weight`, `score` and `rank`, null if not drawn.

    Of the rows with at least `least_words` words so many percent are drawn. keep: columns of df to
    carry along, in a struct named "row".
    """
    keep = df.columns if keep is None else keep
    gains = gains_of(bucket_counts(df, text, size), bucket_counts(target, target_text, size))
    found = weights(df, gains, text, key, seed, keep=list(dict.fromkeys([*keep, key])))
    found = written(found, "weights")
    long_enough = F.col("n_words") >= least_words
    bounds = found.filter(long_enough).agg(
        F.count(F.lit(1)).alias("n"), F.max("score").alias("score"),
        F.min(F.col(f"row.`{key}`")).alias("least"), F.max(F.col(f"row.`{key}`")).alias("most"),
    ).first()
    least, most = (x if x is not None else 0 for x in (bounds["least"], bounds["most"]))
    keyed = found.filter(long_enough).withColumns({
        "key_score": F.lit(bounds["score"] or 0) - F.col("score"),
        "key_id": F.coalesce(F.col(f"row.`{key}`").cast("bigint") - F.lit(least), F.lit(most - least + 1)),
        "key_size": F.col("n_features"),
    })
    ranked = radix_ranks(keyed, ["key_score", "key_id", "key_size"]).drop("key_score", "key_id", "key_size")
    drawn = bounds["n"] * percent // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    short = found.filter(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.withColumn("rank", rank).unionByName(short)
