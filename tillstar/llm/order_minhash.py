"""Order MinHash fingerprints: signatures sensitive to edit distance.

A text's k-mers are numbered by occurrence, so that the second "abc" differs from the first. For
each of SKETCHES hash functions the TUPLE smallest numbered k-mers are selected, put back in
the order of the text and hashed together. Two texts' likeness is the share of equal places: it
falls with texts that share few k-mers and with texts that have them in another order.

Defined results: a null text counts as empty; a text shorter than a k-mer is one k-mer; a text with
fewer k-mers than a tuple has places takes those it has; equal texts, repeated rows included, have
equal fingerprints; the likeness of equal fingerprints is 1, also of empty texts.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tillstar.llm.common import map_rows, written

KMER = 8
TUPLE = 2
SKETCHES = 32
# Partitions whose last rows one task finishes.
ENDS_PER_TASK = 64
# K-mers times hash functions worked on at once.
CELLS = 400_000

_rng = np.random.default_rng(20)
_SALTS = _rng.integers(0, 2**32, SKETCHES, np.uint32)
_FACTORS = _rng.integers(0, 2**31, SKETCHES, np.uint32) * np.uint32(2) + np.uint32(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x):
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def code_points(text):
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _kmers(points, k):
    """A hash of each k-mer."""
    hashes = np.zeros(len(points) - k + 1, np.uint64)
    for i in range(k):
        hashes *= np.uint64(0x100000001B3)
        hashes += points[i : i + len(hashes)]
    return _mixed(hashes * _BASE)


def _numbered(kmers):
    """Hash of each k-mer with its occurrence number, and its position."""
    bits = np.uint64(max(1, int(len(kmers)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    # Sorting by k-mer with the position below it brings occurrences together, in text order.
    order = np.sort(kmers & ~low | np.arange(len(kmers), dtype=np.uint64))
    kmer, position = order & ~low, (order & low).astype(np.int64)
    first = np.ones(len(kmer), bool)
    first[1:] = kmer[1:] != kmer[:-1]
    index = np.arange(len(kmer))
    occurrence = index - np.maximum.accumulate(np.where(first, index, 0))
    # The k-mer's own hash, free of how many positions the text has.
    return _mixed(kmers[position] + occurrence.astype(np.uint64) * _BASE), position


def fingerprint(points):
    """The fingerprint of a text's code points, one number per sketch."""
    if not len(points):
        return np.zeros(SKETCHES, np.uint32)
    hashes, position = _numbered(_kmers(points, min(KMER, len(points))))
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    places = min(TUPLE, len(short))
    step = max(1, CELLS // len(short))
    found = np.empty((SKETCHES, places), np.int64)
    for start in range(0, SKETCHES, step):
        rows = slice(start, start + step)
        values = (short ^ _SALTS[rows, None]) * _FACTORS[rows, None]
        line = np.arange(len(values))
        for place in range(places):
            least = values.argmin(axis=1)
            found[rows, place] = least
            values[line, least] = 0xFFFFFFFF
    in_order = np.take_along_axis(found, np.argsort(position[found], axis=1, kind="stable"), axis=1)
    mixed = np.full(SKETCHES, len(_SALTS), np.uint64)
    for place in range(places):
        mixed = _mixed(mixed * _BASE + hashes[in_order[:, place]])
    return (mixed >> np.uint64(32)).astype(np.uint32)


def as_bytes(found):
    return found.astype(">u4").tobytes()


def as_text(found):
    """Eight hexadecimal digits per sketch."""
    return as_bytes(found).hex()


def likeness(one, other):
    """Share of equal places of two fingerprints."""
    return float(np.mean(one == other))


def fingerprints(df, text="text", keep=None):
    """Rows with `fingerprint`."""

    def make():
        return lambda texts: [[as_text(fingerprint(code_points(t or ""))) for t in texts.to_pylist()]]

    return map_rows(df, [F.col(text)], make, {"fingerprint": "string"}, keep)


def edited_text(text, following):
    """The text with its second half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = (
    "n_chars bigint, edited string, fingerprint binary, edited_fingerprint binary, "
    "near_edited double, near_next double"
)


def _compared(text, mark, following, next_mark):
    """What with_next() adds for one text; mark and next_mark are the two fingerprints."""
    edited = edited_text(text, following)
    edited_mark = mark if edited == text else fingerprint(code_points(edited))
    return (
        len(text), edited, as_bytes(mark), as_bytes(edited_mark),
        likeness(mark, edited_mark), likeness(mark, next_mark),
    )


def with_next(df, order_by="doc_id", text="text", edited_as=lambda edited: edited):
    """Each document compared with an edited form of itself and with the next document.

    Next is the following row by falling order_by, nulls last; after the last row comes the first;
    rows that tie go by a hash of their text. A single row is its own next. Columns: order_by,
    n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next. edited_as: what to
    keep of the edited text, for those who need a digest of it only.

    The rows are range-partitioned once. Each partition is read in order and needs only its
    predecessor in memory; the last row of each waits for the first of the next one, and these two
    rows a partition are matched afterwards.
    """
    source = df.select(F.col(order_by).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").desc_nulls_last(), F.xxhash64("text")]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order)
    added = T.StructType.fromDDL(_FIELDS)
    key = source.schema["key"]
    schema = T.StructType([key, T.StructField("part", T.IntegerType()), T.StructField("end", T.StringType()), T.StructField("text", T.StringType()), *added.fields])
    types = [to_arrow_type(f.dataType) for f in schema.fields]
    names = schema.fieldNames()

    def run(batches):
        part = TaskContext.get().partitionId()
        before = None
        blank = (None,) * len(added)
        for batch in batches:
            out = []
            for value, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mark = fingerprint(code_points(body))
                if before is None:
                    out.append((value, part, "first", body, *blank))
                else:
                    out.append((before[0], part, None, None, *_compared(*before[1:], body, mark)))
                before = (value, body, mark)
                if len(out) >= 500:
                    yield _batch(out, types, names)
                    out = []
            if out:
                yield _batch(out, types, names)
        if before:
            yield _batch([(before[0], part, "last", before[1], *blank)], types, names)

    def end(batches):
        for batch in batches:
            out = []
            for value, one, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marks = fingerprint(code_points(one)), fingerprint(code_points(other))
                out.append((value, *_compared(one, marks[0], other, marks[1])))
            yield _batch(out, [types[0], *types[4:]], ["key", *names[4:]])

    columns = ["key", "n_chars", edited_as(F.col("edited")).alias("edited"), *added.fieldNames()[2:]]
    kept = written(ranged.mapInArrow(run, schema).select("part", "end", "text", *columns), "compared")
    firsts = kept.filter("end = 'first'").select("part", F.col("text").alias("next_text"))
    # One row per partition: the next one that has rows, and after the last the first.
    line = Window.orderBy("part")
    everything = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select(
        F.col("part").alias("last_part"),
        F.coalesce(F.lead("part").over(line), F.min("part").over(everything)).alias("part"),
    )
    lasts = kept.filter("end = 'last'").select("key", "text", F.col("part").alias("last_part"))
    met = lasts.join(following, "last_part").join(firsts, "part").select("key", "text", "next_text")
    # A row for each partition of the documents, so a task may take those of many.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.coalesce(max(1, partitions // ENDS_PER_TASK))
    rest = met.mapInArrow(end, T.StructType([key, *added.fields])).select(*columns)
    digits = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return kept.filter("end is null").select(*rest.columns).union(rest).select(
        F.col("key").alias(order_by), "n_chars", "edited", *digits, "near_edited", "near_next"
    )


def _batch(rows, types, names):
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
