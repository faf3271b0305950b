"""SimHash near-duplicates with pivot distance tables.

A text's fingerprint has a bit set where over half of its shingles' hashes have it. Fingerprints
link at `bits` or fewer differing bits. Equal ones are one class first. Of the classes, those that
agree in some of the blocks the 64 bits are cut into meet in a run (with b blocks and at most k
differing bits, b - k blocks agree; each choice of b - k blocks is tried, so no link is lost). In a
run, the distances of every fingerprint to a set of reference fingerprints, the pivots, form a
table; a pair whose distances to any pivot differ by more than k cannot link and is discarded; the
others are verified. Runs are searched from linked to linked fingerprint, each compared only with
those not yet reached, so that a dense run gives as many links as it has members, not all pairs.
Runs of over RUN_ROWS are dealt out as pairs of shards.

Defined results: a null text counts as empty; texts without words have fingerprint zero and link like
any other; a null id never is a component's id unless all its ids are null; repeated rows give
repeated results; only the id and text columns are read.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillstar.llm.common import attached, map_rows, written
from tillstar.llm.components import connected_components

BITS = 4
SHINGLE_WORDS = 4
SEED = 42
PIVOTS = 16
RUN_ROWS = 200_000
# Runs up to this size are compared pair by pair, all runs of a batch at once.
SHORT_RUN = 24
# Words hashed at once.
CHUNK_WORDS = 20_000


def fingerprint(text, words=SHINGLE_WORDS):
    """The text's fingerprint, unsigned."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    words = min(words, len(parts))
    shingles = len(parts) - words + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, shingles, CHUNK_WORDS):
        chunk = parts[start : start + CHUNK_WORDS + words - 1]
        joined = b" ".join(chunk)
        lengths = np.fromiter(map(len, chunk), np.int64, len(chunk))
        ends = np.cumsum(lengths + 1) - 1
        cuts = zip((ends - lengths)[: len(chunk) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
        hashes = b"".join(map(xxhash.xxh64_digest, [joined[a:b] for a, b in cuts], repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > shingles).tobytes(), "big")


def fingerprints(df, text="text", words=SHINGLE_WORDS, keep=None):
    """Rows with `fp`, the fingerprint as a signed number."""

    def make():
        def work(texts):
            found = np.array([fingerprint(t or "", words) for t in texts.to_pylist()], np.uint64)
            return [pa.array(found.view(np.int64))]

        return work

    return map_rows(df, [F.col(text)], make, {"fp": "bigint"}, keep)


def hex_digits(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _blocks(rows, bits):
    """As many blocks as make a run's key about as long as the number of rows has bits."""
    for count in range(bits + 1, bits + 6):
        if 64 * (count - bits) // count >= max(1, rows).bit_length() - 3:
            break
    return count


def _masks(count, agreeing):
    """A mask for each choice of agreeing blocks, signed."""
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(count)]
    sums = [sum(chosen) for chosen in combinations(blocks, agreeing)]
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def pivot_points(count=PIVOTS):
    """Reference fingerprints, spread by a fixed generator."""
    return np.random.default_rng(SEED).integers(0, 2**64, count, np.uint64)


def pivot_table(points, pivots):
    """Distances of each point to each pivot."""
    return np.bitwise_count(points[None, :] ^ pivots[:, None]).astype(np.int8)


def _near(points, table, one, others, bits):
    """Which of the others link with one: pivots discard first, the rest is verified."""
    left = others
    for row in table:
        left = left[np.abs(row[left] - row[one]) <= bits]
        if not len(left):
            return left
    return left[np.bitwise_count(points[left] ^ points[one]) <= bits]


def run_links(points, table, bits):
    """Links that connect what is connected in one run, as pairs of positions."""
    unseen = np.arange(len(points))
    found = []
    while len(unseen):
        reached, unseen = [unseen[0]], unseen[1:]
        while reached and len(unseen):
            one = reached.pop()
            near = _near(points, table, one, unseen, bits)
            if len(near):
                found.append(np.stack([np.full(len(near), one), near]))
                reached += near.tolist()
                unseen = np.setdiff1d(unseen, near, assume_unique=True)
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _short_runs_links(points, table, run, bits):
    """Links within short runs: all rows are compared with the one 1, 2, ... places on."""
    found = []
    here = np.arange(len(points))
    for step in range(1, SHORT_RUN):
        here = here[here + step < len(points)]
        here = here[run[here] == run[here + step]]
        if not len(here):
            break
        close = here
        for row in table:
            close = close[np.abs(row[close] - row[close + step]) <= bits]
        close = close[np.bitwise_count(points[close] ^ points[close + step]) <= bits]
        found.append(np.stack([close, close + step]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _links_of_runs(batches, bits):
    """Links of the runs in sorted batches of (key columns, fp); a run may go over batches."""
    pivots = pivot_points()
    for batch in _whole_runs(batches):
        *keys, fps = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        change = np.zeros(len(fps), bool)
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        run = np.cumsum(change)
        sizes = np.bincount(run)
        points = fps.astype(np.int64).view(np.uint64)
        table = pivot_table(points, pivots)
        short = np.flatnonzero(sizes[run] <= SHORT_RUN)
        pairs = [short[_short_runs_links(points[short], table[:, short], run[short], bits)]]
        starts = np.cumsum(sizes) - sizes
        for k in np.flatnonzero(sizes > SHORT_RUN):
            span = slice(starts[k], starts[k] + sizes[k])
            pairs.append(starts[k] + run_links(points[span], table[:, span], bits))
        a, b = np.concatenate(pairs, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], ["a", "b"])


def _whole_runs(batches):
    """Batches regrouped so that none ends within a run."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = _key(batch, batch.num_rows - 1)
        same = np.ones(batch.num_rows, bool)
        for column, value in zip(batch.columns[:-1], last, strict=True):
            same &= column.to_numpy(zero_copy_only=False) == value
        cut = batch.num_rows - int(same.sum())
        if held and (cut or _key(held[-1], 0) != last):
            yield pa.concat_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield batch.slice(0, cut)
        held.append(batch.slice(cut))
    if held:
        yield pa.concat_batches(held)


def _key(batch, row):
    return [c[row].as_py() for c in batch.columns[:-1]]


def links(classes, bits=BITS, run_rows=RUN_ROWS):
    """Links between distinct fingerprints (column fp), enough to connect what is connected."""
    rows = classes.count()
    blocks = _blocks(rows, bits)
    masks = _masks(blocks, blocks - bits)
    keyed = [F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    each = F.explode(F.array(*keyed))
    dealt = classes.select("fp", each.alias("k")).select("k.choice", "k.key", "fp")
    sizes = dealt.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n"))
    long = written(sizes.filter(F.col("n") > run_rows), "long_runs")
    if long.isEmpty():
        dealt = dealt.withColumn("cell", F.lit(0))
    else:
        # Every pair of shards is a run of its own, so each pair of members meets in one.
        shards = F.ceil(2 * F.col("n") / run_rows).cast("int")
        own = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
        cells = F.transform(
            F.sequence(F.lit(0), F.col("shards") - 1),
            lambda other: F.least("own", other) * F.col("shards") + F.greatest("own", other),
        )
        dealt = (
            dealt.join(long.withColumn("shards", shards).drop("n"), ["choice", "key"], "left")
            .withColumn("shards", F.coalesce("shards", F.lit(1)))
            .withColumn("own", own)
            .select("choice", "key", F.explode(cells).alias("cell"), "fp")
        )
    keys = ["choice", "key", "cell"]
    runs = dealt.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, "fp")
    found = runs.mapInArrow(lambda batches: _links_of_runs(batches, bits), "a bigint, b bigint")
    return found.distinct()


def _placed(df, doc_id, text, words, bits):
    """(doc_id, text_hash, fp) of all documents, and (fp, least_id, rows, root) of all fingerprints."""
    source = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    source = source.withColumn("text_hash", F.xxhash64("text"))
    made = fingerprints(source, words=words, keep=["doc_id", "text_hash"])
    docs = written(made.select("row.doc_id", "row.text_hash", "fp"), "fingerprints")
    classes = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("rows")), "classes")
    components = connected_components(links(classes, bits))
    placed = classes.join(components, classes["fp"] == components["node"], "left").select(
        "fp", "least_id", "rows", F.coalesce("component", "fp").alias("root")
    )
    return docs, written(placed, "placed")


def groups(df, doc_id="doc_id", text="text", words=SHINGLE_WORDS, bits=BITS):
    """One row per document: doc_id, text_hash, fp, root, component_id.

    component_id is the smallest id reachable by links, root a fingerprint of the component.
    """
    docs, placed = _placed(df, doc_id, text, words, bits)
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    of_fp = attached(placed, written(least, "least"), "root", "n").select("fp", "root", "rows", "component_id")
    return attached(docs, written(of_fp, "of_fp"), "fp", "rows").select("doc_id", "text_hash", "fp", "root", "component_id")


# Keys of rows to drop that are broadcast, 17 bytes each and as much again in a hash table: 100 MB.
BROADCAST_KEYS = 1_000_000


def keep_one(df, doc_id="doc_id", text="text", words=SHINGLE_WORDS, bits=BITS, broadcast_keys=BROADCAST_KEYS):
    """The rows of df without near-duplicates: of each group the row with the smallest id.

    Null ids come last; of rows equal in id, the one with the smaller text hash stays, of rows equal
    in both, one. Which rows go is decided on keys alone, by minima that are taken map-side, so no
    group, however large, meets in one task. Up to `broadcast_keys` keys to drop are broadcast, and
    the texts stay where they are; beyond, texts and keys meet in a shuffle.
    """
    docs, placed = _placed(df, doc_id, text, words, bits)
    keys = ["_none", "_id", "_hash"]
    ids = docs.select(
        F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("text_hash").alias("_hash"), "fp"
    )
    best = F.min(F.struct(*keys)).alias("best")
    best_of_fp = ids.groupBy("fp").agg(best)
    kept = placed.join(best_of_fp, "fp").groupBy("root").agg(F.min("best").alias("best")).select("best.*")
    counted = ids.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    marked = counted.join(kept.withColumn("_kept", F.lit(True)), keys, "left")
    # Keys that go, and keys that stay but once.
    marked = written(marked.filter("_kept IS NULL OR _n > 1").select(*keys, F.col("_kept").isNotNull().alias("_kept")), "marked")

    def small(keys_of):
        return F.broadcast(keys_of) if keys_of.count() <= broadcast_keys else keys_of

    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(doc_id).isNull().alias("_none"),
        F.coalesce(F.col(doc_id), F.lit(0)).alias("_id"),
        F.xxhash64(text).alias("_hash"),
    )
    rows = rows.join(small(marked.filter("NOT _kept").select(keys)), keys, "left_anti")
    repeated = marked.filter("_kept").select(keys)
    if not repeated.isEmpty():
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("_id"))
        first = rows.join(small(repeated), keys, "left_semi").withColumn("_place", place).filter("_place = 1").drop("_place")
        rows = rows.join(small(repeated), keys, "left_anti").unionByName(first)
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
