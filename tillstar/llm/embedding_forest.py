"""Near-duplicate vectors by a forest of random-projection trees with spill.

Equal vectors are one class first. Dense groups, which any split would cut, are found in a sample
and leave the trees: the core of a centre is all within CORE link angles of it, its leaf all within one
link angle more, so that every link of a vector of the core is in that leaf, without exception.

Each tree splits the other classes again and again along random directions, of which neighbouring
nodes take different ones, at the middle of a sample; vectors near a split go to both sides, so that
close ones rarely part. A deeper forest has more trees, as each level may part a pair. Leaves are
large, since a vector is sent once for each leaf it is in, in its own precision. Within the leaves every
pair is verified by its cosine in double precision (single precision, whose error is bounded, decides
which pairs are looked at), links are counted and united to components. A pair that meets in several
leaves counts in the one with the smallest number only: leaves follow from the vector in whole
numbers, whose sums are exact, so every task finds the same ones again. No pairs are written: a leaf
gives a count for each member and links enough to connect what is connected. Leaves of over LEAF_ROWS
members are dealt out as pairs of shards.

Splits and centres are fitted on a sample of at most about SAMPLE_ROWS classes, chosen by a hash of the
vector; every vector is in every tree or in a core. A tree has at most 2 ** MOST_LEVELS leaves and
there are at most MOST_CENTRES centres, so that what is broadcast is bounded; groups without a centre
are in the trees.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing, nor do vectors of different lengths; repeated rows are separate vectors that link; a null
id is never a component's id unless all its ids are null. Only id and vector are read.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tillstar.llm.common import attached, map_rows, sampled, written
from tillstar.llm.components import connected_components

COSINE = 0.9
# Trees at least; a third of the levels and two if that is more.
TREES = 3
# Members aimed at in a leaf.
LEAF = 8_192
MOST_LEVELS = 14
SAMPLE_ROWS = 50_000
LEAF_ROWS = 20_000
# Width of the overlap on each side of a split, in typical projected distances of a linked pair.
SPILL = 0.45
# About the share of a node's members that a child gets with that overlap.
SHRINK = 0.58
# Directions of a level; nodes whose last four turns differ take different ones.
DIRECTIONS = 16
# A core reaches beyond the link angle, for groups in which only some pairs are links.
CORE = 1.4
# A core has at least so many sampled vectors (and DENSE of all, or LEAF if that is less), and its leaf
# at most WIDEST times as many, so that a leaf is not much more than a dense group.
DENSE_SAMPLE = 8
DENSE = 512
WIDEST = 4
CANDIDATES = 8_192
MOST_CENTRES = 512
SEED = 17
BLOCK = 2_048
# Rows routed at once: bounds their copies.
ROUTED_ROWS = 1_024
# Vectors and directions are rounded to multiples of 1 / GRID for routing: their products' sums are whole
# numbers of at most 53 bits, so the order of adding does not matter.
GRID = float(1 << 20)


class Forest:
    """Centres, and directions and split points of the trees, for vectors of one length."""

    def __init__(self, sample, rows, cosine, trees=TREES, leaf=LEAF):
        dims = sample.shape[1]
        rng = np.random.default_rng([SEED, dims])
        angle = np.arccos(np.clip(cosine, -1, 1))
        self.core = np.cos(min(np.pi, CORE * angle))
        # Rounding moves a vector by half a grid step a component at most.
        self.wide = np.cos(min(np.pi, (CORE + 1) * angle)) - 8 * np.sqrt(dims) / GRID
        least = min(DENSE, leaf) * len(sample) / max(1, rows)
        self.centres, rest = self._dense(sample, max(DENSE_SAMPLE, least), rng)
        self.centres = np.rint(self.centres * GRID)
        rows = rows * len(rest) / max(1, len(sample))
        self.levels = min(MOST_LEVELS, max(0, int(np.ceil(np.log(max(1, rows / leaf)) / -np.log(SHRINK)))))
        self.directions = rng.standard_normal((max(trees, 2 + self.levels // 3), self.levels * DIRECTIONS, dims))
        self.directions /= np.linalg.norm(self.directions, axis=2, keepdims=True) + 1e-300
        self.directions = np.rint(self.directions * GRID)
        self.margin = SPILL * np.sqrt((2 - 2 * cosine) / dims)
        self.splits = [self._fit(self._along(rest, d)) for d in self.directions]

    @staticmethod
    def _along(vectors, lines):
        """Cosines with lines given in grid steps, the same however many vectors come together."""
        return np.rint(vectors * GRID) @ lines.T / GRID**2

    def _dense(self, sample, least, rng):
        """Centres of dense groups, and the sampled vectors that are in no core."""
        candidates = rng.permutation(len(sample))[:CANDIDATES]
        # Rounded, as it only decides which candidates are tried, and in which order.
        small = sample.astype(np.float32)
        near, wide = np.zeros(len(candidates), np.int64), np.zeros(len(candidates), np.int64)
        for at in range(0, len(candidates), 128):
            along = small[candidates[at : at + 128]] @ small.T
            near[at : at + 128] = (along >= self.core).sum(axis=1)
            wide[at : at + 128] = (along >= self.wide).sum(axis=1)
        centres, rest = [], np.ones(len(sample), bool)
        for k in np.argsort(-near, kind="stable"):
            if near[k] < least or len(centres) == MOST_CENTRES:
                break
            if not rest[candidates[k]] or wide[k] > WIDEST * near[k]:
                continue
            new = rest & (sample @ sample[candidates[k]] >= self.core)
            if new.sum() >= max(least, wide[k] / WIDEST):
                centres.append(candidates[k])
                rest &= ~new
        return sample[centres].reshape(-1, sample.shape[1]), sample[rest]

    @staticmethod
    def _column(level, node):
        return level * DIRECTIONS + node % DIRECTIONS

    def _fit(self, along):
        """For each level the middle of each node's sample."""
        node = np.zeros(len(along), np.int64)
        splits = []
        for level in range(self.levels):
            at = along[np.arange(len(along)), self._column(level, node)]
            order = np.lexsort((at, node))
            ends = np.searchsorted(node[order], np.arange(2**level + 1))
            split = np.zeros(2**level)
            some = ends[1:] > ends[:-1]
            split[some] = at[order[(ends[:-1] + ends[1:])[some] // 2]]
            splits.append(split)
            node = 2 * node + (at >= split[node])
        return splits

    def leaves(self, vectors):
        """(row, leaf number) for every leaf a unit vector is in; those of centres are below zero."""
        near = self._along(vectors, self.centres)
        row, centre = np.nonzero(near >= self.wide)
        rows, numbers = [row], [centre - len(self.centres)]
        rest = np.flatnonzero(~(near >= self.core).any(axis=1))
        for tree, (directions, splits) in enumerate(zip(self.directions, self.splits, strict=True)):
            along = self._along(vectors[rest], directions)
            row, node = np.arange(len(rest)), np.zeros(len(rest), np.int64)
            for level in range(self.levels):
                gap = along[row, self._column(level, node)] - splits[level][node]
                right, left = gap >= -self.margin, gap < self.margin
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
                row = np.concatenate([row[left], row[right]])
            rows.append(rest[row])
            numbers.append(tree << MOST_LEVELS | node)
        return np.concatenate(rows), np.concatenate(numbers)


def _units(rows):
    """Unit vectors of the rows, which are finite and not zero."""
    # Scaled by the largest component first, so that no norm over- or underflows.
    units = rows.astype(np.float64)
    units /= np.abs(units).max(axis=1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    return units + 0.0


def usable_vectors(lists, kind):
    """Of each list its numbers as bytes, and a key that those with the same unit vector share; None
    if there is no unit vector."""
    found, keys = [None] * len(lists), [None] * len(lists)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    for dims in np.unique(lengths[lengths > 0]).tolist():
        at = np.flatnonzero(lengths == dims)
        flat = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        rows = flat.astype(kind).reshape(-1, dims)
        largest = np.abs(rows).max(axis=1)
        good = np.flatnonzero(np.isfinite(largest) & (largest > 0))
        for k, row, unit in zip(at[good].tolist(), rows[good], _units(rows[good]), strict=True):
            found[k] = row.tobytes()
            keys[k] = hashlib.blake2b(unit.tobytes(), digest_size=16).digest()
    return [found, keys]


def _matrix(column, dims, kind):
    return _units(np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims))


def _dims(column, kind):
    return pc.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize


def _leaves_of(batches, forests, kind):
    """Per part of a batch: its number of components, its rows, and (row, leaf number) of each leaf."""
    for whole in batches:
        for start in range(0, whole.num_rows, ROUTED_ROWS):
            batch = whole.slice(start, ROUTED_ROWS)
            lengths = _dims(batch.column("vector"), kind)
            for dims in np.unique(lengths).tolist():
                part = batch.take(pa.array(np.flatnonzero(lengths == dims)))
                forest = forests.get(dims)
                if forest:
                    row, leaf = forest.leaves(_matrix(part.column("vector"), dims, kind))
                else:
                    row, leaf = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
                yield dims, part, row, leaf


def _counted(batches, forests, kind):
    """How many members each leaf gets."""
    for dims, _, _, leaf in _leaves_of(batches, forests, kind):
        numbers, count = np.unique(leaf, return_counts=True)
        columns = [np.full(len(numbers), dims, np.int32), numbers, count]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["dims", "leaf", "n"])


def _routed(batches, forests, kind):
    """Each class once for each leaf it is in."""
    for dims, part, row, leaf in _leaves_of(batches, forests, kind):
        columns = part.take(pa.array(row)).columns
        keys = [pa.array(np.full(len(row), dims, np.int32)), pa.array(leaf)]
        yield pa.RecordBatch.from_arrays([*keys, *columns], ["dims", "leaf", *part.schema.names])


def _runs(batches, keys):
    """Rows of each run of equal keys in sorted batches, whole runs only."""
    held, last = [], None
    for batch in batches:
        columns = [batch.column(k).to_numpy() for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.concat_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.concat_batches(held)


def _linked_pairs(units, shard, cosine):
    """Pairs of positions with at least the cosine; of two shards only those across."""
    across = len(np.unique(shard)) > 1
    small = units.astype(np.float32)
    # More than single precision can be wrong by, with unit vectors.
    error = 2.0**-23 * (units.shape[1] + 8)
    for i in range(0, len(units), BLOCK):
        for j in range(i, len(units), BLOCK):
            along = small[i : i + BLOCK] @ small[j : j + BLOCK].T
            a, b = np.nonzero(along >= np.float32(cosine - error))
            unsure = np.flatnonzero(along[a, b] <= cosine + error)
            a, b = a + i, b + j
            keep = a < b
            if across:
                keep &= shard[a] != shard[b]
            for start in range(0, len(unsure), 100_000):
                at = unsure[start : start + 100_000]
                keep[at] &= np.einsum("ij,ij->i", units[a[at]], units[b[at]]) >= cosine
            if keep.any():
                yield a[keep], b[keep]


def _earlier(leaves, a, b, leaf):
    """Which pairs meet in a leaf of a smaller number too."""
    members, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    lists = [leaves[m] for m in members]
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.concatenate(lists)
    owner, flat = owner[flat < leaf], flat[flat < leaf]
    names, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    if not shared.any():
        return np.zeros(len(a), bool)
    _, column = np.unique(column[shared], return_inverse=True)
    table = np.zeros((len(members), column.max() + 1), np.float32)
    table[owner[shared], column] = 1
    a, b = where[: len(a)], where[len(a) :]
    met = np.zeros(len(a), bool)
    for start in range(0, len(a), 200_000):
        part = slice(start, start + 200_000)
        rows, of = np.unique(a[part], return_inverse=True)
        both = table[rows] @ table.T
        met[part] = both[of, b[part]] > 0
    return met


def _forest_links(size, a, b):
    """As many of the pairs as connect what all of them connect."""
    parent = np.arange(size)
    found = []
    while len(a):
        # Every root takes the smallest root it is linked to; those links are kept.
        low, high = np.minimum(a, b), np.maximum(a, b)
        best = np.full(size, size)
        np.minimum.at(best, high, low)
        roots = np.flatnonzero(best < size)
        found.append(np.stack([roots, best[roots]]))
        parent[roots] = best[roots]
        while (parent != parent[parent]).any():
            parent = parent[parent]
        a, b = parent[a], parent[b]
        a, b = a[a != b], b[a != b]
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def _leaf_lists(forest, units):
    """Of each vector the numbers of the leaves it is in."""
    found = []
    for start in range(0, len(units), ROUTED_ROWS):
        part = units[start : start + ROUTED_ROWS]
        row, leaf = forest.leaves(part)
        order = np.argsort(row, kind="stable")
        found += np.split(leaf[order], np.searchsorted(row[order], np.arange(1, len(part))))
    return found


def _compared(batches, forests, kind, cosine):
    """Per leaf: links counted for each member as (a, null, n), and connecting links as (a, b, 0)."""
    for run in _runs(batches, 3):
        dims = run.column(0)[0].as_py()
        leaf = run.column(1)[0].as_py()
        ids, weight = run.column(3).to_numpy(), run.column(4).to_numpy()
        shard = run.column(5).to_numpy()
        units = _matrix(run.column(6), dims, kind)
        counts, kept_a, kept_b, lists = np.zeros(len(ids), np.int64), [], [], None
        for a, b in _linked_pairs(units, shard, cosine):
            if dims in forests:
                lists = lists or _leaf_lists(forests[dims], units)
                new = ~_earlier(lists, a, b, leaf)
                a, b = a[new], b[new]
            np.add.at(counts, a, weight[b])
            np.add.at(counts, b, weight[a])
            x, y = _forest_links(len(ids), a, b)
            kept_a.append(x)
            kept_b.append(y)
        at = np.flatnonzero(counts)
        if not len(at):
            continue
        x, y = np.concatenate(kept_a), np.concatenate(kept_b)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([ids[at], ids[x]])),
                pa.concat_arrays([pa.nulls(len(at), pa.int64()), pa.array(ids[y])]),
                pa.array(np.concatenate([counts[at], np.zeros(len(x), np.int64)])),
            ],
            ["a", "b", "n"],
        )


def _fitted(classes, rows, kind, cosine, trees, leaf, sample_rows):
    """A forest for each length of vectors in a sample."""
    chosen = sampled(classes.select("key", "vector"), min(1.0, sample_rows / max(1, rows)), SEED, "key")
    sample = chosen.toArrow().sort_by("key")
    vectors = sample["vector"].combine_chunks()
    lengths = _dims(vectors, kind)
    forests = {}
    for dims in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dims)
        share = len(at) / len(lengths)
        units = _matrix(vectors.take(pa.array(at)), dims, kind)
        forests[dims] = Forest(units, rows * share, cosine, trees, leaf)
    return forests


def near_duplicates(
    df, vec_id="vec_id", vector="embedding", cosine=COSINE, trees=TREES, leaf=LEAF,
    sample_rows=SAMPLE_ROWS, leaf_rows=LEAF_ROWS,
):
    """One row per vector: vec_id, n_links, component_id, kept."""
    picked = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    kind = "<f4" if picked.schema["vector"].dataType.elementType.typeName() == "float" else "<f8"
    found = map_rows(
        picked, [F.col("vector")], lambda: lambda lists: usable_vectors(lists, kind),
        {"vector": "binary", "key": "binary"}, keep=["vec_id"],
    )
    source = written(found.select("row.vec_id", "vector", "key"), "vectors")
    # Any of a class's vectors will do, as they have one unit vector.
    classes = source.filter("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector")
    )
    classes = written(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    forests = _fitted(classes, classes.count(), kind, cosine, trees, leaf, sample_rows)
    shared = df.sparkSession.sparkContext.broadcast(forests)
    sizes = classes.select("vector").mapInArrow(
        lambda batches: _counted(batches, shared.value, kind), "dims int, leaf bigint, n bigint"
    )
    sizes = sizes.groupBy("dims", "leaf").agg(F.sum("n").alias("count"))
    long = written(sizes.filter(F.col("count") > leaf_rows), "long_leaves")
    members = classes.select("class", "weight", "vector").mapInArrow(
        lambda batches: _routed(batches, shared.value, kind),
        "dims int, leaf bigint, class bigint, weight bigint, vector binary",
    )
    if long.isEmpty():
        members = members.withColumn("cell", F.lit(0)).withColumn("shard", F.lit(0))
    else:
        # Every two shards are a cell, and each shard is one of its own.
        shards = long.select("dims", "leaf", F.ceil(2 * F.col("count") / leaf_rows).cast("int").alias("shards"))
        cells = F.transform(
            F.sequence(F.lit(0), F.col("shards") - 1),
            lambda other: F.least("shard", other) * F.col("shards") + F.greatest("shard", other),
        )
        members = (
            members.join(shards, ["dims", "leaf"], "left")
            .withColumn("shards", F.coalesce("shards", F.lit(1)))
            .withColumn("shard", F.pmod(F.xxhash64("class"), F.col("shards")).cast("int"))
            .withColumn("cell", F.explode(cells))
        )
    keys = ["dims", "leaf", "cell"]
    dealt = members.select(*keys, "class", "weight", "shard", "vector")
    compared = dealt.repartition(*keys).sortWithinPartitions(*keys, "class").mapInArrow(
        lambda batches: _compared(batches, shared.value, kind, cosine), "a bigint, b bigint, n bigint"
    )
    compared = written(compared, "compared")
    counts = compared.filter("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    components = connected_components(compared.filter("b is not null").select("a", "b"))
    placed = (
        classes.select("class", "key", "weight", "least_id")
        .join(counts, "class", "left")
        .join(components.withColumnRenamed("node", "class"), "class", "left")
        .select("key", "least_id", "weight", F.coalesce("component", "class").alias("root"),
                (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    placed = written(placed, "placed")
    least = placed.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    of_class = attached(placed, written(least, "least"), "root", "n")
    of_class = written(of_class.select("key", "weight", "n_links", "component_id"), "of_class")
    ids = source.select("vec_id", "key")
    linked = attached(ids, of_class, "key", "weight").select("vec_id", "n_links", "component_id")
    alone = ids.filter("key is null").select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id",
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
