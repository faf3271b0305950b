"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

token_pieces() turns each text into token ids, ended by an end id, and cuts only those longer than
a sequence. pack() places pieces. Pieces as long as a sequence fill one each. The others are dealt
at random into chunks of about CHUNK_ITEMS; each chunk is packed on several islands at once:

- the first packing is best fit by falling length, as it is or slightly shuffled;
- crossover injects whole, well-filled bins of one parent into the other, removes the bins that hold
  a document twice by then, and puts the documents displaced by that back by best fit;
- mutation empties some of the worst-filled bins and puts their documents back by best fit;
- after each epoch the best packing of an island goes to the next island of its chunk.

An island rests once its packing has as few bins as the lengths allow at all, for then none is
better. Then the worst-filled bins of all chunks are opened and their items packed together in the
same way, as the chunks' remainders fit each other.

Defined results: a null or empty text is its end id alone, one piece; repeated rows are separate
pieces; ties in length go by item number, so the same items give the same packing; an empty frame
gives an empty one; other columns are carried along by token_pieces.
"""

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tillstar.llm.common import map_rows, written
from tillstar.llm.word_bpe import model, shared_model

LIMIT = 2048
END_ID = 0
CHUNK_ITEMS = 4_096
ISLANDS = 2
EPOCHS = 2
POPULATION = 6
OFFSPRING = 10
ELITES = 2
# Bins filled less than this are opened for the second round.
WELL_FILLED = 0.97
ROUNDS = 2
# A chunk has far fewer bins than this many bits count.
BIN_BITS = 20

_STATE = "chunk bigint, island int, items array<bigint>, lengths array<int>, elites array<array<int>>"


def token_pieces(df, path, text="text", limit=LIMIT, keep=None):
    """One row per piece: the carried `row`, piece, start, length and its ids.

    ids are little-endian unsigned 32-bit numbers.
    """
    content = shared_model(df.sparkSession, path)
    end, step = END_ID.to_bytes(4, "little"), 4 * limit

    def make():
        ids_of = model(content.value).ids

        def cut(text):
            ids = ids_of(text or "") + end
            return [ids[i : i + step] for i in range(0, len(ids), step)]

        return lambda texts: [[cut(t) for t in texts.to_pylist()]]

    found = map_rows(df, [F.col(text)], make, {"pieces": "array<binary>"}, keep)
    return found.select("row", F.posexplode("pieces").alias("piece", "ids")).select(
        "row",
        "piece",
        (F.col("piece").cast("long") * limit).alias("start"),
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        "ids",
    )


class _Bins:
    """Bins of one packing: members, room left, and the open ones in order of room."""

    def __init__(self, lengths, limit):
        self.lengths, self.limit = lengths, limit
        self.members, self.room, self.open = [], [], []

    def add(self, members):
        room = self.limit - sum(self.lengths[i] for i in members)
        self.members.append(members)
        self.room.append(room)
        if room:
            insort(self.open, (room, len(self.members) - 1))

    def best_fit(self, item):
        at = bisect_left(self.open, (self.lengths[item], -1))
        if at == len(self.open):
            self.add([item])
            return
        room, number = self.open.pop(at)
        self.members[number].append(item)
        self.room[number] = room = room - self.lengths[item]
        if room:
            insort(self.open, (room, number))

    def fit_all(self, items):
        for item in sorted(items, key=lambda i: (-self.lengths[i], i)):
            self.best_fit(item)
        return self

    def fitness(self):
        """Fewer bins first, then the more uneven filling, which leaves more to be merged."""
        return -len(self.members), sum((self.limit - r) ** 2 for r in self.room)


def _first(lengths, limit, rng=None):
    """Best fit by falling length; with rng, lengths are blurred for the order."""
    bins = _Bins(lengths, limit)
    if rng is None:
        return bins.fit_all(range(len(lengths)))
    blurred = np.asarray(lengths) * rng.uniform(0.85, 1.15, len(lengths))
    for item in np.argsort(-blurred, kind="stable").tolist():
        bins.best_fit(item)
    return bins


def crossover(one, other, rng):
    """A child of one with whole well-filled bins of the other."""
    by_room = np.argsort(other.room, kind="stable")
    best = by_room[: max(1, len(by_room) // 2)]
    chosen = best[rng.random(len(best)) < rng.uniform(0.1, 0.6)].tolist()
    child = _Bins(one.lengths, one.limit)
    injected = set()
    for number in chosen:
        child.add(list(other.members[number]))
        injected.update(other.members[number])
    displaced = []
    for members in one.members:
        left = [i for i in members if i not in injected]
        if len(left) == len(members):
            child.add(list(members))
        else:
            displaced += left
    return child.fit_all(displaced)


def mutate(bins, rng):
    """Some of the worst-filled bins are emptied and their items put back."""
    by_room = np.argsort(-np.asarray(bins.room), kind="stable")
    worst = by_room[: max(2, len(by_room) // 10)]
    emptied = set(worst[rng.random(len(worst)) < 0.5].tolist())
    child, displaced = _Bins(bins.lengths, bins.limit), []
    for number, members in enumerate(bins.members):
        if number in emptied:
            displaced += members
        else:
            child.add(list(members))
    rng.shuffle(displaced)
    for item in displaced:
        child.best_fit(item)
    return child


def _from_numbers(numbers, lengths, limit):
    bins = _Bins(lengths, limit)
    members = {}
    for item, number in enumerate(numbers):
        members.setdefault(number, []).append(item)
    for group in members.values():
        bins.add(group)
    return bins


def _numbers(bins):
    numbers = [0] * len(bins.lengths)
    for number, members in enumerate(bins.members):
        for item in members:
            numbers[item] = number
    return numbers


def least_bins(lengths, limit):
    """A number of bins that no packing can go below.

    For each small length, items that leave less room than it are alone, other items over half a bin
    need one each, and what else is at least that long needs the room these leave or more bins.
    """
    x = np.sort(np.asarray(lengths, np.int64))
    if not len(x):
        return 0
    sums = np.concatenate([[0], np.cumsum(x)])
    half = np.searchsorted(x, limit // 2, "right")
    small = np.unique(np.concatenate([[0], x[:half]]))
    alone = np.searchsorted(x, limit - small, "right")
    from_small = np.searchsorted(x, small, "left")
    over = np.maximum(alone, half)
    room = (over - half) * limit - (sums[over] - sums[half])
    more = np.maximum(0, sums[half] - sums[from_small] - room)
    return int((len(x) - half + -(-more // limit)).max())


def evolve(lengths, elites, limit, rng, offspring=OFFSPRING):
    """The best packings after one epoch on one island."""
    least = least_bins(lengths, limit)
    population = [_from_numbers(e, lengths, limit) for e in elites] or [_first(lengths, limit)]
    ranked = sorted(population, key=_Bins.fitness, reverse=True)
    if len(ranked[0].members) > least:
        while len(ranked) < POPULATION:
            ranked.append(_first(lengths, limit, rng))
        for _ in range(offspring):
            one, other = (ranked[int(len(ranked) * rng.random() ** 2)] for _ in range(2))
            child = mutate(one, rng) if one is other else crossover(one, other, rng)
            ranked = sorted([*ranked, child], key=_Bins.fitness, reverse=True)[:POPULATION]
            if len(ranked[0].members) == least:
                break
    return [_numbers(bins) for bins in ranked[:ELITES]]


def _epoch(batches, limit, islands, epoch):
    """Each island's state after an epoch, and its best packing as a guest of the next island."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            rng = np.random.default_rng([epoch, row["island"], row["chunk"] & 0xFFFFFFFF])
            elites = evolve(row["lengths"], row["elites"], limit, rng)
            rows.append({**row, "elites": elites})
            if islands > 1:
                guest = {"chunk": row["chunk"], "island": (row["island"] + 1) % islands}
                rows.append({**guest, "items": None, "lengths": None, "elites": elites[:1]})
        yield pa.RecordBatch.from_pylist(rows, batch.schema)


def _placed(batches, limit):
    """Bin, fill and offset of each item in a chunk's packing."""
    for batch in batches:
        columns = {"item": [], "length": [], "chunk": [], "bin": [], "offset": [], "fill": []}
        for row in batch.to_pylist():
            for number, members in enumerate(_from_numbers(row["best"], row["lengths"], limit).members):
                fill = sum(row["lengths"][i] for i in members)
                at = 0
                for i in members:
                    values = (row["items"][i], row["lengths"][i], row["chunk"], number, at, fill)
                    for column, value in zip(columns.values(), values, strict=True):
                        column.append(value)
                    at += row["lengths"][i]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
        arrays = [pa.array(c, t) for c, t in zip(columns.values(), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(columns))


def _pack_once(items, limit, chunk_items, islands, epochs):
    """item, length, chunk, bin, offset, fill: every item placed in a bin of its chunk."""
    chunks = max(1, -(-items.count() // chunk_items))
    pairs = F.sort_array(F.collect_list(F.struct("item", "length")))
    chunked = items.groupBy(F.pmod(F.xxhash64("item"), F.lit(chunks)).alias("chunk")).agg(pairs.alias("pairs"))
    state = chunked.select(
        "chunk",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.col("pairs.item").alias("items"),
        F.col("pairs.length").alias("lengths"),
        F.array().cast("array<array<int>>").alias("elites"),
    )
    for epoch in range(epochs):
        # One row per island again, its guest's packing beside its own.
        met = state.groupBy("chunk", "island").agg(
            F.max("items").alias("items"), F.max("lengths").alias("lengths"),
            F.flatten(F.array_sort(F.collect_list("elites"))).alias("elites"),
        )
        state = met.mapInArrow(lambda b, epoch=epoch: _epoch(b, limit, islands, epoch), _STATE)
    state = written(state.filter("items is not null"), "islands")
    scored = state.withColumn("best", F.col("elites")[0])
    best = scored.groupBy("chunk").agg(
        F.min_by(F.struct("items", "lengths", "best"), F.struct(F.array_max("best"), "island")).alias("s")
    )
    return best.select("chunk", "s.*").mapInArrow(
        lambda b: _placed(b, limit),
        "item bigint, length int, chunk bigint, bin int, offset bigint, fill int",
    )


def pack(items, limit=LIMIT, chunk_items=CHUNK_ITEMS, islands=ISLANDS, epochs=EPOCHS, rounds=ROUNDS):
    """A place for every item: item, sequence_id, offset.

    items: columns item (unique numbers) and length (1 to limit).
    """
    alone = items.filter(F.col("length") >= limit)
    done = alone.select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = items.filter(F.col("length") < limit).select("item", F.col("length").cast("int").alias("length"))
    for turn in range(rounds):
        placed = written(_pack_once(left, limit, chunk_items, islands, epochs), f"round{turn}")
        closed = placed
        if turn < rounds - 1:
            closed = placed.filter(F.col("fill") >= WELL_FILLED * limit)
            left = placed.filter(F.col("fill") < WELL_FILLED * limit).select("item", "length")
        sequence = F.shiftleft(F.col("chunk") * rounds + turn, BIN_BITS) + F.col("bin")
        done = done.union(closed.select("item", sequence.alias("sequence_id"), "offset"))
    return done


def pack_documents(df, path, doc_id="doc_id", text="text", limit=LIMIT):
    """Every piece of every text in its sequence.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    found = token_pieces(df, path, text, limit, keep=[doc_id])
    pieces = found.select(
        F.col(f"row.`{doc_id}`").alias("doc_id"),
        "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.monotonically_increasing_id().alias("item"),
    )
    pieces = written(pieces, "pieces")
    return pieces.join(pack(pieces.select("item", "length"), limit), "item").drop("item")


def sequences(pieces):
    """The packed sequences: sequence_id and ids, from pieces with sequence_id, offset and ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    empty = F.lit(b"")
    joined = F.aggregate(parts, empty, lambda ids, part: F.concat(ids, part["ids"]))
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"))
